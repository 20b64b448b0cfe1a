"""Frames shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offerloom.llm import words

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


ARROW_ROWS, ARROW_BYTES = "1000", "4m"


def _give_back() -> None:
    """Hand memory that a task no longer uses back to the system; Python workers live on and take other tasks."""
    words.forget()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def map_arrow(frame: DataFrame, work, schema) -> DataFrame:
    """`mapInArrow` in batches of at most 1,000 rows and about 4 MB.

    Texts are long; the default batch would hold tens of megabytes several times
    over, in the JVM and in Python, for each task. No row is cut or left out. The two
    settings hold for the caller's session from here on, since Spark reads them when
    the query runs. What a task has held is given back at its end.
    """
    conf = frame.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            _give_back()

    return frame.mapInArrow(run, schema)
