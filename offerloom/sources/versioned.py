"""Tables with versions: data folders that never change, and manifests that say what a version holds.

A writer puts its rows into a folder of their own, checks them there, and then names
the folder in the next manifest. The manifest gets its final name in one rename that
fails if the name is taken, so a reader sees the whole old table or the whole new one,
a refused table is never seen, and of two writers that started from the same version
one fails. Readers keep the version they have opened.

Manifests are read and written by the driver through the file system that Spark uses;
there are at most `KEEP` of them, and each names a bounded number of folders.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

KEEP = 16  # versions that stay readable; older ones go with the data that only they name
MANIFESTS = "_manifests"


class Conflict(RuntimeError):
    """Another writer has published a version since this one began."""


@dataclass(frozen=True)
class Version:
    number: int
    folders: list[str]
    schema: str
    rows: int | None = None
    info: dict = field(default_factory=dict)


def _files(spark: SparkSession, path: str):
    """(file system, path) of Spark's own file access."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _names(spark: SparkSession, path: str) -> list[str]:
    files, place = _files(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(place)) if files.exists(place) else []


def _read_text(spark: SparkSession, path: str) -> str:
    files, place = _files(spark, path)
    stream = files.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _write_once(spark: SparkSession, path: str, text: str) -> None:
    """Put `text` under a name that must be free; nobody sees a part of it."""
    beside = f"{path}-{uuid.uuid4().hex}.part"
    files, place = _files(spark, beside)
    stream = files.create(place)
    stream.write(bytearray(text.encode()))
    stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(place.toUri(), spark._jsc.hadoopConfiguration())
    strict = spark._sc._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        context.rename(place, hadoop.Path(path), strict)
    except Exception as error:  # noqa: BLE001  (the file system's own class of error)
        files.delete(place, False)
        raise Conflict(f"{path} is there already") from error


def remove(spark: SparkSession, path: str) -> None:
    files, place = _files(spark, path)
    files.delete(place, True)


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return [int(n[:-5]) for n in _names(spark, f"{path}/{MANIFESTS}") if n.endswith(".json")]


def _manifest(path: str, number: int) -> str:
    return f"{path}/{MANIFESTS}/{number:012d}.json"


def version(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """The newest version, or the one asked for; None if there is no version yet."""
    if number is None:
        known = _numbers(spark, path)
        if not known:
            return None
        number = known[-1]
    return Version(**json.loads(_read_text(spark, _manifest(path, number))))


def publish(spark: SparkSession, path: str, new: Version) -> Version:
    """Make `new` the newest version, or raise Conflict; forget versions beyond `KEEP`."""
    _write_once(spark, _manifest(path, new.number), json.dumps(asdict(new)))
    old = _numbers(spark, path)[:-KEEP]
    if old:
        named = {f for n in _numbers(spark, path)[-KEEP:] for f in version(spark, path, n).folders}
        for number in old:
            for folder in set(version(spark, path, number).folders) - named:
                remove(spark, f"{path}/{folder}")
            remove(spark, _manifest(path, number))
    return new


def write_folder(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> tuple[str, int]:
    """Write rows beside the table; (folder, rows). Nobody reads them before a manifest names them."""
    folder, seen = f"data-{uuid.uuid4().hex}", Observation()
    df.observe(seen, F.count("*").alias("n")).write.partitionBy(*partition_by).parquet(f"{path}/{folder}")
    return folder, seen.get["n"]


def write_version(
    df: DataFrame,
    path: str,
    check: Callable[[DataFrame], None] | None = None,
    partition_by: Sequence[str] = (),
    info: dict | None = None,
) -> Version:
    """Replace the table by `df` as its next version; `check` may refuse the stored rows by raising."""
    spark = df.sparkSession
    before = version(spark, path)
    folder, rows = write_folder(df, path, partition_by)
    try:
        if check is not None:
            check(spark.read.schema(df.schema).parquet(f"{path}/{folder}").select(*df.columns))
        number = before.number + 1 if before else 1
        return publish(spark, path, Version(number, [folder], df.schema.json(), rows, info or {}))
    except BaseException:
        remove(spark, f"{path}/{folder}")
        raise


def read_folders(spark: SparkSession, path: str, folders: Sequence[str], schema: StructType) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    parts = [spark.read.schema(schema).parquet(f"{path}/{f}").select(*schema.names) for f in folders]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def read_version(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The rows of a version, the newest by default; later writes do not change what is read."""
    found = version(spark, path, number)
    if found is None:
        raise FileNotFoundError(f"no version under {path}")
    return read_folders(spark, path, found.folders, StructType.fromJson(json.loads(found.schema)))
