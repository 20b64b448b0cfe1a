"""Exact dedup: group by a 128-bit content hash, compare bytes inside the groups.

Both dedup keys, the hash and the text itself, are grouping keys of one aggregate,
so rows are equal only if their bytes are, copies combine before the shuffle, and
no group is ever gathered. What leaves the aggregate is narrow: hash, kept id and
size of each text with copies. A hash that stands for several texts is a collision;
its rows, if there are any, are grouped and joined by the text as well.

Defined results: null text counts as empty; the kept id is the largest (or smallest)
id of a group that is not null; rows that repeat an id share its fate, so all rows
with the kept id stay; a group with null ids only keeps them all; only doc_id and
text are read, whatever other columns hold.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerloom.llm.frames import ascii_lower
from offerloom.session import staged


def content_hash(text: Column) -> Column:
    """128 bits of a text's SHA-256."""
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def copies(
    docs: DataFrame,
    carry: Sequence[Column | str],
    digest: Callable[[Column], Column] = content_hash,
    normal: Callable[[Column], Column] = ascii_lower,
    keep: Callable[..., Column] = F.max,
) -> DataFrame:
    """(row, keep_id, group_size, kept) for every document, `row` a struct of what to `carry`.

    Only what is carried moves with the join: a report carries ids and digests, a
    filter whole rows.
    """
    text = normal(F.col("text").cast("string"))
    keyed = docs.select(
        F.struct(*carry).alias("row"), F.col("doc_id").alias("id"), text.alias("normal"), digest(text).alias("content")
    )
    grouped = keyed.groupBy("content", "normal").agg(keep("id").alias("keep_id"), F.count("*").alias("group_size"))
    groups = staged(grouped.select("content", "keep_id", "group_size"), "text-groups")
    several = groups.filter("group_size > 1")
    collided = groups.groupBy("content").count().filter("count > 1").select("content")
    if collided.isEmpty():
        found = keyed.select("row", "id", "content").join(several, "content", "left")
    else:
        bad = staged(collided, "collisions")
        exact = keyed.join(bad, "content", "left_semi").groupBy("content", "normal")
        exact = exact.agg(keep("id").alias("keep_id"), F.count("*").alias("group_size"))
        clear = several.join(bad, "content", "left_anti").withColumn("normal", F.lit(None).cast("string"))
        known = clear.unionByName(exact).withColumnsRenamed({"content": "_content", "normal": "_normal"})
        same = (F.col("content") == F.col("_content")) & (F.col("_normal").isNull() | (F.col("_normal") == F.col("normal")))
        found = keyed.join(known, same, "left")
    size = F.coalesce("group_size", F.lit(1).cast("long"))
    keep_id = F.when(size == 1, F.col("id")).otherwise(F.col("keep_id"))
    return found.select(
        "row", keep_id.alias("keep_id"), size.alias("group_size"), keep_id.eqNullSafe(F.col("id")).alias("kept")
    )


def exact_dedup(docs: DataFrame) -> DataFrame:
    """The rows that stay, with all columns of `docs`."""
    return copies(docs, docs.columns).filter("kept").select("row.*")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every document."""
    sha = F.sha2(ascii_lower(F.col("text")), 256).alias("text_sha256")
    return copies(docs, ["doc_id", sha]).select("row.doc_id", "keep_id", "group_size", "kept", "row.text_sha256")
