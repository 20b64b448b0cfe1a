"""Connected components of a large graph by alternating stars.

Each round hangs the neighbours of a node on the smallest of them, first the larger
ones (which shortens long chains), then the smaller ones (which merges what is
left), until no edge changes. Rounds grow with the logarithm of the longest path.
An edge list never gets longer than it was, minima combine before the shuffle, and
both sides of each join are written tables, so Spark can split the join at a node
with very many neighbours. Nothing is collected but two sums a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerloom.session import staged


def _starred(edges: DataFrame, larger: bool) -> DataFrame:
    """Hang each node's larger (else smaller) neighbours on its smallest neighbour, itself included.

    `edges` is a written table (a, b) with a > b.
    """
    if larger:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = staged(both.groupBy("a").agg(F.min("b").alias("m")), "stars")
        hung = both.join(least, "a").filter(F.col("b") > F.col("a")).select(
            F.col("b").alias("a"), F.least("m", "a").alias("b")
        )
    else:
        least = staged(edges.groupBy("a").agg(F.min("b").alias("m")), "stars")
        joined = edges.join(least, "a")
        hung = joined.select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        hung = hung.select("e.a", "e.b").filter(F.col("a") > F.col("b"))
    return staged(hung.distinct(), "edges")


def _sums(edges: DataFrame) -> tuple:
    """Equal for equal edge lists."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every node of an edge list (a, b): the smallest id it can reach.

    Loops, repeated and reversed edges are fine; edges with a null end are ignored;
    nodes without an edge to another node are not returned.
    """
    now = staged(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    state = _sums(now)
    while state[0]:
        now = _starred(_starred(now, True), False)
        before, state = state, _sums(now)
        if before == state:
            break
    roots = now.select(F.col("b").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots)
