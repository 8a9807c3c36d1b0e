"""Connected components of an edge table by alternating large-star and small-star rounds.

Defined results: loops and repeated edges change nothing; edges have no nulls; a node without an edge is in no
component; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.staging import staged


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node, root: every node of edges (a, b) with the least node it can reach.

    Each round is two aggregations (combined before the shuffle) and joins, written to
    the shared folder. A star's centre may have any number of neighbours: they are
    never gathered in one row.
    """
    e = staged(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    for _ in range(most_rounds):
        # stars: no node hangs on two others, and no centre hangs on a third node
        loose = e.groupBy("a").agg(F.count("*").alias("n"), F.min("b").alias("b"))
        tangled = loose.where("n > 1").limit(1).count() or e.join(
            loose.select(F.col("a").alias("b")), "b", "left_semi"
        ).limit(1).count()
        if not tangled:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(lower, "a")
            .select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("x"))
            .select("x.a", "x.b")
            .where("a <> b")
            .distinct()
        )
        e = staged(small)
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
