"""Where two tables differ: digest trees over ranges of a key's hash.

A tree's leaves are 2 ** DEPTH ranges of the hash; a node's digest is an exact sum over the digests of its rows, so a
parent's is the sum of its children's, and trees of equal multisets of rows are equal. Two trees are compared from the
root, following only children of nodes that differ; then the rows of the leaves that are left are compared by key. A tree has
some thousand rows whatever the table's size and can be kept beside it; tables that agree are told apart from those that
don't without another look at their rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import row_digest
from tidemark.sources.staging import staged

LEVELS = (0, 4, 8, 12)
_SUMS = [f"s{i}" for i in range(4)]


def _leaf(key: list[str]) -> F.Column:
    told = F.concat(*[F.coalesce(F.concat(F.octet_length(F.col(k).cast("string")).cast("string"), F.lit(":"), F.col(k).cast("string")), F.lit("-")) for k in key])
    return F.conv(F.substring(F.sha2(told, 256), 1, LEVELS[-1] // 4), 16, 10).cast("int")


def digest_tree(df: DataFrame, key: list[str]) -> DataFrame:
    """level (bits), node, n, s0..s3: rows and digests of every node."""
    rows = df.select(_leaf(key).alias("node"), row_digest(df).alias("d"))
    parts = [F.sum(F.conv(F.substring("d", 1 + 15 * i, 15), 16, 10).cast("decimal(20,0)")).cast("decimal(38,0)").alias(s) for i, s in enumerate(_SUMS)]
    leaves = rows.groupBy("node").agg(F.count("*").alias("n"), *parts)
    levels = F.explode(F.array(*[F.struct(F.lit(b).alias("level"), F.shiftright("node", LEVELS[-1] - b).alias("node")) for b in LEVELS]))
    up = leaves.select(levels.alias("x"), "n", *_SUMS).select("x.*", "n", *_SUMS)
    return up.groupBy("level", "node").agg(F.sum("n").alias("n"), *[F.sum(s).cast("decimal(38,0)").alias(s) for s in _SUMS])


def differing_leaves(a: DataFrame, b: DataFrame) -> DataFrame:
    """node: the leaves in which two trees differ, found from the root down."""
    left = a.select("level", "node", F.struct("n", *_SUMS).alias("a"))
    right = b.select("level", "node", F.struct("n", *_SUMS).alias("b"))
    wrong = staged(left.join(right, ["level", "node"], "full").where(~F.col("a").eqNullSafe(F.col("b"))).select("level", "node"))
    found = wrong.where(F.col("level") == LEVELS[0]).select("node")
    for above, level in zip(LEVELS, LEVELS[1:], strict=False):
        below = wrong.where(F.col("level") == level).select("node")
        found = below.join(F.broadcast(found.select(F.col("node").alias("p"))), F.shiftright("node", level - above) == F.col("p"), "left_semi")
    return found


def differences(a: DataFrame, b: DataFrame, key: list[str], trees: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """key, side: the keys whose rows differ as multisets: source_only, derived_only or changed. trees: of both tables, if they are kept."""
    b = b.select(*a.columns)
    left, right = trees or (digest_tree(a, key), digest_tree(b, key))
    nodes = F.broadcast(staged(differing_leaves(left, right)))  # at most 2 ** 12 rows

    def of(df: DataFrame, name: str) -> DataFrame:
        rows = df.select(*key, _leaf(key).alias("node"), row_digest(df).alias("d")).join(nodes, "node", "left_semi")
        return rows.groupBy(*key, "d").agg(F.count("*").alias("n")).select(*key, "d", F.when(F.lit(name == "a"), F.col("n")).otherwise(0).alias("a"), F.when(F.lit(name == "b"), F.col("n")).otherwise(0).alias("b"))

    by_row = of(a, "a").unionByName(of(b, "b")).groupBy(*key, "d").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    by_key = by_row.groupBy(*key).agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.max(F.col("a") != F.col("b")).alias("differs"))
    side = F.when(F.col("b") == 0, "source_only").when(F.col("a") == 0, "derived_only").otherwise("changed")
    return by_key.where("differs").select(*key, side.alias("side"))
