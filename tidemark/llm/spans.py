"""Overlap tests among the spans of one text, as sorted passes over rows.

Spans are rows (key, start, end, ...) and never empty. Nothing is compared pair by pair: a pass ordered by start
carries what may still reach a row, so a text with n spans costs n log n, and a task holds a row and its bounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def touching(others: Column) -> Column:
    """Whether a span touches one of its text's spans that `others` marks; for rows that are not marked themselves.

    Of marked spans that start no later, the one that ends last decides; of those that start no earlier, the first.
    """
    of_text = W.partitionBy("key")
    reach = F.max(F.when(others, F.col("end"))).over(of_text.orderBy("start"))
    following = F.min(F.when(others, F.col("start"))).over(of_text.orderBy(F.desc("start")))
    return F.coalesce(reach > F.col("start"), F.lit(False)) | F.coalesce(following < F.col("end"), F.lit(False))


def untouched_by_better(spans: DataFrame, ranks: range) -> DataFrame:
    """Of distinct spans (key, rank, start, end, q), those that touch no span of their text with a lesser (q, rank, start, end).

    Spans of one rank are disjoint. So of each rank only the last span that started before a row can reach it, and every
    pair that touches is seen once, by the later of its two: a row gives at most one pair a rank.
    """
    own = F.struct("q", "rank", "start", "end")
    before = W.partitionBy("key").orderBy("start", "rank").rowsBetween(W.unboundedPreceding, -1)
    last = [F.last(F.when(F.col("rank") == r, own), True).over(before).alias(f"last_{r}") for r in ranks]
    rows = spans.select("key", own.alias("own"), *last)
    reaching = F.filter(F.array(*[f"last_{r}" for r in ranks]), lambda x: x["end"] > F.col("own.start"))
    beaten = F.transform(reaching, lambda x: F.struct(F.when(x < F.col("own"), F.col("own")).otherwise(x).alias("span"), F.lit(True).alias("lost")))
    every = F.concat(F.array(F.struct(F.col("own").alias("span"), F.lit(False).alias("lost"))), beaten)
    judged = rows.select("key", F.inline(every)).groupBy("key", "span").agg(F.bool_or("lost").alias("lost"))
    return judged.where("not lost").select("key", "span.*")
