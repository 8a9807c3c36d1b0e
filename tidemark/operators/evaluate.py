"""Evaluation of scores: average precision, confusion, thresholds and paired comparison.

Scores are aggregated by distinct value first. Cumulative sums over descending scores are taken in
two steps - within ranges of scores, and over the few ranges' totals - so that no window holds all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def by_score(df: DataFrame, score: str, label: str, group: list[str]) -> DataFrame:
    """group, score, tp, fp, pos: cumulative counts at each distinct score, from the highest down; pos: all positives."""
    s = df.groupBy(*group, F.col(score).cast("double").alias("score")).agg(F.sum(F.col(label).cast("bigint")).alias("p"), F.count("*").alias("n"))
    # bands of scores that order as the scores do: sixteen to each doubling, some thousand at most
    band = F.floor(F.signum("score") * F.log2(1 + F.abs("score") * 1e6) * 16)
    s = s.withColumn("band", band)
    bands = s.groupBy(*group, "band").agg(F.sum("p").alias("bp"), F.sum("n").alias("bn"))
    above = W.partitionBy(*group).orderBy(F.desc("band")).rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(*group)
    bands = bands.select(
        *[F.col(g).alias(f"_{g}") for g in group], F.col("band").alias("_band"),
        F.coalesce(F.sum("bp").over(above), F.lit(0)).alias("p0"), F.coalesce(F.sum("bn").over(above), F.lit(0)).alias("n0"), F.sum("bp").over(whole).alias("pos"),
    )
    same = F.col("band") == F.col("_band")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_{g}"))
    within = W.partitionBy(*group, "band").orderBy(F.desc("score")).rowsBetween(W.unboundedPreceding, W.currentRow)
    joined = s.join(F.broadcast(bands), same)
    tp = F.col("p0") + F.sum("p").over(within)
    return joined.select(*group, "score", tp.alias("tp"), (F.col("n0") + F.sum("n").over(within) - tp).alias("fp"), "pos", "p")


def average_precision(df: DataFrame, scores: list[str], label: str) -> DataFrame:
    """model, average_precision: sum of precision times the gain in recall, ties as one step, of several score columns at once."""
    melted = df.select(F.col(label).alias("label"), F.explode(F.array(*[F.struct(F.lit(s).alias("model"), F.col(s).cast("double").alias("s")) for s in scores])).alias("m"))
    steps = by_score(melted.select("label", "m.model", "m.s"), "s", "label", ["model"])
    gain = F.col("p") / F.col("pos") * (F.col("tp") / (F.col("tp") + F.col("fp")))
    return steps.groupBy("model").agg(F.sum(gain).alias("average_precision"))


def compare_models(df: DataFrame, candidate: str, baseline: str, incumbent: str | None, label: str) -> DataFrame:
    """One row: the average precisions on the same rows and whether the candidate is better than all; a tie keeps the incumbent."""
    names = [candidate, baseline] + ([incumbent] if incumbent else [])
    ap = average_precision(df, names, label)
    one = ap.groupBy().agg(*[F.max(F.when(F.col("model") == n, F.col("average_precision"))).alias(f"ap_{n}") for n in names])
    better = F.lit(True)
    for n in names[1:]:
        better = better & (F.col(f"ap_{candidate}") > F.col(f"ap_{n}"))
    return one.withColumn("promote", better)


def f1_threshold(df: DataFrame, score: str, label: str) -> DataFrame:
    """threshold, f1: the score at or above which predicting positive has the best F1; of equal ones the lowest."""
    steps = by_score(df, score, label, [])
    f1 = F.when(F.col("tp") > 0, 2 * F.col("tp") / (F.col("tp") + F.col("fp") + F.col("pos"))).otherwise(F.lit(0.0))
    best = steps.select("score", f1.alias("f1")).agg(F.max_by(F.struct("score", "f1"), F.struct("f1", -F.col("score"))).alias("b"))
    return best.select(F.col("b.score").alias("threshold"), F.col("b.f1").alias("f1"))


def confusion(df: DataFrame, score: str, label: str, threshold: float) -> DataFrame:
    """One row: counts and rates at a threshold; a rate without a base is zero."""
    yes, real = F.col(score) >= threshold, F.col(label) == 1
    c = df.agg(
        F.count_if(~yes & ~real).alias("true_negative"), F.count_if(yes & ~real).alias("false_positive"),
        F.count_if(~yes & real).alias("false_negative"), F.count_if(yes & real).alias("true_positive"), F.count("*").alias("n"),
    )
    tn, fp, fn, tp, n = (F.col(x) for x in ("true_negative", "false_positive", "false_negative", "true_positive", "n"))
    share = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    return c.select(
        "*", share(tn + tp, n).alias("accuracy"), share(tp, tp + fn).alias("positive_recall"), share(tp, tp + fp).alias("precision"),
        share(2 * tp, 2 * tp + fp + fn).alias("f1"), share(tp + fn, n).alias("prevalence"), share(tn + fp, n).alias("always_negative_accuracy"),
    )


def holdout(split: DataFrame, score: str, baseline: str, label: str) -> DataFrame:
    """One row: the threshold that is best on the train part, and on the test part alone the confusion at it and the
    average precisions of score and baseline. split: part, label and both scores."""
    threshold = f1_threshold(split.where("part = 'train'"), score, label).first()["threshold"]  # one number
    test = split.where("part = 'test'")
    ap = average_precision(test, [score, baseline], label)
    one = ap.agg(*[F.max(F.when(F.col("model") == n, F.col("average_precision"))).alias(f"ap_{c}") for n, c in ((score, "model"), (baseline, "baseline"))])
    return confusion(test, score, label, threshold).select(F.lit(threshold).alias("threshold"), "*").join(one, how="cross")
