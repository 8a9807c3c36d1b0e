"""Mergeable quantile sketches, kept a snapshot.

A sketch counts whole numbers by their first BITS significant bits: numbers below 2 ** BITS are told exactly, larger ones
fall into cells whose width is at most 2 ** (1 - BITS) of their value. Sketches merge by adding counts, in any order, and
the cell that holds a rank is exact; so a quantile (the value at rank ceil(q n)) is off by at most half its cell, a share
of 2 ** -BITS of the value. A sketch has at most 2 ** (BITS - 1) cells for each doubling of its largest value.

Negative numbers are cells of their own sign. Nulls are not counted.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.sources import commits as marks

BITS = 7


def sketch(rows: DataFrame, by: list[str], value: str, bits: int = BITS, weight: str | None = None) -> DataFrame:
    """by, low (the cell's number nearest to zero), width, n."""
    x = rows.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("bigint").alias("x"), (F.col(weight) if weight else F.lit(1)).cast("bigint").alias("w"))
    x = x.withColumn("e", F.greatest(F.length(F.bin(F.abs("x"))) - bits, F.lit(0)))
    low = F.signum("x").cast("bigint") * F.expr("shiftleft(shiftright(abs(x), e), e)")
    return x.groupBy(*by, low.alias("low"), F.expr("shiftleft(cast(1 as bigint), e)").alias("width")).agg(F.sum("w").alias("n"))


def merge(sketches: DataFrame, by: list[str]) -> DataFrame:
    return sketches.groupBy(*by, "low", "width").agg(F.sum("n").alias("n"))


def middle() -> F.Column:
    """The value that stands for a cell."""
    return F.col("low") + F.when(F.col("low") < 0, -1.0).otherwise(1.0) * (F.col("width") - 1) / 2


def quantiles(sketches: DataFrame, by: list[str], wanted: tuple[float, ...]) -> DataFrame:
    """by, n, p: the estimates of the wanted quantiles, in their order."""
    cells = merge(sketches, by).withColumn("v", middle())
    own = W.partitionBy(*by)  # the cells of one sketch
    cells = cells.withColumn("reached", F.sum("n").over(own.orderBy("v"))).withColumn("total", F.sum("n").over(own))
    found = [F.min(F.when(F.col("reached") >= F.ceil(F.lit(q) * F.col("total")), F.col("v"))) for q in wanted]
    return cells.groupBy(*by).agg(F.max("total").alias("n"), F.array(*found).alias("p"))


class SketchStore:
    """Sketches of snapshots (feed, acquisition_date) below a folder; those that it has are not made again."""

    def __init__(self, spark: SparkSession, root: str, bits: int = BITS):
        self.spark, self.root, self.bits = spark, root.rstrip("/"), bits

    def _commits(self) -> list[dict]:
        names = [n for n in marks.children(self.spark, f"{self.root}/commits") if n.endswith(".json") and n[0] not in "._"]
        return [json.loads(marks.content(self.spark, f"{self.root}/commits/{n}")) for n in names]

    def missing(self, selected: DataFrame) -> DataFrame:
        """The selected snapshots (a few) that have no sketch."""
        have = [tuple(s) for c in self._commits() for s in c["snapshots"]]
        known = self.spark.createDataFrame(have, "feed string, acquisition_date string")
        return selected.select("feed", "acquisition_date").distinct().join(F.broadcast(known), ["feed", "acquisition_date"], "left_anti")

    def add(self, selected: DataFrame, rows_of: Callable[[DataFrame], DataFrame], value: str, weight: str | None = None) -> int:
        """Sketches of the selected snapshots that lack one; rows_of reads rows of given snapshots. Their number."""
        fresh = self.missing(selected).collect()
        if not fresh:
            return 0
        wanted = self.spark.createDataFrame([tuple(r) for r in fresh], "feed string, acquisition_date string")
        data = uuid.uuid4().hex
        made = sketch(rows_of(wanted), ["feed", "acquisition_date"], value, self.bits, weight)
        made.coalesce(1).write.parquet(f"{self.root}/data/{data}")
        no = len(self._commits())
        marks.publish(self.spark, f"{self.root}/commits/{no:08d}.json", json.dumps({"data": data, "snapshots": [list(r) for r in fresh]}))
        return len(fresh)

    def read(self) -> DataFrame:
        paths = [f"{self.root}/data/{c['data']}" for c in self._commits()]
        schema = "feed string, acquisition_date string, low bigint, width bigint, n bigint"
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)
