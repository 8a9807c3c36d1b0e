"""Snapshot profiling: report lags and reconciliation of rows against manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import parse
from tidemark.operators.sketch import quantiles, sketch
from tidemark.sources.staging import staged


def select_snapshots(rows: DataFrame, selected: DataFrame) -> DataFrame:
    """Rows of the selected (feed, acquisition_date) partitions; the selection is two rows, so partitions are pruned by it."""
    return rows.join(F.broadcast(selected.select("feed", "acquisition_date")), ["feed", "acquisition_date"], "left_semi")


def parsed(rows: DataFrame) -> DataFrame:
    """rows: feed, acquisition_date, raw_event_date, raw_source_add_at. Adds event_date, reported_date."""
    at = parse.source_timestamp(F.col("raw_source_add_at"))
    return rows.select("*", parse.source_date(F.col("raw_event_date")).alias("event_date"), (at + F.expr("interval 1 day")).cast("date").alias("reported_date"))


def lags(rows: DataFrame) -> DataFrame:
    """feed, acquisition_date, lag_days of rows with both dates and no negative lag."""
    return parsed(rows).where("reported_date >= event_date").select("feed", "acquisition_date", F.datediff("reported_date", "event_date").alias("lag_days"))


QUANTILES = (0.50, 0.90, 0.95, 0.99, 0.995)


def lag_counts(rows: DataFrame) -> DataFrame:
    """feed, acquisition_date, lag_days, n: a snapshot's lags in a few thousand rows, whatever its size."""
    return lags(rows).groupBy("feed", "acquisition_date", "lag_days").agg(F.count("*").alias("n"))


def lag_profile(rows: DataFrame, manifests: DataFrame, exact: bool = False) -> DataFrame:
    """For each snapshot and lag bucket: the bucket's rows and fraction beside the snapshot's summary.

    manifests: feed, acquisition_date, manifest_observed_at, manifest_row_count. The rows are read once, into counts
    by lag. Percentiles are those of a sketch (`operators/sketch.py` gives the bound) unless `exact`.
    """
    on = ["feed", "acquisition_date"]
    at = staged(lag_counts(rows))
    summary = at.groupBy(*on).agg(
        F.sum("n").alias("lag_sample_size"), F.min("lag_days").alias("minimum_lag_days"), F.max("lag_days").alias("maximum_lag_days"),
        F.percentile("lag_days", F.array(*[F.lit(q) for q in QUANTILES]), F.col("n")).alias("p"),
    )
    if not exact:
        found = quantiles(sketch(at, on, "lag_days", weight="n"), on, QUANTILES)
        summary = summary.drop("p").join(F.broadcast(found.drop("n")), on)
    histogram = at.groupBy(*on, parse.lag_bucket(F.col("lag_days")).alias("lag_bucket")).agg(F.sum("n").alias("lag_bucket_row_count"))
    # summaries are one row a snapshot
    wide = histogram.join(F.broadcast(summary), on).join(F.broadcast(manifests), on)
    names = ("p50_lag_days", "p90_lag_days", "p95_lag_days", "p99_lag_days", "p995_lag_days")
    return wide.select(
        "feed", "acquisition_date", "manifest_observed_at", "manifest_row_count", F.lit("source_proxy").alias("availability_quality"),
        "lag_sample_size", "minimum_lag_days", "maximum_lag_days", *[F.get("p", F.lit(i)).alias(n) for i, n in enumerate(names)],
        "lag_bucket", "lag_bucket_row_count", (F.col("lag_bucket_row_count") / F.col("lag_sample_size")).alias("lag_bucket_fraction"),
    )


def dense_histogram(rows: DataFrame) -> DataFrame:
    """feed, lag_bucket, n with a zero for buckets that no row falls into."""
    # pairs of date texts repeat, so they are counted first and each is parsed once; a pair without a lag has no bucket
    pairs = parsed(rows.groupBy("feed", "raw_event_date", "raw_source_add_at").agg(F.count("*").alias("n")))
    days = F.when(F.col("reported_date") >= F.col("event_date"), F.datediff("reported_date", "event_date"))
    # staged, as it is read twice; a row a bucket
    found = staged(pairs.groupBy("feed", parse.lag_bucket(days).alias("lag_bucket")).agg(F.sum("n").alias("n"))).where("lag_bucket is not null")
    every = found.select("feed").distinct().withColumn("lag_bucket", F.explode(F.array(*[F.lit(b) for b in parse.LAG_BUCKETS])))
    return every.join(found, ["feed", "lag_bucket"], "left").select("feed", "lag_bucket", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def reconcile(rows: DataFrame, manifests: DataFrame, selected: DataFrame) -> DataFrame:
    """One row for each selected snapshot: counters of its rows against its manifest, zeros where it has none.

    manifests: feed, acquisition_date, batch_id, manifest_row_count (several rows a snapshot show in metadata_row_count).
    """
    blank = lambda c: F.coalesce(F.btrim(F.col(c), F.lit(" ")), F.lit("")) == ""
    e, r = F.col("event_date"), F.col("reported_date")
    add = parse.source_timestamp(F.col("raw_source_add_at"))
    counts = (
        parsed(select_snapshots(rows, selected))
        .groupBy("feed", "acquisition_date")
        .agg(
            F.count("*").alias("catalog_row_count"),
            F.count_if(blank("raw_event_date")).alias("missing_event_date_count"),
            F.count_if(~blank("raw_event_date") & e.isNull()).alias("invalid_event_date_count"),
            F.count_if(blank("raw_source_add_at")).alias("missing_source_add_at_count"),
            F.count_if(~blank("raw_source_add_at") & add.isNull()).alias("invalid_source_add_at_count"),
            F.count_if(e.isNull() | r.isNull() | (r < e)).alias("excluded_from_lag_count"),
            F.count_if(r < e).alias("negative_lag_count"),
            F.count_if(r >= e).alias("lag_sample_size"),
        )
    )
    known = select_snapshots(manifests, selected).groupBy("feed", "acquisition_date").agg(
        F.count("*").alias("metadata_row_count"), F.any_value("batch_id").alias("batch_id"), F.any_value("manifest_row_count").alias("manifest_row_count")
    )
    wide = selected.select("feed", "acquisition_date").join(known, ["feed", "acquisition_date"], "left").join(counts, ["feed", "acquisition_date"], "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    counters = [c for c in counts.columns if c.endswith("_count") or c == "lag_sample_size"]
    delta = F.coalesce("catalog_row_count", F.lit(0)) - F.coalesce("manifest_row_count", F.lit(0))
    return wide.select(
        "feed", "acquisition_date", zero("metadata_row_count"), "batch_id", F.lit("source_proxy").alias("availability_quality"),
        F.col("manifest_row_count").cast("bigint"), delta.cast("bigint").alias("row_count_delta"), *[zero(c) for c in counters],
    )


def latency_percentiles(df: DataFrame, by: str, value: str) -> DataFrame:
    """by, and p50, p95, p99 of a column in both kinds: the value at rank ceil(q n), and linear between ranks."""
    named = df.select(F.col(by), F.col(value).alias("v"))
    return named.groupBy(by).agg(
        *[F.expr(f"percentile_disc({q}) within group (order by v)").alias(f"rank_p{round(100 * q)}") for q in (0.5, 0.95, 0.99)],
        *[F.percentile("v", F.lit(q)).alias(f"linear_p{round(100 * q)}") for q in (0.5, 0.95, 0.99)],
    )
