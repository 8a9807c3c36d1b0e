"""More registered jobs: published data sets, located differences, attested training sets, rule counts over spoiled rows."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import keys
from tidemark.operators import checks, compare, dataset, features, history, maturity, train
from tidemark.plans import jobs
from tidemark.sources import files, published, tables
from tidemark.sources.staging import shared_dir, staged
from tidemark.sources.staging import staged_small


def _spoiled_text(text: DataFrame) -> DataFrame:
    """Snapshot rows of which some are lost, some changed, some emptied to null and some doubled, by their number."""
    k = F.col("source_row_number")
    cut = text.where(k % 997 != 0).withColumn("dot_number", F.when(k % 991 == 1, F.concat("dot_number", F.lit("0"))).when(k % 983 == 2, F.lit(None)).otherwise(F.col("dot_number")))
    return cut.unionByName(cut.where(k % 977 == 3))


def _text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(tables.raw_inspections(spark, sf_dir).na.fill(""))


def derived_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows in which a spoiled copy of the inspection snapshots differs from them."""
    text = _text(spark, sf_dir)
    return compare.differences(text, staged(_spoiled_text(text)), ["batch_id", "source_row_number"])


def derived_reconciliation_spoiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = _text(spark, sf_dir)
    return files.reconcile_values(text, staged(_spoiled_text(text)))


def derived_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog lines of the snapshots with the rows and value fingerprints of the files derived from them, written as JSON and read again."""
    out = f"{shared_dir(spark)}/catalog-{uuid.uuid4().hex}"
    days = jobs.batches(spark).select("batch_id", "feed_name", F.date_format("observed_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("observed_at"), tables.acquisition_date())
    text = [staged(tables.raw_rows(spark, sf_dir, f).na.fill("")) for f in tables.COLUMNS]
    told = [keys.fingerprint_by(t, ["batch_id"]).toDF("batch_id", "derived_rows", "value_fingerprint") for t in text]
    known = days.withColumns({"object_sha256": F.sha2("batch_id", 256), "schema_fingerprint": F.sha2("feed_name", 256), "row_count": F.lit(0).cast("bigint")})
    files.catalog_rows(known, out, told[0].unionByName(told[1]), "2")
    schema = "batch_id string, observed_at string, derived_rows bigint, value_fingerprint string, converter_version string, feed string, acquisition_date string"
    return spark.read.schema(schema).json(out)


def published_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders published under a name, twice, and read from where they were published."""
    folder = f"{shared_dir(spark)}/published-{uuid.uuid4().hex}"
    orders = tables.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.to_date("o_orderdate").alias("o_orderdate"))
    published.publish(orders, folder, "orders")
    path = published.publish(orders.repartition(3), folder, "orders")
    return spark.read.schema(orders.schema).parquet(path)


def replay_stepwise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rebuilt history against the one stored step by step and replayed, and against one that lost its deletions."""
    store, made = jobs._stepwise(spark, sf_dir)
    store.apply_pending(history.appearances(made, jobs.batches(spark)), jobs.batches(spark))
    # one row stands for the rebuilt history, which is nowhere written
    rebuilt = staged_small(keys.fingerprint(history.rebuild(made, jobs.batches(spark))[0].select(*history.VERSION)))
    stepwise = store.versions().select(*history.VERSION)
    told = lambda df, name: checks.same_prints(rebuilt, keys.fingerprint(df)).select(F.lit(name).alias("against"), "*")
    return told(stepwise, "stepwise").unionByName(told(stepwise.where("not is_deleted"), "without deletions"))


def _training(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    known = tables.snapshot_batches(spark)
    applied = jobs.batches(spark).select("batch_id", "feed_name", "observed_at")
    wanted = [b for b, _, _, _ in tables.BATCHES]
    grid = features.month_grid(jobs.batches(spark)).where(F.add_months("scoring_date", 6) <= F.lit(jobs.CUTOFF))
    return dataset.build(jobs.versions(spark, sf_dir, jobs.NEEDED), applied, known, wanted, jobs.AS_OF, grid, jobs.CUTOFF)


def training_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The identity of the labelled data set that attested batches give."""
    return _training(spark, sf_dir)[1]


def schema_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates against a contract that they break: a missing column, another type, nulls where none may be."""
    made = jobs.candidates(spark, sf_dir)
    contract = T.StructType(
        [
            T.StructField("batch_id", T.StringType(), False), T.StructField("source_record_key", T.StringType(), False), T.StructField("usdot_number", T.StringType(), False),
            T.StructField("event_date", T.DateType()), T.StructField("violation_count", T.IntegerType()), T.StructField("is_model_eligible", T.BooleanType(), False),
            T.StructField("region", T.StringType(), False),
        ]
    )
    return checks.required_violations(made, contract)


def manifest_violation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(rule, n) of manifests made from orders, of which some break each rule."""
    k = F.col("o_orderkey")
    feeds = {f: {"dataset": f"set-{f}", "url": f"https://example.org/{f}", "fingerprint": f"fp-{f}", "columns": len(c)} for f, c in tables.COLUMNS.items()}
    feed = F.when(k % 19 == 0, F.lit("other")).when(k % 2 == 0, F.lit("crashes")).otherwise(F.lit("inspections"))
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    m = tables.table(spark, sf_dir, "orders").select("o_orderkey", feed.alias("feed_name"), F.concat(day, F.lit("T10:00:00Z")).alias("observed_at"), F.sha2(k.cast("string"), 256).alias("object_sha256"))
    f = F.col("feed_name")
    m = m.withColumns(
        {
            "dataset_id": F.concat(F.lit("set-"), F.when(k % 23 == 0, F.lit("x")).otherwise(f)), "url": F.concat(F.lit("https://example.org/"), F.when(k % 29 == 0, F.lit("x")).otherwise(f)),
            "n_columns": F.when(f == "crashes", len(tables.COLUMNS["crashes"])).otherwise(len(tables.COLUMNS["inspections"])) + F.when(k % 31 == 0, 1).otherwise(0),
            "schema_fingerprint": F.when(k % 37 != 0, F.concat(F.lit("fp-"), f)),
            "acquisition_date": F.when(k % 41 == 0, F.lit("1990-01-01")).otherwise(F.substring("observed_at", 1, 10)),
            "object_key": F.concat(F.lit("raw/feed="), f, F.lit("/acquisition_date="), F.substring("observed_at", 1, 10), F.when(k % 43 == 0, F.lit("/s.csv")).otherwise(F.lit("/snapshot.csv.gz"))),
        }
    )
    own = files.batch_id(*[F.col(c) for c in ("feed_name", "dataset_id", "observed_at", "object_key", "object_sha256")])
    m = m.withColumn("batch_id", F.when(k % 47 == 0, F.lit("none")).otherwise(own))
    broken = files.manifest_violations(m, feeds)
    return broken.select(F.explode("violated").alias("rule")).groupBy("rule").agg(F.count("*").alias("n"))


def maturity_watermark_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules of a stored measurement over the cohorts' bounds, and over claims that don't fit them."""
    bounds = staged(jobs.maturity_order_bounds(spark, sf_dir).select("event_month", "incident_count", F.col("high_95_days").cast("double").alias("upper_95_days")))
    top = int(bounds.agg(F.ceil(F.max("upper_95_days"))).first()[0])
    told = lambda df, *claim: maturity.watermark_violations(df, *claim)
    good = told(bounds, top, top, "measured").select(F.lit("stored").alias("claim"), "*")
    hole = bounds.where(F.col("event_month") != F.lit(date(2000, 3, 1)))
    spoiled = told(hole.withColumn("incident_count", F.lit(0)), top + 1, top - 1, "measured").select(F.lit("spoiled").alias("claim"), "*")
    return good.unionByName(spoiled)


def label_window_eligibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(version, reason, n): why the policy after each measurement lets label windows of the order months be trained on or not."""
    rows = staged(jobs.maturity_policy(spark, sf_dir))
    ends = tables.table(spark, sf_dir, "orders").select(F.add_months(F.trunc("o_orderdate", "MM"), 6).alias("label_window_end")).distinct()
    found = maturity.window_eligibility(rows.crossJoin(F.broadcast(ends)))
    return found.groupBy("version", "reason").agg(F.count("*").alias("n"))


def landmark_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact lookups of carriers at the landmarks and a day that is none, with the flag of a threshold; the score is a plain function."""
    v = F.col("violations_per_inspection")
    scored = jobs.landmark_features(spark, sf_dir).select("usdot_number", "scoring_date", F.coalesce(v / (v + 1), F.lit(0.0)).alias("probability"))
    days = F.explode(F.array(*[F.lit(date.fromisoformat(d)) for d in (*jobs.LANDMARKS, "1999-09-09")]))
    asked = tables.table(spark, sf_dir, "orders").select((F.col("o_custkey") + 1).cast("string").alias("usdot_number")).distinct().withColumn("scoring_date", days)
    return train.landmark_lookup(scored, asked, 0.7)


NAMES = (
    "derived_differences derived_reconciliation_spoiled derived_catalog published_dataset replay_stepwise training_dataset schema_contract manifest_violation_counts "
    "maturity_watermark_violations label_window_eligibility landmark_decisions"
).split()
