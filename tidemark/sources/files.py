"""Snapshot files, manifests and derived Parquet: contract scans, audits, reconciliation and catalog rows."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.keys import fingerprint, length_prefixed_id
from tidemark.sources import published, records
from tidemark.sources.staging import staged

ROW = "source_row_number"


def contract_fingerprint(columns: list[str], version: str) -> str:
    import hashlib
    import json

    return hashlib.sha256(json.dumps([version, columns], separators=(",", ":")).encode()).hexdigest()


def read_contract_csv(spark: SparkSession, path: str, columns: list[str], empty_as_null: bool) -> DataFrame:
    """Rows of quoted CSV with their number from 1 in each file, from as many splits as there are (`records`).

    The header's names and order must be the contract's, and rows of another width end the job. Empty cells become null
    for the raw load and stay empty for derived files.
    """
    found = records.read_records(spark, path)
    for r in found.where("record = 1").select("cells").distinct().limit(2).collect():
        if r["cells"] != columns:
            raise ValueError(f"header is not the contract's: {r['cells'][:5]}...")
    wide = F.size("cells") == len(columns)
    wrong = F.raise_error(F.concat(F.lit("row of another width: "), "file", F.lit(" "), (F.col("record") - 1).cast("string"))).cast("bigint")
    cell = lambda i: F.get("cells", F.lit(i))
    cells = [(F.nullif(cell(i), F.lit("")) if empty_as_null else F.coalesce(cell(i), F.lit(""))).alias(c) for i, c in enumerate(columns)]
    return found.where("record > 1").select(F.when(wide, F.col("record") - 1).otherwise(wrong).alias(ROW), *cells)


def derive_parquet(spark: SparkSession, csv_path: str, out: str, columns: list[str]) -> DataFrame:
    """Publishes required-text Parquet below `out` and returns one row of both sides' counts and fingerprints.

    Unequal sides are an error and publish nothing; so are other rows under a name that is taken.
    """
    source = staged(read_contract_csv(spark, csv_path, columns, empty_as_null=False).drop(ROW))
    derived = published.publish(source, out, "derived")
    result = reconcile_values(source, spark.read.parquet(derived))
    if not result.first()["equal"]:
        raise ValueError("derived Parquet does not hold the source's values")
    return result


def reconcile_values(source: DataFrame, derived: DataFrame) -> DataFrame:
    """source_rows, derived_rows, nulls, equal: values compared as multisets of rows with length-prefixed cells."""
    nulls = derived.agg(F.sum(sum([F.col(f"`{c}`").isNull().cast("int") for c in derived.columns], F.lit(0))).alias("nulls"))
    a = fingerprint(source).toDF("source_rows", "source_fingerprint").withColumn("_j", F.lit(1))
    b = fingerprint(derived.select(*source.columns)).toDF("derived_rows", "derived_fingerprint").withColumn("_j", F.lit(1))
    wide = a.join(b, "_j").join(nulls.withColumn("_j", F.lit(1)), "_j").drop("_j")
    same = (F.col("source_fingerprint") == F.col("derived_fingerprint")) & (F.coalesce("nulls", F.lit(0)) == 0)
    return wide.withColumn("nulls", F.coalesce("nulls", F.lit(0))).withColumn("equal", same)


def batch_id(feed: Column, dataset: Column, observed_at: Column, object_key: Column, object_sha256: Column) -> Column:
    return length_prefixed_id(feed, dataset, observed_at, object_key, object_sha256)


def manifest_violations(manifests: DataFrame, feeds: dict[str, dict]) -> DataFrame:
    """manifests with violated: the rules that each breaks.

    feeds: {feed: {dataset, url, fingerprint, columns}}. Columns: feed_name, dataset_id, url, n_columns,
    schema_fingerprint, object_key, object_sha256, observed_at (text), acquisition_date, batch_id.
    """
    c = F.col
    want = lambda name: F.coalesce(*[F.when(c("feed_name") == f, F.lit(v[name])) for f, v in feeds.items()])
    day = F.substring("observed_at", 1, 10)
    place = F.concat(F.lit("raw/feed="), c("feed_name"), F.lit("/acquisition_date="), day, F.lit("/snapshot.csv.gz"))
    rules = {
        "unknown_feed": ~c("feed_name").isin(*feeds),
        "dataset": c("dataset_id") != want("dataset"),
        "url": c("url") != want("url"),
        "columns": c("n_columns") != want("columns"),
        "fingerprint": c("schema_fingerprint") != want("fingerprint"),
        "acquisition_date": c("acquisition_date") != day,
        "object_key": c("object_key") != place,
        "batch_id": c("batch_id") != batch_id(c("feed_name"), c("dataset_id"), c("observed_at"), c("object_key"), c("object_sha256")),
    }
    return manifests.withColumn("violated", F.array_compact(F.array(*[F.when(F.coalesce(x, F.lit(True)), F.lit(n)) for n, x in rules.items()])))


def backfill(manifests: DataFrame, feed: str, first: str, last: str, feeds: tuple[str, ...] = ("crashes", "inspections")) -> DataFrame:
    """Manifests of a feed in an inclusive range of acquisition dates, in order."""
    if feed not in feeds:
        raise ValueError(f"unknown feed {feed}")
    if first > last:
        raise ValueError("backfill range is reversed")
    return manifests.where((F.col("feed_name") == feed) & F.col("acquisition_date").between(first, last)).orderBy("object_key")


def _stripped(c: str) -> Column:
    return F.regexp_replace(F.coalesce(F.col(c), F.lit("")), r"\A\s+|\s+\z", "")


def _digits(c: str) -> Column:
    """The digits of a whole number (a fraction of zeros may follow) without leading zeros, or null."""
    return F.nullif(F.regexp_extract(F.coalesce(F.col(c), F.lit("")), r"\A\s*0*([0-9]+)(?:\.0+)?\s*\z", 1), F.lit(""))


def _within(c: str, windows: list[tuple[str, str]]) -> Column:
    """Whether a stripped date text lies in one of the ranges [from, to)."""
    t = F.col(c)
    return functools.reduce(lambda x, y: x | y, [(t >= lo) & (t < hi) for lo, hi in windows], F.lit(False))


def source_events(inspections: DataFrame, crashes: DataFrame, windows: dict[str, list[tuple[str, str]]], data_as_of: str) -> tuple[DataFrame, DataFrame]:
    """(events, counters) of an extraction: flat events of both feeds from text rows, and what was left out and why.

    windows: ranges [from, to) of raw date text a feed; rows outside them are no part of it. Counters are
    (event_type, outcome, n): selected, not_visible_at_acquisition or the first rule that a row breaks.
    """
    from tidemark.functions import parse

    known = lambda c: F.date_add(parse.source_timestamp(F.col(c)).cast("date"), 1)
    # values that several rules read are made once, as columns of a step of their own
    stripped = lambda df, *names: df.withColumns({n: _stripped(n) for n in names})
    zero = F.lit(0).cast("bigint")

    def first(**broken: Column) -> Column:
        return F.coalesce(*[F.when(F.coalesce(c, F.lit(True)), F.lit(n.rstrip("_"))) for n, c in broken.items()])

    i = stripped(inspections, "insp_date", "mcmis_add_date", "change_date").where(_within("insp_date", windows["inspections"]))
    i = i.select(
        "change_date", _digits("inspection_id").alias("source_key"), _digits("dot_number").alias("usdot_number"), parse.source_date(F.col("insp_date")).alias("event_date"),
        known("mcmis_add_date").alias("reported_date"), _digits("viol_total").alias("viol_total"), _digits("oos_total").alias("oos_total"),
    )
    why_i = first(
        invalid_inspection_integer=F.col("source_key").isNull() | F.col("usdot_number").isNull(),
        invalid_inspection_identity=(F.col("source_key") == "0") | (F.col("usdot_number") == "0"),
        invalid_event_date=F.col("event_date").isNull(),
        invalid_source_add_at=F.col("reported_date").isNull(),
        impossible_event_chronology=F.col("reported_date") < F.col("event_date"),
        invalid_source_add_at_=(F.col("change_date") != "") & parse.source_timestamp(F.col("change_date")).isNull(),
        invalid_inspection_integer_=F.col("viol_total").isNull() | F.col("oos_total").isNull(),
    )
    i = i.select(
        F.lit("inspection").alias("event_type"), "source_key", "usdot_number", "event_date", "reported_date", F.col("viol_total").try_cast("bigint").alias("violation_count"),
        F.col("oos_total").try_cast("bigint").alias("oos_violation_count"), F.lit(False).alias("federal_recordable"), why_i.alias("why"),
    )
    c = stripped(crashes, "report_date", "add_date", "report_state", "report_number", "report_time", "federal_recordable", "crash_id", "report_seq_no")
    c = c.where(_within("report_date", windows["crashes"])).withColumns(
        {
            "usdot_number": _digits("dot_number"), "event_date": parse.source_date(F.col("report_date")), "reported_date": known("add_date"),
            "clock": F.when(F.col("report_time").rlike(r"\A[0-9]+\z"), F.col("report_time").try_cast("int")), "told": F.lower("federal_recordable"),
        }
    )
    clock = F.col("clock")
    yes, no = ("y", "yes", "1", "true"), ("n", "no", "0", "false", "")
    why_c = first(
        invalid_usdot_number=F.coalesce("usdot_number", F.lit("0")) == "0",
        invalid_event_date=F.col("event_date").isNull(),
        invalid_source_add_at=F.col("reported_date").isNull(),
        impossible_event_chronology=F.col("reported_date") < F.col("event_date"),
        invalid_incident_key=(F.col("report_state") == "") | (F.col("report_number") == "") | clock.isNull() | (clock > 2359) | (clock % 100 > 59),
        invalid_federal_recordable=~F.col("told").isin(*yes, *no),
        missing_source_record_key=(F.col("crash_id") == "") & ~F.col("report_seq_no").rlike(r"\A[0-9]+\z"),
    )
    key = F.to_json(F.array("report_state", "report_number", F.date_format("event_date", "yyyy-MM-dd"), clock.cast("string")))
    c = c.select(
        F.lit("crash").alias("event_type"), key.alias("source_key"), "usdot_number", "event_date", "reported_date", zero.alias("violation_count"),
        zero.alias("oos_violation_count"), F.col("told").isin(*yes).alias("federal_recordable"), why_c.alias("why"),
    )
    late = F.when(F.col("reported_date") >= F.lit(data_as_of).cast("date"), F.lit("not_visible_at_acquisition"))
    both = i.unionByName(c).withColumn("why", F.coalesce("why", late))
    counters = both.groupBy("event_type", F.coalesce("why", F.lit("selected")).alias("outcome")).agg(F.count("*").alias("n"))
    return both.where("why is null").drop("why"), counters


def write_once(df: DataFrame, folder: str) -> str:
    """Publishes df below its fingerprint. The same content again is no write."""
    return published.publish(df, folder)


def catalog_rows(manifests: DataFrame, out: str, derived: DataFrame | None = None, converter_version: str = "1") -> None:
    """One JSON line a snapshot, by feed and acquisition date. derived: batch_id, derived_rows, value_fingerprint of the derived files."""
    df = manifests.select("batch_id", "feed_name", "observed_at", "object_sha256", "schema_fingerprint", "row_count", F.col("feed_name").alias("feed"), "acquisition_date")
    if derived is not None:
        df = df.join(derived.select("batch_id", "derived_rows", "value_fingerprint"), "batch_id", "left").withColumn("converter_version", F.lit(converter_version))
    df.write.mode("overwrite").partitionBy("feed", "acquisition_date").json(out)
