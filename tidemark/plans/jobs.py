"""The registered jobs over the feeds, one function a query."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions import keys, parse
from tidemark.operators import checks, clean, dataset, evaluate, features, history, incidents, maturity, profile, sketch, train
from tidemark.operators.stored import StoredHistory
from tidemark.sources import files, records, tables
from tidemark.sources.staging import shared_dir
from tidemark.sources.staging import staged_small as staged
from tidemark.streaming import arrivals


def batches(spark: SparkSession) -> DataFrame:
    return clean.loaded(tables.snapshot_batches(spark))


def clean_inspections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_inspections(tables.raw_inspections(spark, sf_dir), tables.snapshot_batches(spark))


def clean_crashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_crashes(tables.raw_crashes(spark, sf_dir), tables.snapshot_batches(spark))


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.change_candidates(clean_inspections(spark, sf_dir), clean_crashes(spark, sf_dir))


def seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates for a history: each distinct text typed once, with the batches that hold it."""
    return clean.seen_candidates(tables.raw_inspections(spark, sf_dir), tables.raw_crashes(spark, sf_dir), history.numbered(batches(spark)))


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.quarantine(clean_inspections(spark, sf_dir), clean_crashes(spark, sf_dir))


def exclusion_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # staged, as the filter on eligibility would else be made of the cells once more; without the columns that no count needs
    return clean.exclusion_counts(staged(candidates(spark, sf_dir).select("feed_name", "source_record_key", "is_model_eligible", "exclusion_reason")))


def _starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batches' `history.cutoffs`: a date each, which texts would else be read twice for."""
    return staged(clean.earliest_dates(tables.raw_inspections(spark, sf_dir), tables.snapshot_batches(spark)))


def versions(spark: SparkSession, sf_dir: str, columns: tuple[str, ...] = tuple(history.VERSION)) -> DataFrame:
    """The history. Texts go from their types straight to their records; staged is a date a batch."""
    starts = _starts(spark, sf_dir)
    return history.rebuild(seen(spark, sf_dir), batches(spark), columns, starts)[0]


def retention_expiries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of inspections alone: crashes have none."""
    made = clean.seen_inspections(tables.raw_inspections(spark, sf_dir), history.numbered(batches(spark)))
    return history.rebuild(staged(made), batches(spark))[1]


def events_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incidents.events_union(versions(spark, sf_dir))


def incident_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = staged(incidents.crashes(versions(spark, sf_dir)).select(*incidents.VEHICLE))
    return incidents.segments(made)


def current_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incidents.current_events(versions(spark, sf_dir))


def scoring_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month starts between the first and the last order month."""
    orders = tables.table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("timestamp").alias("observed_at"))
    return features.month_grid(orders)


def features_6m_24m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates(features.training_features(_events(spark, sf_dir), features.month_grid(batches(spark))))


def rates(df: DataFrame) -> DataFrame:
    """Exact ratios as doubles, for comparison across engines."""
    return df.withColumns({c: F.col(c).cast("double") for c in ("violations_per_inspection", "oos_violation_rate")})


#: What is known of crashes at this day is what labels and maturity rest on.
AS_OF = date(2001, 9, 5)
CUTOFF = date(2001, 9, 1)
LANDMARKS = ["1996-02-01", "1997-09-01", "2001-06-01"]


def parse_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every parser over text made from order keys: plain, signed, zero-padded, decimal, blank and broken."""
    k = F.col("o_orderkey")
    o = tables.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(k % 13 == 0, F.concat(F.lit(" +000"), k, F.lit(".00 "))).when(k % 13 == 1, F.concat(k, F.lit(".5"))).when(k % 13 == 2, F.lit("")).when(k % 13 == 3, F.concat(F.lit("-"), k)).otherwise(k.cast("string")).alias("n"),
        F.when(k % 11 == 0, F.lit("20230230")).when(k % 11 == 1, F.lit("00000101")).when(k % 11 == 2, F.concat(F.date_format("o_orderdate", "yyyyMMdd"), F.lit("\n"))).otherwise(F.concat(F.lit(" "), F.date_format("o_orderdate", "yyyyMMdd"))).alias("d"),
        F.concat(F.date_format("o_orderdate", "yyyyMMdd"), F.lit(" "), F.lpad((k % 26).cast("string"), 2, "0"), F.lpad((k % 70).cast("string"), 2, "0")).alias("ts"),
        F.element_at(F.array(*[F.lit(x) for x in ("Y", " no ", "TRUE", "0", "maybe", "", "1", "False")]), (k % 8 + 1).cast("int")).alias("b"),
        ((k * 37) % 2500).cast("string").alias("tm"),
    )
    return o.select(
        "o_orderkey", parse.nonnegative_integer(F.col("n")).alias("nonnegative"), parse.positive_id(F.col("n")).alias("id"),
        parse.source_date(F.col("d")).alias("day"), parse.source_timestamp(F.col("ts")).alias("at"), parse.source_boolean(F.col("b")).alias("flag"),
        parse.report_time(F.col("tm")).alias("time_of_day"), parse.request_usdot(F.col("n")).alias("request_id"),
        keys.ratio(k % 1000, k % 7).cast("double").alias("ratio"), parse.lag_bucket((k % 300).cast("int")).alias("bucket"),
    )


def incident_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incident and batch identities of orders."""
    o = tables.table(spark, sf_dir, "orders")
    text = lambda c: F.col(c).cast("string")
    return o.select(
        "o_orderkey",
        keys.incident_key(text("o_custkey"), F.col("o_orderstatus"), text("o_orderkey"), F.to_date("o_orderdate"), F.col("o_orderkey") % 2400).alias("incident_key"),
        files.batch_id(F.col("o_orderstatus"), F.col("o_orderpriority"), text("o_custkey"), text("o_orderkey"), F.lit("x")).alias("batch_id"),
        keys.fallback_key(F.col("o_orderstatus"), F.col("o_orderpriority"), F.to_date("o_orderdate"), F.col("o_orderkey") % 2400, F.col("o_custkey")).alias("fallback_key"),
    )


#: The dates of each feed that profiles are made from.
DATES = {"inspections": ("insp_date", "mcmis_add_date"), "crashes": ("report_date", "add_date")}


def snapshot_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = tables.snapshot_batches(spark).select("batch_id", F.col("feed_name").alias("feed"), tables.acquisition_date())
    rows = [tables.raw_rows(spark, sf_dir, f).select("batch_id", F.col(e).alias("raw_event_date"), F.col(a).alias("raw_source_add_at")) for f, (e, a) in DATES.items()]
    return rows[0].unionByName(rows[1]).join(F.broadcast(known), "batch_id").drop("batch_id")


def selected_rows(spark: SparkSession, folder: str, selected: DataFrame) -> DataFrame:
    """Dates of the selected (feed, acquisition_date) partitions; no other partition is read."""
    rows = []
    for feed, (event, added) in DATES.items():
        mine = tables.read_snapshots(spark, folder, feed).select(
            F.lit(feed).alias("feed"), "acquisition_date", F.col(event).alias("raw_event_date"), F.col(added).alias("raw_source_add_at")
        )
        rows.append(mine.join(F.broadcast(selected.where(F.col("feed") == feed).select("acquisition_date")), "acquisition_date", "left_semi"))
    return rows[0].unionByName(rows[1])


def snapshot_manifests(spark: SparkSession) -> DataFrame:
    b = tables.snapshot_batches(spark)
    return b.select(
        F.col("feed_name").alias("feed"), F.date_format("observed_at", "yyyy-MM-dd").alias("acquisition_date"), "batch_id",
        F.col("observed_at").alias("manifest_observed_at"), (F.col("batch_no") * 1000).cast("bigint").alias("manifest_row_count"),
    )


def reconcile_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All snapshots, the pending one among them, which has a manifest and no rows."""
    m = snapshot_manifests(spark)
    selected = m.select("feed", "acquisition_date")
    return profile.reconcile(selected_rows(spark, tables.snapshots(spark, sf_dir), selected), m, selected)


#: An inclusive range of acquisition dates, and the feed that it is read of.
BACKFILL = ("crashes", "1999-03-10", "2001-03-20")


def backfill_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshots of a bounded backfill with their rows, keys and latest date of addition, read from their partitions alone."""
    feed, first, last = BACKFILL
    known = batches(spark).select("feed_name", "batch_id", tables.acquisition_date()).withColumn("object_key", F.concat(F.lit("raw/feed="), "feed_name", F.lit("/acquisition_date="), "acquisition_date"))
    chosen = files.backfill(known, feed, first, last).select("acquisition_date")
    rows = tables.read_snapshots(spark, tables.snapshots(spark, sf_dir), feed).join(F.broadcast(chosen), "acquisition_date", "left_semi")
    return rows.groupBy("acquisition_date").agg(F.count("*").alias("n_rows"), F.countDistinct("crash_id").alias("n_keys"), F.max("add_date").alias("latest"))


def report_lag_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = profile.lag_profile(snapshot_rows(spark, sf_dir), snapshot_manifests(spark).drop("batch_id"), exact=True)
    return found.orderBy("feed", "acquisition_date", "lag_bucket")


def report_lag_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.lag_profile(snapshot_rows(spark, sf_dir), snapshot_manifests(spark).drop("batch_id"))


def lag_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles of each feed's lags over all snapshots from stored sketches, beside the exact values.

    The sketches are made in two runs: the second finds those of the first and reads the new snapshots alone.
    """
    folder = tables.snapshots(spark, sf_dir)
    store = sketch.SketchStore(spark, f"{shared_dir(spark)}/sketches-{uuid.uuid4().hex}")
    selected = snapshot_manifests(spark).select("feed", "acquisition_date")
    for wave in (selected.where("acquisition_date < '2001-01-01'"), selected):
        store.add(wave, lambda chosen: profile.lag_counts(selected_rows(spark, folder, chosen)), "lag_days", "n")
    listed = F.arrays_zip(F.array(*[F.lit(q) for q in profile.QUANTILES]).alias("quantile"), F.col("p").alias("estimate"))
    found = sketch.quantiles(store.read(), ["feed"], profile.QUANTILES).select("feed", F.col("n").alias("n_rows"), F.inline(listed))
    counts = profile.lag_counts(snapshot_rows(spark, sf_dir))
    ranks = W.partitionBy("feed")
    told = counts.groupBy("feed", "lag_days").agg(F.sum("n").alias("n")).withColumn("upto", F.sum("n").over(ranks.orderBy("lag_days")))
    true = found.join(told, "feed").where(F.col("upto") >= F.ceil(F.col("quantile") * F.col("n_rows"))).groupBy("feed", "n_rows", "quantile", "estimate").agg(F.min("lag_days").alias("exact"))
    near = F.abs(F.col("estimate") - F.col("exact")) <= F.col("exact") / 2**sketch.BITS
    return true.withColumn("within", near)


def lag_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lags between order and shipping, dense over the ten buckets."""
    o, li = tables.table(spark, sf_dir, "orders"), tables.table(spark, sf_dir, "lineitem")
    rows = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_returnflag").alias("feed"), F.lit("x").alias("acquisition_date"), F.date_format("o_orderdate", "yyyyMMdd").alias("raw_event_date"),
        F.date_format("l_shipdate", "yyyyMMdd HHmm").alias("raw_source_add_at"),
    )
    return profile.dense_histogram(rows)


def latency_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.latency_percentiles(tables.table(spark, sf_dir, "events"), "event_type", "value")


def json_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pos, n, total of the elements of JSON arrays made from events' props."""
    k = F.from_json("props", "struct<k:bigint>")["k"]
    arrays = tables.table(spark, sf_dir, "events").select(F.to_json(F.array(k, k * 2, k % 5)).alias("j"))
    return arrays.select(F.posexplode(F.from_json("j", "array<bigint>")).alias("pos", "v")).groupBy("pos").agg(F.count("v").alias("n"), F.sum("v").alias("total"))


def event_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _arrived(spark, sf_dir)[0]


def _arrived(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Manifests named by notifications made from events: some wrapped, some twice, some test events or malformed."""
    e = tables.table(spark, sf_dir, "events").select("event_id", (F.col("event_id") % 500).alias("g"))
    record = F.concat(F.lit('{"Records":[{"s3":{"bucket":{"name":"b'), F.col("g") % 3, F.lit('"},"object":{"key":"raw%2Ffeed%3D'), "g", F.lit('/manifest.json","versionId":"'), F.col("g") % 7, F.lit('"}}}]}'))
    body = (
        F.when(F.col("event_id") % 50 == 0, F.lit('{"Event":"s3:TestEvent"}'))
        .when(F.col("event_id") % 50 == 1, F.lit("not json"))
        .when(F.col("event_id") % 3 == 0, F.to_json(F.struct(F.lit("Notification").alias("Type"), record.alias("Message"))))
        .otherwise(record)
    )
    return arrivals.flatten(e.select(body.alias("body")))


def event_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(reason, n) of the notifications that name no manifest."""
    return _arrived(spark, sf_dir)[1].groupBy("reason").agg(F.count("*").alias("n"))


def _as_file(values: DataFrame) -> str:
    """A folder of text files with one value a line (which may hold line breaks of its own)."""
    folder = f"{shared_dir(values.sparkSession)}/text-{uuid.uuid4().hex}"
    values.write.text(folder)
    return folder


def csv_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dialect violations of CSV records made from orders: quoted, with line breaks, broken in each way, or of another width."""
    k, day = F.col("o_orderkey").cast("string"), F.date_format("o_orderdate", "yyyyMMdd")
    line = F.concat(F.lit('"'), "o_orderpriority", F.lit(', ""q""",'), k, F.lit(","), day)
    s = F.col("o_orderstatus")
    ways = [
        F.concat(s, F.lit("\x00,"), k, F.lit(",x")), F.concat(F.lit('"'), s, F.lit('"y,'), k, F.lit(",x")), F.concat(s, F.lit('"y,'), k, F.lit(',"x"y')),
        F.concat(k, F.lit(","), day), F.concat(F.lit('"'), k, F.lit("\n"), day, F.lit('",'), k, F.lit(",x")), F.concat(line, F.lit(",")),
        F.concat(F.lit('"a\r\n""\n'), s, F.lit('",'), k, F.lit(',"\n"')),
    ]
    for i, w in enumerate(ways):
        line = F.when(F.col("o_orderkey") % 11 == i, w).otherwise(line)
    text = tables.table(spark, sf_dir, "orders").select(line.alias("value"))
    return records.audit(records.read_records(spark, _as_file(text)), 3)


def csv_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a note of several lines, through a CSV file and back."""
    o = tables.table(spark, sf_dir, "orders")
    note = F.concat("o_orderpriority", F.lit(', "'), "o_orderstatus", F.lit('"'), F.expr("repeat('\\n', cast(o_orderkey % 4 as int))"), F.date_format("o_orderdate", "yyyyMMdd"))
    text = o.select(F.concat("o_orderkey", F.lit(',"'), F.replace(note, F.lit('"'), F.lit('""')), F.lit('",'), "o_orderstatus").alias("value"))
    found = records.read_records(spark, _as_file(text))
    return found.select(F.get("cells", F.lit(0)).cast("bigint").alias("o_orderkey"), F.get("cells", F.lit(1)).alias("note"), F.col("lines").alias("n_lines"), F.size("cells").alias("n_cells"))


def derived_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, nulls and value fingerprints of the inspection snapshots as text and of the Parquet derived from them."""
    text = tables.raw_inspections(spark, sf_dir).na.fill("")
    return files.reconcile_values(text, staged(text))


def flat_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat events of both feeds straight from the tables, without snapshots."""
    o = tables.table(spark, sf_dir, "orders").select((F.col("o_orderkey") + 1).alias("k"), (F.col("o_custkey") + 1).cast("string").alias("usdot_number"), F.to_date("o_orderdate").alias("event_date"))
    i = o.select(
        F.lit("inspection").alias("event_type"), F.col("k").cast("string").alias("source_key"), "usdot_number", "event_date",
        F.expr("date_add(event_date, cast(1 + (k - 1) % 60 as int))").alias("reported_date"), ((F.col("k") - 1) % 7).alias("violation_count"),
        F.least((F.col("k") - 1) % 3, (F.col("k") - 1) % 7).alias("oos_violation_count"), F.lit(False).alias("federal_recordable"),
    )
    v = vehicles(spark, sf_dir)
    c = v.select(
        F.lit("crash").alias("event_type"), F.col("report_number").alias("source_key"), "usdot_number", "event_date", "reported_date",
        F.lit(0).cast("bigint").alias("violation_count"), F.lit(0).cast("bigint").alias("oos_violation_count"), "federal_recordable",
    )
    return i.unionByName(c)


def vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One version of each crash vehicle (order line)."""
    li = tables.table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("p"), F.min("l_returnflag").alias("rf"))
    o = tables.table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") + 1).cast("string").alias("usdot_number"), F.to_date("o_orderdate").alias("event_date"), F.col("o_orderstatus").alias("report_state"))
    v = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    k = F.col("l_orderkey") * 8 + F.col("l_linenumber") + 1
    reported = F.expr("date_add(event_date, cast(1 + p % 90 as int))")
    return v.select(
        k.cast("string").alias("source_record_key"), F.when(k % 61 != 0, F.col("usdot_number")).alias("usdot_number"), "report_state",
        F.concat(F.lit("C-"), F.col("l_orderkey")).alias("report_number"), "event_date", (F.col("l_orderkey") % 2400).alias("report_time"),
        reported.alias("reported_date"), reported.cast("timestamp").alias("knowledge_valid_from"), (F.col("rf") != "N").alias("federal_recordable"),
        (k % 53 == 0).alias("is_deleted"),
    )


def landmark_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates(features.landmark_features(flat_events(spark, sf_dir), LANDMARKS, LANDMARKS[-1], "2001-09-03"))


#: Ranges of raw date text that the extraction takes of each feed.
EXTRACTED = {"inspections": [("19950101", "19960401"), ("19971015", "19990101"), ("20000101", "20010701")], "crashes": [("19930601", "20010715")]}


def _extracted(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    i = tables.raw_inspections(spark, sf_dir).where("batch_id = 'insp-6'")
    c = tables.raw_crashes(spark, sf_dir).where("batch_id = 'crash-6'")
    # some cells as other rows spell them
    k = F.col("source_row_number")
    i = i.withColumn("change_date", F.when(k % 41 == 0, F.lit("")).when(k % 41 == 1, F.lit("2001-02-03")).otherwise(F.col("change_date")))
    i = i.withColumn("insp_date", F.when(k % 5 == 0, F.concat(F.lit("  "), "insp_date")).otherwise(F.col("insp_date")))
    c = c.withColumn("federal_recordable", F.when(k % 43 == 0, F.lit("")).when(k % 43 == 1, F.lit("perhaps")).otherwise(F.lower("federal_recordable")))
    c = c.withColumn("report_seq_no", F.when(k % 2 == 0, F.lit("?")).otherwise(F.col("report_seq_no")))
    return files.source_events(i, c, EXTRACTED, "2001-06-01")


def source_event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes of an extraction from the last snapshots' text rows."""
    return _extracted(spark, sf_dir)[1]


def source_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _extracted(spark, sf_dir)[0]


def cohort_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mature cohorts with their orders, as of the last order date."""
    o = tables.table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("d"))
    months = features.cohort_months(spark, o.agg(F.max("d")).first()[0])
    n = o.groupBy(F.trunc("d", "MM").alias("event_month")).agg(F.count("*").alias("n_orders"))
    return months.join(n, "event_month", "left").select("event_month", F.coalesce("n_orders", F.lit(0)).alias("n_orders"))


def mature_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scoring months that the order and line dates cover with whole lookbacks and matured labels."""
    o = tables.table(spark, sf_dir, "orders").agg(F.min(F.to_date("o_orderdate")).alias("a"), F.max(F.to_date("o_orderdate")).alias("b")).first()
    return features.mature_grid(o["a"], o["a"], o["b"], AS_OF, 30, spark)


def first_incident_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maturity.first_incidents(vehicles(spark, sf_dir), AS_OF)


def _histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maturity.cohort_lags(staged(first_incident_reports(spark, sf_dir)), AS_OF)


def cohort_lag_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maturity.cohort_quantiles(_histogram(spark, sf_dir))


def maturity_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maturity.maturity_bound(_histogram(spark, sf_dir))


def maturity_order_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maturity.order_bounds(_histogram(spark, sf_dir))


#: (day, days by which reports come later than in the tables, whether a decrease was reviewed) of successive measurements.
MEASURED = [
    (date(1996, 1, 10), 0, False), (date(1999, 6, 5), 20, False), (date(2000, 3, 5), 0, False), (date(2000, 9, 5), 0, True), (date(2001, 3, 5), 10, False), (date(2001, 9, 5), 0, False),
]


def maturity_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The policy after each of several measurements: first incidents, cohorts, bound, and what the policy makes of it."""
    lags, found = maturity.measured_lags(vehicles(spark, sf_dir), [(day, late) for day, late, _ in MEASURED]), None
    for day, _, _ in MEASURED:
        bounds = maturity.order_bounds(lags.where(F.col("data_as_of") == F.lit(day)).drop("data_as_of")).select(F.lit(day).alias("data_as_of"), "high_95_days")
        found = bounds if found is None else found.unionByName(bounds)
    reviewed = spark.createDataFrame([(d, r) for d, _, r in MEASURED], "data_as_of date, reviewed_decrease boolean")
    grace = reviewed.join(maturity.measured_grace(found, "high_95_days"), "data_as_of", "left")
    return maturity.policy_rows(grace)


def maturity_policy_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Succession rules over the policy's rows, and over a copy that breaks each of them."""
    rows = staged(maturity_policy(spark, sf_dir))
    first = F.col("previous_version").isNull()
    spoiled = rows.withColumns(
        {
            "is_current": F.lit(True), "previous_version": F.when(first, F.lit("none")).otherwise(F.col("previous_version")),
            "data_as_of": F.when(F.col("is_current"), F.lit(date(1990, 1, 1))).otherwise(F.col("data_as_of")),
            "grace_days": F.when(F.col("is_current"), 1).otherwise(F.col("grace_days")),
        }
    )
    told = lambda df, name: maturity.registry_violations(df).select(F.lit(name).alias("registry"), "rule", "violations")
    return told(rows, "policy").unionByName(told(spoiled, "spoiled"))


#: What features, labels and provenance need of a version.
NEEDED = (
    "feed_name", "source_record_key", "event_version_key", "usdot_number", "event_date", "reported_date", "report_state", "state", "report_number", "report_time",
    "violation_count", "oos_violation_count", "knowledge_valid_from", "knowledge_valid_to", "is_deleted", "is_model_eligible", "availability_quality",
)
EVENT = incidents.EVENT


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What features need of events_union."""
    return incidents.events_union(versions(spark, sf_dir, NEEDED), EVENT)


def _versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(versions(spark, sf_dir, NEEDED))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features with six-month outcomes as known at the cutoff, for the months whose outcomes are whole."""
    grid = features.month_grid(batches(spark)).where(F.add_months("scoring_date", 6) <= F.lit(CUTOFF))
    return dataset.labelled(_events(spark, sf_dir), grid, CUTOFF)


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled(spark, sf_dir).select("usdot_number", "scoring_date", "incident_count", "label")


def purged_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part, rows and positives of the split of the labelled rows."""
    rows = staged(labelled(spark, sf_dir))
    grid = features.month_grid(batches(spark)).where(F.add_months("scoring_date", 6) <= F.lit(CUTOFF))
    split = dataset.purged_split(rows, grid)
    return split.groupBy("part").agg(F.count("*").alias("n_rows"), F.sum("label").alias("positives"), F.min("scoring_date").alias("first"), F.max("scoring_date").alias("last"))


def availability_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = features.month_grid(batches(spark)).where(F.add_months("scoring_date", 6) <= F.lit(CUTOFF))
    events = staged(_events(spark, sf_dir))
    rows = staged(features.training_features(events, grid).select("usdot_number", "scoring_date"))
    return dataset.availability_mix(dataset.contributions(rows, events, CUTOFF))


def population_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored carrier-months, spoiled to show differences, against those that the events call for."""
    e = staged(_events(spark, sf_dir))
    grid = features.month_grid(batches(spark))
    return dataset.population_diff(_spoiled(features.training_features(e, grid)), e, grid)


def _spoiled(stored: DataFrame) -> DataFrame:
    """Features of which some carriers are lost, some have another date and some other counts."""
    c = F.col("usdot_number").cast("bigint")
    moved = F.when(c % 107 == 0, F.add_months("scoring_date", 1200)).otherwise(F.col("scoring_date"))
    more = F.when(c % 103 == 0, F.col("violations_6m") + 1).otherwise(F.col("violations_6m"))
    return stored.where(c % 100 != 0).withColumns({"scoring_date": moved, "violations_6m": more})


def features_recomputed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored features, spoiled, against an independent recomputation by the plain interval join."""
    e = staged(_events(spark, sf_dir))
    grid = features.month_grid(batches(spark))
    return features.feature_differences(_spoiled(features.training_features(e, grid)), features.recomputed_features(e, grid))


def encoding_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(reason, n) of feature rows that no model may see, of features spoiled by rules on the carrier."""
    f = features.training_features(_events(spark, sf_dir), features.month_grid(batches(spark)))
    c = F.col("usdot_number").cast("bigint")
    spoil = {
        "inspections_6m": F.when(c % 31 == 0, 0).otherwise(F.col("inspections_6m")),
        "days_since_last_inspection": F.when(c % 37 == 0, 0).otherwise(F.col("days_since_last_inspection")),
        "oos_violation_rate": F.when(c % 41 == 0, F.lit(None)).when(c % 43 == 0, F.lit(0)).otherwise(F.col("oos_violation_rate")),
        "crashes_24m": F.when(c % 47 == 0, -1).otherwise(F.col("crashes_24m")),
        "usdot_number": F.when(c % 53 == 0, F.concat(F.lit("0"), "usdot_number")).otherwise(F.col("usdot_number")),
    }
    rows = train.encoded(f.withColumns(spoil))
    return rows.select(F.explode("invalid").alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


def landmark_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boundary rules of the landmark features, spoiled by rules on the carrier."""
    rows = features.landmark_features(flat_events(spark, sf_dir), LANDMARKS, LANDMARKS[-1], "2001-09-03")
    c = F.col("usdot_number").cast("bigint")
    spoil = {
        "inspections_4m": F.when(c % 31 == 0, 0).otherwise(F.col("inspections_4m")),
        "crashes_24m": F.when(c % 37 == 0, -1).otherwise(F.col("crashes_24m")),
        "days_since_last_inspection": F.when(c % 41 == 0, 0).otherwise(F.col("days_since_last_inspection")),
        "oos_violation_rate": F.when(c % 43 == 0, F.lit(None)).otherwise(F.col("oos_violation_rate")),
        "label": F.when(c % 47 == 0, 1).otherwise(F.col("label")),
    }
    return features.landmark_violations(rows.withColumns(spoil), LANDMARKS[-1])


def inspection_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inspections whose retained rows differ, of flat events of which some are repeated and some changed."""
    e = flat_events(spark, sf_dir).where("event_type = 'inspection'")
    k = F.col("source_key").cast("bigint")
    e = e.unionByName(e.where(k % 13 == 0)).unionByName(e.where(k % 211 == 0).withColumn("violation_count", F.col("violation_count") + 1))
    distinct = e.select("source_key", "usdot_number", "event_date", "reported_date", "violation_count", "oos_violation_count").distinct()
    return checks.duplicates(distinct, "inspection_identity", "source_key")


def dataset_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dataset.dataset_fingerprint(labels(spark, sf_dir))


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a label (urgent) and three deterministic scores with ties."""
    k, p = F.col("o_orderkey"), F.col("o_totalprice")
    y = F.col("o_orderpriority").startswith("1").cast("int")
    return tables.table(spark, sf_dir, "orders").select(
        y.alias("label"), ((k * 7919) % 1000 / 1000 * 0.7 + y * 0.3).alias("candidate"), F.floor(p / 1000).cast("double").alias("baseline"),
        ((k * 104729) % 50 / 50.0).alias("incumbent"),
    )


def average_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.average_precision(scores(spark, sf_dir), ["candidate", "baseline", "incumbent"], "label")


def model_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.compare_models(scores(spark, sf_dir), "candidate", "baseline", "incumbent", "label")


def f1_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.f1_threshold(scores(spark, sf_dir), "candidate", "label")


def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.confusion(scores(spark, sf_dir), "candidate", "label", 0.5)


def _split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = staged(train.encoded(labelled(spark, sf_dir)))
    grid = features.month_grid(batches(spark)).where(F.add_months("scoring_date", 6) <= F.lit(CUTOFF))
    return dataset.purged_split(rows, grid)


def boosted_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows of the purged split with the probability of a model fitted to its train rows."""
    split = _split(spark, sf_dir)
    model = train.train(split)
    return train.score(model, split.where("part = 'test'")).select("usdot_number", "scoring_date", "label", "probability")


def boosted_holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The boosted trees' threshold on their train rows and their metrics on the test rows."""
    split = _split(spark, sf_dir)
    return evaluate.holdout(staged(train.score(train.train(split), split)), "probability", "violations_per_inspection", "label")


def rate_holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same evaluation of a score that needs no model: the violations an inspection."""
    return evaluate.holdout(_split(spark, sf_dir), "violations_per_inspection", "crashes_24m", "label")


def batch_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every carrier's decision on a day: score, or why not."""
    e = staged(_events(spark, sf_dir))
    found = features.training_features(e, features.month_grid(batches(spark)))
    carriers = tables.table(spark, sf_dir, "orders").select((F.col("o_custkey") + 1).cast("string").alias("usdot_number"))
    return train.batch_decisions(found, e, train.request_dates(carriers, date(2001, 3, 11)))


#: Days on which every carrier is asked for.
REQUESTED = [date(2000, 8, 15), date(2000, 12, 31), date(2001, 3, 1), date(2001, 6, 30)]


def batch_decisions_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every carrier's decision on several days."""
    e = staged(_events(spark, sf_dir))
    found = features.training_features(e, features.month_grid(batches(spark)))
    carriers = tables.table(spark, sf_dir, "orders").select((F.col("o_custkey") + 1).cast("string").alias("usdot_number")).distinct()
    asked = carriers.withColumn("request_date", F.explode(F.array(*[F.lit(d) for d in REQUESTED])))
    return train.batch_decisions(found, e, asked)


def batch_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every carrier's decision on a day with a score where there is one; the score is a plain function of the features."""
    e = staged(_events(spark, sf_dir))
    found = features.training_features(e, features.month_grid(batches(spark)))
    carriers = tables.table(spark, sf_dir, "orders").select((F.col("o_custkey") + 1).cast("string").alias("usdot_number"))
    v = F.col("violations_per_inspection")
    return train.batch_scores(found, e, train.request_dates(carriers, date(2001, 3, 11)), lambda rows: rows.withColumn("probability", v / (v + 1)))


def _stepwise(spark: SparkSession, sf_dir: str) -> tuple[StoredHistory, DataFrame]:
    """(stored history, united candidates): the first snapshots of each feed at once and the later ones batch by batch."""
    made, known = staged(seen(spark, sf_dir)), batches(spark)
    if made.where("copies > 0 and source_record_key is not null").limit(1).count():
        raise ValueError("a batch holds a key twice")
    early = known.where("batch_no <= 4")
    store = StoredHistory(spark, f"{shared_dir(spark)}/history-{uuid.uuid4().hex}", alone=True)
    store.seed(*history.rebuild(made, early), early)
    store.apply_pending(history.appearances(made, known), known)
    return store, made


def incremental_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stepwise(spark, sf_dir)[0].versions()


def incremental_expiries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stepwise(spark, sf_dir)[0].expiries()


def applied_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry after an incremental run: each batch with its rows and the versions that it made."""
    store, _ = _stepwise(spark, sf_dir)
    applied = store.applied()
    told = [tables.raw_rows(spark, sf_dir, f).select("batch_id") for f in tables.COLUMNS]
    rows = told[0].unionByName(told[1]).groupBy("batch_id").agg(F.count("*").alias("n_rows"))
    born = store.versions().groupBy(F.col("first_seen_batch_id").alias("batch_id")).agg(F.count("*").alias("n_versions"))
    sound = applied.join(dataset.unattested(applied, tables.snapshot_batches(spark)), "batch_id", "left_anti")
    return sound.join(rows, "batch_id", "left").join(born, "batch_id", "left").select("batch_id", "feed_name", "observed_at", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.coalesce("n_versions", F.lit(0)).alias("n_versions"))


def _arrivals_loaded(spark: SparkSession, sf_dir: str) -> StoredHistory:
    """The history that arriving manifests build: each names a snapshot, some arrive twice, and one comes again later."""
    folder, source = f"{shared_dir(spark)}/arrivals-{uuid.uuid4().hex}", tables.snapshots(spark, sf_dir)
    counted = [tables.read_snapshots(spark, source, f).groupBy("batch_id").agg(F.count("*").alias("row_count")) for f in tables.COLUMNS]
    manifests = staged(batches(spark).join(counted[0].unionByName(counted[1]), "batch_id").select("batch_id", "feed_name", "observed_at", "row_count", "batch_no"))
    store = StoredHistory(spark, f"{folder}/history", alone=True)

    def rows_of(m: Row) -> DataFrame:
        day = m["observed_at"].date().isoformat()
        return tables.read_snapshots(spark, source, m["feed_name"]).where(F.col("acquisition_date") == day).drop("acquisition_date")

    def candidates_of(rows: DataFrame, m: Row) -> DataFrame:
        known = tables.snapshot_batches(spark)
        if m["feed_name"] == "inspections":
            return clean.inspection_candidates(clean.clean_inspections(rows, known))
        return clean.crash_candidates(clean.clean_crashes(rows, known))

    def united(feed: str, rows: DataFrame, known: DataFrame) -> DataFrame:
        return {"inspections": clean.seen_inspections, "crashes": clean.seen_crashes}[feed](rows, history.numbered(known))

    for wave in ("batch_no <= 3", "batch_no >= 3"):
        manifests.where(wave).drop("batch_no").repartition(2).write.mode("append").json(f"{folder}/in")
        arrivals.load_history(spark, f"{folder}/in", store, f"{folder}/checkpoint", rows_of, candidates_of, united)
    return store


def arrived_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _arrivals_loaded(spark, sf_dir).versions()


def arrived_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """batch_id, n_rows, n_keys of the source rows that came in with the batches."""
    store = _arrivals_loaded(spark, sf_dir)
    keyed = [("inspections", "inspection_id"), ("crashes", "crash_id")]
    both = [store.rows(f"batch_id string, {key} string", feed).select("batch_id", F.col(key).alias("k")) for feed, key in keyed]
    return both[0].unionByName(both[1]).groupBy("batch_id").agg(F.count("*").alias("n_rows"), F.countDistinct("k").alias("n_keys"))


def maturity_exclusions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maturity.missing_carriers(vehicles(spark, sf_dir), AS_OF)


def provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the labelled rows rest on, and the outcomes that could not be used."""
    v = _versions(spark, sf_dir)
    grid = features.month_grid(batches(spark)).where(F.add_months("scoring_date", 6) <= F.lit(CUTOFF))
    events = incidents.events_union(v, EVENT)
    rows = staged(features.training_features(events, grid).select("usdot_number", "scoring_date"))
    return dataset.provenance(dataset.contributions(rows, events, CUTOFF), v.where("feed_name = 'crashes'"), CUTOFF)


#: What the rules on a history look at.
CHECKED = (
    "event_version_key", "feed_name", "event_type", "source_record_key", "event_date", "reported_date", "knowledge_valid_from", "knowledge_valid_to",
    "availability_quality", "first_observed_at", "is_model_eligible", "exclusion_reason", "usdot_number", "record_hash", "is_current", "is_deleted", "deletion_reason",
    "first_seen_batch_id", "last_seen_batch_id", "predecessor_version_key", "superseded_by_version_key",
)


def history_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counts of the history, with versions spoiled by their key so that each rule on a row has something to find."""
    v, expiries = history.rebuild(seen(spark, sf_dir), batches(spark), CHECKED, _starts(spark, sf_dir))
    lot = F.pmod(F.conv(F.substring("event_version_key", 1, 8), 16, 10).cast("bigint"), F.lit(200))
    spoil = {
        "is_current": F.when(lot == 0, ~F.col("is_current")).otherwise(F.col("is_current")),
        "availability_quality": F.when(lot == 1, F.lit("guess")).otherwise(F.col("availability_quality")),
        "deletion_reason": F.when(lot > 20, F.col("deletion_reason")),
        "event_type": F.when(lot == 3, F.lit("other")).otherwise(F.col("event_type")),
        "record_hash": F.when(lot != 4, F.col("record_hash")),
        "usdot_number": F.when(lot != 5, F.col("usdot_number")),
        "exclusion_reason": F.when(lot > 60, F.col("exclusion_reason")),
        "event_date": F.when(lot == 7, F.date_add("reported_date", 1)).otherwise(F.col("event_date")),
        "reported_date": F.when(lot == 8, F.date_add("reported_date", 2)).otherwise(F.col("reported_date")),
    }
    expiries = staged(expiries)
    again = expiries.where(F.col("source_record_key").try_cast("bigint") % 50 == 0)
    return checks.history_violations(staged(v.withColumns(spoil)), batches(spark), expiries.unionByName(again))


def publication_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules on candidates to be published, of which some name no known batch or another time and some are keyless or doubled."""
    made = staged(candidates(spark, sf_dir).select("batch_id", "observed_at", "feed_name", "source_record_key", "is_model_eligible"))
    k = F.coalesce(F.col("source_record_key").try_cast("bigint"), F.lit(-1))
    made = made.withColumns(
        {
            "batch_id": F.when(k % 301 == 0, F.lit("none")).otherwise(F.col("batch_id")),
            "observed_at": F.when(k % 307 == 0, F.col("observed_at") + F.expr("interval 1 day")).otherwise(F.col("observed_at")),
            "source_record_key": F.when(k % 311 != 0, F.col("source_record_key")),
        }
    )
    made = made.unionByName(made.where(k % 313 == 0))
    expected = batches(spark).select("batch_id", (F.col("batch_no") * 1000).alias("row_count"))
    twice = batches(spark).unionByName(batches(spark).where("batch_no = 2"))
    return checks.publication_violations(made, twice, expected)


def contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = {
        "o_orderkey": {"not_null": True, "unique": True},
        "o_custkey": {"unique": True},
        "o_orderstatus": {"not_null": True, "accepted": ["O", "F"]},
        "o_orderpriority": {"not_null": True, "where": "o_totalprice > 100", "accepted": ["1-URGENT", "2-HIGH"]},
    }
    return checks.contract_violations(tables.table(spark, sf_dir, "orders"), rules)


def replay_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history built twice from the same batches."""
    made, starts = seen(spark, sf_dir), _starts(spark, sf_dir)
    return checks.replay_identity(history.rebuild(made, batches(spark), starts=starts)[0], history.rebuild(made, batches(spark), starts=starts)[0])
