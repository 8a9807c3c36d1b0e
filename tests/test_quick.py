"""Typed rows and histories that took several times their rows' work: patterns on plain cells, dates printed anew, a pass a window."""

from pyspark.sql import functions as F

from tidemark.functions import parse
from tidemark.operators import clean, history
from tidemark.plans import jobs
from tidemark.sources import tables

QUICK = [
    (parse.quick_id, parse.positive_id), (parse.quick_integer, parse.nonnegative_integer), (parse.quick_time, parse.report_time),
    (parse.quick_date_text, parse.source_date_text), (parse.quick_timestamp_text, parse.source_timestamp_text),
]


def test_quick_parsers_give_the_same_values(spark):
    numbers = ["7", "0", "00", "007", "+7", "-7", "-0", " 7", "7 ", "7.0", "7.5", "7.", ".7", "1e3", "7\n", "\t7", "", " ", None, "x", "\u0667", "7\x00", "0x7", "7L"]
    numbers += ["2147483647", "2147483648", "-2147483648", "9223372036854775807", "9223372036854775808", "-9223372036854775808", "9" * 30, "0" * 30 + "12"]
    times = ["59", "60", "930", "0930", "00930", "0930.00", "0930.50", "1259", "1260", "2359", "2360", "2400", "-005", "+930", "9 30"]
    days = ["20240229", "20230229", "09990101", "00000101", "99991231", "10000101", "2024022", "202402291", "2024-2-9", "+2024022", "-2024022", " 20240229", "20240229 ", "20241301", "20240100"]
    hours = [" 0900", " 2359", " 2400", " 1260", " 0005", " 0000", " 5", " 05", " -005", " +900", "  900", " 900 ", " 09000", " 0900 ", "T0900", "  0900", " 09:0", "\t0900", " 9.00", ""]
    values = numbers + times + days + [d + h for d in days for h in hours]
    df = spark.createDataFrame([(v,) for v in values], "s string").repartition(1)
    for quick, plain in QUICK:
        kinds = {"quick_date_text": "date", "quick_timestamp_text": "timestamp_ntz"}
        a, b = quick(F.col("s")), plain(F.col("s"))
        if quick.__name__ in kinds:  # texts that are no time may differ
            a, b = (F.struct(x.try_cast(kinds[quick.__name__]), F.when(x.try_cast(kinds[quick.__name__]).isNotNull(), x)) for x in (a, b))
        assert df.where(~a.eqNullSafe(b)).select("s", a, b).collect() == [], quick.__name__
        assert df.where(a.isNotNull()).count() > 0


def _lines(df, start):
    plan = df._jdf.queryExecution().optimizedPlan().toString().split("\n")
    return [x.lstrip(" :+-") for x in plan if x.lstrip(" :+-").startswith(start)]


def test_typed_rows_take_two_projections_and_print_no_dates(spark):
    blank = {f: spark.createDataFrame([], "batch_id string, source_row_number bigint, " + ", ".join(f"{c} string" for c in cells)) for f, cells in tables.COLUMNS.items()}
    for feed, typed in (("inspections", clean.clean_inspections), ("crashes", clean.clean_crashes)):
        known = spark.createDataFrame([("b", feed, None, "loaded")], "batch_id string, feed_name string, observed_at timestamp, status string").repartition(1)
        df = typed(blank[feed].repartition(1), known)
        plan = df._jdf.queryExecution().analyzed().toString()
        assert "cast(source_change_at" not in plan, feed
        # cells, what follows from them, and those of the join and its sides
        assert len([x for x in plan.split("\n") if x.lstrip(" :+-").startswith("Project")]) <= 4, feed


def test_a_history_takes_four_passes(spark):
    blank = spark.createDataFrame([], ", ".join(f"{n} {t}" for n, t in clean.CANDIDATE.items())).repartition(1)
    made, expiries = history.rebuild(blank, jobs.batches(spark))
    for df in (made, expiries):
        assert sum("source_record_key" in x for x in _lines(df, "Window")) <= 4


def test_queries_stage_only_the_cells_and_feeds_that_they_need(spark, monkeypatch):
    seen, plain = [], jobs.staged
    monkeypatch.setattr(jobs, "staged", lambda df: seen.append(df) or plain(df))
    for query in (jobs.exclusion_counts, jobs.publication_violations, jobs.retention_expiries):
        seen.clear()
        query(spark, "/root/testdata/sf0.001")
        plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
        # no hash of rows that are only counted, no crashes where only inspections expire
        assert len(seen) == 1 and ("l_linenumber" not in plan if query is jobs.retention_expiries else "record_hash" not in seen[0].columns), query.__name__
