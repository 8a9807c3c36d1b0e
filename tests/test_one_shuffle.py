"""Histories moved their texts twice: to be united, and then to their records."""

import random

from pyspark.sql import functions as F
from test_seen import _texts

from tidemark.operators import clean, history
from tidemark.plans import jobs
from tidemark.sources import tables

SF = "/root/testdata/sf0.001"


def _moved(df):
    """What rows are dealt out by, as it is planned."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line[line.index("Exchange") :] for line in plan.splitlines() if "Exchange hashpartitioning(" in line]


def test_versions_move_each_row_to_its_record_and_nowhere_else(spark):
    found = _moved(jobs.versions(spark, SF))
    assert sum("hashpartitioning(record#" in line for line in found) == 2
    assert not [line for line in found if "source_record_key" in line or "inspection_id" in line or "crash_id" in line]


def test_a_text_lies_at_the_record_that_it_tells_of(spark):
    dice = random.Random(9)
    known = jobs.batches(spark)
    for feed, made, key in (("inspections", clean.seen_inspections, "inspection_id"), ("crashes", clean.seen_crashes, "crash_id")):
        ids = [b.split("-")[1] for b, f, _, _ in tables.BATCHES if f == feed]
        rows = [(b.replace("inspections", "insp").replace("crashes", "crash"), *rest) for b, *rest in _texts(dice, feed, ids)]
        raw = spark.createDataFrame(rows, "batch_id string, source_row_number bigint, " + ", ".join(f"{c} string" for c in tables.COLUMNS[feed]))
        # ids and the parts that make up for one, as odd as they come
        odd = {c: F.element_at(F.array(*[F.lit(x) for x in xs]), (F.col("source_row_number") % len(xs) + 1).cast("int")) for c, xs in {
            key: (None, "", " +007.0 ", "x", "9223372036854775808", "12"), "report_state": ("A", " B ", None, " "), "report_number": ("n\"1", " n ", ""),
            "report_date": ("19970105", " 19970105 ", "19970230", "x", None), "report_time": ("0930", "930", "2360", None, "5"), "report_seq_no": ("1", "01", "+1.0", "x", None),
        }.items() if c in raw.columns}
        seen = made(raw.withColumns(odd), history.numbered(known)).localCheckpoint()
        keyed, keyless = seen.where("source_record_key is not null"), seen.where("source_record_key is null")
        assert keyed.count() > 0 and keyed.where("record != source_record_key").count() == 0
        # rows without a key are not all dealt to one place
        assert keyless.select("record").distinct().count() > 5 and keyless.where("record is null").count() == 0


def test_lines_of_an_order_are_moved_once(spark):
    found = [line for line in _moved(tables.raw_crashes(spark, SF)) if "l_orderkey" in line]
    assert len(found) == 1 and "l_linenumber" not in found[0][: found[0].index(")")]
