"""Work that grew faster than its rows: rows moved only to be written, cells stripped anew for each rule."""

import datetime
import re

import pytest

from tidemark.sources import files, tables


@pytest.fixture
def small(spark, tmp_path):
    for feed, cells in tables.COLUMNS.items():
        rows = [(b, i, *["7"] * len(cells), o[:10]) for b, f, _, o in tables.BATCHES if f == feed for i in range(40)]
        names = ", ".join(f"{c} string" for c in cells)
        df = spark.createDataFrame(rows, f"batch_id string, source_row_number bigint, {names}, acquisition_date string").repartition(3)
        df.write.partitionBy("acquisition_date").parquet(f"{tmp_path}/snapshots/{feed}")
    return str(tmp_path)


def _shuffled(spark):
    sc, jvm = spark.sparkContext._jsc.sc(), spark._jvm
    sc.listenerBus().waitUntilEmpty()
    found = sc.statusStore().stageList(jvm.java.util.ArrayList(), False, False, spark.sparkContext._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
    return sum(found.apply(i).shuffleWriteRecords() for i in range(found.size()))


def test_snapshots_are_written_where_their_rows_are(spark, small, tmp_path):
    before, writers = _shuffled(spark), spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    tables.write_snapshots(spark, small, f"{tmp_path}/out")
    assert _shuffled(spark) == before
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == writers
    for feed in tables.COLUMNS:
        a, b = (sorted(tables.read_snapshots(spark, f, feed).collect()) for f in (f"{small}/snapshots", f"{tmp_path}/out"))
        assert a == b and len({r["acquisition_date"] for r in b}) == 6
        assert all(datetime.date.fromisoformat(r["acquisition_date"]) for r in b)


def test_an_extraction_strips_a_cell_a_few_times_at_most(spark, small):
    i, c = (tables.raw_rows(spark, small, f) for f in ("inspections", "crashes"))
    events, _ = files.source_events(i, c, {"inspections": [("0", "9")], "crashes": [("0", "9")]}, "2001-06-01")
    plan = events._jdf.queryExecution().optimizedPlan().toString()
    # the filter on what is broken, pushed below the projection, makes its cells for itself
    for cell in ("change_date", "add_date", "report_state", "report_time", "report_seq_no", "federal_recordable"):
        assert len(re.findall(rf"regexp_replace\(coalesce\({cell}#", plan)) <= 7, cell
