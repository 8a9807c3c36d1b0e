"""A histogram that read its rows twice and parsed every one of them."""

from tidemark.operators import profile
from tidemark.plans import jobs


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_histogram_reads_its_rows_once_and_parses_distinct_texts(spark, monkeypatch):
    found, plain = [], profile.staged
    monkeypatch.setattr(profile, "staged", lambda df: found.append(df) or plain(df))
    out = jobs.lag_histogram(spark, "/root/testdata/sf0.001")
    assert "lineitem" not in _plan(out) and len(found) == 1
    # what the rows are before they are counted
    below = _plan(found[0]).rsplit("Aggregate", 1)[1].split("\n", 1)[1]
    assert "regexp" not in below and "l_shipdate" in below


def test_a_histogram_keeps_feeds_and_leaves_rows_without_a_lag(spark):
    rows = [("a", "20200101", "20200101 0900"), ("a", "20200101", "20200101 0900"), ("a", "20200105", "20200101 0900"), ("a", "x", "20200101 0900"), ("b", "20200101", None), ("b", None, "20200101 0900")]
    df = spark.createDataFrame([(f, "d", e, a) for f, e, a in rows], "feed string, acquisition_date string, raw_event_date string, raw_source_add_at string")
    got = {(r[0], r[1]): r[2] for r in profile.dense_histogram(df).where("n > 0").collect()}
    assert got == {("a", "01 1-2 days"): 2}
