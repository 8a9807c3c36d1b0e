"""Histories staged all their typed texts, and wrote each column of a version anew in every window."""

from pyspark.sql import functions as F

from tidemark.operators import clean, history
from tidemark.plans import jobs
from tidemark.sources import tables

SF = "/root/testdata/sf0.001"


def _told(df):
    return sorted(tuple(str(x) for x in r) for r in df.select(*sorted(df.columns)).collect())


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_versions_stage_a_date_a_batch_and_no_texts(spark, monkeypatch):
    found, plain = [], jobs.staged
    monkeypatch.setattr(jobs, "staged", lambda df: found.append(df) or plain(df))
    jobs.versions(spark, SF)
    assert [df.columns for df in found] == [["batch_id", "cutoff"]]
    # the dates that the typed texts give
    typed = jobs.candidates(spark, SF)
    assert _told(found[0]) == _told(history.cutoffs(typed, history.numbered(jobs.batches(spark)))) and found[0].count() == 6


def test_windows_carry_the_payload_as_one_column(spark):
    plan = _plan(jobs.versions(spark, SF))
    windows = [line for line in plan.splitlines() if "Window [" in line and "windowspecdefinition(source_record_key" in line]
    # between the last and the first window no column of the payload stands by itself
    assert len(windows) >= 3 and "report_seq_no" not in plan[plan.index(windows[0]) : plan.index(windows[-1])]


def test_the_key_is_not_made_before_texts_are_united(spark):
    plan = _plan(jobs.versions(spark, SF))
    assert "Filter" in plan and not [line for line in plan.splitlines() if "Filter" in line and "regexp_extract" in line]


def test_fewer_columns_give_the_same_versions(spark):
    whole, some = jobs.versions(spark, SF), jobs.versions(spark, SF, jobs.NEEDED)
    assert set(some.columns) == set(jobs.NEEDED) and _told(some) == _told(whole.select(*jobs.NEEDED))


def test_a_keyless_text_starts_no_record(spark):
    steps = history.numbered(jobs.batches(spark))
    raw = tables.raw_inspections(spark, SF).where("source_row_number % 40 = 1").withColumn("inspection_id", F.lit("x"))
    seen = clean.seen_inspections(raw, steps).localCheckpoint()
    assert seen.count() > 0 and history.rebuild(seen, jobs.batches(spark))[0].count() == 0


def test_cells_that_snapshots_share_are_spelled_before_them(spark):
    for feed, cell in (("inspections", "concat(I-"), ("crashes", "concat(C-")):
        plan = _plan(tables.raw_rows(spark, SF, feed))
        assert plan.index("Generate explode") < plan.index(cell)
