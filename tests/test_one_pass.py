"""Measurements that each moved and wrote all versions anew."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.operators import maturity
from tidemark.plans import jobs

SF = "/root/testdata/sf0.001"
VERSION = "source_record_key string, usdot_number string, report_state string, report_number string, event_date date, report_time bigint, reported_date date, knowledge_valid_from timestamp, federal_recordable boolean, is_deleted boolean"


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _versions(spark, dice, n):
    rows = []
    for i in range(n):
        event = date(2000, dice.randint(1, 12), dice.randint(1, 28))
        for _ in range(dice.choice([1, 1, 1, 2, 3])):
            at = date(2001, dice.randint(1, 12), dice.randint(1, 28))
            rows.append((f"k{i}", dice.choice(["7", "8", None]), "A", f"n{i // 3}", event, 5, dice.choice([at, date(2001, 1, 1)]), at, dice.random() < 0.8, dice.random() < 0.1))
    return spark.createDataFrame(rows, VERSION.replace("from timestamp", "from date")).withColumn("knowledge_valid_from", F.col("knowledge_valid_from").cast("timestamp")).dropDuplicates(["source_record_key", "knowledge_valid_from"])


def test_all_measurements_at_once_equal_each_alone(spark):
    v = _versions(spark, random.Random(3), 400).localCheckpoint()
    measured = [(date(2001, 6, 5), 0), (date(2001, 10, 5), 20), (date(2002, 3, 5), 10)]
    got = sorted(tuple(r) for r in maturity.measured_lags(v, measured).collect())
    want = []
    for day, late in measured:
        told = v.withColumns({"reported_date": F.date_add("reported_date", late), "knowledge_valid_from": F.col("knowledge_valid_from") + F.expr(f"interval {late} days")})
        want += [(day, *r) for r in maturity.cohort_lags(maturity.first_incidents(told, day), day).collect()]
    assert got == sorted(want) and len({r[0] for r in got}) == 3


@pytest.mark.parametrize("change", [{"reported_date": date(1999, 1, 1)}, {"usdot_number": "07"}, {"report_number": ""}, {"usdot_number": "9", "twice": True}])
def test_measurements_refuse_what_single_ones_refuse(spark, change):
    # an incident of no cohort
    row = dict(zip([c.split()[0] for c in VERSION.split(", ")], ("k", "7", "A", "n", date(1999, 5, 1), 5, date(1999, 6, 1), None, True, False)))
    rows = [row | {"twice": False}, row | {"twice": False} | change] if change.pop("twice", False) else [row | change]
    df = spark.createDataFrame([tuple(r[c.split()[0]] for c in VERSION.split(", ")) for r in rows], VERSION).withColumn("knowledge_valid_from", F.lit("1999-06-02").cast("timestamp"))
    for run in (lambda: maturity.first_incidents(df, date(2001, 9, 5)), lambda: maturity.measured_lags(df, [(date(2001, 9, 5), 0)])):
        with pytest.raises(ValueError):
            run()


def test_the_policy_moves_versions_once(spark, monkeypatch):
    found, plain = [], maturity.staged
    monkeypatch.setattr(maturity, "staged", lambda df: found.append(df) or plain(df))
    out = jobs.maturity_policy(spark, SF)
    assert len(found) == 1 and "lineitem" not in _plan(out)
    assert _plan(found[0]).count("lineitem") == _plan(jobs.vehicles(spark, SF)).count("lineitem")
