"""Rules that refuse: each is broken once."""

import json
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import checks, dataset, evaluate, maturity, train
from tidemark.operators.stored import StoredHistory
from tidemark.sources import files

FEATURES = "usdot_number string, scoring_date date, inspections_6m bigint, violations_6m bigint, oos_violations_6m bigint, crashes_24m bigint, violations_per_inspection double, oos_violation_rate double, days_since_last_inspection int"
GOOD = {"usdot_number": "81", "scoring_date": date(2031, 2, 1), "inspections_6m": 2, "violations_6m": 3, "oos_violations_6m": 1, "crashes_24m": 0, "violations_per_inspection": 1.5, "oos_violation_rate": 0.33, "days_since_last_inspection": 1}


def test_encoding_refuses_what_no_inspection_can_give(spark):
    broken = {
        "usdot_number": ["081", "0", "8x", None, "-8"], "inspections_6m": [0, -1, None], "days_since_last_inspection": [0, None], "crashes_24m": [-1, None],
        "violations_per_inspection": [float("nan"), float("inf"), -0.1, None], "oos_violation_rate": [None, float("nan"), float("inf"), -1.0], "violations_6m": [None],
    }
    rows, want = [GOOD, GOOD | {"violations_6m": 0, "oos_violation_rate": None}], [[], []]
    for c, values in broken.items():
        for v in values:
            rows.append(GOOD | {c: v})
            want.append([f"invalid_{c}"])
    rows.append(GOOD | {"violations_6m": 0})
    want.append(["invalid_oos_violation_rate"])
    df = spark.createDataFrame([(*r.values(), i) for i, r in enumerate(rows)], FEATURES + ", i int")
    got = {r["i"]: r for r in train.encoded(df).collect()}
    for i, w in enumerate(want):
        assert set(w) <= set(got[i]["invalid"]) and got[i]["valid"] == (not w), rows[i]
    assert got[1]["oos_violation_rate"] == 0.0


def test_every_refusal_of_a_score(spark):
    day = date(2031, 2, 14)
    features = spark.createDataFrame([tuple(GOOD.values()), tuple((GOOD | {"usdot_number": "82", "scoring_date": date(2031, 1, 1)}).values()), tuple((GOOD | {"usdot_number": "83", "inspections_6m": 0}).values())], FEATURES)
    event = lambda carrier, at: ("inspection", carrier, at, at + timedelta(1), datetime(2031, 1, 20), None, False)
    events = spark.createDataFrame([event(c, date(2031, 1, 10)) for c in ("81", "82", "83")] + [event("84", date(2030, 8, 13))], "event_type string, usdot_number string, event_date date, reported_date date, knowledge_valid_from timestamp, knowledge_valid_to timestamp, is_deleted boolean")
    carriers = spark.createDataFrame([(c, day) for c in ("81", "82", "83", "84")], "usdot_number string, request_date date")
    told = lambda model: {r["usdot_number"]: (r["decision"], r["probability"]) for r in train.batch_scores(features, events, carriers, model).collect()}
    refused = {"82": ("features_unavailable", None), "84": ("insufficient_history", None)}
    assert told(lambda rows: rows.withColumn("probability", F.lit(0.25))) == refused | {"81": ("score", 0.25), "83": ("features_unavailable", None)}
    assert told(None) == refused | {"81": ("model_unavailable", None), "83": ("model_unavailable", None)}


def test_first_incidents_refuse_broken_versions(spark):
    schema = "source_record_key string, usdot_number string, report_state string, report_number string, event_date date, report_time bigint, reported_date date, knowledge_valid_from timestamp, federal_recordable boolean, is_deleted boolean"
    good = ["k", "12", "OH", "N7", date(2030, 3, 1), 1405, date(2030, 3, 9), datetime(2030, 3, 9), True, False]
    run = lambda *rows: maturity.first_incidents(spark.createDataFrame([tuple(r) for r in rows], schema), date(2030, 6, 1)).count()
    but = lambda at, v: [v if i == at else x for i, x in enumerate(good)]
    assert run(good) == 1 and run(but(1, None)) == 0
    # what is not known yet is not judged
    assert run(but(6, date(2030, 7, 1))) == 0
    for bad in (but(1, "012"), but(1, "x"), but(2, ""), but(3, None), but(5, None), but(6, date(2030, 2, 1))):
        with pytest.raises(ValueError):
            run(bad)
    missing = maturity.missing_carriers(spark.createDataFrame([tuple(r) for r in (good, but(1, None), ["other", *but(1, None)[1:]], but(1, None)[:3] + ["N8", *good[4:]])], schema), date(2030, 6, 1)).first()
    assert (missing["missing_rows"], missing["missing_incidents"]) == (3, 2)


def test_registry_against_its_metadata(spark):
    start = date(2029, 1, 1)
    months = [date(2029 + i // 12, i % 12 + 1, 1) for i in range(12)]
    cohorts = [{"event_month": m.isoformat(), "incident_count": 5} for m in months]
    good = {"version": "v1", "data_as_of": date(2030, 10, 5), "grace_days": 40, "quantile": 0.995, "confidence": 0.95, "sample_size": 60, "cohort_start": start, "cohort_end": months[-1], "is_current": True}

    def broken(more=None, told=None):
        row = good | (more or {})
        meta = {k: str(v) if isinstance(v, date) else v for k, v in good.items() if k not in ("cohort_start", "cohort_end", "is_current")} | {"cohorts": cohorts} | (told or {})
        df = spark.createDataFrame([(*row.values(), json.dumps(meta))], "version string, data_as_of date, grace_days int, quantile double, confidence double, sample_size bigint, cohort_start date, cohort_end date, is_current boolean, metadata string")
        return {r["rule"] for r in maturity.metadata_violations(df).collect() if r["violations"]}

    assert broken() == set()
    for c, v in (("version", "v2"), ("grace_days", 41), ("quantile", 0.99), ("confidence", None), ("sample_size", 61)):
        assert broken({c: v}) == {c}
    assert broken({"is_current": False}) == {"single_current"}
    assert broken({"data_as_of": date(2030, 9, 29)}, {"data_as_of": "2030-09-29"}) == {"latest_mature"}
    assert broken({"data_as_of": date(2030, 10, 31)}, {"data_as_of": "2030-10-31"}) == {"latest_mature"}
    assert broken(told={"cohorts": cohorts[:6] + cohorts[7:]}) >= {"cohort_count", "cohort_months", "sample_size"}
    assert "cohort_months" in broken(told={"cohorts": cohorts[::-1]})
    assert "cohort_end" in broken({"cohort_end": months[-2]})


def test_batches_behind_a_data_set_are_attested(spark):
    schema = "batch_id string, feed_name string, observed_at timestamp"
    t = datetime(2030, 5, 5, 10)
    rows = [("a", "inspections", t), ("b", "crashes", t)]
    published = spark.createDataFrame([(*r, "loaded") for r in rows] + [("c", "crashes", t, "pending")], schema + ", status string")
    applied = spark.createDataFrame(rows + [("c", "crashes", t)], schema)
    assert dataset.attested(applied, published, ["a", "b"], t.date()).count() == 2
    assert [r[0] for r in dataset.unattested(applied, published).collect()] == ["c"]
    moved = spark.createDataFrame([rows[0], ("b", "crashes", t + timedelta(seconds=1))], schema)
    for args in ((applied, published, ["a", "c"], t.date()), (moved, published, ["a", "b"], t.date()), (applied, published, ["a"], t.date()), (applied, published, ["a", "b"], t.date() + timedelta(1))):
        with pytest.raises(ValueError):
            dataset.attested(*args)


def test_a_repeated_incremental_run_has_nothing_to_do(spark, tmp_path):
    from test_history import SCHEMA, candidate

    days = [datetime(2030, 7, 10, 9) + timedelta(i) for i in range(3)]
    rows = [candidate(f"c{i}", d, "crashes", k, h, event=date(2030, 7, 1)) for i, d in enumerate(days) for k, h in (("x", "same"), ("y", f"h{i}"))]
    made = spark.createDataFrame(rows, SCHEMA)
    known = spark.createDataFrame([(f"c{i}", "crashes", d) for i, d in enumerate(days)], "batch_id string, feed_name string, observed_at timestamp")
    store = StoredHistory(spark, str(tmp_path))
    assert store.apply_pending(made, known) == 3
    found = sorted(map(str, store.versions().collect()))
    assert len(found) == 4 and store.applied().count() == 3
    assert store.apply_pending(made, known) == 0
    assert sorted(map(str, StoredHistory(spark, str(tmp_path)).versions().collect())) == found and len(store.commits()) == 3


def test_the_threshold_comes_from_the_train_part_alone(spark):
    dice = random.Random(8)
    rows = [(p, int(dice.random() < 0.4), dice.randrange(20) / 20, dice.random()) for p in ("train", "purged", "test") for _ in range(200)]
    df = spark.createDataFrame(rows, "part string, label int, score double, other double")
    got = evaluate.holdout(df, "score", "other", "label").first()
    assert got["threshold"] == evaluate.f1_threshold(df.where("part = 'train'"), "score", "label").first()["threshold"]
    test = [r for r in rows if r[0] == "test"]
    assert got["true_positive"] == sum(r[1] for r in test if r[2] >= got["threshold"]) and got["n"] == 200


def test_registry_succession(spark):
    good = [("a", None, date(2030, 1, 1), 30, False, False), ("b", "a", date(2030, 2, 1), 30, False, False), ("c", "b", date(2030, 3, 1), 20, True, True)]

    def broken(rows):
        df = spark.createDataFrame(rows, "version string, previous_version string, data_as_of date, grace_days int, reviewed_decrease boolean, is_current boolean")
        return {r["rule"] for r in maturity.registry_violations(df).collect() if r["violations"]}

    assert broken(good) == set()
    put = lambda i, at, v: [tuple(v if (j, k) == (i, at) else x for k, x in enumerate(r)) for j, r in enumerate(good)]
    assert broken(put(1, 5, True)) == broken(put(2, 5, False)) == {"single_current"}
    assert broken(put(1, 1, "z")) == {"names_predecessor"}
    assert broken(put(2, 2, date(2029, 1, 1))) == {"no_backwards_date"}
    assert broken(put(2, 4, False)) == {"no_unreviewed_decrease"}


def test_schema_contract_and_lookup(spark):
    df = spark.createDataFrame([("7", date(2030, 1, 1), 0.6)], "usdot_number string, scoring_date date, probability double")
    assert checks.schema_differences(df, df.schema) == []
    assert len(checks.schema_differences(df.withColumn("probability", F.col("probability").cast("float")), df.schema)) == 1
    assert len(checks.schema_differences(df.drop("probability"), df.schema)) == 1 and len(checks.schema_differences(df.select(*df.columns[::-1]), df.schema)) == 2
    asked = spark.createDataFrame([("7", date(2030, 1, 1)), ("7", date(2030, 2, 1)), ("8", date(2030, 1, 1))], "usdot_number string, scoring_date date")
    got = {(r["usdot_number"], r["scoring_date"].month): (r["probability"], r["flagged"]) for r in train.landmark_lookup(df, asked, 0.6).collect()}
    assert got == {("7", 1): (0.6, True), ("7", 2): (None, None), ("8", 1): (None, None)}


def test_values_that_differ_and_catalog_lines(spark, tmp_path):
    a = spark.createDataFrame([("x", "1"), ("x", "1"), ("", "22")], "p string, q string")
    same = lambda b: files.reconcile_values(a, b).first()["equal"]
    assert same(a.repartition(3)) and same(a.select("q", "p"))
    for rows in ([("x", "1"), ("", "22")], [("x", "1"), ("x", "1"), ("2", "2")], [("x", "1"), ("x", "1"), (None, "22")], [("1", "x"), ("x", "1"), ("", "22")]):
        assert not same(spark.createDataFrame(rows, "p string, q string"))
    m = spark.createDataFrame([("b1", "crashes", "2030-01-02T00:00:00Z", "s", "f", 5, "2030-01-02")], "batch_id string, feed_name string, observed_at string, object_sha256 string, schema_fingerprint string, row_count bigint, acquisition_date string")
    told = spark.createDataFrame([("b1", 5, "v")], "batch_id string, derived_rows bigint, value_fingerprint string")
    files.catalog_rows(m, str(tmp_path / "catalog"), told, converter_version="3")
    line = spark.read.json(str(tmp_path / "catalog")).first()
    assert (line["batch_id"], line["row_count"], line["feed"], line["converter_version"], line["value_fingerprint"]) == ("b1", 5, "crashes", "3", "v")
    path = files.write_once(a, str(tmp_path / "once"))
    a.limit(1).write.mode("overwrite").parquet(path)
    with pytest.raises(ValueError, match="other rows"):
        files.write_once(a, str(tmp_path / "once"))
