import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import checks, history
from tidemark.operators.clean import CANDIDATE

SCHEMA = ", ".join(f"{n} {t}" for n, t in CANDIDATE.items())


def candidate(batch, at, feed, key, payload, eligible=True, event=date(2025, 12, 1), usdot="1"):
    row = dict.fromkeys(CANDIDATE)
    row |= {
        "batch_id": batch, "observed_at": at, "feed_name": feed, "event_type": feed[:-1] if feed == "inspections" else "crash", "source_record_key": key,
        "usdot_number": usdot, "event_date": event, "record_hash": payload, "is_model_eligible": eligible, "exclusion_reason": None if eligible else "x",
    }
    if event:
        row |= {"source_proxy_reported_date": event + timedelta(5), "source_proxy_valid_from": datetime(event.year, event.month, event.day) + timedelta(5, 43200)}
    return tuple(row.values())


def fold(spark, candidates, batches):
    """The history batch by batch."""
    versions, _ = history.rebuild(candidates.limit(0), batches.limit(0))
    expired, seen = None, set()
    for b in sorted(batches.collect(), key=lambda b: (b["observed_at"], b["batch_id"])):
        mine = candidates.where(F.col("batch_id") == b["batch_id"])
        at = F.lit(b["observed_at"]).cast("timestamp")
        versions, e = history.apply_batch(versions, mine, b["feed_name"], b["batch_id"], at, b["feed_name"] in seen)
        seen.add(b["feed_name"])
        rows = [tuple(r) for r in versions.collect()]
        versions = spark.createDataFrame(rows, versions.schema)
        got = spark.createDataFrame([tuple(r) for r in e.collect()], e.schema)
        expired = got if expired is None else expired.unionByName(got)
    return versions, expired


def test_rebuild_equals_fold(spark):
    dice = random.Random(5)
    days = [datetime(2026, 1, 1, 12) + timedelta(30 * i) for i in range(5)]
    batches, rows = [], []
    for feed, hour in (("inspections", 0), ("crashes", 1)):
        for n, d in enumerate(days):
            at = d + timedelta(hours=hour)
            batches.append((f"{feed[:1]}{n}", feed, at))
            for k in range(60):
                if dice.random() < 0.6:
                    event = None if dice.random() < 0.1 else date(2025, 6, 1) + timedelta(dice.randrange(200))
                    eligible = event is not None and dice.random() < 0.7
                    if event and not eligible and dice.random() < 0.3:
                        event = date(2026, 2, 15)  # future for some batches only
                    rows.append(candidate(f"{feed[:1]}{n}", at, feed, str(k), f"h{event}{dice.randrange(2)}", eligible, event))
    candidates = spark.createDataFrame(rows, SCHEMA)
    known = spark.createDataFrame(batches, "batch_id string, feed_name string, observed_at timestamp")
    whole, lapsed = history.rebuild(candidates, known)
    step, step_lapsed = fold(spark, candidates, known)
    order = sorted(whole.columns)
    assert sorted(map(str, whole.select(*order).collect())) == sorted(map(str, step.select(*order).collect()))
    order = sorted(lapsed.columns)
    assert sorted(map(str, lapsed.select(*order).collect())) == sorted(map(str, step_lapsed.select(*order).collect()))
    found = {r["rule"]: r["violations"] for r in checks.history_violations(whole, known, lapsed).collect()}
    assert all(found[r] == 0 for r in ("not_null", "no_overlap", "single_current", "predecessor_link", "successor_link", "batch_lineage", "unique_version_key", "unique_expiry", "expiry_is_due")), found


def told_by_rule(stories, dates, feed):
    """Versions of each record as letters (x: deleted) and expiries (record, batch), batch by batch over plain dictionaries."""
    versions, expired = {}, set()
    for i in range(len(next(iter(stories.values())))):
        held = {k: s[i] for k, s in stories.items() if s[i] != "-"}
        oldest = min((dates[k] for k in held), default=None)
        for k in stories:
            known = versions.get(k, "")
            if k in held:
                versions[k] = known if known[-1:] == held[k] else known + held[k]
            elif known and known[-1] != "x":
                if feed == "crashes" or (oldest and dates[k] >= oldest):
                    versions[k] = known + "x"
                elif oldest:
                    expired.add((k, i))
    return versions, expired


def test_absence_deletes_inside_the_window_and_expires_outside(spark):
    dice = random.Random(11)
    days = [datetime(2030, 7, 10, 9) + timedelta(i) for i in range(6)]
    batches = spark.createDataFrame([(f"{f}{i}", f, d) for f in ("inspections", "crashes") for i, d in enumerate(days)], "batch_id string, feed_name string, observed_at timestamp")
    stories = {f"r{n}": "".join(dice.choice("aab---") for _ in days) for n in range(80)} | {"always": "aaaaaa", "never": "------"}
    stories |= {f"old{n}": "a" * (n % 3 + 1) + "-" * (5 - n % 3) for n in range(9)}
    dates = {k: date(2029 if "old" in k else 2030, 6, 1) + timedelta(dice.randrange(30)) for k in stories}
    rows = [candidate(f"{f}{i}", d, f, k, s[i], event=dates[k]) for f in ("inspections", "crashes") for k, s in stories.items() for i, d in enumerate(days) if s[i] != "-"]
    v, e = history.rebuild(spark.createDataFrame(rows, SCHEMA), batches)
    got = {"inspections": {}, "crashes": {}}
    for r in sorted(v.collect(), key=lambda r: r["first_observed_at"]):
        mine = got[r["feed_name"]]
        mine[r["source_record_key"]] = mine.get(r["source_record_key"], "") + ("x" if r["is_deleted"] else r["record_hash"])
    want = {f: told_by_rule(stories, dates, f) for f in got}
    assert got == {f: w[0] for f, w in want.items()}
    assert {(r["source_record_key"], int(r["batch_id"][-1])) for r in e.collect()} == want["inspections"][1]
    assert len(want["inspections"][1]) > 10 and any("x" in x for x in got["inspections"].values())


def test_guards(spark):
    schema = "batch_id string, feed_name string, observed_at timestamp"
    applied = spark.createDataFrame([("c", "crashes", datetime(2026, 5, 1))], schema)
    assert history.pending(applied, applied).count() == 0
    with pytest.raises(ValueError, match="made anew"):
        history.pending(spark.createDataFrame([("e", "crashes", datetime(2026, 4, 15))], schema), applied)
    with pytest.raises(ValueError, match="changed"):
        history.pending(spark.createDataFrame([("c", "crashes", datetime(2026, 4, 15))], schema), applied)
    row = candidate("x", datetime(2026, 6, 1), "crashes", "1", "h")
    twice = spark.createDataFrame([row, row], SCHEMA)
    empty = history.rebuild(twice.limit(0), applied.limit(0))[0]
    with pytest.raises(ValueError, match="twice"):
        history.apply_batch(empty, twice, "crashes", "x", F.lit(datetime(2026, 6, 1)), False)


def test_strict_visibility(spark):
    t = datetime(2026, 5, 1)
    rows = [("before", t - timedelta(1), None), ("at", t, None), ("closed_at", t - timedelta(2), t), ("closed_later", t - timedelta(2), t + timedelta(seconds=1))]
    df = spark.createDataFrame(rows, "n string, knowledge_valid_from timestamp, knowledge_valid_to timestamp")
    assert {r["n"] for r in df.where(history.visible_at(F.lit(t))).collect()} == {"before", "closed_later"}


def test_two_hundred_batches(spark):
    """Windows that move on, back and on again, records with long gaps; against the plain rule."""
    dice = random.Random(4)
    days = [datetime(2030, 1, 1, 9) + timedelta(i) for i in range(200)]
    batches = spark.createDataFrame([(f"{f}{i}", f, d) for f in ("inspections", "crashes") for i, d in enumerate(days)], "batch_id string, feed_name string, observed_at timestamp")
    stories, dates = {}, {}
    for n in range(30):
        runs = "".join(dice.choice("ab-") * dice.choice([1, 2, 40]) for _ in range(120))[:200]
        stories[f"r{n}"], dates[f"r{n}"] = runs, date(2028, 1, 1) + timedelta(dice.randrange(400))
    rows = [candidate(f"{f}{i}", d, f, k, s[i], event=dates[k]) for f in ("inspections", "crashes") for k, s in stories.items() for i, d in enumerate(days) if s[i] != "-"]
    v, e = history.rebuild(spark.createDataFrame(rows, SCHEMA), batches)
    got = {"inspections": {}, "crashes": {}}
    for r in sorted(v.collect(), key=lambda r: r["first_observed_at"]):
        mine = got[r["feed_name"]]
        mine[r["source_record_key"]] = mine.get(r["source_record_key"], "") + ("x" if r["is_deleted"] else r["record_hash"])
    want = {f: told_by_rule(stories, dates, f) for f in got}
    assert got == {f: w[0] for f, w in want.items()}
    assert {(r["source_record_key"], int(r["batch_id"].removeprefix("inspections"))) for r in e.collect()} == want["inspections"][1]
    assert len(want["inspections"][1]) > 30
