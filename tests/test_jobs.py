import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import dataset, evaluate, features, maturity


def month_back(d, months):
    """The same day some months before, or that month's last day."""
    at = d.year * 12 + d.month - 1 - months
    first = date(at // 12, at % 12 + 1, 1)
    last = (date((at + 1) // 12, (at + 1) % 12 + 1, 1) - timedelta(1)).day
    return first.replace(day=min(d.day, last))


def landmarks_by_rule(rows, marks, unlabelled_from, reported_before):
    """Each rule said once more over plain rows: strict before a mark, counted once, the first report decides."""
    out = {}
    inspections = {r[1:7] for r in rows if r[0] == "inspection"}
    crashes = {}
    for kind, key, carrier, at, told, _, _, federal in rows:
        if kind == "crash":
            first, any_federal = crashes.get((key, carrier, at), (told, False))
            crashes[key, carrier, at] = min(first, told), any_federal or federal
    for t in marks:
        for carrier in {r[1] for r in inspections}:
            mine = [r for r in inspections if r[1] == carrier and month_back(t, 4) <= r[2] < t and r[3] < t]
            if not mine:
                continue
            own = [(at, *c) for (_, who, at), c in crashes.items() if who == carrier]
            before = sum(month_back(t, 24) <= at < t and told < t for at, told, _ in own)
            after = any(t <= at < month_back(t, -6) and told < reported_before and federal for at, told, federal in own)
            out[carrier, t] = len(mine), sum(r[4] for r in mine), before, int(after) if t < unlabelled_from else None
    return out


def test_landmarks_follow_their_rules(spark):
    dice = random.Random(2)
    marks = [date(2019, 3, 1), date(2019, 8, 1), date(2020, 5, 1)]
    edges = [month_back(t, m) + timedelta(d) for t in marks for m in (0, 4, 24, -6) for d in (-1, 0, 1)]
    rows = []
    for n in range(900):
        at = dice.choice(edges)
        told = dice.choice([at + timedelta(dice.randrange(80)), *[t + timedelta(d) for t in marks for d in (-1, 0) if t > at]])
        kind = dice.choice(["inspection", "crash"])
        violations = dice.randrange(5) if kind == "inspection" else 0
        rows.append((kind, f"k{n % 400}", f"{dice.randrange(12)}", at, told, violations, 0, kind == "crash" and dice.random() < 0.5))
    rows += dice.sample(rows, 100)
    schema = "event_type string, source_key string, usdot_number string, event_date date, reported_date date, violation_count bigint, oos_violation_count bigint, federal_recordable boolean"
    cut, seen = date(2020, 1, 1), date(2019, 12, 15)
    got = features.landmark_features(spark.createDataFrame(rows, schema), [t.isoformat() for t in marks], cut.isoformat(), seen.isoformat()).collect()
    want = landmarks_by_rule(rows, marks, cut, seen)
    assert {(r["usdot_number"], r["scoring_date"]): (r["inspections_4m"], r["violations_4m"], r["crashes_24m"], r["label"]) for r in got} == want
    assert {v[3] for v in want.values()} == {0, 1, None} and len(want) > 25


def test_month_buckets_equal_the_range_join(spark):
    grid = features.explicit_grid(spark, [f"2024-{m:02d}-01" for m in range(1, 13)])
    e = spark.range(400).select(F.expr("date_add(date'2022-01-01', cast(id * 3 as int))").alias("event_date"), (F.col("id") % 41).alias("lag"))
    e = e.withColumn("reported_date", F.expr("date_add(event_date, cast(lag as int))"))
    for months in (6, 24):
        fast = e.select("event_date", "reported_date", F.explode(features.served_months(F.col("event_date"), F.col("reported_date"), F.lit(months), F.lit(date(2024, 1, 1)), F.lit(date(2024, 12, 1)))).alias("t"))
        slow = e.join(grid, (F.col("event_date") < F.col("scoring_date")) & (F.col("reported_date") < F.col("scoring_date")) & (F.col("event_date") >= F.add_months("scoring_date", -months)))
        assert sorted(map(tuple, fast.collect())) == sorted((r["event_date"], r["reported_date"], r["scoring_date"]) for r in slow.collect())


def test_cohorts_are_the_last_twelve_with_nine_months_of_reports(spark):
    for as_of in [date(2021, 1, 31) + timedelta(i) for i in (0, 1, 28, 29, 150, 272, 273, 274)]:
        got = sorted(r[0] for r in features.cohort_months(spark, as_of).collect())
        # a month is whole at its last day; nine months on, or at the end of a shorter month, its reports are in
        month_end = lambda m: month_back(m, -1) - timedelta(1)
        starts = [date(y, m, 1) for y in range(2018, 2023) for m in range(1, 13)]
        assert got == [m for m in starts if month_back(month_end(m), -9) <= as_of][-12:]


def test_grids_hold_the_months_with_whole_windows(spark):
    dice = random.Random(7)
    for _ in range(12):
        day = lambda y: date(y, dice.randint(1, 12), dice.choice([1, 1, 2, 28]))
        inspections, crashes, through, as_of, grace = day(2015), day(2013), day(2018), day(2018), dice.choice([0, 20, 200])
        got = sorted(r[0] for r in features.mature_grid(inspections, crashes, through, as_of, grace, spark).collect())
        starts = [date(y, m, 1) for y in range(2013, 2020) for m in range(1, 13)]
        assert got == [
            t for t in starts
            if t >= month_back(inspections, -6) and t >= month_back(crashes, -24) and month_back(t, -6) + timedelta(grace) <= min(through, as_of)
        ]
    assert [r[0] for r in features.explicit_grid(spark, ["2031-07-01", "2031-07-01"]).collect()] == [date(2031, 7, 1)]
    for bad in ([], "2031-07-01", ["2031-07-03"], ["20310701"], ["2031-7-01"], [date(2031, 7, 1)]):
        with pytest.raises(ValueError):
            features.explicit_grid(spark, bad)


def test_maturity_bound_and_policy(spark):
    as_of = date(2019, 12, 20)
    months = [r[0] for r in features.cohort_months(spark, as_of).collect()]
    h = spark.createDataFrame([(m, lag, 1 + lag % 2) for m in months for lag in range(0, 90)] + [(months[3], 400, 30)], "event_month date, lag_days int, n bigint")
    found = maturity.maturity_bound(h)
    bound = {r["event_month"]: r["upper_95_days"] for r in found.collect()}
    assert max(bound, key=bound.get) == months[3] and bound[months[3]] == 400
    assert maturity.policy(found) == {"measured_grace_days": 400, "grace_days": 400, "status": "measured"}
    again = maturity.maturity_bound(h.orderBy(F.desc("lag_days")).repartition(3))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, again.collect()))
    lower = {"previous_grace": 401}
    assert maturity.policy(found, **lower)["status"] == "decrease_pending_review"
    assert maturity.policy(found, **lower, reviewed_decrease=True)["grace_days"] == 400
    assert maturity.policy(found, previous_grace=399)["status"] == "measured"
    assert maturity.policy(found.where(F.col("event_month") != months[3]), **lower) == {"measured_grace_days": None, "grace_days": 401, "status": "incomplete"}
    assert maturity.policy(found, False, **lower)["status"] == "incomplete"
    for grace, end, want in ((40, as_of - timedelta(40), "eligible"), (40, as_of - timedelta(39), "labels_not_mature"), (500, date(2010, 1, 1), "grace_exceeds_nine_calendar_months")):
        assert maturity.training_eligibility({"status": "measured", "grace_days": grace}, as_of, end) == want
    assert maturity.training_eligibility(None, as_of, as_of) == "maturity_unmeasured"
    assert maturity.training_eligibility({"status": "other"}, as_of, as_of) == "maturity_invalid"
    assert {r["violations"] for r in maturity.watermark_violations(found, 400, 400, "measured").collect()} == {0}
    spoiled = {
        "twelve_cohorts": (found.where(F.col("event_month") != min(months)), 400, 400, "measured"),
        "contiguous_months": (found.where(F.col("event_month") != sorted(months)[5]), 400, 400, "measured"),
        "no_empty_cohort": (found.withColumn("incident_count", F.lit(0)), 400, 400, "measured"),
        "measured_is_ceiling": (found, 300, 300, "measured"),
        "measured_status": (found, 500, 400, "measured"),
        "incomplete_status": (found, 400, 400, "incomplete"),
        "pending_status": (found, 300, 400, "decrease_pending_review"),
    }
    for rule, args in spoiled.items():
        assert {r["rule"]: r["violations"] for r in maturity.watermark_violations(*args).collect()}[rule] == 1, rule


def test_first_incident_rules(spark):
    t = lambda n: datetime(2025, 1, n)
    schema = "source_record_key string, usdot_number string, report_state string, report_number string, event_date date, report_time bigint, reported_date date, knowledge_valid_from timestamp, federal_recordable boolean, is_deleted boolean"
    row = lambda key, known, rec=True, dead=False, usdot="1", num="A": (key, usdot, "MI", num, date(2025, 1, 1), 930, date(2025, 1, known), t(known), rec, dead)
    rows = [row("b", 5, rec=False), row("a", 5), row("a", 9, rec=False), row("c", 4, num="B", dead=True), row("d", 4, num="B"), row("e", 6, usdot=None)]
    got = {r["report_number"]: (r["source_record_key"], r["federal_recordable"]) for r in maturity.first_incidents(spark.createDataFrame(rows, schema), date(2025, 2, 1)).collect()}
    assert got == {"A": ("a", True), "B": ("d", True)}
    with pytest.raises(ValueError, match="differ"):
        maturity.first_incidents(spark.createDataFrame([row("a", 5), row("a", 5, rec=False)], schema), date(2025, 2, 1))


def average_precision_by_rank(pairs):
    """Mean over the positives of the precision among all rows that score as high."""
    hits = [s for y, s in pairs if y]
    return sum(sum(y for y, x in pairs if x >= s) / sum(x >= s for _, x in pairs) for s in hits) / len(hits)


def test_average_precision_and_thresholds(spark):
    dice = random.Random(3)
    rows = [(i, int(dice.random() < 0.3), dice.randrange(12) / 12, dice.random(), 0.25) for i in range(400)]
    df = spark.createDataFrame(rows, "i int, label int, coarse double, fine double, flat double").repartition(4)
    ap = {r["model"]: r["average_precision"] for r in evaluate.average_precision(df, ["coarse", "fine", "flat"], "label").collect()}
    for n, c in ((2, "coarse"), (3, "fine"), (4, "flat")):
        assert ap[c] == pytest.approx(average_precision_by_rank([(r[1], r[n]) for r in rows]))

    def f1(t):
        tp = sum(r[1] for r in rows if r[2] >= t)
        return 2 * tp / (sum(r[2] >= t for r in rows) + sum(r[1] for r in rows))

    chosen = evaluate.f1_threshold(df, "coarse", "label").first()["threshold"]
    assert f1(chosen) == pytest.approx(max(f1(r[2]) for r in rows))
    c = evaluate.confusion(df, "fine", "label", 0.4).first()
    tp, fp = (sum(r[1] == y for r in rows if r[3] >= 0.4) for y in (1, 0))
    p = sum(r[1] for r in rows)
    assert (c["accuracy"], c["positive_recall"], c["precision"], c["false_negative"]) == pytest.approx(((tp + 400 - p - fp) / 400, tp / p, tp / (tp + fp), p - tp))
    assert c["always_negative_accuracy"] == pytest.approx((400 - p) / 400)
    better = df.withColumn("best", F.col("label") + 0.0).withColumn("same", F.col("label") + 0.0)
    assert evaluate.compare_models(better, "best", "flat", "coarse", "label").first()["promote"] is True
    assert evaluate.compare_models(better, "best", "flat", "same", "label").first()["promote"] is False


def test_purged_split(spark):
    grid = features.explicit_grid(spark, [f"20{22 + m // 12}-{m % 12 + 1:02d}-01" for m in range(18)])
    rows = grid.withColumn("label", F.lit(1))
    n = {r["part"]: r["count"] for r in dataset.purged_split(rows, grid).groupBy("part").count().collect()}
    assert n == {"train": 9, "purged": 6, "test": 3}
    with pytest.raises(ValueError):
        dataset.purged_split(rows, grid.where("scoring_date < '2023-01-01'"))
