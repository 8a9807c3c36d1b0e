import math
import random
from datetime import date, timedelta

from pyspark.sql import functions as F

from tidemark.operators import maturity, sketch, train
from tidemark.operators.features import cohort_months


def test_sketches_merge_and_keep_their_bound(spark):
    dice = random.Random(6)
    values = [int(dice.expovariate(1 / m)) * dice.choice([1, 1, 1, -1]) for m in (3, 200, 10**6, 10**12) for _ in range(400)] + [0, 1, 127, 128, 2**62]
    rows = [("ab"[i % 2], f"d{i % 5}", v) for i, v in enumerate(values)] + [("a", "d1", None)]
    df = spark.createDataFrame(rows, "g string, d string, v bigint")
    qs = (0.001, 0.25, 0.5, 0.9, 0.99, 1.0)
    for bits in (1, 4, 7):
        whole = {r["g"]: r for r in sketch.quantiles(sketch.sketch(df, ["g"], "v", bits), ["g"], qs).collect()}
        parts = sketch.sketch(df, ["g", "d"], "v", bits)
        assert {g: r["p"] for g, r in whole.items()} == {r["g"]: r["p"] for r in sketch.quantiles(parts, ["g"], qs).collect()}
        for g, r in whole.items():
            mine = sorted(v for x, _, v in rows if x == g and v is not None)
            assert r["n"] == len(mine)
            for q, p in zip(qs, r["p"]):
                true = mine[math.ceil(q * len(mine)) - 1]
                assert abs(p - true) <= abs(true) * 2.0**-bits + 1e-9, (bits, q, p, true)
    weighted = df.where("v is not null").groupBy("g", "v").agg(F.count("*").alias("w"))
    assert sorted(map(str, sketch.sketch(weighted, ["g"], "v", weight="w").collect())) == sorted(map(str, sketch.sketch(df, ["g"], "v").collect()))


def test_a_new_snapshot_reads_no_old_rows(spark, tmp_path):
    rows = [("f", f"2030-01-0{d}", v) for d in (1, 2, 3) for v in range(d * 100)]
    spark.createDataFrame(rows, "feed string, acquisition_date string, v int").write.partitionBy("acquisition_date").parquet(f"{tmp_path}/t")
    table = spark.read.schema("feed string, v int, acquisition_date string").parquet(f"{tmp_path}/t")
    asked = []

    def rows_of(chosen):
        days = [r[0] for r in chosen.select("acquisition_date").collect()]
        asked.append(sorted(days))
        return table.where(F.col("acquisition_date").isin(days))

    store = sketch.SketchStore(spark, f"{tmp_path}/s")
    days = lambda *d: spark.createDataFrame([("f", f"2030-01-0{x}") for x in d], "feed string, acquisition_date string")
    assert store.add(days(1, 2), rows_of, "v") == 2 and store.add(days(1, 2), rows_of, "v") == 0 and store.add(days(1, 2, 3), rows_of, "v") == 1
    assert asked == [["2030-01-01", "2030-01-02"], ["2030-01-03"]]
    got = sketch.quantiles(store.read(), ["feed"], (0.5,)).first()
    assert got["n"] == 600 and abs(got["p"][0] - sorted(v for _, _, v in rows)[299]) <= 2


def test_selected_partitions_alone_are_scanned(spark, tmp_path):
    from tidemark.plans import jobs
    from tidemark.sources import tables

    for feed, columns in tables.COLUMNS.items():
        cells = ", ".join(f"{c} string" for c in columns)
        rows = [("b", i, *["20300101"] * len(columns), f"2030-01-0{1 + i % 4}") for i in range(40)]
        spark.createDataFrame(rows, f"batch_id string, source_row_number bigint, {cells}, acquisition_date string").write.partitionBy("acquisition_date").parquet(f"{tmp_path}/{feed}")
    selected = spark.createDataFrame([("crashes", "2030-01-02"), ("inspections", "2030-01-03")], "feed string, acquisition_date string")
    df = jobs.selected_rows(spark, str(tmp_path), selected)
    assert sorted((r["feed"], r["acquisition_date"]) for r in df.distinct().collect()) == [("crashes", "2030-01-02"), ("inspections", "2030-01-03")]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("dynamicpruning") >= 2, plan


def test_bounds_without_draws_hold_the_drawn_ones(spark):
    dice = random.Random(1)
    months = [date(2030, m, 1) for m in range(1, 5)]
    rows = [(m, lag, dice.randrange(1, 9)) for m in months for lag in sorted(dice.sample(range(400), 60 + 40 * m.month))] + [(date(2031, 1, 1), 5, 1), (date(2031, 2, 1), 7, 3)]
    h = spark.createDataFrame(rows, "event_month date, lag_days int, n bigint")
    got = {r["event_month"]: r for r in maturity.order_bounds(h).collect()}
    drawn = {r["event_month"]: r["upper_95_days"] for r in maturity.maturity_bound(h, replicates=4000).collect()}
    assert got.keys() == drawn.keys() and got[date(2031, 1, 1)]["low_95_days"] == got[date(2031, 2, 1)]["high_95_days"] - 2 == 5
    for m, r in got.items():
        mine = sorted((lag, n) for x, lag, n in rows if x == m)
        size = sum(n for _, n in mine)
        assert r["incident_count"] == size
        for k, found in ((math.floor((size - 1) * 0.995) + 1, r["low_95_days"]), (math.ceil((size - 1) * 0.995) + 1, r["high_95_days"])):
            upto, want = 0, None
            for lag, n in mine:
                upto += n
                p = upto / size
                tail = sum(math.comb(size, j) * p**j * (1 - p) ** (size - j) for j in range(k, size + 1))
                if tail >= 0.95:
                    want = lag
                    break
            assert found == want
        lags = [lag for lag, _ in mine]
        near = lambda v, step: lags[max(0, min(len(lags) - 1, lags.index(v) + step))]
        assert near(r["low_95_days"], -1) <= drawn[m] <= near(r["high_95_days"], 1)


def test_policy_rows_fold_the_policy(spark):
    dice = random.Random(2)
    for n in range(6):
        rows = [(date(2030, 1, 1) + timedelta(30 * i), dice.choice([None, dice.randrange(10), dice.randrange(10)]), dice.random() < 0.4) for i in range(12)][: 2 * n + 1]
        grace, want = None, []
        for day, m, reviewed in rows:
            bounds = [(date(2020, k, 1), float(m)) for k in range(1, 13)] if m is not None else []
            found = maturity.policy(spark.createDataFrame(bounds, "event_month date, upper_95_days double"), previous_grace=grace, reviewed_decrease=reviewed) if n < 2 else None
            if found is None:  # the same rule, said once more
                held = m is not None and grace is not None and m < grace and not reviewed
                found = {"measured_grace_days": m, "grace_days": grace if m is None or held else m, "status": "incomplete" if m is None else "decrease_pending_review" if held else "measured"}
            grace = found["grace_days"]
            want.append((day, m, grace, found["status"]))
        dice.shuffle(rows)
        got = maturity.policy_rows(spark.createDataFrame(rows, "data_as_of date, measured_grace_days int, reviewed_decrease boolean")).orderBy("data_as_of").collect()
        assert [(r["data_as_of"], r["measured_grace_days"], r["grace_days"], r["status"]) for r in got] == want
        assert [r["previous_version"] for r in got] == [None, *[r["version"] for r in got[:-1]]] and [r["is_current"] for r in got] == [False] * (len(got) - 1) + [True]


def test_latest_features_of_many_days(spark):
    dice = random.Random(3)
    day = lambda: date(2030, 1, 1) + timedelta(dice.randrange(300))
    months = sorted({(str(dice.randrange(5)), day().replace(day=1)) for _ in range(30)})
    features = [(c, d, i, None if i % 3 else 1.5) for i, (c, d) in enumerate(months)]
    asked = [(str(dice.randrange(7)), dice.choice([day(), dice.choice(months)[1]])) for _ in range(80)]
    asked += asked[:5]
    f = spark.createDataFrame(features, "usdot_number string, scoring_date date, x int, y double")
    got = train.latest_features(f, spark.createDataFrame(asked, "usdot_number string, request_date date")).collect()
    want = []
    for c, d in asked:
        mine = [r for r in features if r[0] == c and r[1] <= d]
        if mine:
            want.append((c, d, *max(mine, key=lambda r: r[1])[1:]))
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))
