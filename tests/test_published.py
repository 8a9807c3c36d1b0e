import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.readwriter import DataFrameWriter

from tidemark.operators import checks, compare, dataset, maturity
from tidemark.sources import commits, published


def test_a_killed_write_is_redone_and_other_content_is_a_conflict(spark, tmp_path, monkeypatch):
    df, folder = spark.createDataFrame([(i, f"v{i % 3}") for i in range(50)], "i int, s string"), str(tmp_path)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(published.marks, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            published.publish(df, folder, "d")
    assert published.find(spark, folder, "d") is None and len(commits.children(spark, f"{folder}/data")) == 1
    path = published.publish(df, folder, "d")
    assert published.publish(df.repartition(3), folder, "d") == path and spark.read.parquet(path).count() == 50
    with pytest.raises(ValueError, match="published with other rows"):
        published.publish(df.where("i > 1"), folder, "d")
    assert len(published.sweep(spark, folder)) == 1 and spark.read.parquet(path).count() == 50
    with pytest.MonkeyPatch.context() as patch:
        real = DataFrameWriter.parquet
        patch.setattr(DataFrameWriter, "parquet", lambda self, path, *a: (real(self, path, *a), real(df.limit(1).write.mode("overwrite"), path)))
        with pytest.raises(ValueError, match="differs from its source"):
            published.publish(df, folder, "torn")
    assert published.find(spark, folder, "torn") is None


def test_differences_name_exactly_the_keys(spark):
    dice = random.Random(7)
    a = [(dice.choice(["x", "y", None]), i // 2, dice.choice([None, "", "p", "q"])) for i in range(3000)]
    b, want = [], {}
    for row in a:
        way = dice.random()
        b += [] if way < 0.01 else [row, row] if way < 0.02 else [(*row[:2], (row[2] or "") + "!")] if way < 0.03 else [row]
    b += [("new", i, "p") for i in range(5)]
    rows = lambda t: {k: sorted(map(str, (r[2] for r in t if r[:2] == k))) for k in {r[:2] for r in t}}
    left, right = rows(a), rows(b)
    for k in left.keys() | right.keys():
        if left.get(k) != right.get(k):
            want[k] = "source_only" if k not in right else "derived_only" if k not in left else "changed"
    schema = "g string, i bigint, v string"
    x, y = spark.createDataFrame(a, schema), spark.createDataFrame(b, schema).select("v", "i", "g")
    got = {(r["g"], r["i"]): r["side"] for r in compare.differences(x, y, ["g", "i"]).collect()}
    assert got == want and {"source_only", "derived_only", "changed"} == set(want.values())
    trees = compare.digest_tree(x, ["g", "i"]), compare.digest_tree(x.repartition(5), ["g", "i"])
    assert compare.differing_leaves(*trees).count() == 0 and compare.differences(x, x, ["g", "i"], trees).count() == 0
    few = compare.differing_leaves(trees[0], compare.digest_tree(x.where("i <> 7"), ["g", "i"])).count()
    assert 1 <= few <= 2


def test_required_columns_are_asked_for_in_the_data(spark):
    df = spark.createDataFrame([("a", 1, None), (None, 2, None)], "k string, n int, t string")
    contract = T.StructType([T.StructField("k", T.StringType(), False), T.StructField("n", T.LongType()), T.StructField("gone", T.StringType(), False), T.StructField("t", T.StringType())])
    got = {r["rule"]: r["violations"] for r in checks.required_violations(df, contract).collect()}
    assert got == {"k_type": 0, "k_required": 1, "n_type": 1, "gone_type": 1, "gone_required": 2, "t_type": 0}
    assert {r["violations"] for r in checks.required_violations(df.limit(0), T.StructType(contract.fields[:1])).collect()} == {0}


def test_window_eligibility_is_the_rule_for_one(spark):
    dice = random.Random(5)
    rows = [
        (dice.choice([None, "measured", "incomplete", "decrease_pending_review", "odd"]), dice.choice([None, 0, 40, 272, 274, 276, 500]), date(2031, 1, 1) + timedelta(dice.randrange(60)), date(2030, dice.randrange(1, 13), dice.choice([1, 28])))
        for _ in range(300)
    ]
    df = spark.createDataFrame(rows, "status string, grace_days int, data_as_of date, label_window_end date")
    got = [r["reason"] for r in maturity.window_eligibility(df).collect()]
    want = [maturity.training_eligibility(None if s is None else {"status": s, "grace_days": g}, d, e) for s, g, d, e in rows]
    assert got == want and len(set(want)) == 6


def test_a_data_set_of_unsound_batches_is_refused(spark):
    t = datetime(2030, 5, 5, 10)
    applied = spark.createDataFrame([("a", "inspections", t), ("b", "crashes", t)], "batch_id string, feed_name string, observed_at timestamp")
    known = applied.withColumn("status", F.when(F.col("batch_id") == "b", "pending").otherwise("loaded"))
    with pytest.raises(ValueError, match="not applied or not complete"):
        dataset.build(None, applied, known, ["a", "b"], t.date(), None, t.date())
