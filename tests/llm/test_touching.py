import random
import time

from pyspark.sql import functions as F

from tidemark.llm.pii import find_pii
from tidemark.llm.secrets import scan_secrets
from tidemark.llm.spans import touching, untouched_by_better


def touch(a, b):
    return a[0] < b[1] and b[0] < a[1]


def disjoint(dice, n):
    """Spans that don't overlap each other, some of them adjacent."""
    at, out = 0, []
    for _ in range(n):
        start = at + dice.choice([0, 0, 1, 2, 5, 20])
        at = start + dice.choice([1, 1, 2, 3, 8, 30])
        out.append((start, at))
    return out


def test_touching_equals_all_pairs(spark):
    dice = random.Random(4)
    for _ in range(3):
        rows = [(f"k{k}", s, e, c) for k in range(20) for c in (True, False) for s, e in {*disjoint(dice, dice.randint(0, 9)), *disjoint(dice, dice.randint(0, 9))}]
        df = spark.createDataFrame(rows, "key string, start bigint, end bigint, other boolean")
        got = {(r["key"], r["start"], r["end"]) for r in df.withColumn("met", touching(F.col("other"))).where("met and not other").collect()}
        assert got == {r[:3] for r in rows if not r[3] and any(o[3] and o[0] == r[0] and touch(r[1:3], o[1:3]) for o in rows)}
        assert got


def test_better_spans_stay(spark):
    dice = random.Random(5)
    for _ in range(3):
        rows = [(f"k{k}", rank, s, e, -dice.choice([0.9, 0.95, 0.99])) for k in range(20) for rank in range(4) for s, e in disjoint(dice, dice.randint(0, 8))]
        df = spark.createDataFrame(rows, "key string, rank int, start bigint, end bigint, q double")
        got = {(r["key"], r["rank"], r["start"], r["end"], r["q"]) for r in untouched_by_better(df, range(4)).collect()}
        order = lambda r: (r[4], *r[1:4])
        want = {r for r in rows if not any(o[0] == r[0] and o != r and touch(r[2:4], o[2:4]) and order(o) < order(r) for o in rows)}
        assert got == want and len(want) < len(rows)


def test_texts_with_very_many_spans(spark):
    """Time grows with the spans of one text and not with their square."""
    part = "login: bob42 Zx9Kq8Wm3Rt6Yp1Lc0Vb https://db.example.com/x "
    mail = "write to a (at) b (dot) com or c@d.example.org, 10.0.0.1, +49 30 1234567 "
    for run, unit, count in ((scan_secrets, part, "n_linked"), (find_pii, mail, "n_email")):
        took, n = [], 8_000
        for size in (n // 4, n):
            df = spark.createDataFrame([(1, unit * size)], "doc_id bigint, text string")
            began = time.time()
            found = run(df).select(count).first()[0]
            took.append(time.time() - began)
            assert found >= size
        assert took[1] < 60 and took[1] < 8 * took[0], took
