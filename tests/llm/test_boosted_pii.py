import random

from pyspark.sql import functions as F

from tidemark.llm.pii import evidence, find_pii, luhn

FORMS = {
    "email": ["anna (at) example (dot) com", "j.doe[at]mail.example[dot]org", "bob @ example . net"],
    "phone": ["(415) 555-2671", "212.555.0187"],
    "card": ["4111.1111.1111.1111", "5500/0055/5555/5559"],
}
#: Like them in form only.
ALIKE = ["met (at) noon. Then", "see @ page. Nine", "(015) 155-2671", "4111.1111.1111.1112", "300, 400, 500, 600", "12, 999, 18, 4", "7351.5520.9911.0023"]


def corpus():
    """Addresses in plain and other forms after words that tell of them; numbers that pass a check by chance."""
    dice = random.Random(6)
    digits = lambda n: "".join(dice.choice("0123456789") for _ in range(n))

    def card(sep):
        d = dice.choice("45") + digits(14)
        total = sum(v - 9 if v > 9 else v for i, c in enumerate(reversed(d)) for v in [int(c) * (2 - i % 2)])
        d += str(-total % 10)
        return sep.join(d[i : i + 4] for i in range(0, 16, 4))

    area = lambda: dice.choice("23456789") + digits(2)
    rows = []
    for _ in range(150):
        n = digits(3)
        rows += [
            f"mail us at u{n}@mail.example.com today", f"contact u{n} (at) example (dot) com please",
            f"call +1 ({area()}) {area()}-{digits(4)} now", f"phone ({area()}) {area()}-{digits(4)} or {area()}.{area()}.{digits(4)}",
            f"credit card {card(' ')} was charged", f"pay by card {card(dice.choice('./'))}",
            f"serial {digits(4)}.{digits(4)}.{digits(4)}.{digits(4)} in stock", f"part {digits(16)} in stock", f"host 10.0.{dice.randrange(256)}.{dice.randrange(256)} is up",
            f"rows {', '.join(digits(3) for _ in range(4))} of it", f"ratio {', '.join(str(dice.randrange(1, 900)) for _ in range(4))} again",
        ]
    return rows


def test_other_forms_are_added_and_lookalikes_are_not(spark):
    told = {"email": "contact", "phone": "phone", "card": "credit card"}
    forms = [(k, v) for k, vs in FORMS.items() for v in vs]
    texts = corpus() + [f"{told[k]} {v} thanks" for k, v in forms] + [f"rows {v} of it" for v in ALIKE] + ["serial 4111.1111.1111.1111 in stock"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    got = {r["doc_id"]: r for r in find_pii(df).collect()}
    at = len(corpus())
    for n, (k, v) in enumerate(forms):
        start = len(told[k]) + 1
        assert f"likely_{k}:{start}:{start + len(v)}" in got[at + n]["spans"].split(","), v
    for n, v in enumerate([*ALIKE, "chance"]):
        assert got[at + len(forms) + n]["n_added"] == 0, (v, got[at + len(forms) + n]["spans"])
    assert all("likely" not in got[i]["spans"] for i, t in enumerate(texts[:at]) if t.split()[0] in ("serial", "part", "rows", "ratio"))


def test_evidence(spark):
    cases = [("email", "a (at) b (dot) org", True), ("email", "a@b.c1", False), ("ip", "1 . 2 . 3 . 255", True), ("ip", "1.2.3.256", False), ("card", "4111-1111-1111-1111", True),
             ("card", "4111 1111 1111 1112", False), ("card", "79927398713", False), ("phone", "+49 30 123456", True), ("phone", "1 (415) 555 2671", True), ("phone", "(115) 555 2671", False)]
    df = spark.createDataFrame(cases, "kind string, value string, want boolean")
    for k in ("email", "ip", "card", "phone"):
        assert df.where((F.col("kind") == k) & (evidence(F.col("value"), k) != F.col("want"))).count() == 0, k
    assert df.select(luhn(F.lit("")).alias("x")).first()["x"] is False


def test_one_class_or_nothing_adds_nothing(spark):
    for texts in (["x@y.com"] * 3, ["no data"], []):
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
        assert [r["n_added"] for r in find_pii(df).collect()] == [0] * len(texts)


def test_digits_inside_tokens_are_no_candidates(spark):
    texts = corpus() + [f'token = "ede{n}43f42c939b6405768150e0411"' for n in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    assert all(r["n_added"] == 0 for r in find_pii(df).where(F.col("doc_id") >= len(corpus())).collect())
