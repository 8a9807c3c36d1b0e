from decimal import Decimal

from pyspark.sql import functions as F

from tidemark.functions import keys, parse


def column(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, s {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("s"))).collect()]


def test_numbers(spark):
    values = ["+000123.00", "0", "2147483648", "1.2", "-1", "", "9" * 39, None, "0" * 36 + "123", "12\n", " 7 "]
    assert column(spark, values, parse.nonnegative_integer) == [123, 0, None, None, None, None, None, None, 123, None, 7]
    ids = ["+09223372036854775807.0", "9223372036854775808", "0", "00012"]
    assert column(spark, ids, parse.positive_id) == ["9223372036854775807", None, None, "12"]
    assert column(spark, ["2360", "0930.00", "2359", "2400", "60"], parse.report_time) == [None, 930, 2359, None, None]
    assert column(spark, [" 12 ", "+12", "12.0", "0", "\t5\n"], parse.request_usdot) == ["12", None, None, None, "5"]


def test_dates_times_and_booleans(spark):
    days = ["20240229", "20230229", "20240431", "00000101", "20241301", "", None, "20240101\n"]
    assert [str(d) if d else None for d in column(spark, days, parse.source_date)] == ["2024-02-29"] + [None] * 7
    times = ["20240229 2359", "20240229 2400", "20240229 1260", "20230229 1200", "20240101 1", ""]
    assert [str(t) if t else None for t in column(spark, times, parse.source_timestamp)] == ["2024-02-29 23:59:00"] + [None] * 5
    flags = ["yes", "1", " FALSE ", "0", "maybe", "", None]
    assert column(spark, flags, parse.source_boolean) == [True, True, False, False, None, None, None]


def test_ratio_is_exact(spark):
    top = 9223372036854775807
    cases = [(1, 3), (1, 2000001), (1, 2000000), (1, 1999999), (3, 2000001), (3, 2000000), (3, 1999999), (top, 1), (top, top), (1, 0), (1, None)]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, n bigint, d bigint")
    got = [r[0] for r in df.orderBy("i").select(keys.ratio(F.col("n"), F.col("d"))).collect()]
    want = ["0.333333", "0.000000", "0.000001", "0.000001", "0.000001", "0.000002", "0.000002", f"{top}.000000", "1.000000"]
    assert got == [Decimal(w) for w in want] + [None, None]


def test_identities(spark):
    row = spark.range(1).select(
        keys.fallback_key(F.lit("MI"), F.lit("A42"), F.lit("2024-02-29").cast("date"), F.lit(930), F.lit(2)).alias("f"),
        keys.incident_key(F.lit("123"), F.lit("MI"), F.lit("A42"), F.lit("2024-02-29").cast("date"), F.lit(930)).alias("k"),
        keys.length_prefixed_id(F.lit("a|b"), F.lit("c")).alias("x"),
        keys.length_prefixed_id(F.lit("a"), F.lit("b|c")).alias("y"),
        keys.payload_hash((F.lit("1"), "text"), (F.lit(None).cast("int"), "number"), (F.lit(0), "number")).alias("p"),
    ).first()
    import hashlib

    assert row["f"] == "fallback:5b224d49222c2022413432222c2022323032342d30322d3239222c203933302c20325d"
    assert row["k"] == hashlib.md5("\x1f".join(["123", "MI", "A42", "2024-02-29", "930"]).encode()).hexdigest()
    assert row["x"] != row["y"]
    assert row["p"] == hashlib.md5(b'["1", null, 0]').hexdigest()


def test_fingerprint_ignores_order_and_sees_changes(spark):
    a = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "i int, s string")
    same = spark.createDataFrame([(2, None), (1, "a"), (2, None)], "i int, s string").repartition(3)
    other = spark.createDataFrame([(1, "a"), (2, None)], "i int, s string")
    f = [keys.fingerprint(x).first() for x in (a, same, other)]
    assert f[0] == f[1] and f[0]["fingerprint"] != f[2]["fingerprint"] and f[0]["n_rows"] == 3


def test_parsers_agree_with_plain_python_on_odd_texts(spark):
    import re
    from datetime import datetime

    cores = ["0", "00", "7", "60", "060", "0060", "160", "0160", "960", "2359", "2360", "012360", "12360", "00000930", "2147483647", "2147483648", "9223372036854775807", "9223372036854775808", "19990230", "19991231", "00001231", "19991231 2359", "19991231 0960", "99991231 0000", "1999-12-31", "1999-12-31 10:00:00", "--", ""]
    values = [f"{a}{c}{z}" for c in cores for a in ("", " ", "  +", "-", "\t") for z in ("", ".00", ". ", " ", "\n", "x")] + [None]

    def number(s, most, low=0):
        m = re.fullmatch(r"[+]?([0-9]+)(?:[.]0+)?", s.strip(" ")) if s is not None else None
        return int(m[1]) if m and low <= int(m[1]) <= most else None

    def at(s, fmt, length):
        t = s.strip(" ") if s is not None else ""
        try:
            return datetime.strptime(t, fmt) if len(t) == length and re.fullmatch("[0-9 ]+", t) else None
        except ValueError:
            return None

    big = [number(s, parse.BIGINT_MAX, 1) for s in values]
    assert column(spark, values, parse.positive_id) == [None if n is None else str(n) for n in big]
    assert column(spark, values, parse.nonnegative_integer) == [number(s, parse.INT_MAX) for s in values]
    assert column(spark, values, lambda c: parse.nonnegative_integer(c, 100)) == [number(s, 100) for s in values]
    assert column(spark, values, parse.report_time) == [n if n is None or n % 100 <= 59 else None for n in (number(s, 2359) for s in values)]
    assert column(spark, values, parse.source_timestamp) == [at(s, "%Y%m%d %H%M", 13) for s in values]
    assert column(spark, values, parse.source_date) == [d and d.date() for d in (at(s, "%Y%m%d", 8) for s in values)]


def test_no_parser_repeats_its_cell(spark):
    """A cell that an expression holds several times makes methods that the JVM leaves to its interpreter."""
    row = spark.range(1).select(F.col("id").cast("string").alias("cell"))
    for fn in (parse.positive_id, parse.nonnegative_integer, parse.report_time, parse.source_date, parse.source_timestamp):
        made = row.select(fn(F.col("cell")).alias("v"))._jdf.queryExecution().analyzed().expressions().mkString()
        assert made.count("cell#") == 1, made
