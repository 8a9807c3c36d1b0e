"""Fingerprints that added up decimals row by row."""

import hashlib

from tidemark.functions import keys


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_fingerprints_add_whole_numbers(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("a", 1)], "s string, n int")
    assert "sum(cast" not in _plan(keys.fingerprint(df)).lower()
    digests = [hashlib.sha256(x.encode()).hexdigest() for x in ("1:a1:1", "-1:2", "1:a1:1")]
    sums = [sum(int(d[15 * i : 15 * i + 15], 16) for d in digests) for i in range(4)]
    want = hashlib.sha256(",".join(map(str, [3, *sums])).encode()).hexdigest()
    assert tuple(keys.fingerprint(df).first()) == (3, want)
    nothing = keys.fingerprint(df.limit(0)).first()
    assert tuple(nothing) == (0, hashlib.sha256(b"0,0,0,0,0").hexdigest())
