import hashlib
import re

from tidemark.llm.pii import find_pii
from tidemark.llm.secrets import scan_secrets

LONG = "a" * 60_000
TEXTS = [
    None, "", "password = hunter2x and SECRET:'ab' token: token: abcdef", "token=secret=abcdef passwd=\"short\" api_key: zzzzzz.zz", "AKIA" + "B" * 16 + " AKIA123", "é日" + "0123456789abcdef" * 2,
    "ſecret=abcdefg toKen=abcdefg", LONG, "1" * 30_000, "user: bob42 key Zx9Kq8Wm3Rt6Yp1Lc0Vb https://db.example.com/x", "far Zx9Kq8Wm3Rt6Yp1Lc0Vb " + "w " * 400 + "https://db.example.com/x",
    "mail a@b.co, x.y%z@q-r.example.com.; a@b.c_d@e.f @x.y", "10.0.0.1 999.1.1.1 1.2.3.4.5.6.7.8 0255.1.1.1", "4111 1111 1111 1111 or 4111-1111-1111-1112 and 79927398713", "+1 (385) 555-1563 +49 30 1234 +1 2",
]


def luhn(s):
    t = 0
    for i, c in enumerate(reversed(s)):
        v = int(c) * (1 + i % 2)
        t += v - 9 if v > 9 else v
    return t % 10 == 0


def digits(m):
    return re.sub("[^0-9]", "", m[0])


def secrets_of(t):
    t = t or ""
    word = "(" + "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key")) + ")"
    a = [(m.start(), 0, m.end(), "assign") for m in re.finditer(word + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t) if len(m[2]) >= 6]
    b = [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    c = [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    return [len(a), len(b), len(c)], [f"{k}:{s}:{e}" for s, _, e, k in sorted(a + b + c)]


def pii_of(t):
    t = t or ""
    found = [
        [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)],
        [("ip", m) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))],
        [("card", m) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))],
        [("phone", m) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(digits(m)) <= 15],
    ]
    return [len(f) for f in found], [f"{k}:{m.start()}:{m.end()}" for f in found for k, m in f]


def check(spark, run, brute, names, texts):
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)] + [(None, texts[2], None)] * 2, "doc_id bigint, text string, key string")
    got = run(df).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        t = texts[2] if r["doc_id"] is None else texts[r["doc_id"]]
        if t is LONG and names[0] == "n_email":
            assert r["n_email"] == 0
        n, spans = brute(t if t is not LONG else "a" * 100 if names[0] == "n_email" else t)
        assert [r[c] for c in names] == n, t
        if t is not LONG or names[0] != "n_email":
            assert r["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest(), t
            assert set(spans) <= set(filter(None, r["spans"].split(",")))
    assert run(df.limit(0)).count() == 0
    return {r["doc_id"]: r for r in got}


def test_secrets(spark):
    got = check(spark, scan_secrets, secrets_of, ["n_assign", "n_access", "n_hex"], TEXTS)
    assert "linked_secret" in got[9]["spans"] and "linked_id" in got[9]["spans"]
    assert got[10]["n_linked"] == 0


def test_pii(spark):
    check(spark, find_pii, pii_of, ["n_email", "n_ip", "n_card", "n_phone"], TEXTS)
