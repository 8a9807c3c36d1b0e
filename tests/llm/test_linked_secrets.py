import random
import re

from tidemark.llm import secrets
from tidemark.llm.secrets import scan_secrets

TOKEN, OTHER = "Zx9Kq8Wm3Rt6Yp1Lc0Vb", "Qa1Ws2Ed3Rf4Tg5Yh6Uj"


def spans(pattern, t):
    return [m.span() for m in re.finditer(pattern, t)]


def touch(a, b):
    return a[0] < b[1] and b[0] < a[1]


def linked(t, scope):
    """All pairs of parts, one by one."""
    assign = [m.span() for m in re.finditer(secrets.ASSIGN, t) if len(m[1]) >= 6]
    ids, firm = spans(secrets.ACCESS, t), assign + spans(secrets.HEX, t)
    weak_ids = [s for s in spans(secrets.WEAK_ID, t) if not any(touch(s, o) for o in ids + firm)]
    tokens = [s for s in spans(secrets.WEAK_SECRET, t) if not any(touch(s, o) for o in ids + firm + weak_ids)]
    ends = spans(secrets.ENDPOINT, t)
    near = lambda s, o: 0 <= o[0] - s[1] <= scope or 0 <= s[0] - o[1] <= scope
    found = [(*s, "linked_id") for s in weak_ids if any(near(s, o) for o in firm + tokens)]
    for s in tokens:
        inside = any(touch(s, o) for o in ends)
        if any(near(s, o) for o in ids + weak_ids) or (not inside and any(near(s, o) for o in ends)):
            found.append((*s, "linked_secret"))
    return {f"{k}:{a}:{b}" for a, b, k in found}


def got(spark, texts, scope=200):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(2)
    rows = {r["doc_id"]: r for r in scan_secrets(df, scope).collect()}
    return [({x for x in rows[i]["spans"].split(",") if x.startswith("linked")}, rows[i]["n_linked"]) for i in range(len(texts))]


def test_no_part_is_its_own_partner(spark):
    alone = [f"username={TOKEN}", f"https://example.com/{TOKEN}", TOKEN, "login: bob42", f"user={TOKEN} https://example.com/x", "AKIA" + "B" * 9]
    assert got(spark, alone) == [(set(), 0)] * len(alone)
    both = [f"login: bob42 {TOKEN}", f"{TOKEN} https://example.com/x", f"https://example.com/?user=bob&sig={TOKEN}", f"AKIA{'B' * 9} {TOKEN}"]
    assert [n for _, n in got(spark, both)] == [2, 1, 2, 2]


def test_scope_is_the_gap_between_parts(spark):
    texts = [f"{TOKEN} {'.' * (gap - 2)} https://example.com/{'a' * 400} {'.' * (back - 2)} {OTHER}" for gap, back in ((200, 201), (201, 200), (2, 300))]
    assert [n for _, n in got(spark, texts)] == [1, 1, 1]
    long = "Aa1" * 200
    assert got(spark, [f"login: bob42 {long}", f"{long} login: bob42"]) == [({f"linked_id:0:12", f"linked_secret:13:613"}, 2), ({f"linked_id:601:613", "linked_secret:0:600"}, 2)]


def test_links_equal_all_pairs(spark):
    dice = random.Random(9)
    parts = [TOKEN, OTHER, "login: bob42", "AKIA" + "C" * 10, "AKIA" + "D" * 16, "password=hunter22", f"token={TOKEN}", "0123456789abcdef" * 2, "https://db.example.com/x",
             f"redis://h/{OTHER}", f"account={TOKEN}", "é日", "w", "."]
    texts = ["".join(dice.choice(parts) + " " * dice.choice([1, 1, 2, 30, 60, 90]) for _ in range(dice.randint(1, 40))) for _ in range(120)]
    for scope in (60, 200):
        want = [linked(t, scope) for t in texts]
        assert [g for g, _ in got(spark, texts, scope)] == want
        assert sum(map(bool, want)) > 60
