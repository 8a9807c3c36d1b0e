import hashlib
import random
from collections import Counter

import numpy as np
import xxhash

from tidemark.llm.components import connected_components
from tidemark.llm.lines import cut_boilerplate, drop_boilerplate
from tidemark.llm.simhash import drop_near_duplicates, links, near_duplicates
from tidemark.llm.substrings import dedup_substrings


def groups(nodes, edges):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    return {n: find(n) for n in nodes}


def test_components(spark):
    dice = random.Random(1)
    edges = [(dice.randrange(400), dice.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1060)] + [(2000, i) for i in range(2001, 2200)]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {r["node"]: r["root"] for r in connected_components(df).collect()}
    want = groups({x for e in edges if e[0] != e[1] for x in e}, edges)
    assert got == want
    assert connected_components(df.limit(0)).count() == 0


def test_ball_links_miss_nothing(spark):
    dice = np.random.default_rng(2)
    centres = dice.integers(0, 1 << 63, 30, dtype=np.uint64)
    fps = list(centres)
    for c in centres[:10]:
        for _ in range(40):
            bits = dice.choice(64, dice.integers(1, 7), replace=False)
            fps.append(c ^ np.bitwise_or.reduce(np.uint64(1) << bits.astype(np.uint64)))
    fps = np.unique(np.array(fps + [0, 15], np.uint64))
    near = [(int(a), int(b)) for i, a in enumerate(fps) for b in fps[i + 1 :][np.bitwise_count(fps[i + 1 :] ^ a) <= 4]]
    want = groups(fps.tolist(), near)
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp bigint")
    for crowd in (20_000_000, 3000):  # the small bound splits crowded blocks
        got = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in links(df, crowd).collect()]
        same = groups(fps.tolist(), got)
        assert Counter(Counter(same.values()).values()) == Counter(Counter(want.values()).values())
        assert all(want[a] == want[b] for a, b in got)


def fingerprint(t):
    w = (t or "").encode().lower().split()
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 4]), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_near_duplicates(docs, rows, no_docs):
    fps = [fingerprint(r[1]) for r in rows]
    same = groups(set(fps), [(a, b) for a in set(fps) for b in set(fps) if (a ^ b).bit_count() <= 4])
    least = {}
    for r, f in zip(rows, fps):
        if r[0] is not None:
            least[same[f]] = min(r[0], least.get(same[f], r[0]))
    want = Counter((r[0], f"{f:016x}", least.get(same[f])) for r, f in zip(rows, fps))
    got = near_duplicates(docs).collect()
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == want
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(same.values()))
    assert near_duplicates(no_docs).count() == 0 and drop_near_duplicates(no_docs).count() == 0


def test_substrings(docs, rows, no_docs):
    order = lambda r: (r[0] is None, r[0] or 0, hashlib.md5(("null" if r[0] is None else str(r[0])).encode() + b"\x01" + (r[1] or "").encode()).hexdigest())
    distinct = {order(r): (r[1] or "").encode().split() for r in rows}
    seen, want = set(), {}
    for k in sorted(distinct):
        w, gone = distinct[k], set()
        for i in range(len(w) - 19):
            x = tuple(w[i : i + 20])
            if x in seen:
                gone.update(range(i, i + 20))
            seen.add(x)
        kept = [x for i, x in enumerate(w) if i not in gone]
        want[k] = (len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest(), b" ".join(kept).decode())
    expected = Counter((r[0], *want[order(r)]) for r in rows)
    got = dedup_substrings(docs).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"], r["kept"]) for r in got) == expected
    assert dedup_substrings(no_docs).count() == 0


def test_lines(docs, rows, no_docs):
    strip = lambda x: x.strip(" \t\r")
    pages = {(r[3], r[1] or "") for r in rows}
    total = Counter(s for s, _ in pages)
    held = Counter((s, x) for s, t in pages for x in {strip(x) for x in t.split("\n")} - {""})
    bad = {k for k, n in held.items() if n >= 3 and n > 0.3 * total[k[0]]}
    assert bad

    def cut(r):
        lines = (r[1] or "").split("\n")
        left = [x for x in lines if (r[3], strip(x)) not in bad]
        return (r[0], None if r[1] is None else "\n".join(left), len(lines), len(lines) - len(left))

    for most in (500_000, 0):  # broadcast, and by a join
        got = cut_boilerplate(docs, max_ratio=0.3, broadcast_lines=most).collect()
        assert Counter((r["row"]["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in got) == Counter(map(cut, rows))
    named = docs.withColumnsRenamed({"key": "gone", "t": "row", "score": "site"})
    got = drop_boilerplate(named, "n_chars", max_ratio=0.3)
    assert got.columns == named.columns and got.dtypes == named.dtypes
    want = Counter((d, t, len(t) if dropped else r[4], *r[5:]) for r in rows for d, t, _, dropped in [cut(r)])
    assert Counter((r["doc_id"], r["text"], r["n_chars"], r["gone"], r["row"], r["site"]) for r in got.collect()) == want
    assert drop_boilerplate(no_docs).count() == 0
