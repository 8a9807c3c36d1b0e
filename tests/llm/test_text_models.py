import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import pieces, quality
from tidemark.llm.decontaminate import find_contamination
from tidemark.llm.lm import held_out, score_texts
from tidemark.llm.rules import apply_rules

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_rules(docs, rows, no_docs):
    def measure(t):
        t = t or ""
        w = WORD.findall(t)
        lines = [x for x in t.split("\n") if WORD.search(x)]
        c = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        again = {j for i in range(len(w) - 7) if c[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
        return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(again)

    got = apply_rules(docs).collect()
    want = Counter()
    for r in rows:
        m = measure(r[1])
        want[(r[0], *m, m[0] < 20 or 100 * m[4] > 30 * m[0])] += 1
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert Counter(tuple(r[n] for n in names) for r in got) == want
    assert not any(r["kept"] and r["base_failed"] for r in got)
    assert apply_rules(no_docs).count() == 0


def test_a_bad_host_takes_its_documents_along(spark):
    good = " ".join(f"w{i}" for i in range(30))
    rows = [(i, good if i == 0 else "short", "bad") for i in range(40)] + [(100 + i, good, "fine") for i in range(40)]
    got = {r["doc_id"]: r["kept"] for r in apply_rules(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()}
    assert not got[0] and all(got[100 + i] for i in range(40))


@pytest.mark.parametrize("few", [True, False])
def test_decontamination(spark, docs, rows, no_docs, few):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOW))
    passage = words(rows[9][1])
    items = [(1, rows[9][1].upper()), (1, rows[9][1]), (2, "a, B-c"), (3, ""), (4, None), (None, rows[5][1]), (5, " ".join(passage[5:14])), (10, "nowhere to be found at all in any of these texts")]
    wins = {}
    for i, t in items:
        w = words(t)
        if w and i is not None:
            for k in range(max(1, len(w) - 9)):
                wins.setdefault(tuple(w[k : k + 10]), set()).add(i)

    def judge(r):
        w, hit, ids = words(r[1]), set(), set()
        for win, of in wins.items():
            for k in range(len(w) - len(win) + 1):
                if tuple(w[k : k + len(win)]) == win:
                    hit.update(range(k, k + len(win)))
                    ids |= of
        return (r[0], len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(map(str, ids))).encode()).hexdigest(), bool(hit))

    benchmark = spark.createDataFrame([(*i, "x") for i in items], "item_id bigint, text string, key string")
    got = find_contamination(docs, benchmark, broadcast_windows=200_000 if few else 2, broadcast_shingles=1_000_000 if few else 0)
    names = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert Counter(tuple(r[n] for n in names) for r in got.collect()) == Counter(map(judge, rows))
    assert find_contamination(no_docs, benchmark).count() == 0
    assert not find_contamination(docs, benchmark.limit(0)).where("contaminated").count()


def test_lm(docs, rows, no_docs):
    tokens = [(r[0], (r[1] or "").encode().lower().split() + [b"\n"]) for r in rows]
    c = Counter(w for i, x in tokens if not held_out(i) for w in x)
    n, v = sum(c.values()), len(c)
    want = Counter((i, held_out(i), len(x), sum(c[w] > 0 for w in x), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in x), 6)) for i, x in tokens)
    got = score_texts(docs).collect()
    assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == want
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)
    assert score_texts(no_docs).count() == 0


def test_lm_learns_word_order(spark):
    dice = random.Random(4)
    after = {f"w{i}": [f"w{dice.randrange(50)}" for _ in range(3)] for i in range(50)}
    texts = []
    for i in range(300):
        w = [f"w{dice.randrange(50)}"]
        while len(w) < 60:
            w.append(dice.choice(after[w[-1]]))
        texts.append((i, " ".join(w)))
    got = [r for r in score_texts(spark.createDataFrame(texts, "doc_id bigint, text string")).collect() if r["held_out"]]
    assert sum(r["score"] for r in got) > 0.5 * sum(r["base_score"] for r in got)


def test_classifier(spark, no_docs):
    dice = random.Random(6)
    word = lambda: "".join(dice.choice("abcdefgh") for _ in range(5))
    rows, labels = [(9001, None), (9002, ""), (None, "a b"), (None, None)], []
    for i in range(400):
        bad = i % 3 == 0
        rows.append((i, " ".join(word() + ("***" if bad else "") for _ in range(30))))
        labels.append((i, int(not bad)))
    docs = spark.createDataFrame(rows + [rows[5]], "doc_id bigint, text string")
    known = spark.createDataFrame(labels + [(7, None), (None, 1)], "doc_id bigint, label int").where("doc_id is null or doc_id < 300")
    model = quality.train(docs, known, sample=250)
    got = {r["doc_id"]: r["score"] for r in quality.score(docs, model).collect()}
    assert all((got[i] >= 0.5) == (i % 3 != 0) for i in range(300, 400))
    assert all(0 <= x <= 1 for x in got.values())
    assert quality.train(docs, known.limit(0)) is None
    assert {r["score"] for r in quality.score(docs, None).collect()} == {0.5}
    assert quality.score(no_docs, model).count() == 0
    kept = quality.keep_accepted(docs, model, 0.5)
    assert kept.columns == docs.columns and kept.where("doc_id < 400 and doc_id % 3 = 0").count() == 0


def test_dual_descent_meets_its_conditions():
    dice = np.random.default_rng(0)
    x = dice.normal(size=(60, 5))
    y = np.where(x @ np.array([1.0, -2, 0.5, 0, 0]) > 0, 1, -1)
    rows = [np.arange(5)] * 60
    w = quality.dual_descent(rows, list(x), y, 5, 1.0, 300)
    primal = 0.5 * w @ w + np.maximum(0, 1 - y * (x @ w)).sum()
    step = [0.5 * u @ u + np.maximum(0, 1 - y * (x @ u)).sum() for u in w + dice.normal(size=(200, 5)) * 0.05]
    assert primal <= min(step) + 1e-3


def test_pieces_round_trip(docs, rows, no_docs):
    encoded = pieces.encode(docs)
    back = pieces.decode(encoded)
    assert Counter(tuple(r) for r in back.select("doc_id", "text").collect()) == Counter((r[0], r[1]) for r in rows)
    a, b = (sorted(map(str, pieces.encode(d).collect())) for d in (docs, docs.repartition(1)))
    assert a == b  # batches and partitions don't matter
    assert a != sorted(map(str, pieces.encode(docs, seed=1).collect()))
    assert pieces.encode(no_docs).count() == 0


def test_pieces_follow_the_lattice():
    v = pieces.Vocabulary(open(pieces.MODEL, "rb").read(), 1.0)
    unit = pieces.marked(" there")

    def paths(s):
        if not s:
            yield (), 0.0
        for n in range(1, min(len(s), v.longest) + 1):
            if s[:n] in v.ids:
                for rest, w in paths(s[n:]):
                    yield (s[:n], *rest), v.weight[s[:n]] + w

    every = dict(paths(unit))
    total = sum(map(math.exp, every.values()))
    keys = np.random.default_rng(1).integers(0, 1 << 62, 20_000).tolist()
    seen = Counter(tuple(v.raw[i].decode().replace(" ", pieces.MARK) for i in ids) for ids in pieces.encode_batch(v, [" there"] * len(keys), keys))
    for p, w in every.items():
        share = math.exp(w) / total
        assert abs(seen[p] / len(keys) - share) < 5 * math.sqrt(share * (1 - share) / len(keys)) + 1e-4
    one = Counter(tuple(p for p, _ in pieces.sample_one(v, unit, k, 0)) for k in keys[:3000])
    best = max(every, key=every.get)
    assert abs(one[tuple(v.ids[p] for p in best)] / 3000 - math.exp(every[best]) / total) < 0.05


def test_crc_of_ids():
    assert held_out(5) == (zlib.crc32(b"5") % 7 == 2) and not held_out(None)
