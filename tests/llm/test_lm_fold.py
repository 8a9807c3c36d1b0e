import math
import random
import zlib
from collections import Counter

import xxhash

from tidemark.llm import lm


def made(n=300):
    dice = random.Random(4)
    return [(i, " ".join(f"w{min(dice.randrange(60), dice.randrange(60))}" for _ in range(dice.randint(0, 60)))) for i in range(n)] + [(None, "w1 W2"), (5, "w1"), (7, None)]


def brute(rows, rounds=12):
    """Scores in input order: counts in dictionaries, and expectation-maximisation one event at a time."""
    words = [(t or "").lower().split() + ["\n"] for _, t in rows]
    steps = [list(zip(["\n"] + w[:-1], w)) for w in words]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    fold = [i is not None and not h and xxhash.xxh64_intdigest(str(i), 7) % 10 == 0 for (i, _), h in zip(rows, held)]

    def counts(chosen):
        one, two = Counter(), Counter()
        for w, s, c in zip(words, steps, chosen):
            if c:
                one.update(w)
                two.update(s)
        return one, two, sum(one.values()), len(one)

    def parts(v, w, one, two, n, types):
        bucket = min(math.ceil(math.log2(one[v] + 1)), lm.BUCKETS - 1)
        return bucket, (two[v, w] / max(one[v], 1), one[w] / n, 1 / (types + 1))

    rest = counts([not h and not f for h, f in zip(held, fold)])
    events = [parts(v, w, *rest) for s, f in zip(steps, fold) if f for v, w in s]
    mix = [[0.3, 0.6, 0.1] for _ in range(lm.BUCKETS)]
    for _ in range(rounds):
        total = [[0.3, 0.6, 0.1] for _ in range(lm.BUCKETS)]
        for b, p in events:
            share = [m * x for m, x in zip(mix[b], p)]
            for k in range(3):
                total[b][k] += share[k] / sum(share)
        seen = {b for b, _ in events}
        new = [[x / sum(t) for x in t] if b in seen else m for b, (t, m) in enumerate(zip(total, mix))]
        settled = max(abs(x - y) for a, b in zip(new, mix) for x, y in zip(a, b)) < 1e-4
        mix = new
        if settled:
            break
    every = counts([not h for h in held])
    out = []
    for s in steps:
        found = [parts(v, w, *every) for v, w in s]
        out.append(sum(math.log10(sum(m * x for m, x in zip(mix[b], p))) for b, p in found))
    return out


def test_scores_equal_a_plain_model_however_texts_are_dealt(spark, monkeypatch):
    rows = made()
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = sorted((i is None, i or 0, s) for (i, _), s in zip(rows, brute(rows)))
    for size, parts, keys in ((8_000_000, 1, 500_000), (2000, 7, 500), (300, 3, 40)):
        monkeypatch.setattr(lm, "BLOCK_BYTES", size)
        got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["score"]) for r in lm.score_texts(df.repartition(parts), keys).collect())
        assert len(got) == len(want)
        assert all(a[:2] == b[:2] and abs(a[2] - b[2]) < 1e-5 for a, b in zip(got, want))


def test_requests_do_not_grow_as_blocks_times_ranges(spark, monkeypatch):
    """Four times the texts: four times the blocks and ranges, and at most some eight times the rows, at either level."""
    monkeypatch.setattr(lm, "BLOCK_BYTES", 300)
    found = []
    for n in (400, 1600):
        dice = random.Random(n)
        rows = [(i, " ".join(f"w{dice.randrange(5000)}" for _ in range(50))) for i in range(n)]
        blocks = lm.staged(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2).mapInArrow(lm.pack, lm.BLOCK))
        asked, ranges, count = lm.requested(blocks, 100)
        up = asked.where("far >= 0").groupBy("far").count().agg({"count": "sum"}).first()[0]
        crowd = asked.where("far >= 0").groupBy("far").count().agg({"count": "max"}).first()[0]
        places = asked.where("far < 0").count()
        blocks_n = sum(count.values())
        groups = sum(math.isqrt(x) for x in count.values())
        # a group's range may end within a range of the corpus, which then hears from it twice
        assert crowd <= 2 * groups and up <= 4 * groups * (ranges + 1)
        assert places <= 2 * blocks_n * (ranges / math.isqrt(count["a"]) + 1)
        found.append((blocks_n, up + places, ranges))
    (b0, r0, k0), (b1, r1, k1) = found
    assert b1 / b0 > 3.5 and k1 / k0 > 3.5
    assert r1 / r0 < 10


def test_keys_travel_as_differences():
    dice = random.Random(1)
    for bits in (8, 40, 64):
        x = lm.np.array(sorted(dice.randrange(1 << bits) for _ in range(50)), lm.U)
        assert (lm.sums(lm.differences(x)) == x).all() and (lm.sums(lm.differences(x[:1])) == x[:1]).all()
    x = lm.np.array([7, 7, 9, 1 << 63, (1 << 64) - 1], lm.U)
    assert (lm.sums(lm.differences(x)) == x).all()
