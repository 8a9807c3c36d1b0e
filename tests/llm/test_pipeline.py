import random
from collections import Counter

import corpus_pipeline
from tidemark.llm.simhash import simhash


def shingles(t):
    w = (t or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def alike(a, b):
    return a == b or 5 * len(a & b) >= 4 * len(a | b)


def survivors(rows):
    """Of each group linked at 0.8: its first row. rows: (doc_id, text, ...)."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    sets = {i: shingles(rows[i][1]) for i in order}
    left, kept = list(order), []
    while left:
        group = [left[0]]
        left = left[1:]
        for i in group:
            near = [j for j in left if alike(sets[i], sets[j])]
            group += near
            left = [j for j in left if j not in near]
        kept.append(min(group, key=order.index))
    return kept


def near_copies():
    """Texts with copies around 0.8, chains, and a crowd whose members are linked only through their base."""
    dice = random.Random(8)
    said = lambda n: [f"{dice.choice('abcdefgh')}{dice.randrange(5000)}" for _ in range(n)]
    texts = []
    for _ in range(40):
        base = said(dice.randint(8, 250))
        texts.append(base)
        for changes in (1, max(1, len(base) // 60), max(1, len(base) // 40), max(1, len(base) // 25)):
            copy = list(base)
            for at in dice.sample(range(len(copy)), changes):
                copy[at] = "changed"
            texts.append(copy)
            texts.append(copy[: len(copy) * 7 // 8])
    base = said(200)
    crowd = [base]
    for _ in range(60):
        copy = list(base)
        for at in dice.sample(range(len(copy)), 4):
            copy[at] = f"x{dice.randrange(9999)}"
        crowd.append(copy)
    # members that share most of their edits are similar to each other and not to the middle of the crowd
    for _ in range(4):
        far = list(base)
        for at in dice.sample(range(len(far)), 8):
            far[at] = f"y{dice.randrange(9999)}"
        for _ in range(6):
            copy = list(far)
            copy[dice.randrange(len(copy))] = f"z{dice.randrange(9999)}"
            crowd.append(copy)
    texts += crowd[1:] + crowd[:1]
    return [(i, " ".join(t), "en", "s", 1, None, None, 1) for i, t in enumerate(texts)]


def test_near_duplicates_stage(spark, docs, rows, no_docs):
    for given, df in ((rows, docs), (made := near_copies(), spark.createDataFrame(made, docs.schema).repartition(5))):
        got = corpus_pipeline.near_duplicates(spark, df, "")
        assert got.columns == df.columns
        want = Counter(given[i][0] for i in survivors(given))
        assert Counter(r["doc_id"] for r in got.collect()) == want
    far = [(a, b) for a in made for b in made if a[0] < b[0] and alike(shingles(a[1]), shingles(b[1])) and (simhash(a[1].encode()) ^ simhash(b[1].encode())).bit_count() > 4]
    assert len(far) > 100
    assert corpus_pipeline.near_duplicates(spark, no_docs, "").count() == 0
