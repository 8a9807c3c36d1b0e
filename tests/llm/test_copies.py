import hashlib
from collections import Counter, defaultdict

import pytest

from tidemark.llm import copies
from tidemark.llm.copies import drop_copies, mark_copies

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def normal(t):
    return (t or "").translate(LOWER)


def expected(rows, best):
    groups = defaultdict(list)
    for r in rows:
        groups[normal(r[1])].append(r)
    out = Counter()
    for t, members in groups.items():
        ids = [r[0] for r in members if r[0] is not None]
        keep = best(ids) if ids else None
        for r in members:
            out[(r[0], keep, len(members), hashlib.sha256(t.encode()).hexdigest())] += 1
    return out, {t: (best([r[0] for r in m if r[0] is not None], default=None)) for t, m in groups.items()}


@pytest.mark.parametrize("share", [0.25, 1e-9])  # the small share cuts every group into pieces
@pytest.mark.parametrize("keep,best", [("largest", max), ("smallest", min)])
def test_copies(docs, rows, no_docs, monkeypatch, share, keep, best):
    monkeypatch.setattr(copies, "SHARE", share)
    want, kept = expected(rows, best)
    got = mark_copies(docs, keep).collect()
    assert Counter((r["row"]["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == want
    assert Counter((normal(r["row"]["text"]), r["row"]["doc_id"]) for r in got if r["kept"]) == Counter(kept.items())
    left = drop_copies(docs, keep)
    assert left.columns == docs.columns and left.count() == len(kept)
    assert mark_copies(no_docs, keep).count() == 0


def test_case_of_other_letters_and_spaces_counts(spark):
    rows = [(1, "Äb"), (2, "äb"), (3, "ÄB"), (4, "Äb "), (5, ""), (6, None)]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    got = {r["row"]["doc_id"]: (r["keep_id"], r["kept"]) for r in mark_copies(df, "largest").collect()}
    assert got == {1: (3, False), 2: (2, True), 3: (3, True), 4: (4, True), 5: (6, False), 6: (6, True)}
