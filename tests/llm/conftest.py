import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, t string, score int"


def make_docs():
    """Nulls in every column, empty and white-space texts, ties, repeated rows, near copies, one very long text."""
    dice = random.Random(3)
    vocab = ["".join(dice.choice("abcdefgh") for _ in range(dice.randint(1, 6))) for _ in range(300)]
    said = lambda n: " ".join(dice.choice(vocab) for _ in range(n))
    base, passage = said(120), said(40)
    texts = [None, "", " \t\n ", "One", "a b c", base, base, base + " tail", "x " + base, passage, f"{said(30)} {passage} {said(30)}", f"{passage} {passage}"]
    texts += [f"Line one\nLine two\n{said(20)}\nLine one", "É à ÀB c ▁ 日本 🎉", "w " * 3000, said(4000)]
    texts += [said(dice.randint(5, 60)) + "\nshared footer line" for _ in range(12)]
    rows = [(i, t, "en", f"s{i % 3}" if i % 7 else None, len(t) if t else None, "clash", None, 1) for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], rows[11]]
    rows += [(None, base, None, None, None, None, None, None), (None, None, None, None, None, None, None, None), (None, passage, "en", "s1", 1, "k", "t", 2)]
    return rows


@pytest.fixture(scope="session")
def rows():
    return make_docs()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
