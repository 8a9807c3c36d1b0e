import json
import random
import re
from collections import Counter

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_pipeline import survivors

from tidemark.llm import quality
from tidemark.llm.pieces import decode

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, gone string, _row_key int"
NAMES = ["doc_id", "text", "lang", "source", "n_chars", "key", "gone", "_row_key"]


def corpus():
    """Good prose and junk with labels, shared lines, copies, benchmark passages, nulls, repeated rows."""
    dice = random.Random(14)
    vocab = ["".join(dice.choice("abcdefgh") for _ in range(dice.randint(2, 7))) for _ in range(400)]
    said = lambda n: " ".join(dice.choice(vocab) for _ in range(n)).capitalize() + "."
    junk = lambda n: " ".join(dice.choice(["BUY", "!!!", "$$$", "99%", "click", "WIN", "###"]) for _ in range(n))
    items = [(i, said(25)) for i in range(6)]
    texts, labels = [], []
    for i in range(160):
        good = i % 4 != 0
        text = f"{said(40)}\n{said(40)}" if good else junk(60)
        if i % 5 == 1:
            text += f"\nshared footer of s{i % 2}"
        if i % 16 == 3:
            text += "\n" + said(10) + " " + items[i % 6][1].upper() + " " + said(10)
        texts.append(text)
        labels.append((i, int(good), 0))
    texts += [texts[1], texts[2] + " more", texts[5].replace(" ", "  "), None, "", " \n "]
    rows = [(i, t, "en", f"s{i % 2}" if i % 9 else None, len(t) if t is not None else None, "clash", None, i) for i, t in enumerate(texts)]
    rows += [rows[7], rows[7][:5] + ("other", "g", 1), (None, texts[9], None, None, None, None, None, None), (None, None, None, "s1", None, None, None, None)]
    return rows, labels, items


def as_row(r):
    return dict(zip(NAMES, r))


def cut_lines(rows):
    pages = {(r[3], r[1] or "") for r in rows}
    total = Counter(s for s, _ in pages)
    held = Counter((s, x) for s, t in pages for x in {x.strip(" \t\r") for x in t.split("\n")} - {""})
    bad = {k for k, n in held.items() if n >= 3 and n > 0.05 * total[k[0]]}
    out = []
    for r in rows:
        lines = (r[1] or "").split("\n")
        left = [x for x in lines if (r[3], x.strip(" \t\r")) not in bad]
        same = len(left) == len(lines)
        text = None if r[1] is None else "\n".join(left)
        out.append(r if same else (r[0], text, r[2], r[3], len(text), *r[5:]))
    return out


def one_of_each(rows):
    """Of rows equal in doc_id and text: the one whose columns that are not null come first as JSON."""
    best = {}
    for r in rows:
        told = json.dumps({k: v for k, v in as_row(r).items() if v is not None}, ensure_ascii=False, separators=(",", ":"))
        k = (r[0], r[1] or "")
        if k not in best or told < best[k][0]:
            best[k] = (told, r)
    return [r for _, r in best.values()]


def clean(rows, items):
    words = lambda t: [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower()) if w]
    windows = {tuple(w[i : i + 10]) for _, t in items for w in [words(t)] for i in range(max(1, len(w) - 9))}
    return [r for r in rows for w in [words(r[1])] if not any(tuple(w[i : i + 10]) in windows for i in range(len(w)))]


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    rows, labels, items = corpus()
    folder = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, labels, items


def test_every_stage_and_run_against_plain_versions(spark, made):
    folder, rows, labels, items = made
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    as_counter = lambda df: Counter(tuple(r) for r in df.select(*[f"`{n}`" for n in NAMES]).collect())

    model = quality.train(docs, spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", F.col("quality").alias("label")))
    ratio, weights, a, b = model

    def score(text):
        x = quality.features((text or "").encode())
        v = ratio[x].astype(float)
        return 1 / (1 + np.exp(-(a * (weights[x] @ v) / max(1e-12, np.sqrt(v @ v)) + b)))

    good = [r for r in rows if score(r[1]) >= 0.7]
    wrong = [i for i, y, _ in labels if (i in {r[0] for r in good}) != bool(y)]
    assert len(wrong) <= 2 and pa.array(quality.scorer(model)(pa.array([""])))[0].as_py() == pytest.approx(score(""))
    assert as_counter(corpus_pipeline.quality(spark, docs, folder)) == Counter(good)

    cut = cut_lines(good)
    assert sum(x != y for x, y in zip(cut, good)) > 10
    frame = lambda rs: spark.createDataFrame(rs, docs.schema).repartition(3)
    assert as_counter(corpus_pipeline.lines(spark, frame(good), folder)) == Counter(cut)

    single = one_of_each(cut)
    kept = [single[i] for i in survivors(single)]
    assert len(kept) < len(single) < len(cut)
    near = corpus_pipeline.near_duplicates(spark, frame(cut), folder)
    assert near.columns == NAMES
    assert Counter((r["doc_id"], r["text"]) for r in near.collect()) == Counter((r[0], r[1]) for r in kept)
    assert as_counter(near.where("doc_id is not null")) == Counter(r for r in kept if r[0] is not None)

    left = clean(kept, items)
    assert len(left) < len(kept)
    assert as_counter(corpus_pipeline.decontaminate(spark, frame(kept), folder)) == Counter(left)

    got = corpus_pipeline.run(spark, folder)
    assert Counter(r["doc_id"] for r in got.collect()) == Counter(r[0] for r in left)
    assert Counter((r["doc_id"], r["text"]) for r in decode(got).collect()) == Counter((r[0], r[1]) for r in left)


def test_stages_take_an_empty_table(spark, made):
    folder = made[0]
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0
