"""Quality classifier: naive Bayes support vectors.

Features are indicators of word unigrams and of 1- to 3-grams of word shapes (upper case,
lower case, digits and punctuation, runs collapsed and cut at 12 characters, with a mark where a
word repeats the one before it), hashed into 2**BITS slots. Each is scaled by its class log-count ratio, rows are
scaled to length one, and a linear hinge-loss model is fitted by dual coordinate descent. A
logistic curve fitted on a fifth of the sample, which the model has not seen, turns its
margins into probabilities.

The model is fitted in one task on at most `sample` labelled documents (a documented bound; of
each class those with the least hash of doc_id, a rare class with more than its share); its weights (2**BITS floats) go with the scoring tasks,
which read every text whole and shuffle nothing.

Defined results: a null or empty text is scored by its lack of features; rows with a null
doc_id are scored and never learned from; of repeated labels of a doc_id the lowest counts;
without two documents of both classes every score is 0.5 and the filter keeps all rows; an empty table gives an empty result.
doc_id is an integer.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.text import read_table
from tidemark.sources.staging import staged

BITS = 18
SAMPLE = 8000
THRESHOLD = 0.7
#: Bytes by shape: letters (and all beyond ASCII) a or A, digits 0, all else itself.
SHAPES = bytes(
    ord("A") if 65 <= c <= 90 else ord("a") if 97 <= c <= 122 or c >= 128 else ord("0") if 48 <= c <= 57 else c for c in range(256)
)
RUNS = re.compile(rb"([^\s])\1+")


def features(text: bytes | None, bits: int = BITS) -> np.ndarray:
    """Slots of the indicators that a text has, ascending."""
    raw = (text or b"").split()
    words = [w.lower() for w in raw]
    shapes = RUNS.sub(rb"\1", b" ".join(raw).translate(SHAPES)).split()
    # a long mixed shape (a blob, an address) is cut, so that shapes stay few
    shapes = [s[:12] for s in shapes]
    shapes[1:] = [b"=" + s if a == b else s for s, a, b in zip(shapes[1:], words, words[1:])]
    grams: set[bytes] = set(words)
    two = set(zip(shapes, shapes[1:]))
    three = set(zip(shapes, shapes[1:], shapes[2:]))
    grams.update(b"\x01" + s for s in set(shapes))
    grams.update(b"\x02" + b" ".join(g) for g in two)
    grams.update(b"\x03" + b" ".join(g) for g in three)
    mask = (1 << bits) - 1
    return np.unique(np.fromiter((zlib.crc32(g) & mask for g in grams), np.int32, len(grams)))


def log_count_ratio(rows: list[np.ndarray], y: np.ndarray, size: int) -> np.ndarray:
    counts = []
    for label in (1, -1):
        chosen = [r for r, k in zip(rows, y) if k == label]
        total = 1.0 + np.bincount(np.concatenate(chosen), minlength=size)
        counts.append(total / total.sum())
    return np.log(counts[0] / counts[1])


def dual_descent(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, size: int, cost: float, rounds: int) -> np.ndarray:
    """Weights of min 1/2 |w|^2 + cost * sum of hinge losses; each step solves one row's dual variable exactly."""
    w, a = np.zeros(size), np.zeros(len(rows))
    square = np.array([v @ v for v in values])
    dice = np.random.default_rng(0)
    for _ in range(rounds):
        for i in dice.permutation(len(rows)):
            if square[i] == 0:
                continue
            slope = y[i] * (w[rows[i]] @ values[i]) - 1.0
            new = min(max(a[i] - slope / square[i], 0.0), cost)
            if new != a[i]:
                w[rows[i]] += (new - a[i]) * y[i] * values[i]
                a[i] = new
    return w


def logistic_fit(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """a, b of P(1) = 1 / (1 + exp(-(a * margin + b))), by Newton steps with smoothed targets."""
    n1, n0 = (y == 1).sum(), (y != 1).sum()
    t = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([margin, np.ones_like(margin)], 1)
    ab = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ ab, -30, 30)))
        grad = x.T @ (p - t) + 1e-3 * ab
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        ab -= step
        if np.abs(step).max() < 1e-9:
            break
    return float(ab[0]), float(ab[1])


def fit(rows: list[np.ndarray], y: np.ndarray, bits: int, cost: float = 1.0, rounds: int = 12) -> tuple[np.ndarray, np.ndarray, float, float] | None:
    """(ratios, weights, a, b) or None where a class has fewer than two rows. Every fifth row of a class calibrates, one at least."""
    size = 1 << bits
    held = np.zeros(len(rows), bool)
    for k in (1, -1):
        mine = np.flatnonzero(y == k)
        if len(mine) < 2:
            return None
        held[mine[4::5] if len(mine) >= 5 else mine[-1:]] = True
    learn = [r for r, h in zip(rows, held) if not h]
    ratio = log_count_ratio(learn, y[~held], size)
    values = [ratio[r] / max(1e-12, np.sqrt((ratio[r] ** 2).sum())) for r in learn]
    w = dual_descent(learn, values, y[~held], size, cost, rounds)
    model = ratio.astype(np.float32), w.astype(np.float32)
    margin = np.array([margin_of(r, *model) for r, h in zip(rows, held) if h])
    return *model, *logistic_fit(margin, y[held])


def margin_of(row: np.ndarray, ratio: np.ndarray, weights: np.ndarray) -> float:
    r = ratio[row].astype(np.float64)
    return float((weights[row] * r).sum() / max(1e-12, np.sqrt((r**2).sum())))


def _rows(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            slots = [features(t.as_py(), bits).tobytes() for t in b.column("text").cast(pa.binary())]
            yield pa.record_batch([b.column("doc_id"), b.column("label"), pa.array(slots, pa.binary())], ["doc_id", "label", "slots"])

    return run


def _fit(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = sorted((d, k, s) for b in batches for d, k, s in zip(*(b.column(c).to_pylist() for c in ("doc_id", "label", "slots"))))
        rows = [np.frombuffer(s, np.int32) for _, _, s in got]
        model = fit(rows, np.array([1 if k == 1 else -1 for _, k, _ in got]), bits) if rows else None
        if model:
            ratio, w, a, b = model
            yield pa.record_batch([pa.array([ratio.tobytes()], pa.binary()), pa.array([w.tobytes()], pa.binary()), pa.array([a]), pa.array([b])], ["ratio", "weights", "a", "b"])

    return run


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, bits: int = BITS) -> tuple | None:
    """The model of labels (doc_id, label) over docs (doc_id, text), from at most `sample` documents.

    The sample keeps the classes' shares, but of a rare class it takes up to an eighth of its places; the
    calibration is then set back to the shares of all labels. A repeated doc_id counts once, with its least text.
    """
    known = staged(
        labels.where("doc_id is not null and label is not null")
        .groupBy("doc_id")
        .agg(F.min("label").cast("int").alias("label"))
        .join(docs.select("doc_id"), "doc_id", "left_semi")
    )
    good = F.col("label") == 1
    n = known.agg(F.count(F.when(good, 1)), F.count(F.when(~good, 1))).first()
    if min(n) < 2:
        return None
    places = [k if sum(n) <= sample else max(min(k, sample // 8), sample * k // sum(n)) for k in n]
    if sum(places) > sample:
        places[int(np.argmax(places))] -= sum(places) - sample
    first = [known.where(of).orderBy(F.xxhash64("doc_id"), "doc_id").limit(k) for of, k in zip((good, ~good), places)]
    chosen = first[0].union(first[1])
    texts = (
        docs.select("doc_id", F.col("text").cast("string").alias("text"))
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.min("text").alias("text"))
    )
    slots = texts.select("doc_id", "label", "text").mapInArrow(_rows(bits), "doc_id bigint, label int, slots binary")
    found = slots.repartition(1).mapInArrow(_fit(bits), "ratio binary, weights binary, a double, b double").first()
    if found is None:
        return None
    shift = float(np.log(n[0] / n[1]) - np.log(places[0] / places[1]))
    return np.frombuffer(found["ratio"], np.float32), np.frombuffer(found["weights"], np.float32), found["a"], found["b"] + shift


def scorer(model: tuple | None, bits: int = BITS):
    """texts -> scores, for use inside tasks."""

    def run(texts: pa.Array) -> np.ndarray:
        if model is None:
            return np.full(len(texts), 0.5)
        ratio, w, a, b = model
        m = np.array([margin_of(features(t.as_py(), bits), ratio, w) for t in texts.cast(pa.binary())])
        return 1 / (1 + np.exp(-np.clip(a * m + b, -30, 30)))

    return run


def score(docs: DataFrame, model: tuple | None, bits: int = BITS) -> DataFrame:
    """doc_id, score of every row of docs (doc_id, text)."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    of = scorer(model, bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.record_batch([b.column("doc_id"), pa.array(of(b.column("text")), pa.float64())], ["doc_id", "score"])

    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, score double")


def keep_accepted(docs: DataFrame, model: tuple | None, threshold: float = THRESHOLD, bits: int = BITS) -> DataFrame:
    """The rows of docs whose score is `threshold` or more, all where there is no model; all columns stay and no row is moved."""
    if model is None:
        return docs
    of = scorer(model, bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(of(b.column("text")) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def held_out(doc_id) -> F.Column:
    """A quarter of all ids, never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    labels = read_table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id"))).select("doc_id", F.col("quality").alias("label"))
    scored = score(docs, train(docs, labels))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
