"""Substring dedup by seed and extend over winnowed anchors.

Seeds: every run of `window` words holds a winnowed anchor - the least hash of its
SEED-word shingles - and equal runs hold the same anchor at the same place. Anchors are
shuffled and those met once are dropped; with them go all runs that cannot repeat.
Extension: around each repeated anchor every run of `window` words that it stands for is
taken, as far as it reaches to the left and to the right, and compared by a 96-bit content
hash; the run with the smallest (doc_id, start) is the first one, all others are repeats. Matches
are extended by these hashes and not word by word in one place: the seeds at the edge of a passage
that a third of all rows hold would have to meet in one task, while their runs differ and spread.
Overlapping repeats join up to the maximal repeated stretch, whose words are removed.

Both shuffles are combined before they are sent: of equal anchors or runs of one Arrow batch
only one travels, since the others have their answer already. A passage that stands in a
third of all rows thus arrives once a batch, not once a row, and no pairs are formed.

Defined results: a null or empty text has no words and loses none; documents are ordered by
doc_id, nulls last, then by content; equal rows (same doc_id and text) are one document and
get equal results; an empty table gives an empty result; extra columns are ignored. doc_id is an integer.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.text import read_table, row_key
from tidemark.sources.staging import staged

SEED = 8
U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of uint64 hashes."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def rolling(words: np.ndarray, n: int, base: int) -> np.ndarray:
    """Hash of each run of n word hashes: a polynomial in `base`, mixed."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, U)
    total = np.zeros(m, U)
    for i in range(n):
        total = total * U(base) + words[i : i + m]
    return mixed(total)


def word_hashes(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter(map(digest, words), U, len(words))


def anchors(hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Seed hash at each position, the anchor position of each run, the distinct anchor positions."""
    seeds = rolling(hashes, SEED, 0x9E3779B97F4A7C15)
    wide = window - SEED + 1
    if len(seeds) < wide:
        none = np.zeros(0, np.int64)
        return seeds, none, none
    least = np.lib.stride_tricks.sliding_window_view(seeds, wide).argmin(1)
    of = np.arange(len(least)) + least
    return seeds, of, np.unique(of)


def first_of(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sort order by keys (the last is least significant) and, in it, where the leading key changes."""
    order = np.lexsort(keys[::-1])
    lead = keys[0][order]
    return order, np.concatenate(([True], lead[1:] != lead[:-1])) if len(lead) else np.zeros(0, bool)


#: What is told of an anchor's place: it may repeat, it repeats, or only that the seed repeats.
ASKS, REPEATS, TELLS = 1, 0, 2
SEEDS = "route bigint, seed bigint, doc bigint, place bigint"


def seed_rows(window: int):
    """SEEDS: one row for each distinct anchor of a batch; place: its position and what is told of it; doc: 64 bits of the key.

    An anchor met twice in the batch is known to repeat: it travels once without a place, to tell other
    batches, and its places go on by themselves, dealt by document.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hs, docs, ats = [], [], []
            for i, t in enumerate(b.column("text").cast(pa.binary())):
                hashes = word_hashes((t.as_py() or b"").split())
                seeds, _, at = anchors(hashes, window)
                hs.append(seeds[at])
                docs.append(np.full(len(at), i, np.int64))
                ats.append(at)
            if not hs:
                continue
            h, doc, at = np.concatenate(hs), np.concatenate(docs), np.concatenate(ats)
            if not len(h):
                continue
            order, new = first_of(h)
            h, doc, at = h[order].view(np.int64), b.column("doc").to_numpy()[doc[order]], at[order]
            sizes = np.diff(np.append(np.flatnonzero(new), len(h)))
            many = np.repeat(sizes > 1, sizes)
            told = h[many & new]
            parts = [
                (h[~many], h[~many], doc[~many], at[~many] * 4 + ASKS),
                (told, told, np.zeros(len(told), np.int64), np.full(len(told), TELLS)),
                (doc[many], np.zeros(many.sum(), np.int64), doc[many], at[many] * 4 + REPEATS),
            ]
            yield pa.record_batch([pa.array(np.concatenate(c)) for c in zip(*parts)], ["route", "seed", "doc", "place"])

    return run


def repeated_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, at) of anchors met twice or known to repeat; rows come sorted by route and seed, and only the last waits."""
    held: np.ndarray | None = None

    def out(x: np.ndarray) -> Iterator[pa.RecordBatch]:
        kind = x[3] & 3
        group = np.cumsum(np.concatenate(([True], (x[0, 1:] != x[0, :-1]) | (x[1, 1:] != x[1, :-1])))) - 1
        again = (np.bincount(group, kind)[group] > 1) & (kind == ASKS) | (kind == REPEATS)
        yield pa.record_batch([pa.array(x[2, again]), pa.array((x[3, again] >> 2).astype(np.int32))], ["doc", "at"])

    for b in batches:
        if not b.num_rows:
            continue
        x = np.stack([b.column(n).to_numpy() for n in ("route", "seed", "doc", "place")])
        if held is not None:
            x = np.concatenate([held, x], 1)
        # of a long group, what has been decided need not wait
        last = int(np.argmax((x[0] == x[0, -1]) & (x[1] == x[1, -1])))
        if last:
            yield from out(x[:, :last])
        held = x[:, last:].copy()
        if held.shape[1] > 50_000:
            yield from out(held)
            held = np.array([[held[0, 0]], [held[1, 0]], [0], [TELLS]])
    if held is not None:
        yield from out(held)


RUNS = "bucket bigint, batch string, runs binary, docs binary, keys array<string>"
#: A run: its content hash (96 bits), its start and its document's number in the batch.
RUN = np.dtype([("a", U), ("b", np.uint32), ("at", np.int32), ("doc", np.int32)])
#: A document of a batch: what orders it among all documents.
DOC = np.dtype([("none", np.int8), ("id", np.int64), ("tie", U), ("no", np.int32)])
SPOT = np.dtype([("doc", np.int32), ("at", np.int32)])


def spots_of(x: np.ndarray) -> bytes:
    out = np.empty(len(x), SPOT)
    out["doc"], out["at"] = x["doc"], x["at"]
    return out.tobytes()


def earliest(x: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs in order of content, document and start; where a content starts; which runs are later than its first.

    docs: of DOC, by position; x["doc"] points into it. Equal rows of the input stand in the same place,
    and none of them is earlier than the other.
    """
    of = docs[x["doc"]]
    order = np.lexsort((x["at"], of["tie"], of["id"], of["none"], x["b"], x["a"]))
    x, of = x[order], of[order]
    new = np.concatenate(([True], (x["a"][1:] != x["a"][:-1]) | (x["b"][1:] != x["b"][:-1])))
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    same = (of["none"] == of["none"][first]) & (of["id"] == of["id"][first]) & (of["tie"] == of["tie"][first]) & (x["at"] == x["at"][first])
    return x, new, ~same


def run_rows(window: int, buckets: int):
    """Of each batch: the runs at repeated anchors, one of each content, packed by bucket of the content hash.

    Runs that repeat inside the batch are settled here; one row a batch carries them and the batch's keys.
    A batch's name is its place: rows come sorted, so a task that is run again makes and names the same batches.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for no, b in enumerate(batches):
            parts = []
            keys = b.column("key").to_pylist()
            docs = np.zeros(len(keys), DOC)
            docs["none"] = b.column("doc_id").is_null().to_numpy(zero_copy_only=False)
            docs["id"] = b.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
            docs["tie"] = [int(k[:16], 16) for k in keys]
            docs["no"] = np.arange(len(keys))
            for i, (t, at) in enumerate(zip(b.column("text").cast(pa.binary()), b.column("at"))):
                hashes = word_hashes((t.as_py() or b"").split())
                _, of, _ = anchors(hashes, window)
                starts = np.flatnonzero(np.isin(of, at.values.to_numpy(zero_copy_only=False)))
                x = np.empty(len(starts), RUN)
                x["a"] = rolling(hashes, window, 0xD6E8FEB86659FD93)[starts]
                x["b"] = rolling(hashes ^ (hashes >> U(31)), window, 0xA0761D6478BD642F)[starts] >> U(32)
                x["at"], x["doc"] = starts, i
                parts.append(x)
            x = np.concatenate(parts) if parts else np.zeros(0, RUN)
            if not len(x):
                continue
            x, new, later = earliest(x, docs)
            name = f"{TaskContext.get().partitionId()}-{no}"
            rows = [(int(keys[0][:8], 16) % buckets, name, spots_of(x[later]), None, keys)]
            ahead = x[new]
            bucket = (ahead["a"] >> U(1)).astype(np.int64) % buckets
            order = np.argsort(bucket, kind="stable")
            ahead, bucket = ahead[order], bucket[order]
            cuts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True])))
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                part = ahead[lo:hi].copy()
                used, part["doc"] = np.unique(part["doc"], return_inverse=True)
                rows.append((int(bucket[lo]), name, part.tobytes(), docs[used].tobytes(), None))
            for i in range(0, len(rows), 200):
                kinds = (pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.list_(pa.string()))
                yield pa.record_batch([pa.array([r[j] for r in rows[i : i + 200]], k) for j, k in enumerate(kinds)], ["bucket", "batch", "runs", "docs", "keys"])

    return run


LATER = "batch string, spots binary, keys array<string>"


def later_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each request the runs that are not the first of their content; rows come sorted by bucket, and whole buckets are settled."""

    def out(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.binary(), pa.list_(pa.string()))
        return pa.record_batch([pa.array([r[j] for r in rows], k) for j, k in enumerate(kinds)], ["batch", "spots", "keys"])

    def settle(rows: list[dict]) -> pa.RecordBatch:
        parts, docs, at = [], [], 0
        for r in rows:
            x, d = np.frombuffer(r["runs"], RUN).copy(), np.frombuffer(r["docs"], DOC)
            x["doc"] += at
            at += len(d)
            parts.append(x)
            docs.append(d)
        owner = np.repeat(np.arange(len(rows)), [len(d) for d in docs])
        every = np.concatenate(docs)
        x, _, later = earliest(np.concatenate(parts), every)
        x = x[later]
        who = owner[x["doc"]]
        x["doc"] = every["no"][x["doc"]]
        order = np.argsort(who, kind="stable")
        x, who = x[order], who[order]
        cuts = np.searchsorted(who, np.arange(len(rows) + 1))
        return out([(r["batch"], spots_of(x[lo:hi]), None) for r, lo, hi in zip(rows, cuts[:-1], cuts[1:]) if hi > lo])

    held: list[dict] = []
    for b in batches:
        for i in range(b.num_rows):
            r = b.slice(i, 1).to_pylist()[0]
            if r["keys"] is not None:
                yield out([(r["batch"], r["runs"], r["keys"])])
                continue
            if held and held[-1]["bucket"] != r["bucket"]:
                yield settle(held)
                held = []
            held.append(r)
    if held:
        yield settle(held)


def by_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, starts) of a batch's documents from all its answers."""
    for b in batches:
        for i in range(b.num_rows):
            r = b.slice(i, 1).to_pylist()[0]
            x = np.concatenate([np.frombuffer(s, SPOT) for s in r["spots"]])
            x = x[np.argsort(x["doc"], kind="stable")]
            cuts = np.flatnonzero(np.concatenate(([True], x["doc"][1:] != x["doc"][:-1], [True]))) if len(x) else np.zeros(1, np.int64)
            keys = [r["keys"][x["doc"][lo]] for lo in cuts[:-1]]
            starts = [np.ascontiguousarray(x["at"][lo:hi]).tobytes() for lo, hi in zip(cuts[:-1], cuts[1:])]
            yield pa.record_batch([pa.array(keys, pa.string()), pa.array(starts, pa.binary())], ["key", "starts"])


def batch_runs(rows: DataFrame, met: DataFrame, window: int, buckets: int) -> DataFrame:
    """RUNS of rows (doc_id, key, doc, text) at the anchors met (doc, at); equal keys are equal rows, so the order is fixed."""
    return rows.join(met, "doc").sortWithinPartitions("key").mapInArrow(run_rows(window, buckets), RUNS)


def anchors_met(rows: DataFrame, window: int) -> DataFrame:
    """doc, at: of rows (doc, text) the places of repeated seeds, each once however often the row is repeated."""
    return (
        rows.select("doc", "text").mapInArrow(seed_rows(window), SEEDS)
        .repartition("route")
        .sortWithinPartitions("route", "seed")
        .mapInArrow(repeated_seeds, "doc bigint, at int")
        .groupBy("doc")
        .agg(F.collect_set("at").alias("at"))
    )


def named(docs: DataFrame) -> DataFrame:
    """doc_id, key (names a row by content), doc (64 bits of it; rows that share them only look at more places), text."""
    rows = docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("key"), F.col("text").cast("string").alias("text"))
    return rows.select("doc_id", "key", F.xxhash64("key").alias("doc"), "text")


def repeats(docs: DataFrame, window: int = 20, runs_per_bucket: int = 500_000) -> DataFrame:
    """doc, starts: of the rows of a doc (64 bits of the key) their keys and the starts of their later runs, packed as int32."""
    rows = named(docs)
    met = staged(anchors_met(rows, window))
    places = met.agg(F.sum(F.size("at"))).first()[0] or 0
    runs = batch_runs(rows, met, window, max(16, 8 * places // runs_per_bucket))
    later = runs.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(later_runs, LATER)
    # a batch's answers meet again: as many documents as one Arrow batch holds
    whole = later.groupBy("batch").agg(F.collect_list("spots").alias("spots"), F.any_value("keys", True).alias("keys"))
    found = whole.mapInArrow(by_document, "key string, starts binary")
    return found.groupBy(F.xxhash64("key").alias("doc")).agg(F.collect_list(F.struct("key", "starts")).alias("starts"))


def without_repeats(window: int, text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, gone, digests, kept_texts = [], [], [], []
            for t, starts in zip(b.column("text").cast(pa.binary()), b.column("starts")):
                words = (t.as_py() or b"").split()
                n.append(len(words))
                kept = words
                if starts.is_valid:
                    step = np.zeros(len(words) + 1, np.int64)
                    for s in starts.as_py():
                        at = np.frombuffer(s, np.int32)
                        np.add.at(step, at, 1)
                        np.add.at(step, at + window, -1)
                    keep = np.cumsum(step[:-1]) == 0
                    kept = [w for w, k in zip(words, keep) if k]
                gone.append(len(words) - len(kept))
                joined = b" ".join(kept)
                digests.append(hashlib.sha256(joined).hexdigest())
                kept_texts.append(joined if text else b"")
            columns = [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(digests, pa.string())]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            if text:
                columns.append(pa.array(kept_texts, pa.binary()).cast(pa.string()))
                names.append("kept")
            yield pa.record_batch(columns, names)

    return run


def dedup_substrings(docs: DataFrame, window: int = 20, text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and, if asked for, kept (the words left) of every row of docs (doc_id, text)."""
    starts, rows = repeats(docs, window), named(docs)
    kind = dict(rows.dtypes)["doc_id"]
    schema = f"doc_id {kind}, n_words bigint, n_removed bigint, kept_sha256 string" + ", kept string" * text
    mine = F.transform(F.filter("starts", lambda s: s["key"] == F.col("key")), lambda s: s["starts"])
    # joined by doc as the anchors are, so that the texts are shuffled once for both
    return rows.join(starts, "doc", "left").select("doc_id", "text", mine.alias("starts")).mapInArrow(without_repeats(window, text), schema)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(read_table(spark, sf_dir, "documents"), text=False)
