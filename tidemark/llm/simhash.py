"""SimHash near-duplicate groups by meet-in-the-middle ball hashing.

Two fingerprints within `2 * HALF` bits share a variant that is within HALF bits of each.
Every distinct fingerprint therefore emits its whole ball of that radius, the variants are
shuffled, and fingerprints that meet in a variant are linked.

A ball of 2 bits has 2081 variants. They are shipped as segments: the shuffle key is the
first block of the variant (16 bits), and all variants of one fingerprint with the same
first block travel as one row and are spelled out at the receiver, 137 rows in all. Blocks
that would be crowded (by a count over the 65,536 first blocks) are split by the second
block too, so no group of near copies is bound to one task. Rows of a receiver are sorted
by key and processed as a stream; only colliding pairs, verified by their bits, are kept,
as one link from each member of a collision to its head.

Defined results: a null or empty text has fingerprint zero, which is linked like any other;
the id of a group is its smallest non-null doc_id (null if it has none); repeated rows are
copies of each other; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.components import connected_components
from tidemark.llm.text import one_of_each, read_table, row_key
from tidemark.sources.staging import staged

HALF = 2
BLOCK = 16
SEED = 42


def shingle_hashes(text: bytes | None, shingle: int) -> np.ndarray:
    """Hashes of all shingles of lower-cased (A-Z) words; fewer words than a shingle are one, no words none."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = max(1, len(words) - shingle + 1)
    starts = np.concatenate(([0], ends[: n - 1] + 1)).tolist()
    stops = ends[min(shingle, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, stops)), np.uint64, n)


def simhash(text: bytes | None, shingle: int = 4) -> int:
    """64-bit fingerprint of the shingles; no words have fingerprint zero."""
    return fingerprint(shingle_hashes(text, shingle))


def fingerprint(h: np.ndarray) -> int:
    """The bits set in over half the hashes."""
    n = len(h)
    if not n:
        return 0
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):
        ones += np.unpackbits(h[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = b.column("text").cast(pa.binary())
        fp = np.fromiter((simhash(t.as_py()) for t in texts), np.uint64, len(texts))
        yield pa.record_batch([b.column("doc_id"), b.column("key"), pa.array(fp.view(np.int64))], ["doc_id", "key", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, key, fp (the fingerprint's bits as a signed long) of every row of docs (doc_id, text)."""
    rows = docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("key"), F.col("text").cast("string").alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(_fingerprints, f"doc_id {kind}, key string, fp bigint")


def flips(bits: range, most: int) -> list[np.ndarray]:
    """For k = 0..most: the masks with exactly k of the bits set."""
    return [np.array([sum(1 << x for x in c) for c in combinations(bits, k)], np.uint64) for k in range(most + 1)]


FIRST, SECOND = flips(range(BLOCK), HALF), flips(range(BLOCK, 2 * BLOCK), HALF)
#: By level (first block fixed; both fixed) and flips left: all masks of up to so many further bits.
REST = [[np.concatenate(flips(range(BLOCK * (1 + level), 64), left)) for left in range(HALF + 1)] for level in (0, 1)]
LOW = np.uint64((1 << BLOCK) - 1)
LOW2 = np.uint64((1 << 2 * BLOCK) - 1)


def ball_segments(fp: np.ndarray, crowded: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(key, fingerprint, flips used) of each segment of the balls around fp (uint64).

    key: the first block, or with bit 62 set the first two. crowded: by first block.
    """
    for used, masks in enumerate(FIRST):
        v = fp[:, None] ^ masks[None, :]
        own = np.broadcast_to(fp[:, None], v.shape).ravel()
        v = v.ravel()
        full = crowded[(v & LOW).astype(np.int64)]
        yield v[~full] & LOW, own[~full], np.full(int((~full).sum()), used, np.int8)
        v, own = v[full], own[full]
        for more, further in enumerate(SECOND[: HALF + 1 - used] if len(v) else []):
            w = (v[:, None] ^ further[None, :]).ravel() & LOW2
            yield w | np.uint64(1 << 62), np.repeat(own, len(further)), np.full(len(w), used + more, np.int8)


def crowded_blocks(counts: np.ndarray, most: int) -> np.ndarray:
    """Of first blocks, those that would get over `most` variants. counts: fingerprints by first block."""
    load, at = np.zeros(len(counts)), np.arange(len(counts))
    for used, masks in enumerate(FIRST):
        for m in masks.astype(np.int64):
            load += counts[at ^ m] * len(REST[0][HALF - used])
    return load > most


def collisions(key: np.ndarray, fp: np.ndarray, used: np.ndarray, most: int = 1 << 23) -> tuple[np.ndarray, np.ndarray]:
    """(root, member) fingerprints, members of one connected group under their least, of rows with whole keys."""
    second = (key >> np.uint64(62)).astype(np.int64)
    size = np.array([[len(REST[s][HALF - u]) for u in range(HALF + 1)] for s in (0, 1)])[second, used].sum()
    rounds = 1 << max(0, int(np.ceil(np.log2(max(1, size) / most))))
    heads, members = [], []
    for turn in range(rounds):  # a crowd is gone through in parts of its variants
        vs, owners = [], []
        for s in (0, 1):
            for u in range(HALF + 1):
                at = np.flatnonzero((second == s) & (used == u))
                masks = REST[s][HALF - u]
                for i in range(0, len(at), max(1, most // len(masks))):
                    part = at[i : i + max(1, most // len(masks))]
                    fixed = LOW2 if s else LOW
                    v = (((fp[part] & ~fixed) | (key[part] & fixed))[:, None] ^ masks[None, :]).ravel()
                    own = np.repeat(fp[part], len(masks))
                    if rounds > 1:
                        mine = ((v * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)) % np.uint64(rounds) == turn
                        v, own = v[mine], own[mine]
                    vs.append(v)
                    owners.append(own)
        v, own = np.concatenate(vs), np.concatenate(owners)
        s = np.sort(v)
        twice = s[1:][s[1:] == s[:-1]]
        if not len(twice):
            continue
        twice = np.unique(twice)
        at = np.searchsorted(twice, v)
        met = twice[np.minimum(at, len(twice) - 1)] == v
        v, own = v[met], own[met]
        order = np.lexsort((own, v))
        v, own = v[order], own[order]
        first = np.concatenate(([True], v[1:] != v[:-1]))
        head = own[np.flatnonzero(first)][np.cumsum(first) - 1]
        near = (head != own) & (np.bitwise_count(head ^ own) <= 2 * HALF)
        heads.append(head[near])
        members.append(own[near])
    if not heads:
        none = np.zeros(0, np.uint64)
        return none, none
    a, b = np.concatenate(heads), np.concatenate(members)
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    hang = label != np.arange(len(nodes))
    return nodes[label[hang]], nodes[hang]


def _collide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by key; whole keys are handed on, the last one waits for the next batch."""
    held: list[list[np.ndarray]] = []

    def out(parts: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        root, member = collisions(*(np.concatenate(x) for x in zip(*parts)))
        if len(root):
            yield pa.record_batch([pa.array(member.view(np.int64)), pa.array(root.view(np.int64))], ["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        key, fp, used = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("key", "fp", "used"))
        key, fp = key.astype(np.int64).view(np.uint64), fp.astype(np.int64).view(np.uint64)
        cut = int(np.searchsorted(key, key[-1]))
        if held and (cut or key[0] != held[-1][0][-1]):
            yield from out([*held, [key[:cut], fp[:cut], used[:cut]]])
            held = []
        elif cut:
            yield from out([[key[:cut], fp[:cut], used[:cut]]])
        held.append([key[cut:], fp[cut:], used[cut:]])
    if held:
        yield from out(held)


def links(fps: DataFrame, crowd: int = 20_000_000) -> DataFrame:
    """a, b: links between distinct fingerprints (fp), enough to connect all within 2 * HALF bits."""
    counts = np.zeros(1 << BLOCK, np.int64)
    for block, n in fps.groupBy(F.col("fp").bitwiseAND((1 << BLOCK) - 1).alias("block")).count().toLocalIterator():
        counts[block] = n  # 65,536 numbers at most
    crowded = crowded_blocks(counts, crowd)

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column("fp").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for i in range(0, len(fp), 1000):
                for key, own, used in ball_segments(fp[i : i + 1000], crowded):
                    yield pa.record_batch(
                        [pa.array(key.view(np.int64)), pa.array(own.view(np.int64)), pa.array(used)], ["key", "fp", "used"]
                    )

    rows = fps.select("fp").mapInArrow(segments, "key bigint, fp bigint, used tinyint")
    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(_collide, "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, crowd: int = 20_000_000) -> DataFrame:
    """doc_id, key, fingerprint, component_id, kept of every row of docs (doc_id, text).

    key names the row by content; kept marks the group's first row (its smallest doc_id;
    of rows without an id the smallest key, after all rows with one).
    """
    rows = staged(fingerprints(docs))
    lead = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key")
    fps = staged(rows.groupBy("fp").agg(F.min(lead).alias("lead")))
    roots = staged(connected_components(links(fps, crowd)))
    groups = (
        fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
        .select("fp", "lead", F.coalesce("root", "fp").alias("root"))
    )
    leads = groups.groupBy("root").agg(F.min("lead").alias("lead"))
    of = groups.select("fp", "root").join(leads, "root").select("fp", "lead")
    return rows.join(of, "fp").select(
        "doc_id",
        "key",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("lead.doc_id").alias("component_id"),
        (F.col("key") == F.col("lead.key")).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of docs, one of each group of near-duplicates; all columns stay, whatever their names."""
    return one_of_each(docs, near_duplicates(docs).where("kept").select("key"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")
