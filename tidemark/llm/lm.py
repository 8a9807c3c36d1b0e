"""Language-model scoring by deleted interpolation.

P(w | v) = l2 c(v w)/c(v) + l1 c(w)/N + l0 /(V+1): maximum-likelihood estimates of two orders
and a uniform floor, mixed by weights that depend on how often the context v was seen (buckets
of powers of two). The weights are learned by expectation-maximisation on held-out counts: a
fold of the training texts (a tenth, by doc_id hash) is deleted from the counts and predicted
from what is left.

Counts live in a shuffle, not in the driver or a broadcast. Texts are packed into blocks of some
megabytes and written to the shared folder; the texts of the fold are packed once more into
blocks of their own. Each block asks for the counts of its distinct words and word pairs, once
each, and sends its own counts along: keys are cut into ranges of their hash, sorted and sent as
differences. Requests are combined in two levels. About the square root of the blocks form a
group, whose ranges are as much wider as it has fewer tokens than the corpus; a group's range is
united in one task, which then asks once for what several blocks asked for. The ranges of the
corpus are added up in one task each and answered to the groups: the counts of all training texts
to groups of texts, those without the fold to groups of the fold. The groups' ranges hand them on
by the places of each block's keys. Rows of either level number ranges times the square root of
blocks, and no task sees more requests for a word than that root, be it in every text. Words are
keyed by 80 bits, pairs by 56. Ranges grow in number with the input, not in size; a task holds
one range or one block at a time, and the one text at hand whole.

Defined results: a null or empty text is one end token; a null doc_id counts as training; repeated
rows are counted and scored each time; where nothing is learned the model is the uniform floor;
an empty table gives an empty result; extra columns are ignored. doc_id is an integer.
"""

from __future__ import annotations

import itertools
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.text import read_table
from tidemark.sources.staging import staged

#: The end token; no word holds a line feed.
END = b"\n"
#: Context-frequency buckets: 0 (unseen), 1, 2-3, 4-7, ...
BUCKETS = 24
U = np.uint64
WORD, PAIR = 0, 1
BLOCK_BYTES = 8_000_000
KEYS_PER_RANGE = 500_000
PAIR_BITS = 56


def held_out(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def deleted(doc_id: int | None) -> bool:
    """The fold of the training texts that the weights are learned on."""
    return doc_id is not None and not held_out(doc_id) and xxhash.xxh64_intdigest(str(doc_id), 7) % 10 == 0


def squeeze(x: np.ndarray) -> bytes:
    """Small numbers as bytes: zlib over the narrowest type that holds them."""
    top = int(x.max()) if len(x) else 0
    kind = np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64
    return np.dtype(kind).char.encode() + zlib.compress(x.astype(kind).tobytes(), 1)


def spread(b: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(b[1:]), np.dtype(chr(b[0]))).astype(np.int64)


def differences(x: np.ndarray) -> bytes:
    """Ascending uint64 numbers as the first one and the steps between them: the low bytes that the mean step fills as they
    are, for they are random, and the planes of bytes above them by zlib."""
    steps = np.diff(x)
    n, top = len(steps), int(steps.max()) if len(steps) else 0
    low, width = (int(x[-1] - x[0]) // max(n, 1)).bit_length() // 8, (top.bit_length() + 7) // 8
    planes = steps.view(np.uint8).reshape(-1, 8)
    return bytes([low]) + n.to_bytes(4, "little") + x[:1].tobytes() + planes[:, :low].tobytes() + zlib.compress(planes[:, low:width].T.tobytes(), 1)


def sums(b: bytes) -> np.ndarray:
    low, n = b[0], int.from_bytes(b[1:5], "little")
    whole = np.zeros((n + 1, 8), np.uint8)
    whole[0] = np.frombuffer(b, np.uint8, 8, 5)
    if n:
        whole[1:, :low] = np.frombuffer(b, np.uint8, n * low, 13).reshape(n, low)
        high = np.frombuffer(zlib.decompress(b[13 + n * low :]), np.uint8).reshape(-1, n)
        whole[1:, low : low + len(high)] = high.T
    return np.cumsum(whole.view(U)[:, 0], dtype=U)


BLOCK = "block string, n_tokens bigint, ids array<bigint>, texts binary"


class Packer:
    """Gathers texts until they fill a block."""

    def __init__(self, name: str):
        self.name, self.no = name, 0
        self.clear()

    def clear(self) -> None:
        self.ids: list[int | None] = []
        self.texts: list[bytes] = []
        self.volume = self.tokens = 0

    def add(self, doc_id: int | None, words: list[bytes]) -> Iterator[pa.RecordBatch]:
        self.ids.append(doc_id)
        self.texts.append(b" ".join(words))
        self.volume += len(self.texts[-1]) + 8
        self.tokens += len(words) + 1
        if self.volume >= BLOCK_BYTES:
            yield from self.out()

    def out(self) -> Iterator[pa.RecordBatch]:
        if self.ids:
            texts = zstandard.ZstdCompressor(level=3).compress(b"\n".join(self.texts))
            columns = [pa.array([f"{self.name}-{self.no}"]), pa.array([self.tokens]), pa.array([self.ids], pa.list_(pa.int64())), pa.array([texts], pa.binary())]
            yield pa.record_batch(columns, ["block", "n_tokens", "ids", "texts"])
            self.no += 1
            self.clear()


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of lower-cased texts (names a-...), and of the fold's texts once more (names f-...)."""
    part = TaskContext.get().partitionId()
    every, fold = Packer(f"a-{part}"), Packer(f"f-{part}")
    for b in batches:
        texts = b.column("text")
        for at, i in enumerate(b.column("doc_id").to_pylist()):
            words = (texts[at].as_py() or "").encode().lower().split()
            yield from every.add(i, words)
            if deleted(i):
                yield from fold.add(i, words)
    yield from every.out()
    yield from fold.out()


class Block:
    """A block spelled out: its tokens, distinct words and distinct pairs, with their keys in ascending order."""

    def __init__(self, name: str, ids: list, texts: bytes):
        self.ids, self.is_fold = ids, name[0] == "f"
        index: dict[bytes, int] = {END: 0}
        found: list[np.ndarray] = []
        for line in zstandard.ZstdDecompressor().decompress(texts).split(b"\n"):
            words = line.split()
            found.append(np.fromiter((index.setdefault(w, len(index)) for w in words), np.int32, len(words)))
        self.sizes = np.array([len(x) + 1 for x in found], np.int64)
        ends = np.cumsum(self.sizes)
        # each text ends with the end token and starts after its own end: its first context is the end token
        self.w = np.zeros(int(ends[-1]), np.int32)
        for x, end in zip(found, ends):
            self.w[end - 1 - len(x) : end - 1] = x
        v = np.empty_like(self.w)
        v[1:] = self.w[:-1]
        v[ends - self.sizes] = 0
        self.doc = np.repeat(np.arange(len(ids), dtype=np.int32), self.sizes)
        self.n = len(index)
        digest = np.frombuffer(b"".join(xxhash.xxh3_128_digest(x) for x in index), U).reshape(-1, 2)
        self.pairs, pair = np.unique(v.astype(np.int64) * self.n + self.w, return_inverse=True)
        self.pair = pair.astype(np.int32)
        a, b = digest[self.pairs // self.n, 0], digest[self.pairs % self.n, 0]
        h = (a ^ (a >> U(29))) * U(0xBF58476D1CE4E5B9) + b
        h = (h ^ (h >> U(32))) * U(0x94D049BB133111EB)
        self.key = {WORD: digest[:, 0], PAIR: (h ^ (h >> U(29))) >> U(64 - PAIR_BITS)}
        self.tail = {WORD: digest[:, 1].astype(np.uint16), PAIR: None}
        self.order = {WORD: np.lexsort((self.tail[WORD], self.key[WORD])), PAIR: np.argsort(self.key[PAIR], kind="stable")}

    def counts(self, kind: int) -> tuple[np.ndarray, np.ndarray]:
        """Of each word or pair: its count in the training texts without the fold, and in the fold. A block of the fold only asks."""
        at, n = (self.w, self.n) if kind == WORD else (self.pair, len(self.pairs))
        if self.is_fold:
            return np.zeros(n, np.int64), np.zeros(n, np.int64)
        fold = np.array([deleted(i) for i in self.ids])[self.doc]
        held = np.array([held_out(i) for i in self.ids])[self.doc]
        return np.bincount(at[~held & ~fold], minlength=n), np.bincount(at[fold], minlength=n)

    def ranges(self, kind: int, ranges: int) -> Iterator[tuple[int, np.ndarray]]:
        """Ranges of the hash with the entries in them, both ascending."""
        order = self.order[kind]
        for top, lo, hi in cut(kind, self.key[kind][order], ranges):
            yield top, order[lo:hi]


def cut(kind: int, key: np.ndarray, ranges: int) -> Iterator[tuple[int, int, int]]:
    """Of ascending keys: the ranges of the hash that hold some, and where each begins and ends."""
    top = (key >> U(32 if kind == WORD else PAIR_BITS - 32)) * U(ranges) >> U(32)
    cuts = np.flatnonzero(np.concatenate(([True], top[1:] != top[:-1], [True])))
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        yield int(top[lo]), int(lo), int(hi)


def rows_of(b: pa.RecordBatch) -> Iterator[dict]:
    """Rows one by one: the packed columns of a whole batch would be held twice."""
    for i in range(b.num_rows):
        yield {n: b.column(n)[i].as_py() for n in b.schema.names}


def runs_of(batches: Iterator[pa.RecordBatch], *by: str) -> Iterator[list[dict]]:
    """Neighbouring rows that are equal in `by`."""
    rows = itertools.chain.from_iterable(map(rows_of, batches))
    for _, run in itertools.groupby(rows, key=lambda r: tuple(r[c] for c in by)):
        yield list(run)


def batch_of(rows: list[tuple], names: list[str], kinds: tuple) -> pa.RecordBatch:
    return pa.record_batch([pa.array([r[j] for r in rows], k) for j, k in enumerate(kinds)], names)


def batches_of(rows: Iterator[tuple], names: list[str], kinds: tuple, size: int = 50) -> Iterator[pa.RecordBatch]:
    for some in itertools.batched(rows, size):
        yield batch_of(some, names, kinds)


def grouping(blocks: int, tokens: int, keys_per_range: int) -> tuple[int, int]:
    """Groups that so many blocks form, and ranges that a group's keys are cut into."""
    groups = max(1, math.isqrt(blocks))
    return groups, max(1, math.ceil(tokens / keys_per_range / groups))


KEYS = ["keys", "tails", "rest", "fold"]
ASKED = "group string, part bigint, block string, keys binary, tails binary, rest binary, fold binary"
ASKED_KINDS = (pa.string(), pa.int64(), pa.string(), *[pa.binary()] * 4)


def requests(shapes: dict[str, tuple[int, int]]):
    """What each block asks of its group. Part 2 r + kind goes to range r of the kind's hashes; shapes: grouping of the
    blocks of texts (a) and of the fold (f)."""

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for r in itertools.chain.from_iterable(map(rows_of, batches)):
            name, block = r["block"], Block(r["block"], r["ids"], r["texts"])
            groups, ranges = shapes[name[0]]
            group = f"{name[0]}-{xxhash.xxh64_intdigest(name) % groups}"
            for kind in (WORD, PAIR):
                rest, fold = block.counts(kind)
                for top, at in block.ranges(kind, ranges):
                    tails = block.tail[kind][at].tobytes() if kind == WORD else None
                    told = (None, None) if block.is_fold else (squeeze(rest[at]), squeeze(fold[at]))
                    yield group, 2 * top + kind, name, differences(block.key[kind][at]), tails, *told

    return lambda batches: batches_of(asked(batches), ["group", "part", "block", *KEYS], ASKED_KINDS)


class United:
    """The distinct keys of several requests in ascending order, the places of each request's keys among them, and their sums."""

    def __init__(self, kind: int, rows: list[dict]):
        key = [sums(r["keys"]) for r in rows]
        at = np.cumsum([0] + [len(x) for x in key])
        key = np.concatenate(key)
        self.tail = None
        if kind == WORD:
            tail = np.concatenate([np.frombuffer(r["tails"], np.uint16) for r in rows])
            order = np.lexsort((tail, key))
            key, tail = key[order], tail[order]
            new = np.concatenate(([True], (key[1:] != key[:-1]) | (tail[1:] != tail[:-1])))
            self.tail = tail[new]
        else:
            order = np.argsort(key, kind="stable")
            key = key[order]
            new = np.concatenate(([True], key[1:] != key[:-1]))
        place = np.empty(len(order), np.int64)
        place[order] = np.cumsum(new) - 1
        self.key, self.places = key[new], [place[lo:hi] for lo, hi in zip(at[:-1], at[1:])]
        self.rest, self.fold = np.zeros(len(self.key), np.int64), np.zeros(len(self.key), np.int64)
        for r, x in zip(rows, self.places):
            if r["rest"] is not None:
                # a request names each key once
                self.rest[x] += spread(r["rest"])
                self.fold[x] += spread(r["fold"])


JOINED = "far bigint, group string, part bigint, block string, keys binary, tails binary, rest binary, fold binary"


def joined(ranges: int):
    """A group's range asks the ranges of the corpus (far) once for each of its keys. The places of each block's keys go
    along under negative numbers. Rows come sorted by group and part."""

    def united(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for rows in runs_of(batches, "group", "part"):
            group, part = rows[0]["group"], rows[0]["part"]
            whole = United(part % 2, rows)
            aside = -1 - xxhash.xxh64_intdigest(f"{group} {part}") % (1 << 40)
            for r, x in zip(rows, whole.places):
                yield aside, group, part, r["block"], squeeze(np.diff(x, prepend=0)), None, None, None
            for top, lo, hi in cut(part % 2, whole.key, ranges):
                tails = whole.tail[lo:hi].tobytes() if part % 2 == WORD else None
                told = (None, None) if group[0] == "f" else (squeeze(whole.rest[lo:hi]), squeeze(whole.fold[lo:hi]))
                yield 2 * top + part % 2, group, part, None, differences(whole.key[lo:hi]), tails, *told

    return lambda batches: batches_of(united(batches), ["far", "group", "part", "block", *KEYS], (pa.int64(), *ASKED_KINDS))


ANSWER = "far bigint, group string, part bigint, block string, data binary, tokens bigint, types bigint"


def answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each request's counts in its own order; rows come sorted by far. A row without group holds the range's sums: of
    all counts, and of those without the fold under the range's negative number. Places pass through."""

    def settled() -> Iterator[tuple]:
        # places are passed on one by one: only requests of a range are held together
        rows = itertools.chain.from_iterable(map(rows_of, batches))
        for far, run in itertools.groupby(rows, key=lambda r: r["far"]):
            if far < 0:
                for r in run:
                    yield -1, r["group"], r["part"], r["block"], r["keys"], None, None
                continue
            held = list(run)
            whole = United(far % 2, held)
            every = whole.rest + whole.fold
            if far % 2 == WORD:
                for no, x in ((far, every), (-far - 1, whole.rest)):
                    yield no, None, None, None, None, int(x.sum()), int((x > 0).sum())
            for r, x in zip(held, whole.places):
                yield far, r["group"], r["part"], None, squeeze((whole.rest if r["rest"] is None else every)[x]), None, None

    names = ["far", "group", "part", "block", "data", "tokens", "types"]
    yield from batches_of(settled(), names, (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.int64()))


HANDED = "block string, part bigint, data binary"


def handed_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A group's answers dealt to its blocks by the places of their keys; rows come sorted by group, part and far, places first."""

    def dealt() -> Iterator[tuple]:
        for rows in runs_of(batches, "group", "part"):
            counts = np.concatenate([spread(r["data"]) for r in rows if r["block"] is None])
            for r in rows:
                if r["block"] is not None:
                    yield r["block"], r["part"], squeeze(counts[np.cumsum(spread(r["data"]))])

    yield from batches_of(dealt(), ["block", "part", "data"], (pa.string(), pa.int64(), pa.binary()))


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Block, np.ndarray, np.ndarray]]:
    """Each block with the counts of its words and pairs; rows come sorted by block and part, the block itself first."""

    def out(rows: list[dict]) -> tuple[Block, np.ndarray, np.ndarray]:
        block = Block(rows[0]["block"], rows[0]["ids"], rows[0]["data"])
        found = []
        for kind, n in ((WORD, block.n), (PAIR, len(block.pairs))):
            count = np.zeros(n, np.int64)
            count[block.order[kind]] = np.concatenate([spread(r["data"]) for r in rows[1:] if r["part"] % 2 == kind])
            found.append(count)
        return block, *found

    for rows in runs_of(batches, "block"):
        yield out(rows)


def context_bucket(c: np.ndarray) -> np.ndarray:
    return np.minimum(np.ceil(np.log2(c + 1.0)), BUCKETS - 1).astype(np.int64)


def estimates(block: Block, word: np.ndarray, pair: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket, P2 and P1 of each distinct pair of the block. Each token is a context once: also the end, of a text's first word."""
    v, w = block.pairs // block.n, block.pairs % block.n
    seen = word[v]
    return context_bucket(seen), pair / np.maximum(seen, 1), word[w] / max(n, 1)


EVENTS = "bucket binary, p2 binary, p1 binary, times binary"


def fold_events(n: int):
    """Held-out events of each block of the fold: bucket, the estimates and how often they occur, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, word, pair in counted(batches):
            bucket, p2, p1 = estimates(block, word, pair, n)
            packed = (squeeze(bucket), p2.astype(np.float32).tobytes(), p1.astype(np.float32).tobytes(), squeeze(np.bincount(block.pair)))
            yield batch_of([packed], ["bucket", "p2", "p1", "times"], (pa.binary(),) * 4)

    return run


def learn(events: DataFrame, types: int, rounds: int = 12) -> np.ndarray:
    """Weights (BUCKETS, 3) by expectation-maximisation; each round is one aggregation of BUCKETS x 3 sums."""
    mix = np.tile([0.3, 0.6, 0.1], (BUCKETS, 1))
    for _ in range(rounds):
        now = mix

        def expect(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            total = np.zeros((BUCKETS, 3))
            for b in batches:
                for e in rows_of(b):
                    bucket = spread(e["bucket"])
                    share = now[bucket]
                    share[:, 0] *= np.frombuffer(e["p2"], np.float32)
                    share[:, 1] *= np.frombuffer(e["p1"], np.float32)
                    share[:, 2] /= types + 1
                    share *= (spread(e["times"]) / share.sum(1))[:, None]
                    for k in range(3):
                        total[:, k] += np.bincount(bucket, share[:, k], BUCKETS)
            yield pa.record_batch([pa.array(np.arange(BUCKETS)), *(pa.array(total[:, k]) for k in range(3))], ["bucket", "s2", "s1", "s0"])

        got = events.mapInArrow(expect, "bucket bigint, s2 double, s1 double, s0 double").groupBy("bucket").agg(*[F.sum(c).alias(c) for c in ("s2", "s1", "s0")])
        new = mix.copy()
        for r in got.collect():  # BUCKETS rows
            # one event of the prior mix keeps every weight above zero
            total = np.array([r["s2"], r["s1"], r["s0"]]) + [0.3, 0.6, 0.1]
            new[r["bucket"]] = total / total.sum()
        if np.abs(new - mix).max() < 1e-4:
            return new
        mix = new
    return mix


SCORES = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


def score_rows(n: int, types: int, mix: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, word, pair in counted(batches):
            bucket, p2, p1 = estimates(block, word, pair, n)
            m = mix[bucket]
            mixed = np.log10(m[:, 0] * p2 + m[:, 1] * p1 + m[:, 2] / (types + 1))
            base = np.log10((word + 1.0) / (n + types + 1.0))
            docs = len(block.ids)
            yield pa.record_batch(
                [
                    pa.array(block.ids, pa.int64()),
                    pa.array([held_out(i) for i in block.ids]),
                    pa.array(block.sizes),
                    pa.array(np.bincount(block.doc, word[block.w] > 0, docs).astype(np.int64)),
                    pa.array(np.full(docs, n)),
                    pa.array(np.bincount(block.doc, base[block.w], docs)),
                    pa.array(np.bincount(block.doc, mixed[block.pair], docs)),
                ],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return run


def requested(blocks: DataFrame, keys_per_range: int = KEYS_PER_RANGE) -> tuple[DataFrame, int, dict[str, int]]:
    """The requests of blocks, united by group; the ranges that they go to; and the number of blocks of either kind."""
    sizes = {r["kind"]: r for r in blocks.groupBy(F.substring("block", 1, 1).alias("kind")).agg(F.count("*").alias("n"), F.sum("n_tokens").alias("tokens")).collect()}
    shapes = {kind: grouping(r["n"], r["tokens"], keys_per_range) for kind, r in sizes.items()}
    ranges = max(4, sum(r["tokens"] for r in sizes.values()) // keys_per_range)
    asked = blocks.mapInArrow(requests(shapes), ASKED)
    by_group = asked.repartition(max(8, ranges // 4), "group", "part").sortWithinPartitions("group", "part")
    return by_group.mapInArrow(joined(ranges), JOINED), ranges, {kind: r["n"] for kind, r in sizes.items()}


def score_texts(docs: DataFrame, keys_per_range: int = KEYS_PER_RANGE) -> DataFrame:
    """SCORES of every row of docs (doc_id, text)."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    blocks = staged(rows.mapInArrow(pack, BLOCK))
    asked, ranges, count = requested(blocks, keys_per_range)
    parts = max(8, ranges // 4)
    told = staged(asked.repartition(parts, "far").sortWithinPartitions("far").mapInArrow(answers, ANSWER))

    def totals(where: str) -> tuple[int, int]:
        r = told.where(f"group is null and {where}").agg(F.sum("tokens"), F.sum("types")).first()
        return r[0] or 0, r[1] or 0

    def answered(kind: str) -> DataFrame:
        """Blocks of texts (a) or of the fold (f), each followed by its answers."""
        by_group = told.where(F.col("group").startswith(kind)).select("group", "part", "far", "block", "data")
        said = by_group.repartition(parts, "group", "part").sortWithinPartitions("group", "part", "far").mapInArrow(handed_on, HANDED)
        said = said.select("block", "part", F.lit(None).cast("array<bigint>").alias("ids"), "data")
        whole = blocks.where(F.col("block").startswith(kind)).select("block", F.lit(-1).cast("bigint").alias("part"), "ids", F.col("texts").alias("data"))
        return whole.union(said).repartition(max(8, sum(count.values()) // 4), "block").sortWithinPartitions("block", "part")

    n, types = totals("far < 0")
    mix = learn(staged(answered("f").mapInArrow(fold_events(n), EVENTS)), types)
    return answered("a").mapInArrow(score_rows(*totals("far >= 0"), mix), SCORES)


def op3_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(read_table(spark, sf_dir, "documents"))
