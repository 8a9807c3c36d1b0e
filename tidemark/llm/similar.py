"""Near-duplicates by similarity: texts whose five-word shingle sets have a Jaccard similarity of 0.8 or more.

Candidates come from the SimHash balls of `simhash` over five-word shingles, and, since a pair at 0.8 differs in
some ten of 64 bits and a ball reaches four, from MinHash: 50 bands of 6 minima each. Two texts of similarity s
meet in a band with probability s^6, so at 0.8 a pair is missed with probability (1 - 0.8^6)^50, some 3 in 10
million, and more rarely above. Every link is verified on the shingle sets; nothing is linked by a sketch.

Each band is compared with one of its members, its head: the one that meets most others, which is the middle of
a group of near copies. That links the bulk of a group in one row a member. Pairs of a band that are still in
different groups are found by what sets them apart from their head. With D the symmetric difference to the head
h, two texts are similar just if |Dx ^ Dy| is at most (|x| + |y|) / 9. Of two members in different groups at
least one, x, is not similar to h, so |Dx| is over (|x| + |h|) / 9, and they must share over
(9 |Dy| + |h| - |y|) / 18 entries of Dy. The entries are joined by prefixes in order of rarity, those
that only one member has left out, so members whose edits are their own meet nobody: a crowd of near copies is
never compared pair by pair. Texts with equal sets are one node from the start.

Defined results: fewer than five words are one shingle; null and empty texts have the empty set and are copies
of each other; sets are of 64-bit hashes of lower-cased (A-Z) words; a group keeps its smallest doc_id (rows
without one come last, by key; of rows equal in doc_id and text one whose other columns are least); an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import connected_components
from tidemark.llm.simhash import fingerprint, links, shingle_hashes
from tidemark.llm.text import one_of_each, row_key
from tidemark.sources.staging import staged

WORDS = 5
BANDS, DEPTH = 50, 6
U = np.uint64
_dice = np.random.default_rng(5)
#: Minima are of 32-bit hashes, which processors compare many at a time; equal shingles have equal ones.
FACTORS = _dice.integers(0, 1 << 31, BANDS * DEPTH, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
SHIFTS = _dice.integers(0, 1 << 32, BANDS * DEPTH, dtype=np.uint32)
BLEND = _dice.integers(0, 1 << 63, (BANDS, DEPTH), dtype=U) * U(2) + U(1)


def shingle_set(text: bytes | None) -> np.ndarray:
    """Distinct hashes of the five-word shingles, in order."""
    return np.unique(shingle_hashes(text, WORDS))


def bands(shingles: np.ndarray) -> np.ndarray:
    """A number for each band of minima; none for the empty set."""
    if not len(shingles):
        return np.zeros(0, U)
    least = np.full(BANDS * DEPTH, ~np.uint32(0))
    short = (shingles >> U(32)).astype(np.uint32)
    for i in range(0, len(short), 256):
        x = short[i : i + 256, None] * FACTORS
        x += SHIFTS
        np.minimum(least, x.min(0), out=least)
    x = (least.astype(U).reshape(BANDS, DEPTH) * BLEND).sum(1, dtype=U)
    return x ^ (x >> U(29))


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        nodes, sizes, fps, sketches = [], [], [], []
        for t in b.column("text").cast(pa.binary()):
            hashes = shingle_hashes(t.as_py(), WORDS)
            shingles = np.unique(hashes)
            nodes.append(xxhash.xxh3_64_intdigest(shingles.tobytes()))
            sizes.append(len(shingles))
            fps.append(fingerprint(hashes))
            sketches.append(bands(shingles).tobytes())
        signed = lambda x: pa.array(np.array(x, U).view(np.int64))
        yield pa.record_batch(
            [b.column("doc_id"), b.column("key"), signed(nodes), pa.array(sizes, pa.int32()), signed(fps), pa.array(sketches, pa.binary())],
            ["doc_id", "key", "node", "size", "fp", "sketch"],
        )


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(0, b.num_rows, 1000):
            part = b.slice(i, 1000)
            sketches = [np.frombuffer(x.as_py(), np.int64) for x in part.column("sketch")]
            times = [len(x) for x in sketches]
            node, size = (np.repeat(part.column(c).to_numpy(), times) for c in ("node", "size"))
            band = np.concatenate(sketches) if sketches else np.zeros(0, np.int64)
            yield pa.record_batch([pa.array(band), pa.array(node), pa.array(size)], ["band", "node", "size"])


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by band: those of bands with several nodes, and how many these are."""
    held: list[np.ndarray] = []

    def out(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        x = np.concatenate(parts, 1)
        group = np.cumsum(np.concatenate(([True], x[0, 1:] != x[0, :-1]))) - 1
        met = np.bincount(group)[group]
        several = met > 1
        if several.any():
            columns = [x[0], x[1], x[2].astype(np.int32), met]
            yield pa.record_batch([pa.array(c[several]) for c in columns], ["band", "node", "size", "met"])

    for b in batches:
        if not b.num_rows:
            continue
        x = np.stack([b.column(c).to_numpy().astype(np.int64) for c in ("band", "node", "size")])
        cut = int(np.searchsorted(x[0], x[0, -1]))
        if held and (cut or x[0, 0] != held[-1][0, -1]):
            yield from out([*held, x[:, :cut]])
            held = []
        elif cut:
            yield from out([x[:, :cut]])
        held.append(x[:, cut:])
    if held:
        yield from out(held)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(0, b.num_rows, 500):
            part = b.slice(i, 500)
            sets = [shingle_set(t.as_py()).view(np.int64) for t in part.column("text").cast(pa.binary())]
            yield pa.record_batch([part.column("node"), pa.array(sets, pa.list_(pa.int64()))], ["node", "shingles"])


def with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs (a, b, ...) with their shingles of_a and of_b."""
    a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a"))
    b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))
    return pairs.join(a, "a").join(b, "b")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of pairs (a, b) those with a similarity of 0.8 or more: 9 times the common shingles reach 4 times both sizes."""
    alike = 9 * F.size(F.array_intersect("of_a", "of_b")) >= 4 * (F.size("of_a") + F.size("of_b"))
    return with_sets(pairs, sets).where(alike).select("a", "b")


def sizes_fit(a: str, b: str) -> Column:
    return 5 * F.least(a, b) >= 4 * F.greatest(a, b)


def ball_pairs(nodes: DataFrame) -> DataFrame:
    """a, b: nodes (node, fp) of one fingerprint or of linked ones, as many as connect them all."""
    first = nodes.groupBy("fp").agg(F.min("node").alias("first"))
    same = nodes.join(first, "fp").where("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b"))
    near = links(first.select("fp"))
    a, b = (first.select(F.col("fp").alias(c), F.col("first").alias(f"{c}_node")) for c in "ab")
    return same.union(near.join(a, "a").join(b, "b").select("a_node", "b_node"))


def headed(met: DataFrame) -> DataFrame:
    """a, b, size_a, size_b: each member b of a band (band, node, size, met) with the band's head a, once each."""
    known = met.groupBy("node").agg(F.sum("met").alias("known"))
    heads = met.join(known, "node").groupBy("band").agg(F.max(F.struct("known", "node", "size")).alias("head"))
    pairs = met.join(heads, "band").where(F.col("node") != F.col("head.node"))
    return pairs.select(F.col("head.node").alias("a"), F.col("node").alias("b"), F.col("head.size").alias("size_a"), F.col("size").alias("size_b")).distinct()


def strays(members: DataFrame, roots: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b: pairs in different groups under one head that could be similar. members: of headed; roots: node, root."""
    of = lambda c: roots.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}"))
    rows = members.join(of("a"), "a", "left").join(of("b"), "b", "left")
    rows = rows.select("a", "b", "size_a", "size_b", F.coalesce("root_b", "b").alias("root"), (F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).alias("stray"))
    rows = staged(rows)
    mixed = rows.where("stray").select("a").distinct()
    apart = with_sets(rows.join(mixed, "a", "left_semi"), sets)
    apart = staged(apart.select("a", "b", "size_a", "size_b", "root", "stray", F.array_union(F.array_except("of_a", "of_b"), F.array_except("of_b", "of_a")).alias("d")))
    entries = apart.select("a", "b", F.explode("d").alias("x"))
    often = entries.groupBy("a", "x").agg(F.count("*").alias("held")).where("held > 1")
    shared = entries.join(often, ["a", "x"]).groupBy("a", "b").agg(F.array_sort(F.collect_list(F.struct("held", "x"))).alias("x"))
    need = F.floor((9 * F.col("n") + F.col("size_a") - F.col("size_b")) / 18) + 1
    of_member = apart.select("a", "b", "size_a", "size_b", "root", "stray", F.size("d").alias("n")).join(shared, ["a", "b"])
    of_member = staged(of_member.select("a", "b", "size_b", "root", "stray", "n", F.size("x").alias("m"), need.alias("need"), F.posexplode("x").alias("at", "e")))
    one = of_member.where("at <= m - need").select("a", "e.x", *[F.col(c).alias(f"{c}_1") for c in ("b", "size_b", "root", "n", "m", "at")])
    two = of_member.where("stray").select("a", "e.x", *[F.col(c).alias(f"{c}_2") for c in ("b", "size_b", "root", "n", "m", "at")])
    # what they can still share from here on
    most = F.least(F.col("m_1") - F.col("at_1"), F.col("m_2") - F.col("at_2"))
    enough = 18 * most >= 9 * (F.col("n_1") + F.col("n_2")) - (F.col("size_b_1") + F.col("size_b_2"))
    found = one.join(two, ["a", "x"]).where((F.col("root_1") != F.col("root_2")) & sizes_fit("size_b_1", "size_b_2") & enough)
    return found.select(F.least("b_1", "b_2").alias("a"), F.greatest("b_1", "b_2").alias("b")).distinct()


def similar_groups(docs: DataFrame) -> DataFrame:
    """root, lead: each group of similar rows of docs (doc_id, text) with its first row (last, doc_id, key)."""
    keyed = docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("key"), F.col("text").cast("string").alias("text"))
    kind = dict(keyed.dtypes)["doc_id"]
    marks = staged(keyed.mapInArrow(_marks, f"doc_id {kind}, key string, node bigint, size int, fp bigint, sketch binary"))
    lead = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key")
    firsts = [F.min(lead).alias("lead"), F.min("fp").alias("fp"), F.first("size").alias("size"), F.first("sketch").alias("sketch")]
    nodes = staged(marks.groupBy("node").agg(*firsts))

    spread = nodes.select("node", "size", "sketch").mapInArrow(_spread, "band bigint, node bigint, size int")
    met = spread.repartition("band").sortWithinPartitions("band").mapInArrow(_met, "band bigint, node bigint, size int, met bigint")
    members = staged(headed(staged(met)))
    sizes = lambda c: nodes.select(F.col("node").alias(c), F.col("size").alias(f"size_{c}"))
    balls = ball_pairs(nodes.select("node", "fp")).join(sizes("a"), "a").join(sizes("b"), "b").select(*members.columns)
    tried = staged(members.union(balls).where(sizes_fit("size_a", "size_b")).select("a", "b").distinct())

    wanted = members.select("a").union(members.select("b")).union(tried.select("a")).union(tried.select("b")).distinct().toDF("node")
    texts = nodes.join(wanted, "node", "left_semi").select("node", F.col("lead.key").alias("key"))
    sets = staged(
        keyed.select("key", "text").join(texts, "key").dropDuplicates(["key"]).select("node", "text")
        .mapInArrow(_sets, "node bigint, shingles array<bigint>")
    )
    linked = staged(verified(tried, sets))
    roots = staged(connected_components(linked))
    more = staged(strays(members, roots, sets))
    linked = linked.union(staged(verified(more, sets)))
    roots = staged(connected_components(linked))
    groups = nodes.join(roots, "node", "left").select(F.coalesce("root", "node").alias("root"), "lead")
    return groups.groupBy("root").agg(F.min("lead").alias("lead"))


def drop_similar(docs: DataFrame) -> DataFrame:
    """The rows of docs, one of each group of similar ones; all columns stay, whatever their names."""
    keep = staged(similar_groups(docs).select(F.col("lead.key").alias("key")))
    return one_of_each(docs, keep)
