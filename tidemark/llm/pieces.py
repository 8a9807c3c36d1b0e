"""SentencePiece encoding by forward filtering and backward sampling, and lossless decoding.

A text is cut into units (a word with the space before it, or one white space character);
no piece crosses a unit, so each unit has a lattice of its own. Forward filtering sums the
weights of all segmentations up to each character; backward sampling then draws pieces from
the end. Piece weights fall with the piece's rank in the vocabulary file; `heat` flattens them.
Characters without a piece become byte pieces.

Draws come from a counter hashed with the row's key and the unit's position, so that a row's
segmentation depends on nothing but the row and the seed, whatever batch or attempt it is in.
Equal units of a batch share their lattice, and units of one length are filtered and sampled
together as arrays. Nothing is shuffled.

Defined results: a null text has null pieces, an empty one none; decoding gives back every text
exactly, white space and unknown characters included; repeated rows get equal results; a null doc_id is
kept and an empty table gives an empty result. doc_id is an integer.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.text import read_table

#: The default of every `model` parameter here: a vocabulary file that the driver can read.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNIT = re.compile(r" ?[^\s]+|\s")
#: Longer units are sampled one by one.
LONG = 40
SLOT_BITS = 18
U = np.uint64


def first_slot(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(32))) * U(0xD1B54A32D192ED03)
    return (h >> U(64 - SLOT_BITS)).astype(np.int64)


class Vocabulary:
    """Pieces, weights and byte pieces of a SentencePiece model file, given as bytes."""

    def __init__(self, proto: bytes, heat: float):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
        size = sp.get_piece_size()
        self.raw: list[bytes] = [b""] * size
        self.byte = np.zeros(256, np.int32)
        pieces: dict[str, int] = {}
        for i in range(size):
            p = sp.id_to_piece(i)
            if sp.is_byte(i):
                b = int(p[3:5], 16)
                self.byte[b], self.raw[i] = i, bytes([b])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                pieces[p] = i
                self.raw[i] = p.replace(MARK, " ").encode()
        ranked = sorted(pieces, key=lambda p: (-sp.get_score(pieces[p]), pieces[p]))
        self.weight = {p: -np.log(n + 3.0) / heat for n, p in enumerate(ranked)}
        self.unknown = -(np.log(size) + 12.0) / heat
        self.ids = pieces
        self.longest = max(map(len, pieces), default=1)
        # an open-addressing table of the pieces' hashes: a lookup is a few gathers
        self.slot_hash = np.zeros(1 << SLOT_BITS, U)
        self.slot_id = np.full(1 << SLOT_BITS, -1, np.int32)
        self.slot_weight = np.full(1 << SLOT_BITS, -np.inf)
        self.probes = 1
        for p, i in pieces.items():
            h = self.hashed(p)
            at, n = int(first_slot(np.array([h], U))[0]), 1
            while self.slot_id[at] >= 0:
                at, n = (at + 1) % (1 << SLOT_BITS), n + 1
            self.slot_hash[at], self.slot_id[at], self.slot_weight[at] = h, i, self.weight[p]
            self.probes = max(self.probes, n)

    @staticmethod
    def hashed(piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * 0x9E3779B97F4A7C15 + ord(c) + 1) % (1 << 64)
        return h

    def look_up(self, h: np.ndarray) -> np.ndarray:
        """The slot of each hash, or -1."""
        shape, h = h.shape, np.ascontiguousarray(h).ravel()
        slot = np.full(len(h), -1, np.int64)
        left, at = np.arange(len(h)), first_slot(h)
        for _ in range(self.probes):
            hit = self.slot_hash[at] == h[left]
            slot[left[hit]] = at[hit]
            on = ~hit & (self.slot_id[at] >= 0)  # an empty slot ends the search
            left, at = left[on], (at[on] + 1) % (1 << SLOT_BITS)
            if not len(left):
                break
        return slot.reshape(shape)

    def decode(self, ids) -> bytes:
        return b"".join(map(self.raw.__getitem__, ids))


def marked(unit: str) -> str:
    """A unit as pieces spell it; a mark that the text itself holds can't be told from a space and goes by bytes."""
    body = unit.replace(MARK, "\x00") if MARK in unit else unit
    return MARK + body[1:] if body[0] == " " else body


def draws(row: np.ndarray, unit: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Uniform numbers in [0, 1) for (row key, unit, step)."""
    x = row + unit.astype(U) * U(0x9E3779B97F4A7C15) + step.astype(U) * U(0xD1B54A32D192ED03)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return ((x ^ (x >> U(31))) >> U(11)).astype(np.float64) / float(1 << 53)


def lattice(v: Vocabulary, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Of units of one length m: cum and ids, both (units, m + 1, longest piece).

    cum[u, j, l]: the chance that the piece that ends before character j has at most l + 1
    characters. ids: that piece, or -1 (no piece; of one character: its bytes).
    """
    k, m = len(units), len(units[0])
    code = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32).reshape(k, m).astype(U)
    wide = min(v.longest, m)
    weight = np.full((k, m + 1, wide), -np.inf)
    ids = np.full((k, m + 1, wide), -1, np.int32)
    h = np.zeros((k, m + 1), U)
    for length in range(1, wide + 1):  # of each start, one more character
        h = h[:, :-1] * U(0x9E3779B97F4A7C15) + code[:, length - 1 :] + U(1)
        slot = v.look_up(h)
        known = slot >= 0
        weight[:, length:, length - 1] = np.where(known, v.slot_weight[slot], v.unknown if length == 1 else -np.inf)
        ids[:, length:, length - 1] = np.where(known, v.slot_id[slot], -1)
    forward = np.full((k, m + 1), -np.inf)
    forward[:, 0] = 0.0
    cum = np.ones((k, m + 1, wide), np.float32)
    for j in range(1, m + 1):
        n = min(wide, j)
        terms = forward[:, j - n : j][:, ::-1] + weight[:, j, :n]
        top = terms.max(1)
        e = np.exp(terms - top[:, None])
        total = e.sum(1)
        forward[:, j] = top + np.log(total)
        cum[:, j, :n] = np.cumsum(e, 1) / total[:, None]
        cum[:, j, n - 1 :] = 1.0
    return cum, ids


def sample_one(v: Vocabulary, unit: str, key: int, no: int) -> list[tuple[int, int]]:
    """(piece or -1, character) of one long unit, in order; memory in proportion to its length."""
    m = len(unit)
    forward = np.zeros(m + 1)
    arcs: list[list[tuple[int, int, float]]] = [[]]
    for j in range(1, m + 1):
        here = []
        for length in range(1, min(v.longest, j) + 1):
            p = unit[j - length : j]
            if p in v.ids:
                here.append((length, v.ids[p], forward[j - length] + v.weight[p]))
            elif length == 1:
                here.append((1, -1, forward[j - 1] + v.unknown))
        top = max(a[2] for a in here)
        forward[j] = top + np.log(sum(np.exp(a[2] - top) for a in here))
        arcs.append(here)
    u = draws(np.full(m, key, U), np.full(m, no, np.int64), np.arange(m))
    out, j, step = [], m, 0
    while j:
        left = u[step]
        for length, piece, w in arcs[j]:
            left -= np.exp(w - forward[j])
            if left < 0:
                break
        out.append((piece, j - length))
        j -= length
        step += 1
    return out[::-1]


def encode_batch(v: Vocabulary, texts: list[str | None], keys: list[int]) -> list[np.ndarray | None]:
    """Sampled piece ids of each text; keys: 64-bit, one a text."""
    index: dict[str, int] = {}
    unit_of: list[int] = []
    counts = []
    for t in texts:
        found = UNIT.findall(t) if t else []
        unit_of += [index.setdefault(u, len(index)) for u in found]
        counts.append(len(found))
    if not unit_of:
        return [None if t is None else np.zeros(0, np.int32) for t in texts]
    of, count = np.array(unit_of, np.int32), np.array(counts)
    del unit_of
    row = np.repeat(np.array([int(k) & ((1 << 64) - 1) for k in keys], U), count)
    no = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
    units = list(index)
    lengths = np.fromiter(map(len, units), np.int64, len(units))[of]
    taken = np.zeros(len(of), np.int64)  # pieces of each unit
    got: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []  # unit, its pieces after this one, piece, character
    for m in np.unique(lengths):
        occ = np.flatnonzero(lengths == m)
        if m > LONG:
            for o in occ:
                picked = sample_one(v, marked(units[of[o]]), int(row[o]), int(no[o]))
                n = taken[o] = len(picked)
                got.append((np.full(n, o), np.arange(n)[::-1], *np.array(picked, np.int64).T))
            continue
        distinct, inverse = np.unique(of[occ], return_inverse=True)
        size = max(1, 1_000_000 // int((m + 1) * min(v.longest, m)))
        for lo in range(0, len(distinct), size):
            cum, ids = lattice(v, [marked(units[i]) for i in distinct[lo : lo + size]])
            mine = (inverse >= lo) & (inverse < lo + size)
            o, u = occ[mine].astype(np.int32), inverse[mine] - lo
            at, step = np.full(len(o), m, np.int32), 0
            while len(o):
                x = draws(row[o], no[o], np.full(len(o), step))
                length = (x[:, None] >= cum[u, at]).sum(1)
                piece = ids[u, at, length]
                at = (at - length - 1).astype(np.int32)
                got.append((o, np.full(len(o), step, np.int32), piece, at))
                step += 1
                taken[o] = step
                on = at > 0
                o, u, at = o[on], u[on], at[on]
    ends = np.cumsum(taken)
    piece, at, occ = (np.empty(ends[-1], np.int32) for _ in range(3))
    for o, after, p, c in got:
        to = ends[o] - 1 - after
        piece[to], at[to], occ[to] = p, c, o
    spelled = [(i, units[of[occ[i]]][at[i]].encode()) for i in np.flatnonzero(piece < 0)]
    width = np.ones(len(piece), np.int64)
    for i, raw in spelled:
        width[i] = len(raw)
    starts = np.cumsum(width) - width
    flat = np.repeat(piece, width).astype(np.int32)
    for i, raw in spelled:
        flat[starts[i] : starts[i] + len(raw)] = v.byte[list(raw)]
    per = np.bincount(np.repeat(np.arange(len(texts)), count)[occ], width, len(texts)).astype(np.int64)
    ends = np.cumsum(per)
    return [None if t is None else flat[e - n : e] for t, e, n in zip(texts, ends, per)]


def encoder(model: str, seed: int, heat: float, digest: bool):
    with open(model, "rb") as f:
        proto = f.read()  # half a MB; it goes with the tasks, which need no file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Vocabulary(proto, heat)
        for whole in batches:
            for b in in_parts(whole):
                names = b.column("name").to_pylist()
                texts = b.column("text").to_pylist()
                ids = encode_batch(v, texts, [xxhash.xxh64_intdigest(n or "", seed) for n in names])
                n = pa.array([None if x is None else len(x) for x in ids], pa.int64())
                if not digest:
                    sizes = np.cumsum([0] + [0 if x is None else len(x) for x in ids])
                    flat = pa.array(np.concatenate([x for x in ids if x is not None] or [np.zeros(0, np.int32)]))
                    offsets = pa.array(sizes.astype(np.int32), mask=np.array([x is None for x in ids] + [False]))
                    yield pa.record_batch([b.column("doc_id"), n, pa.ListArray.from_arrays(offsets, flat)], ["doc_id", "n_pieces", "pieces"])
                    continue
                decoded = [None if x is None else v.decode(x) for x in ids]
                yield pa.record_batch(
                    [
                        b.column("doc_id"),
                        n,
                        pa.array([None if x is None else hashlib.sha256(x.tobytes()).hexdigest() for x in ids], pa.string()),
                        pa.array([None if x is None else hashlib.sha256(x).hexdigest() for x in decoded], pa.string()),
                        pa.array([None if x is None else x == t.encode() for x, t in zip(decoded, texts)], pa.bool_()),
                    ],
                    ["doc_id", "n_pieces", "pieces_sha256", "decoded_sha256", "lossless"],
                )

    return run


def in_parts(b: pa.RecordBatch, most: int = 3_000_000) -> Iterator[pa.RecordBatch]:
    """Slices of about `most` bytes of text, of one row at least."""
    size = np.cumsum([len(t.as_py() or b"") for t in b.column("text").cast(pa.binary())])
    lo = 0
    while lo < b.num_rows:
        hi = max(lo + 1, int(np.searchsorted(size, (size[lo - 1] if lo else 0) + most)))
        yield b.slice(lo, hi - lo)
        lo = hi


def _named(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.col("doc_id").cast("string").alias("name"), F.col("text").cast("string").alias("text"))


def encode(docs: DataFrame, model: str = MODEL, seed: int = 42, heat: float = 1.0) -> DataFrame:
    """doc_id, n_pieces, pieces (array of int) of every row of docs (doc_id, text)."""
    kind = dict(docs.dtypes)["doc_id"]
    return _named(docs).mapInArrow(encoder(model, seed, heat, False), f"doc_id {kind}, n_pieces bigint, pieces array<int>")


def decode(pieces: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, text of rows with doc_id and pieces."""
    with open(model, "rb") as f:
        proto = f.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Vocabulary(proto, 1.0)
        for b in batches:
            texts = [None if x is None else v.decode(x) for x in b.column("pieces").to_pylist()]
            yield pa.record_batch([b.column("doc_id"), pa.array(texts, pa.binary()).cast(pa.string())], ["doc_id", "text"])

    kind = dict(pieces.dtypes)["doc_id"]
    return pieces.select("doc_id", "pieces").mapInArrow(run, f"doc_id {kind}, text string")


def op8_sentencepiece(spark: SparkSession, sf_dir: str, model: str = MODEL) -> DataFrame:
    """n_pieces and digests of the sampled pieces and of their decoding, for every whole text."""
    docs = read_table(spark, sf_dir, "documents")
    schema = "doc_id bigint, n_pieces bigint, pieces_sha256 string, decoded_sha256 string, lossless boolean"
    return _named(docs).mapInArrow(encoder(model, 42, 1.0, True), schema)
