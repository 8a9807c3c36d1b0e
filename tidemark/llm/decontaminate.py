"""Benchmark decontamination by a prefix-filtered set join, in SQL functions only.

An item's windows are its runs of `size` consecutive words (an item with fewer words is
one window). A window can stand in a document only if all its shingles of three words do, so
its rarest shingle alone is a sufficient prefix: shingles are ordered by how many documents hold
them, windows with a shingle that no document holds are dropped, and only document positions of
prefix shingles are candidates. A candidate fixes where the window would have to start; the start
must not be negative and the end not beyond the document (positional and length bounds), and
then the words themselves are compared.

Documents are never shuffled and no key is gathered: shingles are counted with partial sums. The
windows that are left go to the documents by a broadcast, in blocks of at most `broadcast_windows`;
more windows are more passes over the documents. For the count, the benchmark's shingles are
broadcast if they are few enough (counted, `broadcast_shingles`); beyond that all shingles of the
documents are counted and joined with them.

Defined results: a null or empty text has no words and no hit; an item without words or
without an id is no item; repeated documents each get their result; repeated items count
once per id; an empty benchmark leaves every document clean.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.text import lower_ascii, read_table, row_key, split_words, text_of
from tidemark.sources.staging import staged

#: Everything in ASCII but letters (lower-cased before) and digits.
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"


def item_words(text: Column) -> Column:
    return split_words(lower_ascii(text_of(text)), BREAKS)


def item_windows(benchmark: DataFrame, size: int) -> DataFrame:
    """item_id, win: the distinct windows of each item."""
    items = benchmark.where("item_id is not null").select("item_id", item_words(F.col("text")).alias("w"))
    starts = F.explode(F.sequence(F.lit(1), F.greatest(F.size("w") - (size - 1), F.lit(1))))
    return (
        items.where(F.size("w") > 0)
        .select("item_id", "w", starts.alias("at"))
        .select("item_id", F.slice("w", F.col("at"), F.lit(size)).alias("win"))
        .distinct()
    )


def shingles(words: Column, size: int) -> Column:
    """A hash for the `size` words from each position on; fewer at the end."""
    return F.transform(words, lambda x, i: F.xxhash64(x, *[F.get(words, i + k) for k in range(1, size)]))


def window_shingles(windows: DataFrame, shingle: int) -> DataFrame:
    """win, s, lead, h: the shingles of each distinct window, of all its words where it has fewer."""
    sized = windows.select("win", F.least(F.size("win"), F.lit(shingle)).alias("s")).distinct()
    parts = [
        sized.where(F.col("s") == n).select("win", "s", F.posexplode(F.slice(shingles(F.col("win"), n), F.lit(1), F.size("win") - (n - 1))).alias("lead", "h"))
        for n in range(1, shingle + 1)
    ]
    return functools.reduce(DataFrame.unionByName, parts)


def held_shingles(words: DataFrame, wanted: DataFrame, sizes: list[int], few: bool) -> DataFrame:
    """h, held: how many rows of words (w) hold each wanted shingle (h) that any holds."""
    own = F.array_distinct(F.flatten(F.array(*[shingles(F.col("w"), n) for n in sizes])))
    every = words.select(F.explode(own).alias("h"))
    if few:
        return every.join(F.broadcast(wanted), "h").groupBy("h").agg(F.count("*").alias("held"))
    return every.groupBy("h").agg(F.count("*").alias("held")).join(wanted, "h")


def prefixes(windows: DataFrame, words: DataFrame, shingle: int, few_shingles: int) -> tuple[DataFrame, list[int]]:
    """(item_id, win, s, lead, h: the rarest shingle of each window that could stand in words; the sizes of shingles, at most `shingle`)."""
    entries = staged(window_shingles(windows, shingle))
    wanted = staged(entries.select("h").distinct())
    sizes = sorted(r["s"] for r in entries.select("s").distinct().collect())
    if not sizes:
        return entries, sizes
    held = held_shingles(words, wanted, sizes, wanted.count() <= few_shingles)
    ranked = entries.join(held, "h", "left").groupBy("win", "s").agg(
        F.min(F.struct("held", "h", "lead")).alias("p"), F.count_if(F.col("held").isNull()).alias("missing")
    )
    chosen = ranked.where("missing = 0").select("win", "s", "p.lead", "p.h")
    return staged(windows.join(chosen, "win")), sizes


def occurrences(words: DataFrame, windows: DataFrame, sizes: list[int], most: int) -> DataFrame:
    """key, item_id, start, n: where windows (item_id, win, s, lead, h) stand in words (key, w)."""
    blocks = max(1, -(-windows.count() // most))
    start, n = F.col("at") - F.col("lead"), F.size("win")
    fits = (start >= 0) & (start + n <= F.size("w")) & (F.slice("w", start + 1, n) == F.col("win"))
    found = []
    for size in sizes:
        at = words.select("key", "w", F.posexplode(shingles(F.col("w"), size)).alias("at", "here"))
        for i in range(blocks):
            block = windows.where((F.col("s") == size) & (F.pmod(F.xxhash64("win"), F.lit(blocks)) == i)).drop("s")
            found.append(at.join(F.broadcast(block), (F.col("here") == F.col("h")) & fits).select("key", "item_id", start.alias("start"), n.alias("n")))
    return functools.reduce(DataFrame.union, found)


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, size: int = 10, shingle: int = 3, broadcast_windows: int = 200_000, broadcast_shingles: int = 1_000_000,
    keep_key: bool = False,
) -> DataFrame:
    """doc_id, [key,] n_words, n_hit, n_items, items_sha256, contaminated, hit_words of every row of docs (doc_id, text).

    hit_words: the positions of the words inside a window, ascending.
    """
    windows = staged(item_windows(benchmark, size))
    words = docs.select(row_key(F.col("doc_id"), F.col("text")).alias("key"), item_words(F.col("text")).alias("w"))
    leads, sizes = prefixes(windows, words, shingle, broadcast_shingles)
    if sizes:
        hits = occurrences(words, leads, sizes, broadcast_windows)
    else:
        hits = windows.select(F.lit("").alias("key"), "item_id", F.lit(0).alias("start"), F.lit(0).alias("n")).limit(0)
    spots = hits.groupBy("key").agg(
        F.collect_set(F.struct("start", "n")).alias("spots"),
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"),
    )
    covered = F.array_sort(
        F.array_distinct(
            F.flatten(F.transform("spots", lambda s: F.sequence(s["start"], s["start"] + s["n"] - 1)))
        )
    )
    spots = spots.select("key", covered.alias("hit_words"), "items")
    rows = docs.select(
        "doc_id",
        row_key(F.col("doc_id"), F.col("text")).alias("key"),
        F.size(item_words(F.col("text"))).cast("bigint").alias("n_words"),
    )
    items = F.coalesce("items", F.array().cast("array<string>"))
    hit = F.coalesce("hit_words", F.array().cast("array<int>"))
    return rows.join(spots, "key", "left").select(
        "doc_id",
        *["key"] * keep_key,
        "n_words",
        F.size(hit).cast("bigint").alias("n_hit"),
        F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (F.size(hit) > 0).alias("contaminated"),
        hit.alias("hit_words"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that hold no window of a benchmark item; all columns stay, whatever their names."""
    bad = find_contamination(docs, benchmark, keep_key=True).where("contaminated").select("key").distinct()
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    keyed = docs.select(row_key(F.col("doc_id"), F.col("text")).alias("key"), row.alias("row"))
    return keyed.join(bad, "key", "left_anti").select("row.*")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = (read_table(spark, sf_dir, n).select(i, "text") for n, i in (("documents", "doc_id"), ("benchmark", "item_id")))
    return find_contamination(docs, benchmark).drop("hit_words")
