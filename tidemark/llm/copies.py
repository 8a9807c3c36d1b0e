"""Exact copies by a content sort, in DataFrame functions only.

Normalised texts are range partitioned by splitters from a sample, sorted within their partition, and neighbours
are compared in full: a run of equal texts is a group of copies, of which one row stays. Splitters are short
(the first characters of a text and its digest), so what the driver gets for them is bounded; the sort
below them compares whole texts, and equal texts have equal splitters, so they always lie together.

A text that the sample shows to fill more than a quarter of a mean partition, by rows or by bytes, is cut into
pieces by a hash of its rows, which the splitters spread. Each piece is sorted and compared like any other run;
the pieces' best rows and sizes are then added up by digest. There are at most eight such texts a partition, which
bounds what is broadcast. The sample decides only how groups are cut: any cut gives the same result.

Scale: texts are shuffled once, whole; all that follows has a few numbers and the digest a row.

Defined results: null texts count as empty and are copies of each other; null doc_ids stay only if no copy has
another id; of rows with one id and equal texts one stays, the same at each run unless they are equal in all
columns; other columns may have any names; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.text import lower_ascii, read_table, text_of
from tidemark.sources.staging import staged

#: Sampled rows a partition, and the share of a mean partition above which a text is cut into pieces.
SAMPLED, SHARE = 200, 0.25
PREFIX = 32


def _keys(docs: DataFrame) -> DataFrame:
    normal = lower_ascii(text_of(F.col("text")))
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("id"), text_of(F.col("text")).alias("said"),
        F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("mark"), F.unhex(F.sha2(normal, 256)).alias("digest"), F.substring(normal, 1, PREFIX).alias("start"),
    )


def crowded(docs: DataFrame, partitions: int) -> DataFrame:
    """digest, pieces: texts of which a sample holds so many rows or bytes that they are to be cut."""
    total = docs.count()
    share = min(1.0, SAMPLED * partitions / max(total, 1))
    some = docs if share == 1.0 else docs.sample(share, 7)
    normal = lower_ascii(text_of(F.col("text")))
    some = staged(some.select(F.unhex(F.sha2(normal, 256)).alias("digest"), F.octet_length(normal).cast("bigint").alias("size")))
    whole = some.agg(F.count("*").alias("n"), F.sum("size").alias("size")).first()
    a_row, a_byte = (partitions / (SHARE * max(whole[x] or 1, 1)) for x in ("n", "size"))
    groups = some.groupBy("digest").agg(F.count("*").alias("n"), F.sum("size").alias("size")).where("n > 1")
    return groups.select("digest", F.ceil(F.greatest(F.col("n") * F.lit(a_row), F.col("size") * F.lit(a_byte))).cast("int").alias("pieces")).where("pieces > 1")


def mark_copies(docs: DataFrame, keep: str = "smallest", carry: list[str] | None = None) -> DataFrame:
    """carry's columns of each row (all by default) in `row`, and keep_id, group_size, kept, text_sha256.

    keep: whether of equal texts the row with the smallest or the largest doc_id stays.
    """
    largest = {"smallest": False, "largest": True}[keep]
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = _keys(docs).join(F.broadcast(crowded(docs, partitions)), "digest", "left")
    if carry is not None:
        rows = rows.withColumn("row", F.struct(*[F.col("row")[c].alias(c) for c in carry]))
    rows = rows.withColumn("piece", F.coalesce(F.pmod(F.col("mark"), F.col("pieces")), F.lit(0)))
    # better rows come first; nulls are below all ids in a struct's order
    place = F.struct("id", F.bitwise_not("mark").alias("mark")) if largest else F.struct(F.col("id").isNull().alias("none"), "id", "mark")
    rows = rows.repartitionByRange("start", "digest", "piece")
    rows = rows.withColumn("normal", lower_ascii(F.col("said"))).withColumn("place", place)
    run = W.partitionBy("start", "digest", "piece", "normal")
    best = F.max if largest else F.min
    ranked = run.orderBy(F.col("place").desc() if largest else F.col("place").asc())
    found = staged(
        rows.select(
            "row", "digest", F.col("pieces").isNotNull().alias("cut"), F.row_number().over(ranked).alias("rank"), F.count("*").over(run).alias("size"), best("place").over(run).alias("top")
        )
    )
    joined = found.where("cut and rank = 1").groupBy("digest").agg(F.sum("size").alias("whole"), best("top").alias("best"))
    found = found.join(F.broadcast(joined), "digest", "left")
    top = F.coalesce("best", "top")
    return found.select(
        "row", top["id"].alias("keep_id"), F.coalesce("whole", "size").alias("group_size"),
        ((F.col("rank") == 1) & top.eqNullSafe(F.col("top"))).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, keep: str = "smallest") -> DataFrame:
    """docs with one row of each group of equal texts."""
    return mark_copies(docs, keep).where("kept").select("row.*")


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mark_copies(read_table(spark, sf_dir, "documents"), "largest", ["doc_id"])
    return found.select("row.doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP13_SQL = """
WITH docs AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
ranked AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) AS k FROM docs)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size, k = 1 AS kept, sha256(t) AS text_sha256
FROM ranked
"""
