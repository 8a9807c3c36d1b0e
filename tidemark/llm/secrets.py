"""Secret scan by multipart credential linking, in SQL functions only.

Strong patterns (assignments, access ids, long hex) are reported on their own. Weak parts - short
access ids, login names, dense tokens - are reported only where a complementary part stands within
`scope` code points (of the gap between the two) in the same document: an id needs a secret, a secret
needs an id or an endpoint. Partners never overlap. A weak part that touches a base span is reported
already and is no part; a token that touches an id is that id's value and no secret; a token within an
endpoint is a part of its address, so it needs an id.

The link is an interval join. Each part is a point where it starts, for partners before it, and a point
where it ends, for partners behind it; points are binned by offset and each bin keeps its least and
greatest point of each class. Of the bin that a part's edge lies in and the bin beyond, the extremes
decide exactly whether a point is in scope. A bin gives one row however many parts it holds, so no
pairs are enumerated; which parts touch is found in passes over the sorted parts of a text (`spans.py`).

Defined results: null or empty text finds nothing; a null doc_id is kept as null; repeated rows each
get their result; an empty table gives an empty result; extra columns of the input are ignored,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.spans import touching
from tidemark.llm.text import TAGGED, find_spans, joined_spans, read_table, row_key, tagged, text_of

KINDS = ("assign", "access", "hex")
KEYWORDS = "(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
ASSIGN = KEYWORDS + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
_TOKEN = "A-Za-z0-9+/_-"
WEAK_ID = r"AKIA[A-Z0-9]{8,15}(?![A-Z0-9])|(?:user|username|login|account|client_id)\x20?[:=]\x20?[A-Za-z0-9_.@-]{3,}+"
#: A run of 20 or more with a digit and letters of both cases; runs are entered at their start only.
WEAK_SECRET = rf"(?<![{_TOKEN}])(?=[A-Za-z+/_-]*+[0-9])(?=[a-z0-9+/_-]*+[A-Z])(?=[A-Z0-9+/_-]*+[a-z])[{_TOKEN}]{{20,}}+"
ENDPOINT = r"(?:https?|jdbc:[a-z]{2,12}|mongodb|postgres|redis|amqp|s3)://[^\x00-\x20\"'<>]{3,}+"


def base_spans(text: Column) -> dict[str, Column]:
    """The base spans of each kind of a non-null text."""
    return {
        "assign": F.filter(find_spans(text, ASSIGN, 1), lambda s: F.length(s["part"]) >= 6),
        "access": find_spans(text, ACCESS),
        "hex": find_spans(text, HEX),
    }


def _parts(docs: DataFrame) -> DataFrame:
    """One row per part of docs (key, t): key, kind (id, secret, endpoint), weak, inside (an endpoint), rank, start, end."""
    t = F.col("t")
    # only texts with a weak part that could be reported need linking
    rows = docs.where(t.rlike(WEAK_ID) | t.rlike(WEAK_SECRET))
    base = base_spans(t)
    every = F.concat(
        tagged(base["access"], "id", 1).cast(TAGGED),
        tagged(F.concat(base["assign"], base["hex"]), "secret", 0).cast(TAGGED),
        tagged(find_spans(t, WEAK_ID), "id", 3).cast(TAGGED),
        tagged(find_spans(t, WEAK_SECRET), "secret", 4).cast(TAGGED),
        tagged(find_spans(t, ENDPOINT), "endpoint", 5).cast(TAGGED),
    )
    parts = rows.select("key", F.inline(every)).distinct()
    rank = F.col("rank")
    # weak ids beside the base spans; then tokens beside both; then tokens within endpoints
    parts = parts.withColumn("met", touching(rank < 3)).where((rank != 3) | ~F.col("met"))
    parts = parts.withColumn("met", touching(rank < 4)).where((rank != 4) | ~F.col("met"))
    parts = parts.withColumn("inside", (rank == 4) & touching(rank == 5))
    return parts.select("key", "kind", rank.isin(3, 4).alias("weak"), "inside", "rank", "start", "end")


def linked_parts(docs: DataFrame, scope: int) -> DataFrame:
    """Weak parts with a complementary part in scope: key, linked (array of tagged spans). docs: key, t."""
    parts = _parts(docs)
    edges = F.explode(F.array(*[F.struct(F.lit(side).alias("side"), F.col(at).alias("pos")) for side, at in (("behind", "start"), ("before", "end"))]))
    points = parts.select("key", F.col("kind").alias("partner"), edges.alias("e")).select("key", "partner", "e.side", "e.pos")
    bins = points.groupBy("key", "side", "partner", F.floor(F.col("pos") / scope).alias("bin")).agg(
        F.min("pos").alias("least"), F.max("pos").alias("greatest")
    )
    look = [
        F.struct(
            F.lit(side).alias("side"), (F.floor(edge / scope) + step).alias("bin"),
            (edge - (scope if side == "before" else 0)).alias("low"), (edge + (scope if side == "behind" else 0)).alias("high"),
        )
        for side, edge, steps in (("behind", F.col("end"), (0, 1)), ("before", F.col("start"), (0, -1)))
        for step in steps
    ]
    near = parts.where("weak").withColumn("at", F.explode(F.array(*look))).select("*", "at.*")
    complementary = ((F.col("kind") == "secret") & (F.col("partner") == "id")) | (
        (F.col("kind") == "secret") & ~F.col("inside") & (F.col("partner") == "endpoint")
    ) | ((F.col("kind") == "id") & (F.col("partner") == "secret"))
    in_scope = F.col("least").between(F.col("low"), F.col("high")) | F.col("greatest").between(F.col("low"), F.col("high"))
    hit = near.join(bins, ["key", "side", "bin"]).where(complementary & in_scope)
    span = F.struct("start", "rank", "end", F.concat(F.lit("linked_"), F.col("kind")).alias("kind"))
    return hit.groupBy("key").agg(F.collect_set(span).alias("linked"))


def scan_secrets(docs: DataFrame, scope: int = 200) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked of every row of docs (doc_id, text)."""
    rows = docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("key"), text_of(F.col("text")).alias("t"))
    base = base_spans(F.col("t"))
    counted = rows.select("doc_id", "key", *[tagged(base[k], k, i).cast(TAGGED).alias(k) for i, k in enumerate(KINDS)])
    links = linked_parts(rows.select("key", "t"), scope)
    own = F.array_sort(F.concat(*KINDS))
    extra = F.coalesce(F.col("linked"), F.array().cast(TAGGED))
    return (
        counted.join(links, "key", "left")
        .withColumn("own", own)
        .withColumn("extra", extra)
        .select(
            "doc_id",
            *[F.size(k).cast("bigint").alias(f"n_{k}") for k in KINDS],
            F.sha2(joined_spans(F.col("own")), 256).alias("base_sha256"),
            joined_spans(F.array_sort(F.concat("own", "extra"))).alias("spans"),
            F.size("extra").cast("bigint").alias("n_linked"),
        )
    )


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(read_table(spark, sf_dir, "documents"))
