"""Line dedup by site-relative frequency, in SQL functions.

A line's ratio is the number of its host's pages that hold it, divided by the host's pages;
lines beyond a ratio are boilerplate of that host and are dropped from its pages. Pages are
counted by content: copies of a page are one page, or else a page that is often copied would
be its own boilerplate.

Only hashes of lines are shuffled (96 bits each), combined before they are sent, so neither a
host nor a line with a third of all rows is gathered. A host's boilerplate has at most
(lines a page) / ratio entries. Where all lists are small enough (counted) they go to the pages by a
broadcast. Beyond that the hashes of each page's lines look for their entry by a salted join, so that
a line of a third of all pages is dealt to many tasks, and the page gets back those of its own.

Defined results: null texts stay null; blank lines are no lines and always stay; lines are
compared without the spaces, tabs and returns around them; a null host is a host of its own;
repeated rows are copies; an empty table gives an empty result; other columns pass through, whatever
their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.text import let, read_table, text_of
from tidemark.sources.staging import staged

MAX_RATIO, MIN_PAGES = 0.05, 3


def line_of(x: Column) -> Column:
    return F.btrim(x, F.lit(" \t\r"))


def digest(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("h"), F.hash(line).alias("g"))


def digests(text: Column) -> Column:
    """The distinct digests of a text's lines that are not blank."""
    lines = F.filter(F.transform(F.split(text_of(text), "\n", -1), line_of), lambda x: x != "")
    return F.array_distinct(F.transform(lines, digest))


def boilerplate(docs: DataFrame, host: str, max_ratio: float, min_pages: int) -> DataFrame:
    """site, h, g: the digests of each host's boilerplate lines."""
    t = text_of(F.col("text"))
    pages = (
        docs.select(F.col(host).cast("string").alias("site"), F.xxhash64(t).alias("t1"), F.hash(t).alias("t2"), digests(F.col("text")).alias("held"))
        .groupBy("site", "t1", "t2")
        .agg(F.any_value("held").alias("held"))
    )
    pages = staged(pages.select("site", "held"))
    totals = pages.groupBy(F.col("site").alias("of")).agg(F.count("*").alias("pages"))
    counts = (
        pages.select("site", F.inline("held"))
        .groupBy("site", "h", "g")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= min_pages)
    )
    often = counts.join(totals, F.col("site").eqNullSafe(F.col("of"))).where(F.col("n") > max_ratio * F.col("pages"))
    return often.select("site", "h", "g")


def with_lines(rows: DataFrame, found: DataFrame, few: bool, salts: int = 32) -> DataFrame:
    """rows (site, row) with gone: digests of boilerplate lines, of the host or of those in the text."""
    named = found.withColumnRenamed("site", "of")
    if few:
        lists = named.groupBy("of").agg(F.collect_set(F.struct("h", "g")).alias("gone"))
        return rows.join(F.broadcast(lists), F.col("site").eqNullSafe(F.col("of")), "left").drop("of")
    text = F.col("row.text")
    keyed = rows.withColumn("key", F.xxhash64("site", F.lit("\n"), text)).withColumn("key2", F.hash(text))
    asked = keyed.select("key", "key2", "site", F.pmod(F.col("key"), F.lit(salts)).cast("int").alias("salt"), F.inline(digests(text))).distinct()
    dealt = named.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    hits = asked.join(dealt, ["h", "g", "salt"]).where(F.col("site").eqNullSafe(F.col("of")))
    lists = hits.groupBy("key", "key2").agg(F.collect_set(F.struct("h", "g")).alias("gone"))
    return keyed.join(lists, ["key", "key2"], "left").drop("key", "key2")


def cut_boilerplate(
    docs: DataFrame, host: str = "source", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES, broadcast_lines: int = 500_000
) -> DataFrame:
    """row (a struct of the columns of docs), text, n_lines, n_dropped of every row of docs."""
    found = staged(boilerplate(docs, host, max_ratio, min_pages))
    rows = docs.select(F.col(host).cast("string").alias("site"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = with_lines(rows, found, found.count() <= broadcast_lines)
    none = F.array().cast("array<struct<h:bigint,g:int>>")

    def cut(lines: Column) -> Column:
        kept = F.filter(
            lines,
            lambda x: let(line_of(x), lambda y: (y == "") | ~F.array_contains(F.coalesce(F.col("gone"), none), digest(y))),
        )
        return let(
            kept,
            lambda k: F.struct(
                F.array_join(k, "\n").alias("text"),
                F.size(lines).cast("bigint").alias("n_lines"),
                (F.size(lines) - F.size(k)).cast("bigint").alias("n_dropped"),
            ),
        )

    cuts = let(F.split(text_of(F.col("row.text")), "\n", -1), cut)
    return rows.select("row", F.col("row.text").isNull().alias("none"), cuts.alias("cut")).select(
        "row", F.when(~F.col("none"), F.col("cut.text")).alias("text"), "cut.n_lines", "cut.n_dropped"
    )


def drop_boilerplate(docs: DataFrame, length: str | None = None, **how) -> DataFrame:
    """docs with boilerplate lines cut from text; a column of lengths, if named, follows the texts that were cut."""
    cut = cut_boilerplate(docs, **how)
    kinds = dict(docs.dtypes)

    def column(c: str) -> Column:
        if c == "text":
            return F.col("text").cast(kinds[c])
        kept = F.col("row").getField(c)
        return F.when(F.col("n_dropped") > 0, F.length("text").cast(kinds[c])).otherwise(kept) if c == length else kept

    return cut.select(*[column(c).alias(c) for c in docs.columns])


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = cut_boilerplate(read_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return cut.select("row.doc_id", "n_lines", "n_dropped", F.sha2(text_of(F.col("text")), 256).alias("kept_sha256"))


OP4_SQL = f"""
WITH pages AS (SELECT DISTINCT source, coalesce(text, '') AS t FROM documents),
held AS (
  SELECT source, t, trim(unnest(string_split(t, chr(10))), ' ' || chr(9) || chr(13)) AS line FROM pages
),
counts AS (SELECT source, line, count(DISTINCT t) AS n FROM held WHERE line <> '' GROUP BY ALL),
totals AS (SELECT source, count(*) AS pages FROM pages GROUP BY ALL),
often AS (
  SELECT c.source, c.line FROM counts c JOIN totals p ON c.source IS NOT DISTINCT FROM p.source
  WHERE n >= {MIN_PAGES} AND n > {MAX_RATIO}::DOUBLE * pages
),
split AS (
  SELECT row_number() OVER () AS r, doc_id, source, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
),
each AS (
  SELECT r, doc_id, source, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM split
),
judged AS (
  SELECT e.*, o.line IS NOT NULL AS gone FROM each e
  LEFT JOIN often o ON e.source IS NOT DISTINCT FROM o.source AND trim(e.line, ' ' || chr(9) || chr(13)) = o.line
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY r, doc_id
"""
