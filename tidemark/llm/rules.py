"""Document and host quality rules, in SQL functions only.

Documents are measured in place (no shuffle of texts). Rule failures are summed by
host, a beta prior is fitted to the hosts' failure rates by the method of moments,
each host's rate is shrunk towards it, and the verdict on the host is joined back.
Host sums are one row a host and pre-aggregated, so a host with a third of all rows
is one row a task in the shuffle.

Defined results: a null or empty text has no words and fails; a null host counts as
a host of its own; repeated rows count each time; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.text import SPACE, let, read_table, split_words, text_of
from tidemark.sources.staging import staged

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_window_words(words: Column, size: int = 8) -> Column:
    """Words inside windows of `size` words that occur twice or more in the same array."""

    def covered(h: Column) -> Column:
        # equal hashes become neighbours; starts of windows that have an equal neighbour
        ordered = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        starts = let(
            ordered,
            lambda s: F.array_sort(
                F.transform(
                    F.filter(
                        s,
                        lambda x, j: F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False))
                        | F.coalesce((j > 0) & (F.get(s, F.greatest(j - 1, F.lit(0)))["h"] == x["h"]), F.lit(False)),
                    ),
                    lambda x: x["i"],
                )
            ),
        )
        # each start adds what the start before it has not covered yet
        return let(
            starts,
            lambda s: F.aggregate(
                F.transform(
                    s,
                    lambda x, j: F.when(j == 0, F.lit(size)).otherwise(
                        F.least(F.lit(size), x - F.get(s, F.greatest(j - 1, F.lit(0))))
                    ),
                ),
                F.lit(0),
                lambda a, x: a + x,
            ),
        )

    def of(w: Column) -> Column:
        hashes = F.transform(
            F.sequence(F.lit(1), F.size(w) - (size - 1)), lambda i: F.xxhash64(F.slice(w, i, F.lit(size)))
        )
        return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(F.lit(0)))

    return let(words, lambda w: F.when(F.size(w) > size, of(w)).otherwise(F.lit(0))).cast("bigint")


def measure(text: Column) -> Column:
    """Struct of MEASURES of a text; null has no words."""
    t = text_of(text)
    # a line has a word if it has a character that is not white space
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(f"[^{SPACE[1:]}"))
    return let(
        split_words(t),
        lambda w: F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
            F.length(F.regexp_replace(t, "[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
            repeated_window_words(w).alias("n_repeat_words"),
        ),
    )


def host_verdicts(rows: DataFrame, max_rate: float = 0.5) -> DataFrame:
    """host, pages, failures, rate, bad: failure rates shrunk with an empirical beta prior.

    rows: host, base_failed. The prior's mean is the failure share of all pages; its
    weight (in pages) comes from the spread of the hosts' rates, kept within 1 and 1000.
    """
    hosts = rows.groupBy("host").agg(
        F.count("*").alias("pages"), F.sum(F.col("base_failed").cast("bigint")).alias("failures")
    )
    rate = F.col("failures") / F.col("pages")
    prior = hosts.agg(
        (F.sum("failures") / F.sum("pages")).alias("mean"), F.coalesce(F.var_pop(rate), F.lit(0.0)).alias("spread")
    ).first()  # two numbers
    mean, spread = (prior["mean"] or 0.0), (prior["spread"] or 0.0)
    weight = min(1000.0, max(1.0, mean * (1 - mean) / spread - 1)) if spread > 0 else 1000.0
    shrunk = (F.col("failures") + mean * weight) / (F.col("pages") + weight)
    return hosts.select("host", "pages", "failures", shrunk.alias("rate"), (shrunk > max_rate).alias("bad"))


def apply_rules(
    docs: DataFrame, host: str = "source", min_words: int = 20, max_repeat_percent: int = 30, max_rate: float = 0.5
) -> DataFrame:
    """doc_id, MEASURES, base_failed, kept, host_rate of every row of docs (doc_id, text, host)."""
    rows = docs.select("doc_id", F.col(host).cast("string").alias("host"), measure(F.col("text")).alias("m")).select(
        "doc_id", "host", "m.*"
    )
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    # a narrow table without texts: measured once, read for the sums and for the result
    rows = staged(rows.withColumn("base_failed", failed))
    verdicts = host_verdicts(rows.select("host", "base_failed"), max_rate).select(F.col("host").alias("of"), "rate", "bad")
    joined = rows.join(verdicts, F.col("host").eqNullSafe(F.col("of")), "left")
    return joined.select(
        "doc_id",
        *MEASURES,
        "base_failed",
        (~F.col("base_failed") & ~F.coalesce(F.col("bad"), F.lit(False))).alias("kept"),
        F.col("rate").alias("host_rate"),
    )


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(read_table(spark, sf_dir, "documents")).drop("host_rate")
