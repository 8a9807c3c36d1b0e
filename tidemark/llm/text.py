"""Column helpers shared by the text operators: words, spans with offsets, row keys.

Everything here is built from SQL functions, so it stays in the JVM.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once per row and hand it to `body`.

    A lambda that mentions an outer expression evaluates it again for every
    element; binding it as the variable of a one-element transform does not.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_of(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def split_words(text: Column, separator: str = SPACE) -> Column:
    """The maximal runs of characters outside `separator`; null has none."""
    return F.array_remove(F.split(text_of(text), f"{separator}+"), "")


def row_key(doc_id: Column, text: Column) -> Column:
    """Identity of a row by content: equal rows share it and so get equal results.

    Unlike a generated row number it is the same when a lost task is run again.
    """
    return F.md5(F.concat_ws("\x01", F.coalesce(doc_id.cast("string"), F.lit("null")), text_of(text)))


def one_of_each(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Of the rows of docs (doc_id, text, ...) whose row key is in keys (key): one of each key, with the columns of docs.

    Of rows equal in doc_id and text the least by their other columns as JSON stays. All columns travel in one
    struct, so no name can clash.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    keyed = docs.select(row_key(F.col("doc_id"), F.col("text")).alias("key"), row.alias("row"))
    best = F.min_by("row", F.to_json("row")).alias("row")
    return keyed.join(keys, "key", "left_semi").groupBy("key").agg(best).select("row.*")


def _starts(pieces: Column, block: int = 256) -> Column:
    """Running starts of array<struct<gap,len>>: gap_0, gap_0+len_0+gap_1, ...

    Summed in blocks, because appending to one long array copies it each time.
    """
    empty = F.array().cast("array<bigint>")

    def step(acc: Column, x: Column) -> Column:
        at = acc["pos"] + x["gap"]
        return F.struct((at + x["len"]).alias("pos"), F.concat(acc["out"], F.array(at)).alias("out"))

    def whole(p: Column) -> Column:
        blocks = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(p) - 1) / block).cast("int")),
            lambda b: F.slice(p, b * block + 1, F.lit(block)),
        )
        total = F.aggregate(
            blocks,
            F.struct(F.lit(0).cast("bigint").alias("pos"), F.array().cast("array<array<bigint>>").alias("out")),
            lambda acc, blk: let(
                F.aggregate(blk, F.struct(acc["pos"].alias("pos"), empty.alias("out")), step),
                lambda inner: F.struct(
                    inner["pos"].alias("pos"), F.concat(acc["out"], F.array(inner["out"])).alias("out")
                ),
            ),
        )
        return F.flatten(total["out"])

    return let(pieces, lambda p: F.when(F.size(p) > 0, whole(p)).otherwise(empty))


SPAN = "array<struct<start:bigint,end:bigint,value:string,part:string>>"


def find_spans(text: Column, pattern: str, group: int = 0) -> Column:
    """Leftmost non-overlapping matches with code-point offsets (end exclusive).

    What stands between the matches (split) and the matches themselves alternate,
    so the offsets are running sums of their lengths. `part` is capture `group`.
    """

    def spans(t: Column) -> Column:
        found = F.regexp_extract_all(t, F.lit(pattern), F.lit(0))
        parts = F.regexp_extract_all(t, F.lit(pattern), F.lit(group)) if group else found
        zipped = F.arrays_zip(
            found.alias("value"),
            parts.alias("part"),
            F.slice(F.split(t, pattern, -1), F.lit(1), F.size(found)).alias("before"),
        )
        return let(
            zipped,
            lambda z: let(
                _starts(F.transform(z, lambda x: F.struct(F.length(x["before"]).cast("bigint").alias("gap"), F.length(x["value"]).cast("bigint").alias("len")))),
                lambda s: F.transform(
                    z,
                    lambda x, i: F.struct(
                        F.get(s, i).alias("start"),
                        (F.get(s, i) + F.length(x["value"])).alias("end"),
                        x["value"].alias("value"),
                        x["part"].alias("part"),
                    ),
                ),
            ),
        )

    none = F.array().cast(SPAN)
    return F.when(text.rlike(pattern), spans(text).cast(SPAN)).otherwise(none)


def tagged(spans: Column, kind: str, order: int) -> Column:
    """Spans as sortable array<struct<start,rank,end,kind>>."""
    return F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"), F.lit(order).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind")
        ),
    )


TAGGED = "array<struct<start:bigint,rank:int,end:bigint,kind:string>>"


def joined_spans(spans: Column) -> Column:
    """kind:start:end, comma-joined in the order given."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def read_table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
