"""Identities, payload hashes, exact ratios and order-free fingerprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNIT = "\x1f"


def incident_key(usdot: Column, state: Column, number: Column, day: Column, time: Column) -> Column:
    """Identity of an incident; the vehicle's place in it is no part."""
    return F.md5(F.concat_ws(UNIT, usdot, state, number, day.cast("date").cast("string"), time.cast("string")))


def json_text(value: Column) -> Column:
    """A string as JSON text with its quotes, null as null. Most strings need no escapes and skip the JSON writer."""
    one = F.to_json(F.array(value))
    plain = F.concat(F.lit('"'), value, F.lit('"'))
    escaped = F.substring(one, F.lit(2), F.length(one) - 2)
    return F.when(value.isNull(), "null").when(value.rlike(r'["\\\x00-\x1F]'), escaped).otherwise(plain)


def quoted(value: Column) -> Column:
    """A string without anything to escape as JSON text; null stays null."""
    return F.concat(F.lit('"'), value, F.lit('"'))


def json_array(*pieces: Column) -> Column:
    """JSON array text of pieces that are JSON already; null pieces are explicit."""
    listed = [x for p in pieces for x in (F.lit(", "), F.coalesce(p, F.lit("null")))]
    return F.concat(F.lit("["), *listed[1:], F.lit("]"))


def fallback_key(state: Column, number: Column, day: Column, time: Column, sequence: Column) -> Column:
    """Key of a row without an id of its own: the hex of its five parts as a JSON array."""
    parts = json_array(
        json_text(state), json_text(number), quoted(day.cast("date").cast("string")), time.cast("string"), sequence.cast("string")
    )
    return F.concat(F.lit("fallback:"), F.lower(F.hex(F.encode(parts, "UTF-8"))))


def payload_hash(*values: tuple[Column, str]) -> Column:
    """md5 of the ordered values as a JSON array. kinds: text, plain (a text without anything to escape), number, boolean, date, timestamp, texts."""

    def piece(value: Column, kind: str) -> Column:
        if kind == "text":
            return F.when(value.isNotNull(), json_text(value))
        if kind == "plain":
            return quoted(value)
        if kind == "date":
            return quoted(value.cast("date").cast("string"))
        if kind == "timestamp":
            return quoted(F.replace(value.cast("timestamp_ntz").cast("string"), F.lit(" "), F.lit("T")))
        if kind == "texts":
            return F.when(F.size(value) == 0, "[]").otherwise(F.concat(F.lit("["), F.array_join(F.transform(value, json_text), ", "), F.lit("]")))
        return value.cast("string")

    return F.md5(json_array(*[piece(v, k) for v, k in values]))


def ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator in whole millionths, half up, as decimal(38,6); null for a null or zero divisor."""
    scaled = numerator.cast("decimal(20,0)") * F.lit(1000000).cast("decimal(7,0)")
    divisor = F.nullif(denominator, F.lit(0).cast("bigint")).cast("decimal(20,0)")
    rest = scaled % divisor
    whole = ((scaled - rest) / divisor).cast("decimal(26,0)")
    up = F.when(2 * rest >= divisor, 1).otherwise(0).cast("decimal(1,0)")
    return F.when(divisor.isNotNull() & numerator.isNotNull(), ((whole + up) * F.lit("0.000001").cast("decimal(7,6)")).cast("decimal(38,6)"))


def length_prefixed_id(*values: Column) -> Column:
    """sha256 over the values, each behind its length in bytes, so that no two lists of values collide."""
    parts = [F.concat(F.octet_length(v).cast("string"), F.lit(":"), v) for v in values]
    return F.sha2(F.concat(*parts), 256)


def row_digest(df: DataFrame) -> Column:
    """sha256 of a row: every value as text behind its length, nulls told apart."""
    parts = [
        F.coalesce(F.concat(F.octet_length(F.col(f"`{c}`").cast("string")).cast("string"), F.lit(":"), F.col(f"`{c}`").cast("string")), F.lit("-"))
        for c in df.columns
    ]
    return F.sha2(F.concat(*parts), 256)


def fingerprint(df: DataFrame) -> DataFrame:
    """One row: n_rows and a digest of the multiset of rows, whatever their order and partitions.

    Four 60-bit slices of each row's sha256 are summed exactly, so equal multisets agree and a changed,
    lost or doubled row shows.
    """
    return fingerprint_by(df, [])


def fingerprint_by(df: DataFrame, by: list[str]) -> DataFrame:
    """The fingerprint of each group's rows: by, n_rows, fingerprint."""
    slices = [F.conv(F.substring("d", 1 + 15 * i, 15), 16, 10).cast("bigint").alias(f"v{i}") for i in range(4)]
    d = df.select(*by, row_digest(df).alias("d")).select(*by, *slices)
    # sums of 20 bits are whole numbers that hold for trillions of rows; decimals are objects and take several times as long
    sums = [F.sum(F.shiftright(f"v{i}", 20 * j).bitwiseAND(F.lit((1 << 20) - 1))).alias(f"v{i}_{j}") for i in range(4) for j in range(3)]
    folded = d.groupBy(*by).agg(F.count("*").alias("n_rows"), *sums)
    whole = [F.expr(" + ".join(f"cast(v{i}_{j} as decimal(20,0)) * {1 << 20 * j}BD" for j in range(3))) for i in range(4)]
    return folded.select(*by, "n_rows", F.sha2(F.concat_ws(",", "n_rows", *[F.coalesce(w.cast("decimal(38,0)"), F.lit(0)) for w in whole]), 256).alias("fingerprint"))
