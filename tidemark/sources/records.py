"""CSV records from files that are read in any number of splits.

Whether a line begins a record depends on all quotes before it. What a split does to that state is a map of two
states to two (outside or inside quotes), and such maps compose: it keeps, flips or fixes the state. One pass gives
each split's map and, for either state at its start, the records that begin in it; a prefix over a file's splits then
gives the state and the ordinal at each split's start, and a second pass reads all splits at once, each from its
known state. A record that crosses splits leaves a part in each; only such parts are shuffled, to be joined.

Quoting: a cell that begins with a quote runs to the closing one, a doubled quote is a quote, line breaks inside are
kept. Text after a closing quote and quotes in bare text count as text and are reported. A CR before a line's end
is part of it. A compressed file is one split. The driver gets one row a split, as it does to list them.

Defined results: an empty line outside quotes is a record without cells; a byte-order mark is left out; a record whose
quotes never close ends with its file; one of more than MOST bytes, or that is not UTF-8, is an error that names it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.sources.staging import staged

MOST = 64 << 20
NUL, AFTER, BARE = 1, 2, 4
QUOTE, BOM = 34, b"\xef\xbb\xbf"
PASSES = "file string, start bigint, out_inside boolean, in_inside boolean, out_records bigint, in_records bigint"
RECORDS = "file string, record bigint, start bigint, cells array<string>, found int, lines int, open boolean"


def scan(line: bytes, inside: bool) -> tuple[list[bytes], bool, int]:
    """(pieces of cells, whether the line ends inside quotes, what it breaks). Inside, the first piece goes on with an open cell."""
    cr = line.endswith(b"\r")
    body = line[:-1] if cr else line
    cells, found, i, n = [], NUL if b"\0" in line else 0, 0, len(body)
    if not n and not inside:
        return [], False, found
    while True:
        if inside or (i < n and body[i] == QUOTE):
            i, text, inside = i if inside else i + 1, [], False
            while True:
                j = body.find(b'"', i)
                if j < 0:
                    cells.append(b"".join([*text, body[i:], b"\r" if cr else b""]))
                    return cells, True, found
                if body[j + 1 : j + 2] != b'"':
                    break
                text.append(body[i : j + 1])
                i = j + 2
            end = body.find(b",", j + 1)
            rest = body[j + 1 : end if end >= 0 else n]
            if rest:
                found |= AFTER
            cells.append(b"".join([*text, body[i:j], rest]))
        else:
            end = body.find(b",", i)
            piece = body[i : end if end >= 0 else n]
            if b'"' in piece:
                found |= BARE
            cells.append(piece)
        if end < 0:
            return cells, False, found
        i = end + 1


def _lines(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary").alias("value"))


def _rows(batch: pa.RecordBatch):
    return zip(batch.column("file").to_pylist(), batch.column("start").to_pylist(), batch.column("value").to_pylist(), strict=True)


def passes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each split does to either state, and the records that begin in it."""
    at, done = None, []
    for batch in batches:
        for file, start, line in _rows(batch):
            if (file, start) != at:
                at = (file, start)
                done.append([file, start, False, True, 0, 0])
            own = done[-1]
            out, inn = own[2], own[3]
            own[4] += not out
            own[5] += not inn
            if b'"' in line:
                body = line.removeprefix(BOM) if start == 0 else line
                ends = scan(body, out)[1]
                own[2], own[3] = ends, ends if inn == out else scan(body, inn)[1]
    kinds = (pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64())
    names = ["file", "start", "out_inside", "in_inside", "out_records", "in_records"]
    yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], k) for i, k in enumerate(kinds)], names)


def entries(splits: DataFrame) -> DataFrame:
    """file, start, inside, before: the state at each split's start and the records begun before it."""
    order = W.partitionBy("file").orderBy("start")
    past, so_far = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(W.unboundedPreceding, W.currentRow)
    flips = F.when(F.col("out_inside") & ~F.col("in_inside"), 1).otherwise(0)
    df = splits.withColumn("flips", F.sum(flips).over(so_far)).withColumn("flipped", F.coalesce(F.sum(flips).over(past), F.lit(0)))
    fixed = F.last(F.when(F.col("out_inside") == F.col("in_inside"), F.struct(F.col("out_inside").alias("state"), "flips")), True).over(past)
    df = df.withColumn("fixed", fixed)
    odd = (F.col("flipped") - F.coalesce(F.col("fixed.flips"), F.lit(0))) % 2 == 1
    df = df.withColumn("inside", F.coalesce(F.col("fixed.state"), F.lit(False)) != odd)
    begun = F.when(F.col("inside"), F.col("in_records")).otherwise(F.col("out_records"))
    return df.withColumn("before", F.coalesce(F.sum(begun).over(past), F.lit(0))).select("file", "start", "inside", "before")


def _assemble(known: dict[tuple[str, int], tuple[bool, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        at, inside, record, cells, found, lines, size, part = None, False, 0, [], 0, 0, 0, False

        def close() -> None:
            nonlocal cells, found, lines, size, part
            if lines:
                try:
                    texts = [b"".join(c).decode() for c in cells]
                except UnicodeDecodeError as e:
                    raise ValueError(f"{at[0]}: record {record} is not UTF-8") from e
                # whole records carry no start
                done.append((at[0], record, at[1] if part or inside else None, texts, found, lines, inside))
            cells, found, lines, size, part = [], 0, 0, 0, False

        def out() -> pa.RecordBatch:
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.int32(), pa.int32(), pa.bool_())
            batch = pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], k) for i, k in enumerate(kinds)], ["file", "record", "start", "cells", "found", "lines", "open"])
            done.clear()
            return batch

        for batch in batches:
            for file, start, line in _rows(batch):
                if (file, start) != at:
                    close()
                    at = (file, start)
                    inside, record = known[at]
                    part = inside
                    line = line.removeprefix(BOM) if start == 0 else line
                pieces, ends, broken = scan(line, inside)
                if inside and cells:
                    cells[-1] += [b"\n", pieces[0]]
                    cells += [[p] for p in pieces[1:]]
                else:
                    if not inside:
                        record += 1
                    cells = [[p] for p in pieces]
                found, lines, size, inside = found | broken, lines + 1, size + len(line), ends
                if size > MOST:
                    raise ValueError(f"{file}: record {record} has more than {MOST} bytes")
                if not inside:
                    close()
            yield out()
        close()
        yield out()

    return run


def _joined(parts: Column) -> Column:
    """The cells of a record's parts: each part's first piece goes on with the last cell before it, behind the line break."""

    def add(a: Column, b: Column) -> Column:
        last, head = F.element_at(a, -1), F.slice(a, 1, F.size(a) - 1)
        return F.concat(head, F.array(F.concat(last, F.lit("\n"), F.element_at(b, 1))), F.slice(b, 2, F.greatest(F.size(b) - 1, F.lit(0))))

    return F.aggregate(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), F.get(parts, F.lit(0))["cells"], lambda a, p: add(a, p["cells"]))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """file, record (from 1 in each file), cells, found (NUL, AFTER, BARE), lines, open (quotes that never close)."""
    lines = _lines(spark, path)
    # one row a split
    known = {(r["file"], r["start"]): (r["inside"], r["before"]) for r in entries(lines.mapInArrow(passes, PASSES)).collect()}
    read = staged(lines.mapInArrow(_assemble(known), RECORDS))
    parts = read.where("start is not null").groupBy("file", "record").agg(F.array_sort(F.collect_list(F.struct("start", "cells", "found", "lines", "open"))).alias("parts"))
    joined = parts.select(
        "file", "record", _joined(F.col("parts")).alias("cells"), F.aggregate("parts", F.lit(0), lambda a, p: a.bitwiseOR(p["found"])).alias("found"),
        F.aggregate("parts", F.lit(0), lambda a, p: a + p["lines"]).alias("lines"), F.element_at("parts", -1)["open"].alias("open"),
    )
    return read.where("start is null").drop("start").unionByName(joined)


def audit(records: DataFrame, columns: int) -> DataFrame:
    """(violation, n): records with a NUL, text after a closing quote, a quote in bare text, a line break, an open quote, another width."""
    bit = lambda b: F.col("found").bitwiseAND(b) != 0
    kinds = {
        "nul": bit(NUL), "text_after_quote": bit(AFTER), "quote_in_bare_text": bit(BARE), "embedded_newline": F.col("lines") > 1,
        "open_quote": F.col("open"), "wrong_width": F.size("cells") != columns,
    }
    sums = records.agg(*[F.count_if(c).alias(n) for n, c in kinds.items()])
    return sums.select(F.explode(F.array(*[F.struct(F.lit(n).alias("violation"), F.col(n).alias("n")) for n in kinds])).alias("x")).select("x.*")
