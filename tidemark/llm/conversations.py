"""Repair of conversations: rows are kept, given another role, deleted or inserted at least cost, so that roles alternate.

Faults are found per row, equal rows of a turn are summed, and what is left of a conversation is a string of symbols
(`grammar`). Strings are cut into blocks, equal ones fall together, and Re-Pair rounds over all of them replace
the most frequent pairs of symbols by rules; each rule's matrix is made once and shared. The cheapest audit of
each distinct string follows from the matrices of what the rules left of it. A last pass streams texts and audits
side by side and writes the repaired rows.

Scale: texts are shuffled once, for the last pass. Blocks come from a range sort, so a conversation with a third
of all rows is cut at any row. Rules are at most ROUNDS x RULES, the driver and all tasks hold their matrices and
nothing else; what the rules leave is read symbol by symbol, with equal results. A conversation's audit and its
digest are sequential by definition (an audit is one value, SHA-256 reads one byte after the other): one task
streams over it and holds no texts.

Defined results: rows go by turn (nulls first), in a turn by role and then by the digest of role and text; nulls
show as one space, in the key of the damage, as role and as text; a null conv_id is a conversation of its own; an
empty role has no initial and can't be kept; repeated rows are duplicates after the first; other columns play no
part, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.grammar import Walk, chosen, matrices
from tidemark.llm.text import read_table
from tidemark.sources.staging import staged

#: Rows of a block; rounds of Re-Pair, and rules a round.
BLOCK, ROUNDS, RULES = 4096, 8, 48
FIRST_RULE = 0x100
WORD = r"[^\x20\x09-\x0D]"
LEGAL = ("su", "ua", "au")


def _shown(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damage(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after the damage that each row's key calls for."""
    lot = F.pmod(F.crc32(F.concat(_shown("conv_id"), F.lit(":"), _shown("turn"))), F.lit(20))
    text = _shown("text")
    text = F.when(lot == 1, F.lit("")).when(lot == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    rows = turns.where(lot != 0).select(
        "conv_id", "turn", F.when(lot == 4, F.lit("user")).otherwise(_shown("role")).alias("role"), text.alias("text"), F.when(lot == 3, 2).otherwise(1).alias("times")
    )
    return rows.select("conv_id", "turn", "role", "text", F.explode(F.array_repeat(F.lit(0), F.col("times")))).drop("col")


def _named(turns: DataFrame) -> DataFrame:
    """conv (never null), conv_id, turn, role, text, mark (digest of role and text)."""
    role, text = _shown("role"), _shown("text")
    mark = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    conv = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("-"))
    return turns.select(conv.alias("conv"), "conv_id", "turn", role.alias("role"), text.alias("text"), mark.alias("mark"))


def faults(turns: DataFrame) -> DataFrame:
    """One row for equal rows of a turn: conv, turn, role, mark, n, initial, and the first one's fault (blank, duplicate, truncated or null)."""
    rows = _named(turns)
    one = F.substring("role", 1, 1)
    runs = rows.select(
        "conv", "turn", "role", "mark", F.when(one.isin("s", "u", "a"), one).otherwise("o").alias("initial"), (~F.col("text").rlike(WORD)).alias("blank"),
        (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("cut"),
    )
    runs = staged(runs.groupBy("conv", "turn", "role", "mark").agg(F.count("*").alias("n"), *[F.first(c).alias(c) for c in ("initial", "blank", "cut")]))
    seen = runs.groupBy("conv", "mark").agg(F.min(F.struct("turn")).alias("earliest"), F.count("*").alias("turns")).where("turns > 1").drop("turns")
    again = F.coalesce(~F.col("turn").eqNullSafe(F.col("earliest")["turn"]) & F.col("earliest").isNotNull(), F.lit(False))
    fault = F.when(F.col("blank"), "blank").when(again, "duplicate").when(F.col("cut"), "truncated")
    return runs.join(seen, ["conv", "mark"], "left").select("conv", "turn", "role", "mark", "n", "initial", fault.alias("fault"))


def _symbols(initial: str, fault: str | None) -> str:
    return "x" if fault in ("blank", "duplicate") else initial.upper() if fault else initial


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted runs as blocks of a conversation: conv, no, seq, first and last initial, illegal neighbours inside."""
    base, made = TaskContext.get().partitionId() << 33, 0
    conv, seq, size, first, last, illegal, done = None, [], 0, "", "", 0, []

    def close() -> None:
        nonlocal seq, size, illegal, made
        if size:
            done.append((conv, base + made, "".join(seq), first, last, illegal))
            made += 1
        seq, size, illegal = [], 0, 0

    def out() -> pa.RecordBatch:
        table = list(zip(*done, strict=True)) if done else [[]] * 6
        kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64())
        done.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(table, kinds, strict=True)], ["conv", "no", "seq", "first", "last", "illegal"])

    for batch in batches:
        for c, n, initial, fault in zip(*[batch.column(x).to_pylist() for x in ("conv", "n", "initial", "fault")], strict=True):
            if c != conv:
                close()
                conv = c
            head = _symbols(initial, fault)
            while n:
                if size >= BLOCK:
                    close()
                if size:
                    illegal += last + initial not in LEGAL
                else:
                    first = initial
                take = min(n, BLOCK - size)
                seq.append(head + "x" * (take - 1))
                # equal neighbours never alternate
                illegal += take - 1
                size, n, last, head = size + take, n - take, initial, "x"
        yield out()
    close()
    yield out()


def compress(units: DataFrame) -> tuple[DataFrame, list[tuple[str, str, str]]]:
    """units (key, no, seq) with seq in terms of rules, and the rules (symbol, left, right)."""
    rules: list[tuple[str, str, str]] = []
    for _ in range(ROUNDS):
        one = F.split("seq", "")
        pairs = F.zip_with(F.slice(one, 1, F.greatest(F.size(one) - 1, F.lit(0))), F.slice(one, 2, F.greatest(F.size(one) - 1, F.lit(0))), lambda a, b: F.concat(a, b))
        counted = units.where(F.length("seq") > 1).select(F.explode(pairs).alias("pair")).groupBy("pair").agg(F.count("*").alias("n")).where("n > 1")
        found = chosen([(r["pair"], r["n"]) for r in counted.orderBy(F.desc("n"), "pair").limit(4 * RULES).collect()], RULES)
        if not found:
            break
        seq = F.col("seq")
        for pair in found:
            symbol = chr(FIRST_RULE + len(rules))
            rules.append((symbol, pair[0], pair[1]))
            seq = F.replace(seq, F.lit(pair), F.lit(symbol))
        units = staged(units.withColumn("seq", seq))
    return units, rules


def audits(units: DataFrame) -> DataFrame:
    """key, cost, audit of the units (key, no, seq): all blocks of a key in order of no."""
    units, rules = compress(units)
    table = matrices(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, walk, done = None, None, []

        def out() -> pa.RecordBatch:
            columns = list(zip(*done, strict=True)) if done else [[]] * 3
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.string()), strict=True)], ["key", "cost", "audit"])

        for batch in batches:
            for k, seq in zip(batch.column("key").to_pylist(), batch.column("seq").to_pylist(), strict=True):
                if k != key:
                    if walk:
                        done.append((key, *walk.end()))
                    key, walk = k, Walk(table)
                walk.take(seq)
            yield out()
        if walk:
            done.append((key, *walk.end()))
        yield out()

    return units.repartition("key").sortWithinPartitions("key", "no").select("key", "seq").mapInArrow(run, "key string, cost bigint, audit string")


def diagnose(turns: DataFrame) -> DataFrame:
    """One row a conversation that has rows: conv, gaps, blank, duplicate, truncated, illegal, cost, audit."""
    runs = staged(faults(turns))
    n, fault = F.col("n"), F.col("fault")
    others = F.when(fault == "blank", 0).otherwise(n - 1)
    stats = runs.groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("bigint").alias("gaps"),
        F.coalesce(F.sum(F.when(fault == "blank", n)), F.lit(0)).alias("blank"),
        F.sum(F.coalesce(others, n - 1) + F.when(fault == "duplicate", 1).otherwise(0)).alias("duplicate"),
        F.count_if(fault == "truncated").alias("truncated"),
    )
    lying = runs.repartitionByRange("conv", "turn", "role", "mark").sortWithinPartitions("conv", "turn", "role", "mark")
    cut = staged(lying.select("conv", "n", "initial", "fault").mapInArrow(blocks, "conv string, no bigint, seq string, first string, last string, illegal bigint"))
    # one row a block from here on
    own = W.partitionBy("conv")
    met = F.concat(F.lag("last").over(own.orderBy("no")), F.col("first"))
    cut = cut.withColumn("met", F.when(~met.isin(*LEGAL), 1).otherwise(0)).withColumn("blocks", F.count("*").over(own))
    cut = staged(cut.withColumn("key", F.when(F.col("blocks") == 1, F.concat(F.lit("s"), "seq")).otherwise(F.concat(F.lit("c"), "conv"))))
    alike = cut.where("blocks = 1").select("key", F.lit(0).cast("bigint").alias("no"), "seq").distinct()
    found = audits(staged(alike.unionByName(cut.where("blocks > 1").select("key", "no", "seq"))))
    neighbours = cut.groupBy("conv", "key").agg(F.sum(F.col("illegal") + F.col("met")).alias("illegal"))
    return stats.join(neighbours.join(found, "key").drop("key"), "conv")


def _repairs(kind: pa.DataType, turn: pa.DataType):
    """Rows and, before them, the audit of each conversation, as repaired rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        conv, at, audit, place, state, no = None, None, "", 0, 0, 0

        def put(t, role: str, text: str, edit: str) -> None:
            nonlocal no, state
            done.append((conv, at, no, t, role, text, edit))
            no, state = no + 1, 1 if role[0] == "s" else 2 if role[0] == "u" else 3

        def legal() -> str:
            return "assistant" if state == 2 else "user"

        def inserts() -> None:
            nonlocal place
            while place < len(audit) and audit[place] == "I":
                put(None, legal(), "", "I")
                place += 1

        def out() -> pa.RecordBatch:
            columns = list(zip(*done, strict=True)) if done else [[]] * 7
            done.clear()
            kinds = (pa.string(), kind, pa.int64(), turn, pa.string(), pa.string(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["conv", "conv_id", "no", "turn", "role", "text", "edit"])

        for batch in batches:
            for c, i, t, role, text, given in zip(*[batch.column(x).to_pylist() for x in ("conv", "conv_id", "turn", "role", "text", "audit")], strict=True):
                if given is not None:
                    inserts()
                    conv, audit, place, state, no = c, given, 0, 0, 0
                    continue
                at = i
                inserts()
                edit, place = audit[place], place + 1
                if edit != "D":
                    put(t, role if edit == "K" else legal(), text, edit)
            yield out()
        inserts()
        yield out()

    return run


def repaired_rows(turns: DataFrame, found: DataFrame) -> DataFrame:
    """conv, conv_id, no, turn, role, text, edit: the rows that the audits leave and make, those of a conversation one after another in a partition."""
    rows = _named(turns)
    heads = found.select("conv", F.lit(0).alias("kind"), "audit")
    lying = heads.unionByName(rows.withColumn("kind", F.lit(1)), allowMissingColumns=True).repartition("conv").sortWithinPartitions("conv", "kind", "turn", "role", "mark")
    kinds = dict(turns.dtypes)
    from pyspark.sql.pandas.types import to_arrow_type

    arrow = [to_arrow_type(turns.schema[c].dataType) for c in ("conv_id", "turn")]
    return lying.select("conv", "conv_id", "turn", "role", "text", "audit").mapInArrow(
        _repairs(*arrow), f"conv string, conv_id {kinds['conv_id']}, no bigint, turn {kinds['turn']}, role string, text string, edit string"
    )


def repair(turns: DataFrame) -> DataFrame:
    """conv_id, no, turn, role, text, edit: the conversations after the cheapest repair; edit is K(ept), R(erole) or I(nserted)."""
    return repaired_rows(turns, diagnose(turns)).drop("conv")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, sha = None, None
    for batch in batches:
        done = []
        for c, role, text in zip(*[batch.column(x).to_pylist() for x in ("conv", "role", "text")], strict=True):
            if c != conv:
                if sha:
                    done.append((conv, sha.hexdigest()))
                conv, sha = c, hashlib.sha256()
            else:
                sha.update(b"\n")
            sha.update(f"{role}:{text}".encode())
        yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], pa.string()) for i in (0, 1)], ["conv", "repaired_sha256"])
    if sha:
        yield pa.RecordBatch.from_arrays([pa.array([conv], pa.string()), pa.array([sha.hexdigest()], pa.string())], ["conv", "repaired_sha256"])


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def digests(all_turns: DataFrame, turns: DataFrame) -> DataFrame:
    """One row for each conv_id of all_turns: the faults and the audit of its rows in turns, and the digest of their repair."""
    found = staged(diagnose(turns))
    hashed = repaired_rows(turns, found).select("conv", "role", "text").mapInArrow(_digests, "conv string, repaired_sha256 string")
    every = _named(all_turns.select("conv_id", *[F.lit(None).cast("string").alias(c) for c in ("turn", "role", "text")])).select("conv", "conv_id")
    parts = every.unionByName(found, allowMissingColumns=True).unionByName(hashed, allowMissingColumns=True)
    whole = parts.groupBy("conv").agg(*[F.max(c).alias(c) for c in ("conv_id", *COUNTS, "audit", "repaired_sha256")])
    counts = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in COUNTS]
    nothing = hashlib.sha256().hexdigest()
    return whole.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations")
    return digests(turns, damage(turns))


_CRC = """xor(list_reduce(list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ascii(x)::BIGINT),
  lambda c, b: list_reduce([1, 2, 3, 4, 5, 6, 7, 8], lambda k, i: xor(k >> 1, 3988292384 * (k & 1)), xor(c, b)), 4294967295::BIGINT), 4294967295)"""

OP11_SQL = rf"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_CRC} % 20 AS lot FROM conversations
),
damaged AS (
  SELECT conv_id, turn, CASE WHEN lot = 4 THEN 'user' ELSE role END AS role,
         CASE lot WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN lot = 3 THEN 2 ELSE 1 END)) AS copy
  FROM raw WHERE lot <> 0
),
placed AS (
  SELECT *, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS c, left(role, 1) AS one,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(strlen(role) || ':' || role || text), copy) AS i
  FROM damaged
),
judged AS (
  SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank, row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 AS again,
         NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') AS cut, lag(one) OVER (PARTITION BY c ORDER BY i) AS before
  FROM placed
),
ways(one, state, upto) AS (VALUES ('s', 0, 1), ('u', 0, 2), ('u', 1, 2), ('u', 3, 2), ('a', 2, 3)),
inserted(state, upto, n, made) AS (
  VALUES (0, 0, 0, ''), (1, 1, 0, ''), (2, 2, 0, ''), (3, 3, 0, ''), (0, 2, 1, chr(10) || 'user:'), (1, 2, 1, chr(10) || 'user:'), (3, 2, 1, chr(10) || 'user:'),
         (2, 3, 1, chr(10) || 'assistant:'), (0, 3, 2, chr(10) || 'user:' || chr(10) || 'assistant:'), (1, 3, 2, chr(10) || 'user:' || chr(10) || 'assistant:')
),
edits AS (
  SELECT c, i, s.state, s.state AS upto, 2 AS cost, 'D' AS letter, '' AS made FROM judged, (SELECT unnest(range(4)) AS state) s
  UNION ALL
  SELECT c, i, state, upto, CASE WHEN cut THEN 5 ELSE 0 END, 'K', chr(10) || role || ':' || text FROM judged JOIN ways USING (one) WHERE NOT blank AND NOT again
  UNION ALL
  SELECT c, i, state, upto, CASE WHEN cut THEN 6 ELSE 1 END, 'R', chr(10) || CASE w.one WHEN 'u' THEN 'user' ELSE 'assistant' END || ':' || text
  FROM judged, ways w WHERE NOT blank AND NOT again AND w.one <> 's'
),
walk AS (
  SELECT DISTINCT c, 0::BIGINT AS i, 0 AS state, 0::BIGINT AS cost, '' AS audit, '' AS made FROM judged
  UNION ALL
  SELECT c, i, state, first(cost ORDER BY cost, audit), first(audit ORDER BY cost, audit), first(made ORDER BY cost, audit)
  FROM (
    SELECT w.c, w.i + 1 AS i, e.upto AS state, w.cost + 5 * n.n + e.cost AS cost, w.audit || repeat('I', n.n) || e.letter AS audit, w.made || n.made || e.made AS made
    FROM walk w JOIN inserted n USING (state) JOIN edits e ON e.c = w.c AND e.i = w.i + 1 AND e.state = n.upto
  ) GROUP BY c, i, state
),
ends AS (
  SELECT w.c, w.cost + 5 * n.n AS cost, w.audit || repeat('I', n.n) AS audit, w.made || n.made AS made
  FROM walk w JOIN inserted n USING (state) JOIN (SELECT c, max(i) AS i FROM judged GROUP BY c) USING (c, i) WHERE n.upto IN (0, 3)
),
best AS (SELECT c, first(cost ORDER BY cost, audit) AS cost, first(audit ORDER BY cost, audit) AS audit, first(made ORDER BY cost, audit) AS made FROM ends GROUP BY c),
stats AS (
  SELECT c, any_value(conv_id) AS conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank, count_if(NOT blank AND again) AS duplicate,
         count_if(NOT blank AND NOT again AND cut) AS truncated, count_if(before || one NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY c
)
SELECT k.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit,
       sha256(coalesce(substr(made, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) k LEFT JOIN (stats JOIN best USING (c)) r ON k.conv_id IS NOT DISTINCT FROM r.conv_id
"""
