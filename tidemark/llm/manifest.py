"""Merkle manifest of a dataset: a tree of SHA-256 digests a source, and one over the sources' roots.

Only every second level of a tree is stored (level 0, 2, 4, ... by `stride`). The nodes between are made
again where they are needed: a stored level is grouped into aligned subtrees of FANOUT ** stride nodes, each
a row; from its members the missing nodes of that subtree follow, serve as siblings and are dropped. Proofs
go down from the root: a subtree's members get their siblings inside it and then the path of the stored node
above it.

Scale: texts are read once, to make leaves. Places in a source come from a range sort and the sizes of its
partitions, so a source with a third of all rows is cut wherever a partition or a subtree ends and is never
in one task. A subtree's row holds at most FANOUT ** stride members; paths have a few KB and are not
shuffled with the leaves. The driver sees the height and the root.

Defined results: null columns are `-` in a leaf; a null source is a source of its own, before the others; null doc_ids
come first in their source, rows of one doc_id by their leaf, equal rows each have a place; other columns play no part,
whatever their names; a text of any length is one leaf; an empty table has no rows and no root.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.text import lower_ascii, read_table
from tidemark.sources.staging import staged

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left:string,right:string>>"


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def leaf(fields: list[Column]) -> Column:
    """Digest of the fields, each with its length in bytes before it."""
    shown = [f.cast("string") for f in fields]
    return digest(F.concat(*[F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in shown]))


@dataclass
class Tree:
    """levels: stored nodes (g, at, n, h, row) from the leaves up, n being the nodes of group g at that level; roots: (g, height, root)."""

    levels: list[DataFrame]
    roots: DataFrame
    stride: int


def _placed(nodes: DataFrame) -> DataFrame:
    """nodes (g, o, h, row) with their place in g by (o, h), from 0, and g's size.

    The rows are range partitioned and numbered as they lie; a group's rows before a partition are a sum over partitions.
    """
    sorted_rows = nodes.repartitionByRange("g", "o", "h").sortWithinPartitions("g", "o", "h")
    lying = staged(sorted_rows.select("g", "h", "row", F.monotonically_increasing_id().alias("lies")).withColumn("part", F.shiftright("lies", 33)))
    runs = lying.groupBy("g", "part").agg(F.count("*").alias("size"), F.min("lies").alias("first"))
    before = F.sum("size").over(W.partitionBy("g").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    runs = runs.select("g", "part", "first", F.coalesce(before, F.lit(0)).alias("before"), F.sum("size").over(W.partitionBy("g")).alias("n"))
    return lying.join(runs, ["g", "part"]).select("g", (F.col("before") + F.col("lies") - F.col("first")).alias("at"), "n", "h", "row")


def _parents(level: str) -> Column:
    runs = F.sequence(F.lit(0), F.expr(f"cast((size({level}) - 1) div {FANOUT} as int)"))
    return F.transform(runs, lambda k: digest(F.array_join(F.slice(level, k * FANOUT + 1, F.lit(FANOUT)), "")))


def _subtrees(nodes: DataFrame, stride: int) -> DataFrame:
    """One row for each aligned subtree: its place, its members, the levels l0.. made again from them, and its top node."""
    span = FANOUT**stride
    rows = nodes.groupBy("g", F.expr(f"at div {span}").alias("no")).agg(
        F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("at", "h", "row"))).alias("members")
    )
    rows = rows.withColumn("l0", F.transform("members", lambda m: m["h"]))
    for j in range(stride):
        rows = rows.withColumn(f"l{j + 1}", F.when(F.col("n") > FANOUT**j, _parents(f"l{j}")))
    top = F.coalesce(*[F.get(F.col(f"l{j}"), F.lit(0)) for j in range(stride, -1, -1)])
    return rows.withColumn("top", top)


def grow(nodes: DataFrame, stride: int = 2) -> Tree:
    """The trees over nodes (g, o, h, row): one a group, its leaves in order of (o, h). row is a struct of whatever the caller wants back."""
    span = FANOUT**stride
    levels, tops = [staged(_placed(nodes))], []
    most = levels[0].agg(F.max("n")).first()[0] or 0
    while True:
        above = _subtrees(levels[-1], stride).select(
            "g", F.col("no").alias("at"), F.expr(f"cast((n + {span - 1}) div {span} as bigint)").alias("n"), F.col("top").alias("h"), F.struct(F.lit(0).alias("none")).alias("row")
        )
        above = staged(above)
        tops.append(above.where("n = 1").select("g", F.lit(len(levels) - 1).alias("height"), F.col("h").alias("root")))
        most = -(-most // span)
        if most <= 1:
            break
        levels.append(above.where("n > 1"))
    roots = tops[0]
    for t in tops[1:]:
        roots = roots.unionByName(t)
    return Tree(levels, roots, stride)


def prove(tree: Tree, above: DataFrame) -> DataFrame:
    """(g, h, row, root, path) of every leaf: its tree's root, and for each level the digests left and right of its ancestor in the run.

    above: (g, path) from each group's root on, where the groups hang in another tree. Roots and upper paths come down
    with the subtrees, so no leaf is joined by its group.
    """
    span, upper = FANOUT**tree.stride, None
    for level in range(len(tree.levels) - 1, -1, -1):
        ends = tree.roots.where(F.col("height") == level).join(above, "g").select("g", F.lit(0).cast("bigint").alias("no"), "root", "path")
        upper = ends if upper is None else upper.select("g", F.col("at").alias("no"), "root", "path").unionByName(ends)
        rows = _subtrees(tree.levels[level], tree.stride).join(upper, ["g", "no"])

        def beside(at: Column, j: int) -> Column:
            nodes, i = F.col(f"l{j}"), F.floor(at / FANOUT**j).cast("int")
            first = i - i % FANOUT
            left, right = F.slice(nodes, first + 1, i - first), F.slice(nodes, i + 2, first + FANOUT - 1 - i)
            return F.when(F.col("n") > FANOUT**j, F.struct(F.array_join(left, "").alias("left"), F.array_join(right, "").alias("right")))

        def path(m: Column) -> Column:
            local = m["at"] - F.col("no") * span
            return F.concat(F.array_compact(F.array(*[beside(local, j) for j in range(tree.stride)])), F.col("path"))

        rows = rows.select("g", "root", F.explode(F.transform("members", lambda m: F.struct(m["at"].alias("at"), m["h"].alias("h"), m["row"].alias("row"), path(m).alias("path")))).alias("m"))
        upper = rows.select("g", "root", "m.*")
    return upper.select("g", "h", "row", "root", "path")


def fold(node: Column, path: Column) -> Column:
    """The root that follows from a leaf and its path."""
    return F.aggregate(path, node, lambda x, p: digest(F.concat(p["left"], x, p["right"])))


def siblings(path: Column) -> Column:
    return F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), "")


def manifest(docs: DataFrame, carry: dict[str, Column] | None = None, stride: int = 2) -> tuple[DataFrame, str | None]:
    """(rows, root): carry's columns, leaf, subroot and path of every row of docs; and the root of the whole dataset.

    carry: columns over docs that come back with each row, doc_id by default.
    """
    carry = carry or {"doc_id": F.col("doc_id")}
    group = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("-")).alias("g")
    kept = F.struct(*[v.alias(k) for k, v in carry.items()])
    nodes = docs.select(group, F.col("doc_id").alias("o"), leaf([F.col(c) for c in FIELDS]).alias("h"), kept.alias("row"))
    sources = grow(nodes, stride)
    roots = sources.roots
    crown = grow(roots.select(F.lit("").alias("g"), F.col("g").alias("o"), F.col("root").alias("h"), F.struct(F.col("g").alias("source")).alias("row")), stride)
    found = crown.roots.select("root").first()
    none = F.array().cast(PATH)
    up = prove(crown, crown.roots.select("g", none.alias("path"))).select(F.col("row.source").alias("g"), "path")
    rows = prove(sources, up)
    return rows.select("row.*", F.col("h").alias("leaf"), F.col("root").alias("subroot"), "path"), found["root"] if found else None


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    hit = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    lowered = leaf([F.col(c) for c in FIELDS[:-1]] + [lower_ascii(F.col("text"))])
    rows, root = manifest(docs, {"doc_id": F.col("doc_id"), "altered": F.when(hit, lowered)})
    root = F.lit(root).cast("string")
    found = rows.select(
        "doc_id", "leaf", "subroot", root.alias("root"), digest(siblings(F.col("path"))).alias("proof_sha256"),
        fold(F.coalesce("altered", "leaf"), F.col("path")).alias("folded_root"),
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


_CRC = """xor(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
  lambda c, b: list_reduce([1, 2, 3, 4, 5, 6, 7, 8], lambda k, i: xor(k >> 1, 3988292384 * (k & 1)), xor(c, b)), 4294967295::BIGINT), 4294967295)"""


def _leaf_sql(text: str) -> str:
    shown = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    return "sha256(concat(" + ", ".join(f"coalesce(strlen({x})::VARCHAR || ':' || {x}, '-')" for x in shown) + "))"


OP12_SQL = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source, {_leaf_sql("text")} AS leaf,
         CASE WHEN {_CRC} % 5 = 0 THEN {_leaf_sql("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS altered
  FROM documents
),
placed AS (
  SELECT *, coalesce('=' || source, '-') AS g, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY source) AS n
  FROM docs
),
trees AS (
  SELECT g, 0 AS level, pos, n, leaf AS h FROM placed
  UNION ALL
  SELECT g, any_value(level) + 1, pos // 16, any_value((n + 15) // 16), sha256(string_agg(h, '' ORDER BY pos)) FROM trees WHERE n > 1 GROUP BY g, pos // 16
),
subroots AS (SELECT g, level AS height, h AS subroot FROM trees WHERE n = 1),
crown AS (
  SELECT 0 AS level, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n, subroot AS h FROM subroots
  UNION ALL
  SELECT any_value(level) + 1, pos // 16, any_value((n + 15) // 16), sha256(string_agg(h, '' ORDER BY pos)) FROM crown WHERE n > 1 GROUP BY pos // 16
),
top AS (SELECT h AS root FROM crown WHERE n = 1),
nodes AS (
  SELECT g, level, pos, n, h FROM trees
  UNION ALL SELECT '', level, pos, n, h FROM crown
),
runs AS (SELECT g, level, pos // 16 AS run, list(h ORDER BY pos) AS hs FROM nodes WHERE n > 1 GROUP BY ALL),
ranked AS (SELECT g, height, row_number() OVER (ORDER BY g) - 1 AS place FROM subroots),
walk AS (
  SELECT row_number() OVER () AS r, g, 0 AS level, pos, coalesce(altered, leaf) AS cur, '' AS beside FROM placed
  UNION ALL
  SELECT r, w.g, w.level + 1, pos // 16,
         sha256(array_to_string(list_slice(hs, 1, pos % 16) || [cur] || list_slice(hs, pos % 16 + 2, 16), '')),
         beside || array_to_string(list_slice(hs, 1, pos % 16) || list_slice(hs, pos % 16 + 2, 16), '')
  FROM walk w JOIN runs u ON u.g = w.g AND u.level = w.level AND u.run = w.pos // 16
),
reached AS (SELECT w.r, r.place AS pos, w.cur, w.beside FROM walk w JOIN ranked r ON r.g = w.g AND r.height = w.level),
climb AS (
  SELECT r, 0 AS level, pos, cur, beside FROM reached
  UNION ALL
  SELECT r, w.level + 1, pos // 16,
         sha256(array_to_string(list_slice(hs, 1, pos % 16) || [cur] || list_slice(hs, pos % 16 + 2, 16), '')),
         beside || array_to_string(list_slice(hs, 1, pos % 16) || list_slice(hs, pos % 16 + 2, 16), '')
  FROM climb w JOIN runs u ON u.g = '' AND u.level = w.level AND u.run = w.pos // 16
),
proofs AS (SELECT r, arg_max(cur, level) AS folded_root, arg_max(beside, level) AS beside FROM climb GROUP BY r),
numbered AS (SELECT row_number() OVER () AS r, * FROM placed)
SELECT doc_id, leaf, subroot, root, sha256(beside) AS proof_sha256, folded_root, folded_root = root AS verified
FROM numbered JOIN proofs USING (r) JOIN subroots USING (g), top
"""
