import hashlib
import random
from collections import Counter, defaultdict

import pytest

from pyspark.sql import functions as F

from tidemark.llm.manifest import fold, manifest, siblings

H = lambda x: hashlib.sha256(x.encode()).hexdigest()


def leaf(r):
    return H("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in r))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H("".join(out[-1][i : i + 16])) for i in range(0, len(out[-1]), 16)])
    return out


def path(tree, at):
    out = []
    for nodes in tree[:-1]:
        first = at - at % 16
        out.append(("".join(nodes[first:at]), "".join(nodes[at + 1 : first + 16])))
        at //= 16
    return out


def by_hand(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([leaf(r) for r in sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))]) for s in order}
    crown = levels([trees[s][-1][0] for s in order])
    out = Counter()
    for i, s in enumerate(order):
        up = path(crown, i)
        for j, h in enumerate(trees[s][0]):
            p = path(trees[s], j) + up
            out[(h, trees[s][-1][0], H("".join(a + b for a, b in p)))] += 1
    return out, crown[-1][0] if order else None


def check(spark, rows, stride):
    df = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string").repartition(5)
    found, root = manifest(df, stride=stride)
    got = found.select("leaf", "subroot", F.sha2(siblings(F.col("path")), 256).alias("p"), fold(F.col("leaf"), F.col("path")).alias("f"), fold(F.lit("x"), F.col("path")).alias("x")).collect()
    want, top = by_hand(rows)
    assert root == top
    assert Counter((r["leaf"], r["subroot"], r["p"]) for r in got) == want
    assert all(r["f"] == root and r["x"] != root for r in got)


@pytest.mark.parametrize("stride", [1, 2, 3])
def test_trees_of_every_height(spark, stride):
    dice = random.Random(5)
    sizes = {None: 17, "": 1, "a": 16, "B": 300, "é": 256, "z": 257, "big": 4200, "two": 2}
    sizes |= {f"s{i}": 1 + i % 3 for i in range(40)}
    rows = [(i, s, dice.choice(["en", None]), dice.choice([None, 3]), dice.choice([None, "", "Ab ü", "x" * 50])) for s, n in sizes.items() for i in range(n)]
    dice.shuffle(rows)
    check(spark, rows if stride == 2 else [r for r in rows if r[1] != "big"], stride)


def test_ties_nulls_and_clashing_names(spark, docs, rows, no_docs):
    plain = [(r[0], r[3], r[2], r[4], r[1]) for r in rows]
    check(spark, plain, 2)
    found, root = manifest(docs)
    assert root == by_hand(plain)[1] and found.count() == len(rows)
    none, root = manifest(no_docs)
    assert root is None and none.count() == 0
    check(spark, [(7, "s", "en", 1, "only")], 2)
