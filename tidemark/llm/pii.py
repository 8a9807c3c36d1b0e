"""Personal data: candidate generators, gradient-boosted trees and calibrated thresholds.

Base spans (email, ip, card, phone) come from fixed rules. Beside them, high-recall generators
propose overlapping candidates (spaced or bracketed addresses, any run of grouped digits). A
candidate has a format and a context (length, groups, separators, words before it, characters
around it), which the trees see, and evidence, which is withheld from them: a domain ending, octets,
a check digit, a dialling plan. Boosted trees learn, from a bounded sample of the corpus' own
candidates of all forms, how likely a candidate of such a format and context is to hold its evidence.
Numbers that pass a check by chance stand among others that fail it and score low; real ones do not.

The threshold of each kind is calibrated on a fold that the trees have not seen, over all its
candidates in the corpus: the least score down to which nine in ten of each hundredth hold their evidence. Candidates beyond
it that hold their evidence and touch no base span and no better candidate are added.

SQL functions and Spark ML only. Texts are read once; spans and features go to a narrow table in
the shared folder, and texts are never shuffled.

Defined results: null and empty texts hold nothing; null doc_ids stay null; repeated rows get
equal results; where the sample has one class only (or is empty), or no score of a kind is good
enough, no spans (of that kind) are added.
"""

from __future__ import annotations

import functools

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.spans import touching, untouched_by_better
from tidemark.llm.text import find_spans, joined_spans, let, read_table, row_key, text_of
from tidemark.sources.staging import staged

KINDS = ("email", "ip", "card", "phone")
_LOCAL = "A-Za-z0-9._%+-"
#: The contract's patterns. Runs are entered at their start only and taken whole, which finds the
#: same matches without going back over long runs.
EMAIL = rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Generators: candidates of a kind, far more than are personal data. What joins their parts may be spaced on both sides;
#: digits inside a longer token are none.
_AT = r"(?:@|\x20@\x20|\x20?(?:\(at\)|\[at\])\x20?)"
_DOT = r"(?:\.|\x20\.\x20|\x20?(?:\(dot\)|\[dot\])\x20?)"
GENERATORS = {
    "email": rf"(?<![{_LOCAL}])[{_LOCAL}]{{1,64}}+{_AT}[A-Za-z0-9-]{{1,63}}+(?:{_DOT}[A-Za-z0-9-]{{1,63}}+){{1,6}}",
    "ip": r"(?<![0-9])[0-9]{1,3}+(?:\x20?[.,:]\x20?[0-9]{1,3}+){3}(?![0-9])",
    "card": r"(?<![A-Za-z0-9])[0-9]{4}(?:[\x20./-]?[0-9]{3,6}){2,4}(?![A-Za-z0-9])",
    "phone": r"(?<![A-Za-z0-9])[+(]?[0-9](?:[\x20()./-]{0,2}[0-9]){7,16}(?![A-Za-z0-9])",
}
SAMPLE = 20_000
FEATURES = (
    "rank", "n_chars", "n_digits", "n_groups", "longest", "n_seps", "n_letters", "n_spaces", "paren",
    "glued", "said_mail", "said_phone", "said_card", "said_host",
)
ROW = "struct<rank:int,start:bigint,end:bigint,kind:string>"


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits has a Luhn check digit."""
    n = F.length(digits)
    total = F.aggregate(
        F.sequence(F.lit(1), n),
        F.lit(0),
        lambda acc, i: acc
        + let(
            F.substring(digits, i, F.lit(1)).cast("int") * F.when((n - i) % 2 == 1, 2).otherwise(1),
            lambda d: F.when(d > 9, d - 9).otherwise(d),
        ),
    )
    return F.when(n > 0, total % 10 == 0).otherwise(F.lit(False))


def octets(value: Column) -> Column:
    """Whether all number groups are at most 255."""
    return F.forall(
        F.regexp_extract_all(value, F.lit("[0-9]+"), F.lit(0)),
        lambda p: let(F.regexp_replace(p, "^0+", ""), lambda q: (F.length(q) < 3) | ((F.length(q) == 3) & (q <= "255"))),
    )


def base_spans(text: Column) -> dict[str, Column]:
    def digits_between(value: Column, low: int, high: int) -> Column:
        return F.length(digits_of(value)).between(low, high)

    return {
        "email": find_spans(text, EMAIL),
        "ip": F.filter(find_spans(text, IP), lambda s: octets(s["value"])),
        "card": F.filter(
            find_spans(text, CARD), lambda s: F.when(digits_between(s["value"], 13, 19), luhn(digits_of(s["value"]))).otherwise(F.lit(False))
        ),
        "phone": F.filter(find_spans(text, PHONE), lambda s: digits_between(s["value"], 9, 15)),
    }


def ranked(spans: Column, rank: int, kind: str) -> Column:
    """Spans that sort by kind and then by place."""
    row = lambda s: F.struct(F.lit(rank).alias("rank"), s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind"))
    return F.transform(spans, row).cast(f"array<{ROW}>")


def _said(before: Column, words: str) -> Column:
    return before.rlike(f"(?i)(?:{words})").cast("double")


def evidence(value: Column, kind: str) -> Column:
    """Whether a candidate holds what its format alone does not show."""
    if kind == "email":
        return value.rlike(rf"{_DOT}[A-Za-z]{{2,6}}$")
    if kind == "ip":
        return octets(value)
    if kind == "card":
        return let(digits_of(value), lambda d: F.length(d).between(13, 19) & luhn(d))
    # an international prefix, or the North American plan: neither area nor exchange starts with 0 or 1
    plan = r"^1?[2-9][0-9]{2}[2-9][0-9]{6}$"
    return let(digits_of(value), lambda d: (value.startswith("+") & F.length(d).between(9, 15)) | d.rlike(plan))


def described(text: Column, kind: str, rank: int) -> Column:
    """Candidates of a generator: array of structs (rank, start, end, kind, holds, FEATURES)."""

    def context(spans: Column, gaps: Column, i: Column) -> Column:
        # of the text itself, substring would count code points from its start for every candidate; a candidate has
        # 5 characters or more, so 5 of them with the gaps around them reach back far enough
        near = F.transform(
            F.sequence(F.greatest(i - 5, F.lit(0)), i),
            lambda j: F.concat(F.right(F.get(gaps, j), F.lit(24)), F.when(j < i, F.get(spans, j)["value"]).otherwise("")),
        )
        after = F.concat(F.get(gaps, i + 1), F.coalesce(F.get(spans, i + 1)["value"], F.lit("")))
        return F.struct(F.right(F.array_join(near, ""), F.lit(24)).alias("before"), F.left(after, F.lit(1)).alias("after"))

    def one(s: Column, around: Column) -> Column:
        value, before = s["value"], around["before"]
        shown = F.regexp_replace(value, r"^\+", "")
        count = lambda p: F.length(F.regexp_replace(shown, p, "")).cast("double")
        groups = F.regexp_extract_all(shown, F.lit("[0-9]+"), F.lit(0))
        return F.struct(
            F.lit(rank).alias("rank"), s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind"),
            evidence(value, kind).alias("holds"),
            F.length(shown).cast("double").alias("n_chars"),
            count("[^0-9]").alias("n_digits"),
            F.size(groups).cast("double").alias("n_groups"),
            F.coalesce(F.array_max(F.transform(groups, lambda g: F.length(g))), F.lit(0)).cast("double").alias("longest"),
            count("[A-Za-z0-9]").alias("n_seps"),
            count("[^A-Za-z]").alias("n_letters"),
            count("[^ ]").alias("n_spaces"),
            value.contains("(").cast("double").alias("paren"),
            F.concat(F.right(before, F.lit(1)), around["after"]).rlike("[A-Za-z0-9]").cast("double").alias("glued"),
            _said(before, "mail|contact|write").alias("said_mail"),
            _said(before, "phone|tel|call|fax|mobil").alias("said_phone"),
            _said(before, "card|visa|credit|pay").alias("said_card"),
            _said(before, r"\bip\b|host|server|addr").alias("said_host"),
        )

    def each(spans: Column) -> Column:
        gaps = F.split(F.when(F.size(spans) > 0, text), GENERATORS[kind], -1)
        return let(gaps, lambda g: F.transform(spans, lambda s, i: let(context(spans, g, i), lambda c: one(s, c))))

    return let(find_spans(text, GENERATORS[kind]), each)


def _vectors(candidates: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(candidates)


def held_back() -> Column:
    return F.pmod(F.xxhash64("key"), F.lit(4)) == 0


def fitted(candidates: DataFrame, sample: int):
    """Trees fitted on at most `sample` candidates (key, start, rank, holds, FEATURES) outside the held-back fold, an equal
    share of each kind at most; None where they are all alike."""
    order = (F.xxhash64("key", "start", "rank"), "key", "start")
    seen = candidates.where(~held_back())
    parts = [seen.where(F.col("rank") == i).orderBy(*order).limit(sample // len(KINDS)) for i in range(len(KINDS))]
    chosen = staged(functools.reduce(DataFrame.unionByName, parts).withColumn("label", F.col("holds").cast("double")))
    if chosen.select("label").distinct().count() < 2:
        return None
    gbt = GBTClassifier(featuresCol="features", labelCol="label", maxIter=8, maxDepth=4, stepSize=0.3, seed=7, maxBins=32)
    return gbt.fit(_vectors(chosen))


def thresholds(judged: DataFrame, precision: float) -> dict[int, float]:
    """Of each kind (rank) that has one: the least score down to which, hundredth by hundredth, `precision` of the candidates hold their evidence.

    One aggregation over all candidates of the held-back fold; a hundred rows a kind come back.
    """
    sums = judged.groupBy("rank", F.floor(F.col("p") * 100).cast("int").alias("at")).agg(F.count("*").alias("n"), F.count_if("holds").alias("y"))
    found, done = {}, set()
    for r in sorted(sums.collect(), key=lambda r: -r["at"]):
        # many sure candidates above must not carry doubtful ones below
        if r["y"] < precision * r["n"]:
            done.add(r["rank"])
        elif r["rank"] not in done:
            found[r["rank"]] = r["at"] / 100
    return found


def scored(candidates: DataFrame, model) -> DataFrame:
    return model.transform(_vectors(candidates)).withColumn("p", vector_to_array("probability")[1])


def find_pii(docs: DataFrame, sample: int = SAMPLE, precision: float = 0.9) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added of every row of docs (doc_id, text)."""
    rows = docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("key"), text_of(F.col("text")).alias("t"))
    base = base_spans(F.col("t"))
    plain = [ranked(base[k], i, k).alias(k) for i, k in enumerate(KINDS)]
    shape = f"array<{ROW[:-1]},holds:boolean,{','.join(f'{f}:double' for f in FEATURES[1:])}>>"
    listed = F.concat(*[described(F.col("t"), k, i).cast(shape) for i, k in enumerate(KINDS)])
    found = staged(rows.select("doc_id", "key", *plain, listed.alias("candidates")))
    own = F.concat(*KINDS)
    each = found.where(F.size("candidates") > 0).select("key", F.explode("candidates").alias("c")).select("key", "c.*")
    model = fitted(each, sample)
    done = found.select("doc_id", "key", *KINDS)
    least = thresholds(scored(each.where(held_back()), model), precision) if model else {}
    if not least:
        done = done.withColumn("added", F.array().cast(f"array<{ROW}>"))
    else:
        good = functools.reduce(lambda a, b: a | b, [(F.col("rank") == k) & (F.col("p") >= t) for k, t in least.items()])
        chosen = scored(each.where("holds"), model).where(good).select("key", "rank", "start", "end", (-F.col("p")).alias("q"))
        plainly = found.select("key", F.inline(own)).select("key", F.lit(-1).alias("rank"), "start", "end", F.lit(None).cast("double").alias("q"))
        apart = chosen.unionByName(plainly).distinct().withColumn("taken", touching(F.col("rank") < 0)).where("rank >= 0 and not taken").drop("taken")
        # of candidates that touch, the one with the better score stays
        best = untouched_by_better(apart, range(len(KINDS)))
        kind = F.element_at(F.array(*[F.lit(f"likely_{k}") for k in KINDS]), F.col("rank") + 1)
        chosen = best.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("q", "rank", "start", "end", kind.alias("kind")))).alias("c"))
        added = F.transform("c", lambda x: F.struct(x["rank"].alias("rank"), x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind")))
        done = done.join(chosen.select("key", added.cast(f"array<{ROW}>").alias("added")), "key", "left")
        done = done.withColumn("added", F.coalesce("added", F.array().cast(f"array<{ROW}>")))
    return done.select(
        "doc_id",
        *[F.size(k).cast("bigint").alias(f"n_{k}") for k in KINDS],
        F.sha2(joined_spans(F.array_sort(own)), 256).alias("base_sha256"),
        joined_spans(F.array_sort(F.concat(own, "added"))).alias("spans"),
        F.size("added").cast("bigint").alias("n_added"),
    )


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(read_table(spark, sf_dir, "documents"))
