"""How long reports take to mature: first reports, cohort quantiles and a bootstrapped bound."""

from __future__ import annotations

import functools
import math
from datetime import date, timedelta

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators.features import cohort_months
from tidemark.sources.staging import staged

QUANTILE, CONFIDENCE, COHORTS, GRACE_MONTHS = 0.995, 0.95, 12, 9
INCIDENT = ("usdot_number", "report_state", "report_number", "event_date", "report_time")


def known_by(versions: DataFrame, day: date) -> DataFrame:
    return versions.where((F.to_date("knowledge_valid_from") <= F.lit(day)) & (F.col("reported_date") <= F.lit(day)))


def missing_carriers(versions: DataFrame, data_as_of: date) -> DataFrame:
    """One row: the versions without a carrier that are known by a day, and the incidents they stand for."""
    return known_by(versions, data_as_of).where("usdot_number is null").agg(
        F.count("*").alias("missing_rows"), F.countDistinct(F.struct(*INCIDENT)).alias("missing_incidents")
    )


def _whole() -> Column:
    """Whether an incident's identity is complete."""
    whole = F.col("usdot_number").rlike(r"\A[1-9][0-9]*\z")
    for c in ("report_state", "report_number", "report_time"):
        whole = whole & (F.coalesce(F.col(c).cast("string"), F.lit("")) != "")
    return whole


def _refuse(broken: tuple) -> None:
    for found, what in zip(broken, ("a report is dated before its event", "two first versions of a source key differ", "an incident lacks a part of its identity, or its carrier number is not canonical"), strict=True):
        if found:
            raise ValueError(what)


def _best() -> Column:
    """Of an incident's earliest versions the least is the one that is taken."""
    rank = F.when(F.col("federal_recordable") & ~F.col("is_deleted"), 0).when(~F.col("is_deleted"), 1).otherwise(2)
    return F.struct("knowledge_valid_from", rank.alias("rank"), "reported_date", "source_record_key", "federal_recordable", "is_deleted")


def first_incidents(versions: DataFrame, data_as_of: date) -> DataFrame:
    """One row for each incident: the version that first made it known.

    versions: crash rows with source_record_key, INCIDENT, reported_date, knowledge_valid_from,
    federal_recordable, is_deleted. The earliest version of each source key is taken; then, of the
    keys that are an incident's earliest, a reportable one first, then a living one, then any, and
    among those the least (reported_date, source_record_key).
    """
    known = known_by(versions, data_as_of).where("event_date is not null")
    content = (*INCIDENT, "reported_date", "federal_recordable", "is_deleted")
    # the least and the greatest content at the earliest time: two that differ are a conflict
    early = -F.unix_micros("knowledge_valid_from")
    both = known.groupBy("source_record_key").agg(
        F.min(F.struct("knowledge_valid_from", *content)).alias("first"), F.max(F.struct(early.alias("early"), *content)).alias("other"),
        F.max(F.col("reported_date") < F.col("event_date")).alias("backwards"),
    )
    clash = ~F.struct(*[F.col("first")[c] for c in content]).eqNullSafe(F.struct(*[F.col("other")[c] for c in content]))
    own = staged(both.select("source_record_key", "first.*", "backwards", clash.alias("clash")))
    whole = _whole()
    _refuse(own.agg(F.max("backwards"), F.max("clash"), F.max(F.col("usdot_number").isNotNull() & ~whole)).first())
    best, rest = F.min(_best()).alias("best"), ("federal_recordable", "is_deleted")
    chosen = own.where("usdot_number is not null").groupBy(*INCIDENT).agg(best)
    return chosen.select("best.source_record_key", *INCIDENT, "best.reported_date", "best.knowledge_valid_from", *[f"best.{c}" for c in rest])


def cohort_lags(incidents: DataFrame, data_as_of: date) -> DataFrame:
    """event_month, lag_days, n: the lag histogram of each mature cohort."""
    months = cohort_months(incidents.sparkSession, data_as_of, COHORTS, GRACE_MONTHS)
    rows = incidents.where(F.col("federal_recordable") & ~F.col("is_deleted")).select(
        F.trunc("event_date", "MM").alias("event_month"), F.datediff("reported_date", "event_date").alias("lag_days")
    )
    return rows.join(F.broadcast(months), "event_month").groupBy("event_month", "lag_days").agg(F.count("*").alias("n"))


def measured_lags(versions: DataFrame, measured: list[tuple[date, int]]) -> DataFrame:
    """data_as_of, event_month, lag_days, n: `cohort_lags` of `first_incidents` for each (day, days by which reports come later), in one pass.

    A record's versions meet once for all measurements, as a list (of few). Incidents outside a measurement's cohorts are only
    checked: they fall into one group before anything is moved. The result is a histogram.
    """
    spark, content = versions.sparkSession, (*INCIDENT, "reported_date", "federal_recordable", "is_deleted")
    told = F.collect_list(F.struct("knowledge_valid_from", *content)).alias("told")
    days = F.explode(F.array(*[F.struct(F.lit(d).alias("data_as_of"), F.lit(n).alias("late")) for d, n in measured]))
    keyed = versions.where("event_date is not null").groupBy("source_record_key").agg(told).select("*", days.alias("m")).select("source_record_key", "told", "m.*")

    def known(v: Column) -> Column:
        return (F.to_date(v["knowledge_valid_from"] + F.make_dt_interval("late")) <= F.col("data_as_of")) & (F.date_add(v["reported_date"], F.col("late")) <= F.col("data_as_of"))

    def backwards(v: Column) -> Column:
        return known(v) & (F.date_add(v["reported_date"], F.col("late")) < v["event_date"])

    # most records have one version, for which no list has to be looked through
    alone, only, seen = F.size("told") == 1, F.get("told", F.lit(0)), F.filter("told", known)
    earliest = F.filter(seen, lambda v: v["knowledge_valid_from"] == F.array_min(seen)["knowledge_valid_from"])
    own = keyed.select(
        "source_record_key", "data_as_of", "late", F.when(alone, F.when(known(only), only)).otherwise(F.array_min(seen)).alias("first"),
        F.when(alone, backwards(only)).otherwise(F.exists("told", backwards)).alias("backwards"),
        F.when(alone, F.lit(False)).otherwise(~F.array_min(earliest).eqNullSafe(F.array_max(earliest))).alias("clash"),
    )
    own = own.where("first is not null").select("source_record_key", "data_as_of", "late", "backwards", "clash", "first.*")
    own = own.withColumns({"reported_date": F.date_add("reported_date", F.col("late")), "event_month": F.trunc("event_date", "MM")})
    cohorts = [cohort_months(spark, d, COHORTS, GRACE_MONTHS).select("event_month", F.lit(d).alias("data_as_of"), F.lit(True).alias("mature")) for d, _ in measured]
    own = own.join(F.broadcast(functools.reduce(DataFrame.unionByName, cohorts)), ["data_as_of", "event_month"], "left")
    mine = F.col("mature").isNotNull() & F.col("usdot_number").isNotNull()
    guards = {"backwards": F.col("backwards"), "clash": F.col("clash"), "partial": F.col("usdot_number").isNotNull() & ~_whole()}
    by = ("data_as_of", mine.alias("mine"), *[F.when(mine, F.col(c)).alias(c) for c in INCIDENT])
    chosen = own.groupBy(*by).agg(F.min(_best()).alias("best"), *[F.max(g).alias(n) for n, g in guards.items()])
    counted = F.col("mine") & F.col("best.federal_recordable") & ~F.col("best.is_deleted")
    month, lag = F.when(counted, F.trunc("event_date", "MM")), F.when(counted, F.datediff("best.reported_date", "event_date"))
    found = staged(chosen.groupBy("data_as_of", month.alias("event_month"), lag.alias("lag_days")).agg(F.count("*").alias("n"), *[F.max(n).alias(n) for n in guards]))
    _refuse(found.agg(*[F.max(n) for n in guards]).first())
    return found.where("event_month is not null").select("data_as_of", "event_month", "lag_days", "n")


def cohort_quantiles(histogram: DataFrame) -> DataFrame:
    """event_month, incident_count, p995_days (linear between ranks)."""
    return histogram.groupBy("event_month").agg(
        F.sum("n").alias("incident_count"), F.percentile("lag_days", F.lit(QUANTILE), F.col("n")).alias("p995_days")
    )


def order_bounds(histogram: DataFrame) -> DataFrame:
    """event_month, incident_count, low_95_days, high_95_days: between which a drawn bound (`maturity_bound`) lies, without draws.

    Of n lags drawn with replacement, the k-th is at most v if at least k of them are: a binomial tail with F(v), the share of
    lags up to v. The drawn quantile lies between two neighbouring ranks, so its 95th percentile lies between theirs. A tail has
    n - k terms, half a percent of n; they are summed as logarithms.
    """
    month = W.partitionBy("event_month")  # a histogram: some thousand lags
    h = histogram.withColumn("upto", F.sum("n").over(month.orderBy("lag_days"))).withColumn("size", F.sum("n").over(month))
    p = F.col("upto") / F.col("size")
    place = (F.col("size") - 1) * QUANTILE

    def reached(k: Column) -> Column:
        start, odds, n = F.col("size") * F.log(p), F.log((1 - p) / p), F.col("size")

        def add(a: Column, m: Column) -> Column:
            term = a["term"] + F.log((n - m + 1) / m) + odds
            total = F.greatest(a["total"], term) + F.log1p(F.exp(-F.abs(a["total"] - term)))
            return F.struct(term.alias("term"), total.alias("total"))

        missing = n - k
        terms = F.when(missing > 0, F.sequence(F.lit(1).cast("bigint"), missing)).otherwise(F.array().cast("array<bigint>"))
        tail = F.aggregate(terms, F.struct(start.alias("term"), start.alias("total")), add, lambda a: F.exp(a["total"]))
        return F.when(F.col("upto") == n, F.lit(1.0)).otherwise(tail) >= CONFIDENCE

    ranks = {"low_95_days": F.floor(place) + 1, "high_95_days": F.ceil(place) + 1}
    h = h.select("event_month", "size", "lag_days", *[F.when(reached(k), F.col("lag_days")).alias(name) for name, k in ranks.items()])
    return h.groupBy("event_month").agg(F.max("size").alias("incident_count"), *[F.min(name).alias(name) for name in ranks])


def policy_rows(measurements: DataFrame) -> DataFrame:
    """The policy after each measurement (data_as_of, measured_grace_days or null, reviewed_decrease), one after the other.

    Adds version, previous_version, grace_days, status, is_current. A measurement that is incomplete leaves the former
    grace in force; so does a decrease, until one is reviewed. One row a measurement, a few a year.
    """
    made = F.array_sort(F.collect_list(F.struct("data_as_of", "measured_grace_days", "reviewed_decrease"))).alias("all")
    kind = "array<struct<data_as_of:date,measured_grace_days:int,reviewed_decrease:boolean,grace_days:int,status:string,before:date>>"

    def fold(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        grace = F.when(F.size(done) > 0, last["grace_days"])
        m = x["measured_grace_days"]
        held = F.coalesce((m < grace) & ~x["reviewed_decrease"], F.lit(False))
        status = F.when(m.isNull(), "incomplete").when(held, "decrease_pending_review").otherwise("measured")
        now = F.when(m.isNull() | held, grace).otherwise(m)
        row = F.struct(x["data_as_of"], m, x["reviewed_decrease"], now.alias("grace_days"), status.alias("status"), F.when(F.size(done) > 0, last["data_as_of"]).alias("before"))
        return F.concat(done, F.array(row).cast(kind))

    cast = measurements.select("data_as_of", F.col("measured_grace_days").cast("int").alias("measured_grace_days"), "reviewed_decrease")
    rows = cast.agg(made).select(F.explode(F.aggregate("all", F.array().cast(kind), fold)).alias("r"), F.element_at("all", -1)["data_as_of"].alias("newest"))
    name = lambda d: F.concat(F.lit("maturity-"), F.date_format(d, "yyyy-MM-dd"))
    return rows.select(
        name("r.data_as_of").alias("version"), F.when(F.col("r.before").isNotNull(), name("r.before")).alias("previous_version"), "r.data_as_of",
        "r.measured_grace_days", "r.grace_days", "r.status", "r.reviewed_decrease", (F.col("r.data_as_of") == F.col("newest")).alias("is_current"),
    )


def measured_grace(bounds: DataFrame, upper: str) -> DataFrame:
    """data_as_of, measured_grace_days of bounds (data_as_of, event_month, ...): the largest in whole days, null unless all cohorts are there."""
    top = F.when(F.count(upper) == COHORTS, F.ceil(F.max(upper))).cast("int")
    return bounds.groupBy("data_as_of").agg(top.alias("measured_grace_days"))


def _replicate(seed: int, replicates: int, chunk: int):
    """Bootstrap quantiles of one cohort: each replicate is a multinomial draw over the lag histogram."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        month, part = key[0], int(key[1])
        pdf = pdf.sort_values("lag_days")
        values, counts = pdf["lag_days"].to_numpy(np.int64), pdf["n"].to_numpy(np.int64)
        size = int(counts.sum())
        dice = np.random.Generator(np.random.PCG64(np.random.SeedSequence([seed, month.toordinal(), part])))
        n = min(chunk, replicates - part * chunk)
        reached = np.cumsum(dice.multinomial(size, counts / size, size=n), axis=1)
        place = (size - 1) * QUANTILE
        low = values[(reached > math.floor(place)).argmax(1)]
        high = values[(reached > math.ceil(place)).argmax(1)]
        return pd.DataFrame({"event_month": month, "q": low + (high - low) * (place - math.floor(place))})

    return run


def maturity_bound(histogram: DataFrame, seed: int = 20260911, replicates: int = 2000, chunk: int = 500) -> DataFrame:
    """event_month, incident_count, p995_days, upper_95_days.

    Only histograms meet (one row a cohort and lag), and replicates are dealt in chunks, each with a
    seed of its own, so that the draw does not depend on where a chunk runs.
    """
    parts = F.explode(F.sequence(F.lit(0), F.lit((replicates - 1) // chunk))).alias("part")
    drawn = histogram.select("event_month", "lag_days", "n", parts).groupBy("event_month", "part")
    q = drawn.applyInPandas(_replicate(seed, replicates, chunk), "event_month date, q double")
    upper = q.groupBy("event_month").agg(F.percentile("q", F.lit(CONFIDENCE)).alias("upper_95_days"))
    return cohort_quantiles(histogram).join(upper, "event_month")


def policy(cohorts: DataFrame, source_complete: bool = True, previous_grace: int | None = None, reviewed_decrease: bool = False) -> dict:
    """measured_grace_days, grace_days and status from the cohorts' bounds (twelve rows).

    A missing cohort leaves the former grace in force; a decrease waits for review.
    """
    n, top = cohorts.agg(F.count("upper_95_days"), F.max("upper_95_days")).first()
    measured = math.ceil(top) if source_complete and n == COHORTS else None
    if measured is None:
        return {"measured_grace_days": None, "grace_days": previous_grace, "status": "incomplete"}
    if previous_grace is not None and measured < previous_grace and not reviewed_decrease:
        return {"measured_grace_days": measured, "grace_days": previous_grace, "status": "decrease_pending_review"}
    return {"measured_grace_days": measured, "grace_days": measured, "status": "measured"}


def _add_months(d: date, months: int) -> date:
    y, m = divmod(d.year * 12 + d.month - 1 + months, 12)
    last = (date(y + (m == 11), (m + 1) % 12 + 1, 1) - timedelta(days=1)).day
    return date(y, m + 1, min(d.day, last))


def training_eligibility(found: dict | None, data_as_of: date, label_window_end: date) -> str:
    """Why a label window may not be trained on, or "eligible"."""
    if found is None:
        return "maturity_unmeasured"
    if found.get("status") not in ("measured", "incomplete", "decrease_pending_review"):
        return "maturity_invalid"
    grace = found.get("grace_days")
    if found["status"] == "incomplete" or grace is None:
        return "maturity_incomplete"
    if grace > (_add_months(label_window_end, GRACE_MONTHS) - label_window_end).days:
        return "grace_exceeds_nine_calendar_months"
    if label_window_end + timedelta(days=grace) > data_as_of:
        return "labels_not_mature"
    return "eligible"


def window_eligibility(rows: DataFrame) -> DataFrame:
    """rows (status, grace_days, data_as_of, label_window_end, ...) with reason: `training_eligibility` of each, as a column."""
    grace, end = F.col("grace_days"), F.col("label_window_end")
    known = F.col("status").isin("measured", "incomplete", "decrease_pending_review")
    reason = (
        F.when(F.col("status").isNull(), "maturity_unmeasured")
        .when(~known, "maturity_invalid")
        .when((F.col("status") == "incomplete") | grace.isNull(), "maturity_incomplete")
        .when(grace > F.datediff(F.add_months(end, GRACE_MONTHS), end), "grace_exceeds_nine_calendar_months")
        .when(F.date_add(end, grace) > F.col("data_as_of"), "labels_not_mature")
        .otherwise("eligible")
    )
    return rows.withColumn("reason", reason)


def watermark_violations(cohorts: DataFrame, grace_days: int | None, measured: int | None, status: str) -> DataFrame:
    """(rule, violations) of a stored measurement: twelve contiguous months, grace = ceil(max), consistent status."""
    order = W.orderBy("event_month")  # twelve rows
    steps = cohorts.withColumn("before", F.lag("event_month").over(order))
    top = cohorts.agg(F.ceil(F.max("upper_95_days")).alias("top"), F.count("*").alias("n"), F.count_if(F.col("incident_count") <= 0).alias("empty")).first()
    gaps = steps.where("before is not null and event_month <> add_months(before, 1)").count()
    rules = {
        "twelve_cohorts": int(top["n"] != COHORTS),
        "contiguous_months": gaps,
        "no_empty_cohort": int(status == "measured" and top["empty"] > 0),
        "measured_is_ceiling": int(measured is not None and measured != top["top"]),
        "measured_status": int(status == "measured" and grace_days != measured),
        "incomplete_status": int(status == "incomplete" and measured is not None),
        "pending_status": int(status == "decrease_pending_review" and not (measured is not None and grace_days is not None and measured < grace_days)),
    }
    spark: SparkSession = cohorts.sparkSession
    return spark.createDataFrame([(k, int(v)) for k, v in rules.items()], "rule string, violations bigint")


METADATA = "struct<version:string,data_as_of:date,grace_days:int,quantile:double,confidence:double,sample_size:bigint,cohorts:array<struct<event_month:date,incident_count:bigint>>>"


def metadata_violations(registry: DataFrame) -> DataFrame:
    """(rule, violations) of a registry against the JSON it was written from.

    registry: version, data_as_of, grace_days, quantile, confidence, sample_size, cohort_start, cohort_end, is_current, metadata.
    """
    df = registry.withColumn("m", F.from_json("metadata", METADATA)).withColumn("months", F.col("m.cohorts.event_month"))
    differs = lambda c: ~F.col(c).eqNullSafe(F.col(f"m.{c}"))
    not_ = lambda a, b: ~F.coalesce(a == b, F.lit(False))
    start, end, as_of = F.col("cohort_start"), F.col("cohort_end"), F.col("data_as_of")
    in_order = F.transform(F.sequence(F.lit(0), F.lit(COHORTS - 1)), lambda i: F.add_months(start, i))
    sampled = F.aggregate("m.cohorts", F.lit(0).cast("bigint"), lambda a, x: a + x["incident_count"])
    whole = lambda months: F.add_months(F.last_day(F.add_months(end, months)), GRACE_MONTHS)
    rules = {
        "version": differs("version"), "data_as_of": differs("data_as_of"), "grace_days": differs("grace_days"),
        "quantile": differs("quantile") | not_(F.col("quantile"), F.lit(QUANTILE)), "confidence": differs("confidence") | not_(F.col("confidence"), F.lit(CONFIDENCE)),
        "sample_size": differs("sample_size") | not_(F.col("sample_size"), sampled),
        "cohort_count": not_(F.size("months"), F.lit(COHORTS)),
        "cohort_months": not_(F.col("months"), in_order) | not_(F.trunc(start, "MM"), start),
        "cohort_end": not_(F.add_months(start, COHORTS - 1), end),
        "latest_mature": ~F.coalesce((whole(0) <= as_of) & (whole(1) > as_of), F.lit(False)),
    }
    sums = df.agg(*[F.count_if(c).alias(n) for n, c in rules.items()], F.count_if("is_current").alias("current"))
    every = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations")) for n in rules], F.struct(F.lit("single_current").alias("rule"), (F.col("current") != 1).cast("bigint").alias("violations")))
    return sums.select(F.explode(every).alias("x")).select("x.*")


def registry_violations(registry: DataFrame) -> DataFrame:
    """(rule, violations) of a registry of measurements: version, previous_version, data_as_of, grace_days, reviewed_decrease, is_current."""
    before = registry.select(F.col("version").alias("v"), F.col("data_as_of").alias("before_as_of"), F.col("grace_days").alias("before_grace"))
    linked = registry.join(before, F.col("previous_version") == F.col("v"), "left")
    current = registry.agg(F.count_if("is_current").alias("n"))
    rules = [
        current.select(F.lit("single_current").alias("rule"), (F.col("n") != 1).cast("bigint").alias("violations")),
        linked.agg(F.count_if(F.col("previous_version").isNotNull() & F.col("v").isNull()).alias("violations")).select(F.lit("names_predecessor").alias("rule"), "violations"),
        linked.agg(F.count_if(F.col("data_as_of") < F.col("before_as_of")).alias("violations")).select(F.lit("no_backwards_date").alias("rule"), "violations"),
        linked.agg(F.count_if((F.col("grace_days") < F.col("before_grace")) & ~F.col("reviewed_decrease")).alias("violations")).select(F.lit("no_unreviewed_decrease").alias("rule"), "violations"),
    ]
    out = rules[0]
    for r in rules[1:]:
        out = out.unionByName(r)
    return out


