"""Point-in-time features on a monthly grid.

A feature of month start t may use an event only if it happened before t, was reported before t
and its version is known at t; all bounds are strict. The interval join of events and months is
rewritten: an event can serve only the few month starts after it, so it is exploded to those
(at most 6 or 24) and the join becomes an aggregation by (carrier, month).
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.keys import ratio
from tidemark.operators.history import visible_at


def month_grid(batches: DataFrame) -> DataFrame:
    """scoring_date: the month starts from the first to the last applied batch."""
    ends = batches.agg(F.trunc(F.min("observed_at"), "MM").alias("a"), F.trunc(F.max("observed_at"), "MM").alias("b"))
    return ends.where("a is not null").select(F.explode(F.sequence("a", "b", F.expr("interval 1 month"))).alias("scoring_date"))


def _is_month_start(d: object) -> bool:
    try:
        return isinstance(d, str) and date.fromisoformat(d).replace(day=1).isoformat() == d
    except ValueError:
        return False


def explicit_grid(spark: SparkSession, dates: list[str]) -> DataFrame:
    """scoring_date of a list of month starts as text (YYYY-MM-01), one at least."""
    if not isinstance(dates, (list, tuple)) or not dates:
        raise ValueError("a grid takes a list with one month start or more")
    for d in dates:
        if not _is_month_start(d):
            raise ValueError(f"{d!r} is no month start in the form YYYY-MM-01")
    return spark.createDataFrame([(date.fromisoformat(d),) for d in sorted(set(dates))], "scoring_date date")


def mature_grid(
    inspections_start: date, crashes_start: date, observed_through: date, data_as_of: date, grace_days: int, spark: SparkSession
) -> DataFrame:
    """scoring_date of months with whole lookbacks and labels that have matured."""
    ends = spark.range(1).select(
        F.greatest(F.add_months(F.lit(inspections_start), 6), F.add_months(F.lit(crashes_start), 24)).alias("first"),
        F.least(F.lit(observed_through), F.lit(data_as_of)).alias("cutoff"),
    )
    start = F.when(F.trunc("first", "MM") < F.col("first"), F.add_months(F.trunc("first", "MM"), 1)).otherwise(F.col("first"))
    grid = ends.select("cutoff", start.alias("start")).where("start <= cutoff")
    grid = grid.select("cutoff", F.explode(F.sequence("start", "cutoff", F.expr("interval 1 month"))).alias("scoring_date"))
    return grid.where(F.date_add(F.add_months("scoring_date", 6), grace_days) <= F.col("cutoff")).select("scoring_date")


def cohort_months(spark: SparkSession, data_as_of: date, months: int = 12, grace_months: int = 9) -> DataFrame:
    """event_month of the latest months whose reports have had `grace_months` to arrive."""
    back = F.explode(F.sequence(F.lit(0), F.lit(months + grace_months + 2))).alias("i")
    every = spark.range(1).select(back).select(F.add_months(F.trunc(F.lit(data_as_of), "MM"), -F.col("i")).alias("event_month"))
    mature = every.where(F.add_months(F.last_day("event_month"), grace_months) <= F.lit(data_as_of))
    return mature.orderBy(F.desc("event_month")).limit(months)


def served_months(event: Column, reported: Column, months: Column, first: Column, last: Column) -> Column:
    """The month starts in [first, last] at which an event lies in the lookback and was reported before."""
    start = F.greatest(F.add_months(F.trunc(F.greatest(event, reported), "MM"), 1), first)
    end = F.least(F.trunc(F.add_months(event, months), "MM"), last)
    return F.when(start <= end, F.sequence(start, end, F.expr("interval 1 month"))).otherwise(F.array().cast("array<date>"))


#: What features need of an event.
_OF_EVENT = (
    "usdot_number", "event_type", "carrier_crash_key", "event_date", "reported_date", "violation_count", "oos_violation_count", "knowledge_valid_from",
    "knowledge_valid_to", "is_deleted",
)


def at_carriers(events: DataFrame, *columns: str) -> DataFrame:
    """Events at their carriers: they are moved once and as they are, not once a month that they serve; what is made of a carrier's months stays there."""
    return events.select(*columns).repartition("usdot_number")


def outcome_months(event: Column, months: int = 6) -> Column:
    """Month starts t with t <= event < t + months."""
    last = F.trunc(event, "MM")
    return F.sequence(F.add_months(last, -(months - 1)), last, F.expr("interval 1 month"))


def _at_grid(events: DataFrame, grid: DataFrame, months: Column, outcome: Column) -> DataFrame:
    """Living events at each month they serve, as known then (known), and those that are outcomes at each month they count for (not known)."""
    ends = grid.agg(F.min("scoring_date"), F.max("scoring_date")).first()  # two dates
    first, last = F.lit(ends[0]).cast("date"), F.lit(ends[1]).cast("date")
    none = F.array().cast("array<date>")
    served = F.coalesce(F.when(~F.col("is_deleted"), served_months(F.col("event_date"), F.col("reported_date"), months, first, last)), none)
    due = F.coalesce(F.when(outcome, outcome_months(F.col("event_date"))), none)
    told = lambda known: lambda t: F.struct(t.alias("scoring_date"), F.lit(known).alias("known"))
    at = events.withColumn("m", F.explode(F.concat(F.transform(served, told(True)), F.transform(due, told(False))))).select("*", "m.*").drop("m")
    at = at.where(~F.col("known") | visible_at(F.col("scoring_date").cast("timestamp")))
    # the grid is one row a month
    return at.join(F.broadcast(grid.select("scoring_date").distinct()), "scoring_date", "left_semi")


def training_features(events: DataFrame, grid: DataFrame, outcome: Column | None = None) -> DataFrame:
    """usdot_number, scoring_date and the features of carriers with an inspection in the six months before.

    events: of events_union. outcome: which events count in the six months from scoring_date on; then rows have the number of their
    incidents too (incident_count).
    """
    inspection = F.col("event_type") == "inspection"
    at = at_carriers(events, *_OF_EVENT)
    at = _at_grid(at, grid, F.when(inspection, 6).otherwise(24), F.lit(False) if outcome is None else F.coalesce(outcome, F.lit(False)))
    # vehicles of one incident collapse before they are counted
    once = at.groupBy("usdot_number", "scoring_date", F.coalesce("carrier_crash_key", F.lit("")).alias("incident")).agg(
        F.count_if(inspection & F.col("known")).alias("n"),
        F.sum(F.when(inspection, F.col("violation_count"))).alias("v"),
        F.sum(F.when(inspection, F.col("oos_violation_count"))).alias("o"),
        F.max(F.when(inspection, F.col("event_date"))).alias("last"),
        F.bool_or("known").alias("known"),
        F.bool_or(~F.col("known")).alias("hit"),
    )
    wide = once.groupBy("usdot_number", "scoring_date").agg(
        F.sum("n").alias("inspections_6m"),
        F.coalesce(F.sum("v"), F.lit(0)).cast("bigint").alias("violations_6m"),
        F.coalesce(F.sum("o"), F.lit(0)).cast("bigint").alias("oos_violations_6m"),
        F.count_if((F.col("incident") != "") & F.col("known")).alias("crashes_24m"),
        F.max("last").alias("last_inspection_date"),
        F.count_if("hit").alias("incident_count"),
    )
    return wide.where("inspections_6m > 0").select(
        "usdot_number", "scoring_date", "inspections_6m", "violations_6m", "oos_violations_6m", "crashes_24m",
        ratio(F.col("violations_6m"), F.col("inspections_6m")).alias("violations_per_inspection"),
        ratio(F.col("oos_violations_6m"), F.col("violations_6m")).alias("oos_violation_rate"),
        F.datediff("scoring_date", "last_inspection_date").alias("days_since_last_inspection"), "last_inspection_date",
        *([] if outcome is None else ["incident_count"]),
    )


def recomputed_features(events: DataFrame, grid: DataFrame) -> DataFrame:
    """The features once more by the plain interval join of events and months; for checks, not for use at scale."""
    t = F.col("scoring_date")
    inspection = F.col("event_type") == "inspection"
    back = F.when(inspection, F.add_months(t, -6)).otherwise(F.add_months(t, -24))
    seen = at_carriers(events.where("not is_deleted"), *_OF_EVENT).join(
        F.broadcast(grid.select("scoring_date").distinct()),
        (F.col("event_date") < t) & (F.col("reported_date") < t) & (F.col("event_date") >= back) & visible_at(t.cast("timestamp")),
    )
    whole = lambda c: F.coalesce(F.sum(F.when(inspection, F.col(c))), F.lit(0)).cast("bigint").alias(f"{c}s")
    wide = seen.groupBy("usdot_number", "scoring_date").agg(
        F.count_if(inspection).alias("inspections_6m"), whole("violation_count"), whole("oos_violation_count"),
        F.countDistinct(F.when(~inspection, F.col("carrier_crash_key"))).alias("crashes_24m"), F.max(F.when(inspection, F.col("event_date"))).alias("last_inspection_date"),
    )
    wide = wide.where("inspections_6m > 0").withColumnsRenamed({"violation_counts": "violations_6m", "oos_violation_counts": "oos_violations_6m"})
    return wide.select(
        "usdot_number", "scoring_date", "inspections_6m", "violations_6m", "oos_violations_6m", "crashes_24m",
        ratio(F.col("violations_6m"), F.col("inspections_6m")).alias("violations_per_inspection"),
        ratio(F.col("oos_violations_6m"), F.col("violations_6m")).alias("oos_violation_rate"),
        F.datediff("scoring_date", "last_inspection_date").alias("days_since_last_inspection"), "last_inspection_date",
    )


def feature_differences(stored: DataFrame, expected: DataFrame) -> DataFrame:
    """(side, n): carrier-months that only one side has, and those of both whose values differ."""
    keys, values = ["usdot_number", "scoring_date"], [c for c in expected.columns if c not in ("usdot_number", "scoring_date")]
    a = stored.select(*keys, F.struct(*values).alias("a"))
    b = expected.select(*keys, F.struct(*values).alias("b"))
    both = a.join(b, keys, "full")
    side = F.when(F.col("b").isNull(), "stored_only").when(F.col("a").isNull(), "expected_only").when(~F.col("a").eqNullSafe(F.col("b")), "values")
    sums = both.select(side.alias("side")).agg(*[F.count_if(F.col("side") == s).alias(s) for s in ("stored_only", "expected_only", "values")])
    return sums.select(F.explode(F.array(*[F.struct(F.lit(s).alias("side"), F.col(s).alias("n")) for s in sums.columns])).alias("x")).select("x.*")


def landmark_violations(rows: DataFrame, unlabelled_from: str) -> DataFrame:
    """(rule, violations) of landmark features: bounds, rates exactly where there are violations, labels exactly before a day."""
    c, late = F.col, F.col("scoring_date") >= F.lit(unlabelled_from).cast("date")
    rules = {
        "inspections": c("inspections_4m") < 1,
        "counts": F.least("violations_4m", "oos_violations_4m", "crashes_24m") < 0,
        "days": c("days_since_last_inspection") < 1,
        "rate": (c("violations_4m") == 0) == c("oos_violation_rate").isNotNull(),
        "label": late == c("label").isNotNull(),
    }
    sums = rows.agg(*[F.count_if(F.coalesce(x, F.lit(True))).alias(n) for n, x in rules.items()])
    return sums.select(F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations")) for n in rules])).alias("x")).select("x.*")


def landmark_features(events: DataFrame, landmarks: list[str], unlabelled_from: str, reported_before: str) -> DataFrame:
    """Features and labels at a few fixed dates from flat events.

    events: event_type, source_key, usdot_number, event_date, reported_date, violation_count,
    oos_violation_count, federal_recordable. Landmarks are a handful, so events are exploded to them.
    """
    marks = F.array(*[F.lit(d).cast("date") for d in landmarks])
    mine = lambda ok: F.explode(F.filter(marks, ok)).alias("scoring_date")
    seen = events.where("event_type = 'inspection'").select("source_key", "usdot_number", "event_date", "reported_date", "violation_count", "oos_violation_count").distinct()
    seen = seen.select("*", mine(lambda t: (F.col("event_date") >= F.add_months(t, -4)) & (F.col("event_date") < t) & (F.col("reported_date") < t)))
    features = seen.groupBy("usdot_number", "scoring_date").agg(
        F.count("*").alias("inspections_4m"),
        F.sum("violation_count").cast("bigint").alias("violations_4m"),
        F.sum("oos_violation_count").cast("bigint").alias("oos_violations_4m"),
        F.max("event_date").alias("last_inspection_date"),
    )
    known = (
        events.where("event_type = 'crash'")
        .groupBy("source_key", "usdot_number", "event_date")
        .agg(F.min("reported_date").alias("first_reported"), F.max(F.col("federal_recordable").cast("int")).alias("recordable"))
    )
    before = lambda t: (F.col("event_date") >= F.add_months(t, -24)) & (F.col("event_date") < t) & (F.col("first_reported") < t)
    after = lambda t: (
        (F.col("event_date") >= t)
        & (F.col("event_date") < F.add_months(t, 6))
        & (F.col("first_reported") < F.lit(reported_before).cast("date"))
        & (F.col("recordable") == 1)
    )
    counted = known.select("usdot_number", F.col("source_key").isNotNull().alias("keyed"), mine(before)).groupBy("usdot_number", "scoring_date").agg(F.count_if("keyed").alias("crashes_24m"))
    outcome = known.select("usdot_number", F.col("source_key").isNotNull().alias("keyed"), mine(after)).groupBy("usdot_number", "scoring_date").agg(F.max(F.col("keyed").cast("int")).alias("hit"))
    wide = features.join(counted, ["usdot_number", "scoring_date"], "left").join(outcome, ["usdot_number", "scoring_date"], "left")
    return wide.select(
        "usdot_number", "scoring_date", "inspections_4m", "violations_4m", "oos_violations_4m",
        F.coalesce("crashes_24m", F.lit(0)).cast("bigint").alias("crashes_24m"),
        ratio(F.col("violations_4m"), F.col("inspections_4m")).alias("violations_per_inspection"),
        ratio(F.col("oos_violations_4m"), F.col("violations_4m")).alias("oos_violation_rate"),
        F.datediff("scoring_date", "last_inspection_date").alias("days_since_last_inspection"),
        F.when(F.col("scoring_date") < F.lit(unlabelled_from).cast("date"), F.coalesce("hit", F.lit(0))).alias("label"),
    )
