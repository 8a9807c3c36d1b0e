"""Projections of the history: inspections, crash vehicles, incidents and current events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.keys import UNIT, incident_key

UNION = (
    "event_key", "event_version_key", "event_type", "carrier_crash_key", "usdot_number", "event_date", "reported_date",
    "report_lag_days", "state", "violation_count", "oos_violation_count", "fatalities", "injuries", "tow_away",
    "knowledge_valid_from", "knowledge_valid_to", "is_current", "is_deleted", "deletion_reason", "record_hash",
)
#: Those of UNION that features, labels and provenance need.
EVENT = (
    "event_version_key", "event_type", "carrier_crash_key", "usdot_number", "event_date", "reported_date", "violation_count", "oos_violation_count",
    "knowledge_valid_from", "knowledge_valid_to", "is_deleted", "availability_quality",
)


def _event_key() -> F.Column:
    return F.md5(F.concat_ws("|", "feed_name", "source_record_key"))


def crashes(versions: DataFrame) -> DataFrame:
    """Eligible crash vehicle versions with the key of their incident."""
    v = versions.where("feed_name = 'crashes' and is_model_eligible").drop("state").withColumnRenamed("report_state", "state")
    key = incident_key(*[F.col(c) for c in ("usdot_number", "state", "report_number", "event_date", "report_time")])
    return v.select("*", _event_key().alias("event_key"), F.datediff("reported_date", "event_date").alias("report_lag_days"), key.alias("carrier_crash_key"))


def events_union(versions: DataFrame, columns: tuple[str, ...] = UNION) -> DataFrame:
    """Both feeds in one shape, in one pass. Vehicles stay apart: both clocks apply before incidents are formed."""
    crash = F.col("feed_name") == "crashes"
    key = incident_key(*[F.col(c) for c in ("usdot_number", "report_state", "report_number", "event_date", "report_time")])
    made = {
        "event_key": _event_key(),
        "event_type": F.when(crash, "crash").otherwise("inspection"),
        "carrier_crash_key": F.when(crash, key),
        "report_lag_days": F.datediff("reported_date", "event_date"),
        "state": F.when(crash, F.col("report_state")).otherwise(F.col("state")),
    }
    made |= {c: F.when(crash, F.col(c)) for c in ("fatalities", "injuries", "tow_away")}
    made |= {c: F.when(~crash, F.col(c)) for c in ("violation_count", "oos_violation_count")}
    return versions.where("is_model_eligible").select(*[made.get(c, F.col(c)).alias(c) for c in columns])


def crash_incidents(versions: DataFrame) -> DataFrame:
    """One row for each incident and stretch of time in which what is known of its vehicles stays the same.

    Boundaries and vehicles meet within one incident key, so the range join is as wide as the
    incident has vehicle versions.
    """
    return segments(crashes(versions))


#: What segments need of a vehicle version (`crashes`).
VEHICLE = (
    "carrier_crash_key", "usdot_number", "state", "report_number", "report_time", "event_key", "event_version_key", "event_date", "reported_date", "fatalities",
    "injuries", "tow_away", "is_deleted", "deletion_reason", "source_record_key", "record_hash", "knowledge_valid_from", "knowledge_valid_to",
)


def segments(v: DataFrame) -> DataFrame:
    """`crash_incidents` of vehicle versions (VEHICLE)."""
    edges = (
        v.select("carrier_crash_key", F.explode(F.array("knowledge_valid_from", "knowledge_valid_to")).alias("at"))
        .where("at is not null")
        .distinct()
    )
    order = W.partitionBy("carrier_crash_key").orderBy("at")
    stretches = edges.select(F.col("carrier_crash_key").alias("k"), F.col("at").alias("seg_from"), F.lead("at").over(order).alias("seg_to"))
    covers = (F.col("knowledge_valid_from") <= F.col("seg_from")) & (
        F.col("knowledge_valid_to").isNull() | (F.col("knowledge_valid_to") > F.col("seg_from"))
    )
    active = stretches.join(v, (F.col("k") == F.col("carrier_crash_key")) & covers)
    return _incidents(active)


def _incidents(active: DataFrame) -> DataFrame:
    """One row for each incident and stretch (seg_from, seg_to) of the vehicle versions that hold in it."""
    living = lambda c: F.when(~F.col("is_deleted"), F.col(c))
    grouped = active.groupBy("carrier_crash_key", "usdot_number", "state", "report_number", "report_time", "seg_from", "seg_to").agg(
        F.min("event_key").alias("event_key"),
        F.min("event_version_key").alias("event_version_key"),
        F.min("event_date").alias("event_date"),
        F.max("reported_date").alias("reported_date"),
        F.max(living("fatalities")).alias("fatalities"),
        F.max(living("injuries")).alias("injuries"),
        F.bool_or(living("tow_away")).alias("tow_away"),
        F.bool_and("is_deleted").alias("is_deleted"),
        F.max("deletion_reason").alias("any_reason"),
        # an incident's vehicles are few; their hashes in key order
        F.array_sort(F.collect_list(F.struct("source_record_key", "record_hash"))).alias("hashes"),
    )
    return grouped.select(
        "event_key", "event_version_key", "carrier_crash_key", "usdot_number", "event_date", "reported_date",
        F.datediff("reported_date", "event_date").alias("report_lag_days"), "state", "report_number", "report_time",
        "fatalities", "injuries", "tow_away", F.col("seg_from").alias("knowledge_valid_from"), F.col("seg_to").alias("knowledge_valid_to"),
        F.col("seg_to").isNull().alias("is_current"), "is_deleted", F.when(F.col("is_deleted"), F.col("any_reason")).alias("deletion_reason"),
        F.md5(F.array_join(F.transform("hashes", lambda h: h["record_hash"]), UNIT)).alias("record_hash"),
    )


def current_segments(v: DataFrame) -> DataFrame:
    """The `segments` that last: from the last change of an incident on, what its open versions say. No row is joined."""
    changed = F.max(F.greatest("knowledge_valid_from", "knowledge_valid_to")).over(W.partitionBy("carrier_crash_key"))
    v = v.withColumns({"seg_from": changed, "seg_to": F.lit(None).cast("timestamp")})
    return _incidents(v.where("knowledge_valid_to is null and knowledge_valid_from is not null"))


def current_events(versions: DataFrame) -> DataFrame:
    """Inspections and incidents as they are known now and not deleted. Each feed's versions are read by one of the two parts alone."""
    i = events_union(versions.where("feed_name <> 'crashes' and is_current and not is_deleted"))
    c = current_segments(crashes(versions).select(*VEHICLE)).where("not is_deleted")
    c = c.select(
        *[
            F.lit("crash").alias(n) if n == "event_type" else F.lit(None).cast("bigint").alias(n) if n in ("violation_count", "oos_violation_count") else F.col(n)
            for n in UNION
        ]
    )
    return i.unionByName(c)
