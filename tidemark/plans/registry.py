"""Registered queries by name, with DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import jobs, jobs_more
from tidemark.plans.sql import ctes
from tidemark.plans.sql_checks import CHECKS
from tidemark.plans.sql_measured import MEASURED
from tidemark.plans.sql_more import MORE
from tidemark.plans.sql_spoiled import SPOILED

_NAMES = (
    "parse_scalars incident_keys clean_inspections clean_crashes quarantine exclusion_counts event_versions retention_expiries events_union "
    "incident_segments current_events scoring_grid features_6m_24m reconcile_snapshot report_lag_profile report_lag_approx lag_histogram "
    "latency_percentiles json_positions event_arrivals landmark_features source_event_counts cohort_months mature_grid first_incident_reports "
    "cohort_lag_quantiles maturity_bound labels purged_split availability_mix population_diff dataset_fingerprint average_precision "
    "model_comparison f1_threshold confusion boosted_scores batch_decisions history_violations publication_violations contract_violations replay_identity "
    "source_events features_recomputed encoding_violations landmark_violations inspection_identity boosted_holdout rate_holdout batch_scores "
    "incremental_history incremental_expiries arrived_history arrived_rows backfill_counts applied_batches maturity_exclusions provenance event_rejects csv_audit csv_records lag_sketches maturity_order_bounds maturity_policy maturity_policy_violations batch_decisions_dates derived_reconciliation"
).split()
_RENAMED = {"event_versions": jobs.versions}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {n: _RENAMED.get(n) or getattr(jobs, n) for n in _NAMES}
QUERIES["change_candidates"] = jobs.candidates
QUERIES |= {n: getattr(jobs_more, n) for n in jobs_more.NAMES}

_VERSION_COLUMNS = """feed_name, source_record_key, event_date, reported_date, knowledge_valid_from, knowledge_valid_to, availability_quality,
first_observed_at, is_deleted, deletion_reason, is_current, first_seen AS first_seen_batch_id, last_seen AS last_seen_batch_id, event_type, usdot_number,
source_add_at, source_change_at, is_model_eligible, exclusion_reason, record_hash, state, violation_count, oos_violation_count, report_state,
report_number, report_time, report_seq_no, fatalities, injuries, tow_away, event_version_key,
lag(event_version_key) OVER w AS predecessor_version_key, lead(event_version_key) OVER w AS superseded_by_version_key"""

ORACLE: dict[str, str] = {
    "clean_inspections": ctes("clean_inspections") + "SELECT * FROM clean_inspections",
    "clean_crashes": ctes("clean_crashes") + "SELECT * FROM clean_crashes",
    "change_candidates": ctes("candidates") + "SELECT * FROM candidates",
    "quarantine": ctes("candidates")
    + """SELECT batch_id, source_row_number, feed_name, source_record_key, parse_reasons FROM clean_inspections WHERE len(parse_reasons) > 0
UNION ALL SELECT batch_id, source_row_number, feed_name, source_record_key, parse_reasons FROM clean_crashes WHERE len(parse_reasons) > 0""",
    "exclusion_counts": ctes("candidates")
    + """SELECT feed_name, coalesce(exclusion_reason, 'other') AS exclusion_reason, count(*) AS n_rows, count(DISTINCT source_record_key) AS n_keys
FROM candidates WHERE NOT is_model_eligible GROUP BY ALL""",
    "event_versions": ctes("versions")
    + f"SELECT {_VERSION_COLUMNS} FROM versions WINDOW w AS (PARTITION BY feed_name, source_record_key ORDER BY first_observed_at, is_deleted)",
    "incremental_history": ctes("versions")
    + f"SELECT {_VERSION_COLUMNS} FROM versions WINDOW w AS (PARTITION BY feed_name, source_record_key ORDER BY first_observed_at, is_deleted)",
    "arrived_history": ctes("versions")
    + f"SELECT {_VERSION_COLUMNS} FROM versions WINDOW w AS (PARTITION BY feed_name, source_record_key ORDER BY first_observed_at, is_deleted)",
    "backfill_counts": ctes("raw_crashes")
    + f"""SELECT strftime(observed_at, '%Y-%m-%d') AS acquisition_date, count(*) AS n_rows, count(DISTINCT crash_id) AS n_keys, max(add_date) AS latest
FROM raw_crashes JOIN batches USING (batch_id) WHERE observed_at::DATE BETWEEN DATE '{jobs.BACKFILL[1]}' AND DATE '{jobs.BACKFILL[2]}' GROUP BY ALL""",
    "arrived_rows": ctes("raw_inspections", "raw_crashes")
    + """SELECT batch_id, count(*) AS n_rows, count(DISTINCT k) AS n_keys
FROM (SELECT batch_id, inspection_id AS k FROM raw_inspections UNION ALL SELECT batch_id, crash_id FROM raw_crashes) GROUP BY ALL""",
    "incremental_expiries": ctes("i_expired")
    + """SELECT source_record_key, batch_id, md5(concat_ws('|', first_seen, 'inspections', source_record_key, 'false')) AS event_version_key,
observed_at, retention_cutoff FROM i_expired""",
    "retention_expiries": ctes("i_expired")
    + """SELECT source_record_key, batch_id, md5(concat_ws('|', first_seen, 'inspections', source_record_key, 'false')) AS event_version_key,
observed_at, retention_cutoff FROM i_expired""",
    "events_union": ctes("union_events") + "SELECT * FROM union_events",
    "incident_segments": ctes("incidents") + "SELECT * FROM incidents",
    "current_events": ctes("union_events", "incidents")
    + """SELECT * FROM union_events WHERE is_current AND NOT is_deleted AND event_type = 'inspection'
UNION ALL SELECT event_key, event_version_key, 'crash', carrier_crash_key, usdot_number, event_date, reported_date, report_lag_days, state, NULL, NULL,
fatalities, injuries, tow_away, knowledge_valid_from, knowledge_valid_to, is_current, is_deleted, deletion_reason, record_hash
FROM incidents WHERE is_current AND NOT is_deleted""",
    "scoring_grid": """SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH))::DATE
AS scoring_date FROM orders""",
    "features_6m_24m": ctes("features") + "SELECT * REPLACE (violations_per_inspection::DOUBLE AS violations_per_inspection, oos_violation_rate::DOUBLE AS oos_violation_rate) FROM features",
} | MORE | CHECKS | MEASURED | SPOILED
