"""DuckDB SQL of sketches, bounds without draws, the maturity policy and as-of decisions on several days."""

from __future__ import annotations

from tidemark.plans import jobs
from tidemark.plans.sql import ctes
from tidemark.plans.sql_more import _BUCKET, _FIRST, _SNAPSHOTS, _VEHICLES

_QS = (0.5, 0.9, 0.95, 0.99, 0.995)
_NAMES = ("p50", "p90", "p95", "p99", "p995")
#: Cells of the sketch: seven significant bits.
_LAGS = """, lagged AS (SELECT feed, acquisition_date, (rep - ev)::BIGINT AS x FROM parsed WHERE rep >= ev),
celled AS (SELECT *, greatest(length(bin(x)) - 7, 0) AS e FROM lagged),
cells AS (SELECT feed, acquisition_date, (x >> e) << e AS low, 1::BIGINT << e AS width, count(*) AS n FROM celled GROUP BY ALL)"""


def _estimates(by: str) -> str:
    return f"""(SELECT {by}, {", ".join(f"min(v) FILTER (reached >= ceil({q}::DOUBLE * total)) AS {n}" for q, n in zip(_QS, _NAMES, strict=True))}, max(total) AS total
  FROM (SELECT {by}, v, sum(n) OVER (PARTITION BY {by} ORDER BY v) AS reached, sum(n) OVER (PARTITION BY {by}) AS total
    FROM (SELECT {by}, low + (width - 1) / 2 AS v, sum(n) AS n FROM cells GROUP BY ALL)) GROUP BY {by})"""


def _bounds(first: str) -> str:
    """(event_month, incident_count, low_95_days, high_95_days) of the lags in `l`."""
    tail = """CASE WHEN upto = size THEN 1.0 ELSE list_sum(list_transform(range(0, size - {k} + 1), lambda m:
    exp(lgamma(size + 1) - lgamma(m + 1) - lgamma(size - m + 1) + m * ln(1 - p) + (size - m) * ln(p)))) END >= 0.95"""
    return f"""{first}, h AS (SELECT event_month, x, sum(n) OVER (PARTITION BY event_month ORDER BY x)::BIGINT AS upto, sum(n) OVER (PARTITION BY event_month)::BIGINT AS size
  FROM (SELECT event_month, x, count(*) AS n FROM l GROUP BY ALL)),
s AS (SELECT *, upto / size AS p, floor((size - 1) * 0.995::DOUBLE)::BIGINT + 1 AS k1, ceil((size - 1) * 0.995::DOUBLE)::BIGINT + 1 AS k2 FROM h)
SELECT event_month, max(size) AS incident_count, min(x) FILTER ({tail.format(k="k1")}) AS low_95_days, min(x) FILTER ({tail.format(k="k2")}) AS high_95_days FROM s GROUP BY event_month"""


def _cohorts(day: str, late: int) -> str:
    """Lags of the mature cohorts as of a day, with reports that come some days later."""
    first = f"""{ctes("vehicle_rows").rstrip()}, {_VEHICLES},
moved AS (SELECT * REPLACE (reported_date + {late} AS reported_date, knowledge_valid_from + INTERVAL {late} DAY AS knowledge_valid_from) FROM vehicles),
first AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY usdot_number, report_state, report_number, event_date, report_time
    ORDER BY knowledge_valid_from, CASE WHEN federal_recordable AND NOT is_deleted THEN 0 WHEN NOT is_deleted THEN 1 ELSE 2 END, reported_date, source_record_key) AS n
  FROM moved WHERE reported_date <= DATE '{day}' AND usdot_number IS NOT NULL) WHERE n = 1),
months AS (SELECT event_month FROM (SELECT (date_trunc('month', DATE '{day}') - to_months(i))::DATE AS event_month FROM (SELECT unnest(range(24)) AS i))
  WHERE (last_day(event_month) + INTERVAL 9 MONTH)::DATE <= DATE '{day}' ORDER BY event_month DESC LIMIT 12),
l AS (SELECT date_trunc('month', event_date)::DATE AS event_month, (reported_date - event_date)::INTEGER AS x FROM first
  WHERE federal_recordable AND NOT is_deleted AND date_trunc('month', event_date)::DATE IN (SELECT event_month FROM months))"""
    return _bounds(first)


_POLICY = "WITH RECURSIVE measured AS (" + " UNION ALL ".join(
    f"""SELECT {i} AS i, DATE '{d}' AS data_as_of, {str(r).lower()} AS reviewed_decrease,
  (SELECT CASE WHEN count(high_95_days) = 12 THEN max(high_95_days) END FROM ({_cohorts(str(d), late)}))::INTEGER AS measured_grace_days"""
    for i, (d, late, r) in enumerate(jobs.MEASURED)
) + """),
told AS (
  SELECT i, data_as_of, NULL::DATE AS before, measured_grace_days, measured_grace_days AS grace_days,
    CASE WHEN measured_grace_days IS NULL THEN 'incomplete' ELSE 'measured' END AS status, reviewed_decrease FROM measured WHERE i = 0
  UNION ALL
  SELECT m.i, m.data_as_of, t.data_as_of, m.measured_grace_days,
    CASE WHEN m.measured_grace_days IS NULL OR coalesce(m.measured_grace_days < t.grace_days AND NOT m.reviewed_decrease, false) THEN t.grace_days ELSE m.measured_grace_days END,
    CASE WHEN m.measured_grace_days IS NULL THEN 'incomplete' WHEN coalesce(m.measured_grace_days < t.grace_days AND NOT m.reviewed_decrease, false) THEN 'decrease_pending_review' ELSE 'measured' END,
    m.reviewed_decrease
  FROM told t JOIN measured m ON m.i = t.i + 1
),
policy AS (SELECT 'maturity-' || data_as_of::VARCHAR AS version, 'maturity-' || before::VARCHAR AS previous_version, data_as_of, measured_grace_days, grace_days, status, reviewed_decrease,
  i = (SELECT max(i) FROM told) AS is_current FROM told)
"""


def _rules(table: str, name: str) -> str:
    linked = f"{table} a LEFT JOIN {table} b ON a.previous_version = b.version"
    return " UNION ALL ".join(
        f"SELECT '{name}' AS registry, '{rule}' AS rule, {what}"
        for rule, what in {
            "single_current": f"(count_if(is_current) <> 1)::BIGINT AS violations FROM {table}",
            "names_predecessor": f"count_if(a.previous_version IS NOT NULL AND b.version IS NULL) AS violations FROM {linked}",
            "no_backwards_date": f"count_if(a.data_as_of < b.data_as_of) AS violations FROM {linked}",
            "no_unreviewed_decrease": f"count_if(a.grace_days < b.grace_days AND NOT a.reviewed_decrease) AS violations FROM {linked}",
        }.items()
    )


_DATES = ", ".join(f"DATE '{d}'" for d in jobs.REQUESTED)

MEASURED: dict[str, str] = {
    "report_lag_approx": _SNAPSHOTS.rstrip() + _LAGS + f""",
summary AS (SELECT feed, acquisition_date, count(*) AS lag_sample_size, min(x)::INTEGER AS minimum_lag_days, max(x)::INTEGER AS maximum_lag_days FROM lagged GROUP BY ALL),
histogram AS (SELECT feed, acquisition_date, {_BUCKET.format(x="x")} AS lag_bucket, count(*) AS lag_bucket_row_count FROM lagged GROUP BY ALL)
SELECT h.feed, h.acquisition_date, manifest_observed_at, manifest_row_count, 'source_proxy' AS availability_quality, s.* EXCLUDE (feed, acquisition_date),
  {", ".join(f"e.{n} AS {n}_lag_days" for n in _NAMES)}, lag_bucket, lag_bucket_row_count, lag_bucket_row_count / lag_sample_size AS lag_bucket_fraction
FROM histogram h JOIN summary s USING (feed, acquisition_date) JOIN {_estimates("feed, acquisition_date")} e USING (feed, acquisition_date) JOIN manifests m USING (feed, acquisition_date)""",
    "lag_sketches": _SNAPSHOTS.rstrip() + _LAGS + f""", e AS {_estimates("feed")},
q AS (SELECT feed, total AS n_rows, unnest([{", ".join(f"{q}::DOUBLE" for q in _QS)}]) AS quantile, unnest([{", ".join(_NAMES)}]) AS estimate FROM e),
t AS (SELECT feed, {", ".join(f"quantile_disc(x, {q}) AS {n}" for q, n in zip(_QS, _NAMES, strict=True))} FROM lagged GROUP BY feed),
x AS (SELECT feed, unnest([{", ".join(f"{q}::DOUBLE" for q in _QS)}]) AS quantile, unnest([{", ".join(_NAMES)}])::INTEGER AS exact FROM t)
SELECT feed, n_rows::BIGINT AS n_rows, quantile, estimate, exact, abs(estimate - exact) <= exact / 128 AS within FROM q JOIN x USING (feed, quantile)""",
    "maturity_order_bounds": _bounds(_FIRST.rstrip() + """, l AS (SELECT date_trunc('month', event_date)::DATE AS event_month, (reported_date - event_date)::INTEGER AS x FROM first
  WHERE federal_recordable AND NOT is_deleted AND date_trunc('month', event_date)::DATE BETWEEN DATE '1999-12-01' AND DATE '2000-11-01')"""),
    "maturity_policy": _POLICY + "SELECT * FROM policy",
    "maturity_policy_violations": _POLICY.rstrip() + f""",
spoiled AS (SELECT * REPLACE (true AS is_current, coalesce(previous_version, 'none') AS previous_version, CASE WHEN is_current THEN DATE '1990-01-01' ELSE data_as_of END AS data_as_of,
  CASE WHEN is_current THEN 1 ELSE grace_days END AS grace_days) FROM policy)
{_rules("policy", "policy")} UNION ALL {_rules("spoiled", "spoiled")}""",
    "batch_decisions_dates": ctes("features").rstrip() + f""",
r AS (SELECT usdot_number, request_date FROM (SELECT DISTINCT (o_custkey + 1)::VARCHAR AS usdot_number FROM orders), (SELECT unnest([{_DATES}]) AS request_date)),
latest AS (SELECT usdot_number, request_date, max(scoring_date) AS scoring_date FROM r JOIN features USING (usdot_number) WHERE scoring_date <= request_date GROUP BY ALL),
has AS (SELECT DISTINCT usdot_number, request_date FROM r JOIN union_events e USING (usdot_number) WHERE event_type = 'inspection' AND NOT is_deleted
  AND event_date >= (request_date - INTERVAL 6 MONTH)::DATE AND event_date < request_date AND reported_date < request_date
  AND knowledge_valid_from < request_date::TIMESTAMP AND (knowledge_valid_to IS NULL OR knowledge_valid_to > request_date::TIMESTAMP))
SELECT r.usdot_number, r.request_date, scoring_date, CASE WHEN has.usdot_number IS NULL THEN 'insufficient_history'
  WHEN scoring_date IS DISTINCT FROM date_trunc('month', r.request_date)::DATE THEN 'features_unavailable' ELSE 'score' END AS decision
FROM r LEFT JOIN latest USING (usdot_number, request_date) LEFT JOIN has USING (usdot_number, request_date)""",
}
