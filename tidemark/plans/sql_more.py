"""DuckDB SQL of the profiling, maturity, dataset, evaluation and check queries."""

from __future__ import annotations

from tidemark.plans.sql import _bool, _date, _id, _integer, _time, _timestamp, ctes, ratio

_BUCKET = """CASE WHEN {x} = 0 THEN '00 same day' WHEN {x} <= 2 THEN '01 1-2 days' WHEN {x} <= 7 THEN '02 3-7 days' WHEN {x} <= 14 THEN '03 8-14 days'
WHEN {x} <= 30 THEN '04 15-30 days' WHEN {x} <= 60 THEN '05 31-60 days' WHEN {x} <= 90 THEN '06 61-90 days' WHEN {x} <= 180 THEN '07 91-180 days'
WHEN {x} <= 270 THEN '08 181-270 days' ELSE '09 271+ days' END"""

_SNAPSHOTS = ctes("raw_inspections", "raw_crashes").rstrip() + f""",
rows AS (SELECT feed_name AS feed, strftime(observed_at, '%Y-%m-%d') AS acquisition_date, e AS raw_e, a AS raw_a
  FROM (SELECT batch_id, insp_date AS e, mcmis_add_date AS a FROM raw_inspections UNION ALL SELECT batch_id, report_date, add_date FROM raw_crashes) JOIN batches USING (batch_id)),
parsed AS (SELECT *, {_date("raw_e")} AS ev, {_timestamp("raw_a")} AS at_, ({_timestamp("raw_a")} + INTERVAL 1 DAY)::DATE AS rep FROM rows),
manifests AS (SELECT feed_name AS feed, strftime(observed_at, '%Y-%m-%d') AS acquisition_date, batch_id, observed_at AS manifest_observed_at, (batch_no * 1000)::BIGINT AS manifest_row_count FROM batches)
"""

_VEHICLES = """vehicles AS (SELECT k::VARCHAR AS source_record_key, CASE WHEN k % 61 <> 0 THEN c::VARCHAR END AS usdot_number, st AS report_state, 'C-' || ok AS report_number,
  d AS event_date, ok % 2400 AS report_time, (d + (1 + p % 90)::INTEGER)::DATE AS reported_date, (d + (1 + p % 90)::INTEGER)::TIMESTAMP AS knowledge_valid_from,
  rf <> 'N' AS federal_recordable, k % 53 = 0 AS is_deleted FROM vehicle_rows)"""

_FIRST = ctes("vehicle_rows").rstrip() + f""",
{_VEHICLES},
first AS (SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY usdot_number, report_state, report_number, event_date, report_time
    ORDER BY knowledge_valid_from, CASE WHEN federal_recordable AND NOT is_deleted THEN 0 WHEN NOT is_deleted THEN 1 ELSE 2 END, reported_date, source_record_key) AS n
  FROM vehicles WHERE reported_date <= DATE '2001-09-05' AND usdot_number IS NOT NULL) WHERE n = 1)
"""

_LABELLED = ctes("features").rstrip() + """,
whole AS (SELECT * FROM features WHERE scoring_date + INTERVAL 6 MONTH <= DATE '2001-09-01'),
outcomes AS (SELECT * FROM crash_versions WHERE knowledge_valid_from < TIMESTAMP '2001-09-01' AND (knowledge_valid_to IS NULL OR knowledge_valid_to > TIMESTAMP '2001-09-01')
  AND reported_date < DATE '2001-09-01' AND NOT is_deleted),
labelled AS (SELECT f.usdot_number, f.scoring_date, count(DISTINCT carrier_crash_key) AS incident_count, (count(carrier_crash_key) > 0)::INTEGER AS label
  FROM whole f LEFT JOIN outcomes o ON o.usdot_number = f.usdot_number AND o.event_date >= f.scoring_date AND o.event_date < f.scoring_date + INTERVAL 6 MONTH GROUP BY ALL)
"""

_SCORES = """WITH scores AS (SELECT (o_orderpriority LIKE '1%')::INTEGER AS label,
  (o_orderkey * 7919) % 1000 / 1000 * 0.7::DOUBLE + (o_orderpriority LIKE '1%')::INTEGER * 0.3::DOUBLE AS candidate, floor(o_totalprice / 1000)::DOUBLE AS baseline,
  (o_orderkey * 104729) % 50 / 50 AS incumbent FROM orders)
"""
_AP = """, melted AS (SELECT label, unnest(['candidate', 'baseline', 'incumbent']) AS model, unnest([candidate, baseline, incumbent]) AS s FROM scores),
steps AS (SELECT model, s, sum(label) AS p, count(*) AS n FROM melted GROUP BY ALL),
cum AS (SELECT model, p, sum(p) OVER w AS tp, sum(n) OVER w AS m, sum(p) OVER (PARTITION BY model) AS pos FROM steps WINDOW w AS (PARTITION BY model ORDER BY s DESC)),
ap AS (SELECT model, sum(p / pos * (tp / m)) AS average_precision FROM cum GROUP BY model)
"""

LANDMARK = ctes("order_rows", "vehicle_rows").rstrip() + f""",
{_VEHICLES},
grid AS (SELECT unnest([DATE '1996-02-01', DATE '1997-09-01', DATE '2001-06-01']) AS t),
insp AS (SELECT c::VARCHAR AS usdot_number, d AS e, (d + (1 + (k - 1) % 60)::INTEGER)::DATE AS r, (k - 1) % 7 AS v, least((k - 1) % 3, (k - 1) % 7) AS o FROM order_rows),
f AS (SELECT usdot_number, t, count(*) AS n, sum(v)::BIGINT AS v, sum(o)::BIGINT AS o, max(e) AS last FROM insp JOIN grid ON e >= t - INTERVAL 4 MONTH AND e < t AND r < t GROUP BY ALL),
crash AS (SELECT report_number, usdot_number, event_date AS e, min(reported_date) AS r, max(federal_recordable::INTEGER) AS rec FROM vehicles GROUP BY ALL),
prior AS (SELECT f.usdot_number, t, count(*) AS c FROM f JOIN crash c ON c.usdot_number = f.usdot_number AND e >= t - INTERVAL 24 MONTH AND e < t AND r < t GROUP BY ALL),
after AS (SELECT DISTINCT f.usdot_number, t FROM f JOIN crash c ON c.usdot_number = f.usdot_number AND e >= t AND e < t + INTERVAL 6 MONTH AND r < DATE '2001-09-03' AND rec = 1)
SELECT f.usdot_number, f.t AS scoring_date, n AS inspections_4m, v AS violations_4m, o AS oos_violations_4m, coalesce(c, 0) AS crashes_24m,
  ({ratio("v", "n")})::DOUBLE AS violations_per_inspection, ({ratio("o", "v")})::DOUBLE AS oos_violation_rate, (f.t - last)::INTEGER AS days_since_last_inspection,
  CASE WHEN f.t < DATE '2001-06-01' THEN (after.t IS NOT NULL)::INTEGER END AS label
FROM f LEFT JOIN prior USING (usdot_number, t) LEFT JOIN after ON after.usdot_number = f.usdot_number AND after.t = f.t"""

DECISIONS = ctes("features") + """, r AS (SELECT DISTINCT (o_custkey + 1)::VARCHAR AS usdot_number, DATE '2001-03-11' AS request_date FROM orders),
latest AS (SELECT usdot_number, max(scoring_date) AS scoring_date FROM features WHERE scoring_date <= DATE '2001-03-11' GROUP BY ALL),
has AS (SELECT DISTINCT usdot_number FROM union_events WHERE event_type = 'inspection' AND NOT is_deleted AND event_date >= DATE '2000-09-11' AND event_date < DATE '2001-03-11' AND reported_date < DATE '2001-03-11'
  AND knowledge_valid_from < TIMESTAMP '2001-03-11' AND (knowledge_valid_to IS NULL OR knowledge_valid_to > TIMESTAMP '2001-03-11'))
SELECT r.usdot_number, request_date, scoring_date, CASE WHEN has.usdot_number IS NULL THEN 'insufficient_history' WHEN scoring_date IS DISTINCT FROM DATE '2001-03-01' THEN 'features_unavailable' ELSE 'score' END AS decision
FROM r LEFT JOIN latest USING (usdot_number) LEFT JOIN has ON has.usdot_number = r.usdot_number"""

MORE: dict[str, str] = {
    "parse_scalars": f"""WITH t AS (SELECT o_orderkey, o_orderkey AS k,
  CASE WHEN o_orderkey % 13 = 0 THEN ' +000' || o_orderkey || '.00 ' WHEN o_orderkey % 13 = 1 THEN o_orderkey || '.5' WHEN o_orderkey % 13 = 2 THEN ''
    WHEN o_orderkey % 13 = 3 THEN '-' || o_orderkey ELSE o_orderkey::VARCHAR END AS n,
  CASE WHEN o_orderkey % 11 = 0 THEN '20230230' WHEN o_orderkey % 11 = 1 THEN '00000101' WHEN o_orderkey % 11 = 2 THEN strftime(o_orderdate, '%Y%m%d') || chr(10)
    ELSE ' ' || strftime(o_orderdate, '%Y%m%d') END AS d,
  strftime(o_orderdate, '%Y%m%d') || ' ' || lpad((o_orderkey % 26)::VARCHAR, 2, '0') || lpad((o_orderkey % 70)::VARCHAR, 2, '0') AS ts,
  ['Y', ' no ', 'TRUE', '0', 'maybe', '', '1', 'False'][o_orderkey % 8 + 1] AS b, ((o_orderkey * 37) % 2500)::VARCHAR AS tm FROM orders)
SELECT o_orderkey, {_integer("n")} AS nonnegative, {_id("n")} AS id, {_date("d")} AS day, {_timestamp("ts")} AS at, {_bool("b")} AS flag, {_time("tm")} AS time_of_day,
  CASE WHEN regexp_full_match(trim(n), '[0-9]{{1,19}}') AND trim(n)::HUGEINT BETWEEN 1 AND 9223372036854775807 THEN trim(n)::HUGEINT::VARCHAR END AS request_id,
  ({ratio("(k % 1000)", "(k % 7)")})::DOUBLE AS ratio, {_BUCKET.format(x="(k % 300)")} AS bucket FROM t""",
    "incident_keys": """SELECT o_orderkey, md5(concat_ws(chr(31), o_custkey::VARCHAR, o_orderstatus, o_orderkey::VARCHAR, strftime(o_orderdate, '%Y-%m-%d'), (o_orderkey % 2400)::VARCHAR)) AS incident_key,
  sha256(strlen(o_orderstatus) || ':' || o_orderstatus || strlen(o_orderpriority) || ':' || o_orderpriority || strlen(o_custkey::VARCHAR) || ':' || o_custkey
    || strlen(o_orderkey::VARCHAR) || ':' || o_orderkey || '1:x') AS batch_id,
  'fallback:' || lower(hex(encode('["' || o_orderstatus || '", "' || o_orderpriority || '", "' || strftime(o_orderdate, '%Y-%m-%d') || '", ' || (o_orderkey % 2400) || ', ' || o_custkey || ']'))) AS fallback_key
  FROM orders""",
    "reconcile_snapshot": _SNAPSHOTS + """, counts AS (SELECT feed, acquisition_date, count(*) AS catalog_row_count, count_if(coalesce(trim(raw_e, ' '), '') = '') AS missing_event_date_count,
  count_if(coalesce(trim(raw_e, ' '), '') <> '' AND ev IS NULL) AS invalid_event_date_count, count_if(coalesce(trim(raw_a, ' '), '') = '') AS missing_source_add_at_count,
  count_if(coalesce(trim(raw_a, ' '), '') <> '' AND at_ IS NULL) AS invalid_source_add_at_count, count_if(ev IS NULL OR at_ IS NULL OR rep < ev) AS excluded_from_lag_count,
  count_if(rep < ev) AS negative_lag_count, count_if(rep >= ev) AS lag_sample_size FROM parsed GROUP BY ALL)
SELECT m.feed, m.acquisition_date, 1 AS metadata_row_count, m.batch_id, 'source_proxy' AS availability_quality, manifest_row_count,
  coalesce(catalog_row_count, 0) - manifest_row_count AS row_count_delta, coalesce(catalog_row_count, 0) AS catalog_row_count, coalesce(missing_event_date_count, 0) AS missing_event_date_count,
  coalesce(invalid_event_date_count, 0) AS invalid_event_date_count, coalesce(missing_source_add_at_count, 0) AS missing_source_add_at_count,
  coalesce(invalid_source_add_at_count, 0) AS invalid_source_add_at_count, coalesce(excluded_from_lag_count, 0) AS excluded_from_lag_count,
  coalesce(negative_lag_count, 0) AS negative_lag_count, coalesce(lag_sample_size, 0) AS lag_sample_size
FROM manifests m LEFT JOIN counts USING (feed, acquisition_date)""",
    "report_lag_profile": _SNAPSHOTS + f""", lagged AS (SELECT feed, acquisition_date, (rep - ev)::INTEGER AS lag_days FROM parsed WHERE rep >= ev),
summary AS (SELECT feed, acquisition_date, count(*) AS lag_sample_size, min(lag_days) AS minimum_lag_days, max(lag_days) AS maximum_lag_days,
  quantile_cont(lag_days, 0.5) AS p50_lag_days, quantile_cont(lag_days, 0.9) AS p90_lag_days, quantile_cont(lag_days, 0.95) AS p95_lag_days,
  quantile_cont(lag_days, 0.99) AS p99_lag_days, quantile_cont(lag_days, 0.995) AS p995_lag_days FROM lagged GROUP BY ALL),
histogram AS (SELECT feed, acquisition_date, {_BUCKET.format(x="lag_days")} AS lag_bucket, count(*) AS lag_bucket_row_count FROM lagged GROUP BY ALL)
SELECT h.feed, h.acquisition_date, manifest_observed_at, manifest_row_count, 'source_proxy' AS availability_quality, s.* EXCLUDE (feed, acquisition_date), lag_bucket,
  lag_bucket_row_count, lag_bucket_row_count / lag_sample_size AS lag_bucket_fraction
FROM histogram h JOIN summary s USING (feed, acquisition_date) JOIN manifests m USING (feed, acquisition_date)""",
    "lag_histogram": f"""WITH lagged AS (SELECT l_returnflag AS feed, ((l_shipdate + INTERVAL 1 DAY)::DATE - o_orderdate::DATE)::INTEGER AS x FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
ok AS (SELECT feed, {_BUCKET.format(x="x")} AS lag_bucket FROM lagged WHERE x >= 0),
every AS (SELECT DISTINCT feed, b.lag_bucket FROM ok CROSS JOIN (SELECT unnest(['00 same day', '01 1-2 days', '02 3-7 days', '03 8-14 days', '04 15-30 days', '05 31-60 days',
  '06 61-90 days', '07 91-180 days', '08 181-270 days', '09 271+ days']) AS lag_bucket) b)
SELECT feed, lag_bucket, count(ok.feed) AS n FROM every LEFT JOIN ok USING (feed, lag_bucket) GROUP BY ALL""",
    "latency_percentiles": "SELECT event_type, "
    + ", ".join(f"quantile_disc(value, {q}) AS rank_p{round(100 * q)}, quantile_cont(value, {q}) AS linear_p{round(100 * q)}" for q in (0.5, 0.95, 0.99))
    + " FROM events GROUP BY event_type",
    "json_positions": """WITH j AS (SELECT (props->>'k')::BIGINT AS k FROM events), e AS (SELECT unnest([0, 1, 2]) AS pos, unnest([k, k * 2, k % 5]) AS v FROM j)
SELECT pos, count(v) AS n, sum(v)::BIGINT AS total FROM e GROUP BY pos""",
    "event_arrivals": """SELECT DISTINCT 'b' || (event_id % 500 % 3) AS bucket, 'raw/feed=' || (event_id % 500) || '/manifest.json' AS key, (event_id % 500 % 7)::VARCHAR AS version
FROM events WHERE event_id % 50 > 1""",
    "landmark_features": LANDMARK,
    "cohort_months": """WITH m AS (SELECT max(o_orderdate)::DATE AS as_of FROM orders),
months AS (SELECT (date_trunc('month', as_of) - to_months(i))::DATE AS event_month, as_of FROM m, (SELECT unnest(range(24)) AS i)),
mature AS (SELECT event_month FROM months WHERE (last_day(event_month) + INTERVAL 9 MONTH)::DATE <= as_of ORDER BY event_month DESC LIMIT 12)
SELECT event_month, count(o_orderkey) AS n_orders FROM mature LEFT JOIN orders ON date_trunc('month', o_orderdate)::DATE = event_month GROUP BY ALL""",
    "mature_grid": """WITH o AS (SELECT min(o_orderdate)::DATE AS a, least(max(o_orderdate)::DATE, DATE '2001-09-05') AS cutoff FROM orders),
s AS (SELECT cutoff, CASE WHEN date_trunc('month', f)::DATE < f THEN (date_trunc('month', f) + INTERVAL 1 MONTH)::DATE ELSE f END AS start FROM (SELECT cutoff, (a + INTERVAL 24 MONTH)::DATE AS f FROM o)),
g AS (SELECT cutoff, unnest(generate_series(start::TIMESTAMP, cutoff::TIMESTAMP, INTERVAL 1 MONTH))::DATE AS scoring_date FROM s)
SELECT scoring_date FROM g WHERE (scoring_date + INTERVAL 6 MONTH)::DATE + 30 <= cutoff""",
    "first_incident_reports": _FIRST + "SELECT * FROM first",
    "cohort_lag_quantiles": _FIRST + """, l AS (SELECT date_trunc('month', event_date)::DATE AS event_month, (reported_date - event_date)::INTEGER AS x FROM first WHERE federal_recordable AND NOT is_deleted)
SELECT event_month, count(*)::BIGINT AS incident_count, quantile_cont(x, 0.995) AS p995_days FROM l
WHERE event_month BETWEEN DATE '1999-12-01' AND DATE '2000-11-01' GROUP BY event_month""",
    "labels": _LABELLED + "SELECT * FROM labelled",
    "purged_split": _LABELLED + """, g AS (SELECT list(scoring_date ORDER BY scoring_date) AS d FROM grid WHERE scoring_date + INTERVAL 6 MONTH <= DATE '2001-09-01'),
s AS (SELECT l.*, CASE WHEN scoring_date >= d[-3] THEN 'test' WHEN scoring_date >= d[-9] THEN 'purged' ELSE 'train' END AS part FROM labelled l, g)
SELECT part, count(*) AS n_rows, sum(label)::BIGINT AS positives, min(scoring_date) AS first, max(scoring_date) AS last FROM s GROUP BY part""",
    "availability_mix": _LABELLED + """, e AS (SELECT u.*, v.availability_quality FROM union_events u JOIN versions v USING (event_version_key)),
used AS (SELECT event_version_key, e.availability_quality FROM e JOIN whole w ON w.usdot_number = e.usdot_number AND NOT e.is_deleted AND e.event_date < w.scoring_date AND e.reported_date < w.scoring_date
    AND e.event_date >= w.scoring_date - CASE WHEN e.event_type = 'inspection' THEN INTERVAL 6 MONTH ELSE INTERVAL 24 MONTH END
    AND e.knowledge_valid_from < w.scoring_date::TIMESTAMP AND (e.knowledge_valid_to IS NULL OR e.knowledge_valid_to > w.scoring_date::TIMESTAMP)
  UNION SELECT o.event_version_key, o.availability_quality FROM outcomes o JOIN whole w ON w.usdot_number = o.usdot_number AND o.event_date >= w.scoring_date AND o.event_date < w.scoring_date + INTERVAL 6 MONTH)
SELECT availability_quality, count(*) AS n_versions FROM used GROUP BY ALL""",
    "average_precision": _SCORES + _AP + "SELECT * FROM ap",
    "model_comparison": _SCORES + _AP + """SELECT max(average_precision) FILTER (model = 'candidate') AS ap_candidate, max(average_precision) FILTER (model = 'baseline') AS ap_baseline,
max(average_precision) FILTER (model = 'incumbent') AS ap_incumbent, ap_candidate > ap_baseline AND ap_candidate > ap_incumbent AS promote FROM ap""",
    "f1_threshold": _SCORES + """, s AS (SELECT candidate, sum(label) AS p, count(*) AS n FROM scores GROUP BY ALL),
c AS (SELECT candidate, sum(p) OVER w AS tp, sum(n) OVER w AS m, sum(p) OVER () AS pos FROM s WINDOW w AS (ORDER BY candidate DESC))
SELECT candidate AS threshold, 2 * tp / (m + pos) AS f1 FROM c ORDER BY f1 DESC, candidate LIMIT 1""",
    "confusion": _SCORES + """, c AS (SELECT count_if(candidate < 0.5 AND label = 0) AS tn, count_if(candidate >= 0.5 AND label = 0) AS fp, count_if(candidate < 0.5 AND label = 1) AS fn,
count_if(candidate >= 0.5 AND label = 1) AS tp, count(*) AS n FROM scores)
SELECT tn AS true_negative, fp AS false_positive, fn AS false_negative, tp AS true_positive, n, (tn + tp) / n AS accuracy, tp / (tp + fn) AS positive_recall, tp / (tp + fp) AS precision,
2 * tp / (2 * tp + fp + fn) AS f1, (tp + fn) / n AS prevalence, (tn + fp) / n AS always_negative_accuracy FROM c""",
    "batch_decisions": DECISIONS,
    "contract_violations": """SELECT 'o_orderkey_not_null' AS rule, count_if(o_orderkey IS NULL) AS violations FROM orders
UNION ALL SELECT 'o_orderkey_unique', (SELECT count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1))
UNION ALL SELECT 'o_custkey_unique', (SELECT count(*) FROM (SELECT 1 FROM orders GROUP BY o_custkey HAVING count(*) > 1))
UNION ALL SELECT 'o_orderstatus_not_null', count_if(o_orderstatus IS NULL) FROM orders
UNION ALL SELECT 'o_orderstatus_accepted', count_if(o_orderstatus NOT IN ('O', 'F')) FROM orders
UNION ALL SELECT 'o_orderpriority_not_null', count_if(o_totalprice > 100 AND o_orderpriority IS NULL) FROM orders
UNION ALL SELECT 'o_orderpriority_accepted', count_if(o_orderpriority NOT IN ('1-URGENT', '2-HIGH')) FROM orders""",
}
