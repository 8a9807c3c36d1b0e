"""DuckDB SQL: the pieces from which the oracles are built. Written against the tables, not derived from the plans."""

from __future__ import annotations

from tidemark.sources.tables import BATCHES, PENDING, WINDOW_MONTHS


def ctes(*names: str) -> str:
    """A WITH clause of the named pieces and all that they need, in order."""
    need: list[str] = []

    def add(n: str) -> None:
        for d in NEEDS.get(n, ()):
            add(d)
        if n not in need:
            need.append(n)

    for n in names:
        add(n)
    return "WITH " + ",\n".join(f"{n} AS ({PIECES[n]})" for n in need) + "\n"


def _date(x: str) -> str:
    t = f"trim({x}, ' ')"
    return f"CASE WHEN regexp_full_match({t}, '[0-9]{{8}}') AND substr({t}, 1, 4) <> '0000' THEN try_strptime({t}, '%Y%m%d')::DATE END"


def _timestamp(x: str) -> str:
    t = f"trim({x}, ' ')"
    return (
        f"CASE WHEN regexp_full_match({t}, '[0-9]{{8}} ([01][0-9]|2[0-3])[0-5][0-9]') AND substr({t}, 1, 4) <> '0000' "
        f"THEN try_strptime({t}, '%Y%m%d %H%M') END"
    )


def _integer(x: str, most: int = 2147483647) -> str:
    t = f"trim({x}, ' ')"
    d = f"regexp_replace(regexp_extract({t}, '^[+]?([0-9]+)', 1), '^0+([0-9])', '\\1')"
    return (
        f"CASE WHEN regexp_full_match({t}, '[+]?[0-9]+([.]0+)?') AND length({d}) <= {len(str(most))} "
        f"AND TRY_CAST({d} AS HUGEINT) <= {most} THEN TRY_CAST({d} AS BIGINT) END"
    )


def _id(x: str) -> str:
    return f"nullif({_integer(x, 9223372036854775807)}, 0)::VARCHAR"


def _time(x: str) -> str:
    n = _integer(x, 2359)
    return f"CASE WHEN ({n}) % 100 <= 59 THEN {n} END"


def _bool(x: str) -> str:
    t = f"lower(trim({x}, ' '))"
    return f"CASE WHEN {t} IN ('y', 'yes', '1', 'true') THEN true WHEN {t} IN ('n', 'no', '0', 'false') THEN false END"


def ratio(n: str, d: str) -> str:
    return (
        f"CASE WHEN {d} <> 0 THEN ((({n}::HUGEINT * 1000000) // {d}::HUGEINT "
        f"+ CASE WHEN 2 * (({n}::HUGEINT * 1000000) % {d}::HUGEINT) >= {d} THEN 1 ELSE 0 END)::DECIMAL(32, 0) * 0.000001)::DECIMAL(38, 6) END"
    )


def _json(x: str) -> str:
    return f"to_json({x})::VARCHAR"


def _payload(*parts: tuple[str, str]) -> str:
    def piece(x: str, kind: str) -> str:
        if kind == "date":
            return f"'\"' || strftime({x}, '%Y-%m-%d') || '\"'"
        if kind == "timestamp":
            return f"'\"' || strftime({x}, '%Y-%m-%dT%H:%M:%S') || '\"'"
        if kind == "text":
            return _json(x)
        if kind == "texts":
            return f"'[' || array_to_string(list_transform({x}, lambda r: '\"' || r || '\"'), ', ') || ']'"
        return f"({x})::VARCHAR"

    return "md5('[' || " + " || ', ' || ".join(f"coalesce({piece(x, k)}, 'null')" for x, k in parts) + " || ']')"


_LISTED = ", ".join(f"('{b}', '{f}', {n}, TIMESTAMP '{o}', 'loaded')" for b, f, n, o in BATCHES)
_HELD = "CROSS JOIN batches b WHERE b.feed_name = '{feed}' AND b.status = 'loaded' AND added < b.observed_at::DATE AND (k * 31 + b.batch_no) % 11 <> 0"

PIECES = {
    "batches": f"SELECT * FROM (VALUES {_LISTED}, ('{PENDING[0]}', '{PENDING[1]}', {PENDING[2]}, TIMESTAMP '{PENDING[3]}', '{PENDING[4]}')) t(batch_id, feed_name, batch_no, observed_at, status)",
    "order_rows": """SELECT o_orderkey + 1 AS k, o_custkey + 1 AS c, o_orderdate::DATE AS d, o_orderstatus AS st,
        (o_orderdate::DATE + (o_orderkey % 60)::INTEGER)::DATE AS added FROM orders""",
    "raw_inspections": f"""SELECT b.batch_id, k AS source_row_number,
        CASE WHEN k % 97 = 3 THEN '+00' || k || '.0' ELSE k::VARCHAR END AS inspection_id,
        CASE WHEN k % 97 = 17 THEN ' ' WHEN k % 97 = 19 THEN NULL ELSE c::VARCHAR END AS dot_number,
        CASE WHEN k % 97 = 23 THEN '  ' ELSE st END AS report_state,
        'I-' || k AS report_number,
        CASE WHEN k % 97 = 5 THEN '20230230' WHEN k % 97 = 29 THEN '21000101' ELSE strftime(d, '%Y%m%d') END AS insp_date,
        strftime(added, '%Y%m%d') || CASE WHEN k % 97 = 31 THEN ' 2400' ELSE ' 0900' END AS mcmis_add_date,
        strftime(added, '%Y%m%d') || ' 1000' AS change_date,
        CASE WHEN k % 97 = 11 THEN '12.5' ELSE ((k - 1) % 7 + CASE WHEN (k * 31 + b.batch_no) % 11 = 1 THEN 1 ELSE 0 END)::VARCHAR END AS viol_total,
        least((k - 1) % 3, (k - 1) % 7)::VARCHAR AS oos_total
        FROM order_rows {_HELD.format(feed="inspections")} AND d >= (b.observed_at::DATE - INTERVAL {WINDOW_MONTHS} MONTH)::DATE""",
    "vehicle_rows": """SELECT l_orderkey AS ok, l_linenumber AS ln, l_orderkey * 8 + l_linenumber + 1 AS k, p, rf, ls, o_custkey + 1 AS c,
        o_orderdate::DATE AS d, o_orderstatus AS st, (o_orderdate::DATE + (p % 90)::INTEGER)::DATE AS added
        FROM (SELECT l_orderkey, l_linenumber, min(l_partkey) AS p, min(l_returnflag) AS rf, min(l_linestatus) AS ls FROM lineitem GROUP BY ALL) l
        JOIN orders ON o_orderkey = l_orderkey""",
    "raw_crashes": f"""SELECT b.batch_id, k AS source_row_number,
        CASE WHEN k % 89 = 7 THEN NULL ELSE k::VARCHAR END AS crash_id,
        CASE WHEN k % 89 = 13 THEN ' ' ELSE st END AS report_state, 'C-' || ok AS report_number,
        CASE WHEN k % 89 = 17 THEN '20261340' ELSE strftime(d, '%Y%m%d') END AS report_date,
        CASE WHEN k % 89 = 19 THEN '2360' ELSE (ok % 24 * 100 + ok % 60)::VARCHAR END AS report_time,
        ln::VARCHAR AS report_seq_no, CASE WHEN k % 89 = 23 THEN NULL ELSE c::VARCHAR END AS dot_number,
        strftime(added, '%Y%m%d') || ' 1100' AS add_date, strftime(added, '%Y%m%d') || ' 1200' AS change_date,
        (ln % 3 + CASE WHEN (k * 31 + b.batch_no) % 11 = 1 THEN 1 ELSE 0 END)::VARCHAR AS fatalities,
        CASE WHEN k % 89 = 29 THEN 'bad' ELSE (p % 5)::VARCHAR END AS injuries,
        CASE WHEN ls = 'F' THEN 'Y' ELSE 'no' END AS tow_away, CASE WHEN rf <> 'N' THEN 'Y' ELSE 'N' END AS federal_recordable
        FROM vehicle_rows {_HELD.format(feed="crashes")}""",
    "typed_inspections": f"""SELECT r.*, b.observed_at, {_id("inspection_id")} AS key, {_id("dot_number")} AS usdot, {_date("insp_date")} AS ev,
        {_timestamp("mcmis_add_date")} AS add_at, {_timestamp("change_date")} AS change_at, {_integer("viol_total")} AS viol, {_integer("oos_total")} AS oos
        FROM raw_inspections r JOIN batches b USING (batch_id) WHERE b.status = 'loaded'""",
    "reasoned_inspections": """SELECT *, nullif(trim(report_state, ' '), '') AS st, list_filter([
        CASE WHEN inspection_id IS NOT NULL AND key IS NULL THEN 'invalid_source_record_key' END,
        CASE WHEN dot_number IS NOT NULL AND usdot IS NULL THEN 'invalid_usdot_number' END,
        CASE WHEN insp_date IS NOT NULL AND ev IS NULL THEN 'invalid_event_date' END,
        CASE WHEN mcmis_add_date IS NOT NULL AND add_at IS NULL THEN 'invalid_source_add_at' END,
        CASE WHEN change_date IS NOT NULL AND change_at IS NULL THEN 'invalid_source_change_at' END,
        CASE WHEN viol_total IS NOT NULL AND viol IS NULL THEN 'invalid_violation_count' END,
        CASE WHEN oos_total IS NOT NULL AND oos IS NULL THEN 'invalid_oos_violation_count' END,
        CASE WHEN (add_at + INTERVAL 1 DAY)::DATE < ev THEN 'impossible_event_chronology' END], lambda x: x IS NOT NULL) AS reasons
        FROM typed_inspections""",
    "clean_inspections": f"""SELECT batch_id, source_row_number, 'inspections' AS feed_name, key AS source_record_key, usdot AS usdot_number, ev AS event_date,
        add_at AS source_add_at, change_at AS source_change_at, observed_at AS first_observed_at,
        (add_at + INTERVAL 1 DAY)::DATE AS source_proxy_reported_date, add_at + INTERVAL 1 DAY AS source_proxy_valid_from, st AS state,
        viol AS violation_count, oos AS oos_violation_count, reasons AS parse_reasons,
        {_payload(("usdot", "text"), ("ev", "date"), ("add_at", "timestamp"), ("change_at", "timestamp"), ("st", "text"), ("viol", "number"), ("oos", "number"), ("reasons", "texts"))} AS record_hash
        FROM reasoned_inspections""",
    "typed_crashes": f"""SELECT r.*, b.observed_at, {_id("crash_id")} AS own, {_id("dot_number")} AS usdot, {_date("report_date")} AS ev,
        {_timestamp("add_date")} AS add_at, {_timestamp("change_date")} AS change_at, {_time("report_time")} AS tm, {_integer("report_seq_no")} AS seq,
        {_integer("fatalities")} AS fat, {_integer("injuries")} AS inj, {_bool("tow_away")} AS tow, {_bool("federal_recordable")} AS rec,
        nullif(trim(report_state, ' '), '') AS st, nullif(trim(report_number, ' '), '') AS num
        FROM raw_crashes r JOIN batches b USING (batch_id) WHERE b.status = 'loaded'""",
    "reasoned_crashes": f"""SELECT *, coalesce(own, CASE WHEN st IS NOT NULL AND num IS NOT NULL AND ev IS NOT NULL AND tm IS NOT NULL AND seq IS NOT NULL
          THEN 'fallback:' || lower(hex(encode('[' || {_json("st")} || ', ' || {_json("num")} || ', "' || strftime(ev, '%Y-%m-%d') || '", ' || tm || ', ' || seq || ']'))) END) AS key,
        list_filter([
        CASE WHEN crash_id IS NOT NULL AND own IS NULL THEN 'invalid_source_record_key' END,
        CASE WHEN dot_number IS NOT NULL AND usdot IS NULL THEN 'invalid_usdot_number' END,
        CASE WHEN report_date IS NOT NULL AND ev IS NULL THEN 'invalid_event_date' END,
        CASE WHEN add_date IS NOT NULL AND add_at IS NULL THEN 'invalid_source_add_at' END,
        CASE WHEN change_date IS NOT NULL AND change_at IS NULL THEN 'invalid_source_change_at' END,
        CASE WHEN report_time IS NOT NULL AND tm IS NULL THEN 'invalid_report_time' END,
        CASE WHEN report_seq_no IS NOT NULL AND seq IS NULL THEN 'invalid_report_seq_no' END,
        CASE WHEN fatalities IS NOT NULL AND fat IS NULL THEN 'invalid_fatalities' END,
        CASE WHEN injuries IS NOT NULL AND inj IS NULL THEN 'invalid_injuries' END,
        CASE WHEN tow_away IS NOT NULL AND tow IS NULL THEN 'invalid_tow_away' END,
        CASE WHEN federal_recordable IS NOT NULL AND rec IS NULL THEN 'invalid_federal_recordable' END,
        CASE WHEN (add_at + INTERVAL 1 DAY)::DATE < ev THEN 'impossible_event_chronology' END], lambda x: x IS NOT NULL) AS reasons
        FROM typed_crashes""",
    "clean_crashes": f"""SELECT batch_id, source_row_number, 'crashes' AS feed_name, key AS source_record_key, usdot AS usdot_number, ev AS event_date,
        add_at AS source_add_at, change_at AS source_change_at, observed_at AS first_observed_at,
        (add_at + INTERVAL 1 DAY)::DATE AS source_proxy_reported_date, add_at + INTERVAL 1 DAY AS source_proxy_valid_from,
        st AS report_state, num AS report_number, tm AS report_time, seq AS report_seq_no, fat AS fatalities, inj AS injuries, tow AS tow_away,
        rec AS federal_recordable, CASE WHEN why IS NULL THEN 'eligible' ELSE 'excluded' END AS model_eligibility, why AS exclusion_reason, reasons AS parse_reasons,
        {_payload(("usdot", "text"), ("ev", "date"), ("add_at", "timestamp"), ("change_at", "timestamp"), ("st", "text"), ("num", "text"), ("tm", "number"), ("seq", "number"), ("fat", "number"), ("inj", "number"), ("tow", "boolean"), ("rec", "boolean"), ("reasons", "texts"))} AS record_hash
        FROM (SELECT *, CASE WHEN list_contains(reasons, 'invalid_event_date') THEN 'invalid_event_date' WHEN len(reasons) > 0 THEN reasons[1]
            WHEN key IS NULL THEN 'missing_source_record_key' WHEN usdot IS NULL THEN 'missing_usdot_number'
            WHEN rec IS DISTINCT FROM true THEN 'not_federally_recordable'
            WHEN st IS NULL OR num IS NULL OR ev IS NULL OR tm IS NULL THEN 'invalid_incident_key' END AS why FROM reasoned_crashes)""",
    "candidates": """SELECT batch_id, first_observed_at AS observed_at, feed_name, 'inspection' AS event_type, source_record_key, usdot_number, event_date,
        source_proxy_reported_date, source_proxy_valid_from, source_add_at, source_change_at, state, violation_count, oos_violation_count,
        NULL::VARCHAR AS report_state, NULL::VARCHAR AS report_number, NULL::BIGINT AS report_time, NULL::BIGINT AS report_seq_no,
        NULL::BIGINT AS fatalities, NULL::BIGINT AS injuries, NULL::BOOLEAN AS tow_away, record_hash,
        coalesce(len(parse_reasons) = 0 AND source_record_key IS NOT NULL AND usdot_number IS NOT NULL AND event_date IS NOT NULL
          AND source_proxy_reported_date >= event_date, false) AS is_model_eligible,
        CASE WHEN len(parse_reasons) > 0 THEN parse_reasons[1] WHEN source_record_key IS NULL THEN 'missing_source_record_key'
          WHEN usdot_number IS NULL THEN 'missing_usdot_number' WHEN event_date IS NULL THEN 'missing_event_date'
          WHEN source_proxy_reported_date IS NULL THEN 'missing_source_add_at' END AS exclusion_reason
        FROM clean_inspections
        UNION ALL
        SELECT batch_id, first_observed_at, feed_name, 'crash', source_record_key, usdot_number, event_date, source_proxy_reported_date,
        source_proxy_valid_from, source_add_at, source_change_at, NULL, NULL, NULL, report_state, report_number, report_time, report_seq_no,
        fatalities, injuries, tow_away, record_hash, coalesce(model_eligibility = 'eligible' AND source_proxy_reported_date >= event_date, false),
        coalesce(exclusion_reason, CASE WHEN source_proxy_valid_from IS NULL THEN 'missing_source_add_at' END)
        FROM clean_crashes""",
}

NEEDS: dict[str, tuple[str, ...]] = {
    "raw_inspections": ("batches", "order_rows"),
    "raw_crashes": ("batches", "vehicle_rows"),
    "typed_inspections": ("raw_inspections",),
    "reasoned_inspections": ("typed_inspections",),
    "clean_inspections": ("reasoned_inspections",),
    "typed_crashes": ("raw_crashes",),
    "reasoned_crashes": ("typed_crashes",),
    "clean_crashes": ("reasoned_crashes",),
    "candidates": ("clean_inspections", "clean_crashes"),
}

# The history as a fold: one step for each batch, each from the versions that the step before left.
_CARRIED = (
    "event_type, usdot_number, source_add_at, source_change_at, is_model_eligible, exclusion_reason, record_hash, state, violation_count, "
    "oos_violation_count, report_state, report_number, report_time, report_seq_no, fatalities, injuries, tow_away"
)
_EMPTY = """SELECT feed_name, source_record_key, event_date, source_proxy_reported_date AS reported_date, source_proxy_valid_from AS knowledge_valid_from,
    NULL::TIMESTAMP AS knowledge_valid_to, '' AS availability_quality, observed_at AS first_observed_at, false AS is_deleted,
    NULL::VARCHAR AS deletion_reason, true AS is_current, batch_id AS first_seen, batch_id AS last_seen, {carried} FROM candidates WHERE false""".format(carried=_CARRIED)


def _step(before: str, batch: str, feed: str, no: int, at: str) -> tuple[str, str, str]:
    cut = f"(SELECT min(event_date) FROM candidates WHERE batch_id = '{batch}')"
    prior = f"(SELECT * FROM {before} WHERE is_current)"
    now = f"(SELECT * FROM candidates WHERE batch_id = '{batch}' AND source_record_key IS NOT NULL)"
    proxy = no == 1
    c_cols = ", ".join(f"c.{x.strip()}" for x in _CARRIED.split(","))
    p_cols = ", ".join(f"p.{x.strip()}" for x in _CARRIED.split(","))
    window = "true" if feed == "crashes" else f"coalesce(p.event_date >= {cut}, false)"
    new = f"""SELECT c.feed_name, c.source_record_key,
      CASE WHEN NOT c.is_model_eligible AND c.event_date > TIMESTAMP '{at}'::DATE THEN NULL ELSE c.event_date END AS event_date,
      {"c.source_proxy_reported_date" if proxy else f"TIMESTAMP '{at}'::DATE"} AS reported_date,
      {"c.source_proxy_valid_from" if proxy else f"TIMESTAMP '{at}'"} AS knowledge_valid_from, NULL::TIMESTAMP AS knowledge_valid_to,
      '{"source_proxy" if proxy else "observed"}' AS availability_quality, TIMESTAMP '{at}' AS first_observed_at, false AS is_deleted,
      NULL::VARCHAR AS deletion_reason, true AS is_current, '{batch}' AS first_seen, '{batch}' AS last_seen, {c_cols}
      FROM {now} c LEFT JOIN {prior} p USING (source_record_key)
      WHERE (c.is_model_eligible OR p.record_hash IS NOT NULL)
        AND (p.record_hash IS NULL OR p.is_deleted OR p.record_hash <> c.record_hash OR p.is_model_eligible <> c.is_model_eligible)
      UNION ALL
      SELECT p.feed_name, p.source_record_key, p.event_date, TIMESTAMP '{at}'::DATE, TIMESTAMP '{at}', NULL, 'observed', TIMESTAMP '{at}', true,
      'source_deleted', true, '{batch}', '{batch}', {p_cols}
      FROM {prior} p ANTI JOIN {now} c USING (source_record_key) WHERE NOT p.is_deleted AND {window}"""
    expired = f"""SELECT p.source_record_key, '{batch}' AS batch_id, p.first_seen, TIMESTAMP '{at}' AS observed_at, {cut} AS retention_cutoff
      FROM {prior} p ANTI JOIN {now} c USING (source_record_key) WHERE '{feed}' = 'inspections' AND NOT p.is_deleted AND p.event_date < {cut}"""
    return new, expired, now


def _fold() -> None:
    for feed, tag in (("inspections", "i"), ("crashes", "c")):
        PIECES[f"{tag}0"] = _EMPTY
        NEEDS[f"{tag}0"] = ("candidates",)
        lapsed = []
        for batch, f, no, at in BATCHES:
            if f != feed:
                continue
            before, this = f"{tag}{no - 1}", f"{tag}{no}"
            new, expired, now = _step(before, batch, feed, no, at)
            PIECES[f"{this}n"], NEEDS[f"{this}n"] = new, (before,)
            PIECES[f"{this}x"], NEEDS[f"{this}x"] = expired, (before,)
            lapsed.append(f"SELECT * FROM {this}x")
            PIECES[this] = f"""SELECT o.* REPLACE (
                CASE WHEN o.is_current AND n.source_record_key IS NOT NULL THEN TIMESTAMP '{at}' ELSE o.knowledge_valid_to END AS knowledge_valid_to,
                o.is_current AND n.source_record_key IS NULL AS is_current,
                CASE WHEN o.is_current AND NOT o.is_deleted AND n.source_record_key IS NULL AND c.source_record_key IS NOT NULL THEN '{batch}' ELSE o.last_seen END AS last_seen)
                FROM {before} o LEFT JOIN (SELECT DISTINCT source_record_key FROM {this}n) n USING (source_record_key)
                LEFT JOIN (SELECT DISTINCT source_record_key FROM {now}) c USING (source_record_key)
                UNION ALL SELECT * FROM {this}n"""
            NEEDS[this] = (f"{this}n",)
        PIECES[f"{tag}_expired"] = " UNION ALL ".join(lapsed)
        NEEDS[f"{tag}_expired"] = tuple(x.split()[-1] for x in lapsed)


_fold()
PIECES["versions"] = """SELECT *, md5(concat_ws('|', first_seen, feed_name, source_record_key, is_deleted::VARCHAR)) AS event_version_key,
    md5(concat_ws('|', feed_name, source_record_key)) AS event_key FROM (SELECT * FROM i6 UNION ALL SELECT * FROM c6)"""
NEEDS["versions"] = ("i6", "c6")
PIECES["crash_versions"] = """SELECT * EXCLUDE (state), report_state AS state, (reported_date - event_date)::INTEGER AS report_lag_days,
    md5(concat_ws(chr(31), usdot_number, report_state, report_number, strftime(event_date, '%Y-%m-%d'), report_time::VARCHAR)) AS carrier_crash_key
    FROM versions WHERE feed_name = 'crashes' AND is_model_eligible"""
NEEDS["crash_versions"] = ("versions",)
PIECES["union_events"] = """SELECT event_key, event_version_key, 'inspection' AS event_type, NULL::VARCHAR AS carrier_crash_key, usdot_number, event_date, reported_date,
    (reported_date - event_date)::INTEGER AS report_lag_days, state, violation_count, oos_violation_count, NULL::BIGINT AS fatalities, NULL::BIGINT AS injuries,
    NULL::BOOLEAN AS tow_away, knowledge_valid_from, knowledge_valid_to, is_current, is_deleted, deletion_reason, record_hash
    FROM versions WHERE feed_name = 'inspections' AND is_model_eligible
    UNION ALL
    SELECT event_key, event_version_key, 'crash', carrier_crash_key, usdot_number, event_date, reported_date, report_lag_days, state, NULL, NULL,
    fatalities, injuries, tow_away, knowledge_valid_from, knowledge_valid_to, is_current, is_deleted, deletion_reason, record_hash FROM crash_versions"""
NEEDS["union_events"] = ("crash_versions",)
PIECES["segments"] = """SELECT carrier_crash_key, edge AS seg_from, lead(edge) OVER (PARTITION BY carrier_crash_key ORDER BY edge) AS seg_to
    FROM (SELECT carrier_crash_key, knowledge_valid_from AS edge FROM crash_versions
          UNION SELECT carrier_crash_key, knowledge_valid_to FROM crash_versions WHERE knowledge_valid_to IS NOT NULL)"""
NEEDS["segments"] = ("crash_versions",)
PIECES["incidents"] = """SELECT min(event_key) AS event_key, min(event_version_key) AS event_version_key, carrier_crash_key, usdot_number, min(event_date) AS event_date,
    max(reported_date) AS reported_date, (max(reported_date) - min(event_date))::INTEGER AS report_lag_days, state, report_number, report_time,
    max(CASE WHEN NOT is_deleted THEN fatalities END) AS fatalities, max(CASE WHEN NOT is_deleted THEN injuries END) AS injuries,
    bool_or(CASE WHEN NOT is_deleted THEN tow_away END) AS tow_away, seg_from AS knowledge_valid_from, seg_to AS knowledge_valid_to,
    seg_to IS NULL AS is_current, bool_and(is_deleted) AS is_deleted,
    CASE WHEN bool_and(is_deleted) THEN max(deletion_reason) END AS deletion_reason,
    md5(string_agg(record_hash, chr(31) ORDER BY source_record_key)) AS record_hash
    FROM segments s JOIN crash_versions v USING (carrier_crash_key)
    WHERE v.knowledge_valid_from <= seg_from AND (v.knowledge_valid_to IS NULL OR v.knowledge_valid_to > seg_from)
    GROUP BY carrier_crash_key, usdot_number, state, report_number, report_time, seg_from, seg_to"""
NEEDS["incidents"] = ("segments",)
PIECES["grid"] = """SELECT unnest(generate_series(date_trunc('month', min(observed_at)), date_trunc('month', max(observed_at)), INTERVAL 1 MONTH))::DATE AS scoring_date
    FROM batches WHERE status = 'loaded'"""
NEEDS["grid"] = ("batches",)
PIECES["features"] = f"""SELECT usdot_number, scoring_date, inspections_6m, violations_6m, oos_violations_6m, crashes_24m,
    {ratio("violations_6m", "inspections_6m")} AS violations_per_inspection, {ratio("oos_violations_6m", "violations_6m")} AS oos_violation_rate,
    (scoring_date - last_inspection_date)::INTEGER AS days_since_last_inspection, last_inspection_date
    FROM (SELECT e.usdot_number, scoring_date,
        count(*) FILTER (i) AS inspections_6m, coalesce(sum(violation_count) FILTER (i), 0)::BIGINT AS violations_6m,
        coalesce(sum(oos_violation_count) FILTER (i), 0)::BIGINT AS oos_violations_6m,
        count(DISTINCT carrier_crash_key) FILTER (event_type = 'crash') AS crashes_24m, max(event_date) FILTER (i) AS last_inspection_date
      FROM (SELECT *, event_type = 'inspection' AND event_date >= (scoring_date - INTERVAL 6 MONTH)::DATE AS i
            FROM grid JOIN union_events ON event_date < scoring_date AND reported_date < scoring_date
             AND event_date >= (scoring_date - INTERVAL 24 MONTH)::DATE AND knowledge_valid_from < scoring_date::TIMESTAMP
             AND (knowledge_valid_to IS NULL OR knowledge_valid_to > scoring_date::TIMESTAMP) AND NOT is_deleted) e
      GROUP BY ALL) WHERE inspections_6m > 0"""
NEEDS["features"] = ("grid", "union_events")
