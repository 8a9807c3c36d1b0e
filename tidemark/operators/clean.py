"""Typed rows, stable quarantine reasons and change candidates of both feeds.

Everything is a projection of the raw rows joined to the loaded batches (a broadcast of the
registry, which is one row a snapshot); no row is moved.

A feed's snapshots repeat most of their rows word by word. Where only the history is wanted, `seen_texts` unites equal texts
first, with the batches that hold them as bits, and each text is typed once (SEEN).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import parse
from tidemark.functions.keys import fallback_key, payload_hash

CANDIDATE = {
    "batch_id": "string", "observed_at": "timestamp", "feed_name": "string", "event_type": "string",
    "source_record_key": "string", "usdot_number": "string", "event_date": "date",
    "source_proxy_reported_date": "date", "source_proxy_valid_from": "timestamp",
    "source_add_at": "timestamp_ntz", "source_change_at": "timestamp_ntz", "state": "string",
    "violation_count": "bigint", "oos_violation_count": "bigint", "report_state": "string",
    "report_number": "string", "report_time": "bigint", "report_seq_no": "bigint", "fatalities": "bigint",
    "injuries": "bigint", "tow_away": "boolean", "record_hash": "string", "is_model_eligible": "boolean",
    "exclusion_reason": "string",
}
#: Batches that one row of seen_texts tells of.
BLOCK = 62
#: A candidate's columns with the batches that it stands in (`seen_texts`) in place of its batch.
SEEN = {"record": "string", "block": "int", "mask": "bigint", "copies": "bigint", **{n: t for n, t in CANDIDATE.items() if n not in ("batch_id", "observed_at")}}


def loaded(batches: DataFrame) -> DataFrame:
    """Only complete batches are visible downstream."""
    return batches.where(F.col("status") == "loaded")


def _with_batch(rows: DataFrame, batches: DataFrame, feed: str) -> DataFrame:
    known = loaded(batches).where(F.col("feed_name") == feed).select("batch_id", "observed_at")
    return rows.join(F.broadcast(known), "batch_id")


def seen_texts(rows: DataFrame, steps: DataFrame, key: Column) -> DataFrame:
    """The distinct texts of a feed's rows, and the batches that hold them: record, block, mask, copies and the cells.

    steps: the feed's batches, numbered (`history.numbered`). Bit i of mask stands for the batch of number block * BLOCK + i + 1.
    copies: rows beyond one a batch. key: the record that a row tells of, made of its cells. Rows go to their record at once, so
    that neither the texts nor the windows over records (`history.rebuild`) move them again; a row without a key goes where its text does.
    """
    at = steps.select("batch_id", ((F.col("no") - 1) / BLOCK).cast("int").alias("block"), F.expr(f"shiftleft(1L, (no - 1) % {BLOCK})").alias("bit"))
    cells = [c for c in rows.columns if c not in ("batch_id", "source_row_number")]
    record = F.coalesce(key, F.concat(F.lit("\x00"), F.xxhash64(*cells).cast("string"))).alias("record")
    held = rows.join(F.broadcast(at), "batch_id").select(record, "block", "bit", *cells).repartition("record")
    told = held.groupBy("record", *cells, "block").agg(F.bit_or("bit").alias("mask"), F.count("*").alias("n"))
    return told.select("record", "block", "mask", (F.col("n") - F.bit_count("mask")).alias("copies"), *cells)


def _text(c: str) -> Column:
    return F.when(F.trim(F.col(c)) != "", F.trim(F.col(c)))


def _broken(raw: str, parsed: str) -> Column:
    return F.col(raw).isNotNull() & F.col(parsed).isNull()


def _timed(**raw: str) -> list[Column]:
    """Dates and times of a row beside their texts (`<name>_text`). A time is named source_*, a date otherwise."""
    made = []
    for name, cell in raw.items():
        time = name.startswith("source_")
        text = (parse.quick_timestamp_text if time else parse.quick_date_text)(F.col(cell))
        made += [text.alias(f"{name}_text"), text.try_cast("timestamp_ntz" if time else "date").alias(name)]
    return made


def _hashed_times() -> list[tuple[Column, str]]:
    """Dates and times for the payload hash, as they are spelled already: printing them anew costs more than all the rest of it."""
    return [(F.when(F.col(c).isNotNull(), F.col(f"{c}_text")), "plain") for c in ("event_date", "source_add_at", "source_change_at")]


def _reported() -> Column:
    return F.date_add(F.col("source_add_at").cast("date"), 1)


def _known_from() -> Column:
    return (F.col("source_add_at") + F.expr("interval 1 day")).cast("timestamp")


def _impossible() -> Column:
    return _reported() < F.col("event_date")


# Both feeds take two projections, one of cells and one of what follows from them: each further one writes the whole wide row
# once more. What stands several times within one projection is evaluated once.


_PLACE = ("batch_id", "source_row_number", "observed_at")
_SEEN = ("record", "block", "mask", "copies")


def _observed(place: tuple[str, ...]) -> list[Column]:
    return [F.col("observed_at").alias("first_observed_at")] if "observed_at" in place else []


def _unobserved(place: tuple[str, ...]) -> list[str]:
    return [c for c in place if c != "observed_at"]


def clean_inspections(rows: DataFrame, batches: DataFrame) -> DataFrame:
    """Typed inspections with their ordered parse_reasons and record_hash."""
    return _inspections(_with_batch(rows, batches, "inspections"), _PLACE)


def _inspections(rows: DataFrame, place: tuple[str, ...]) -> DataFrame:
    """place: the columns that tell where a row stands."""
    parsed = rows.select(
        *place, "inspection_id", "dot_number", "insp_date", "mcmis_add_date", "change_date", "viol_total", "oos_total",
        parse.quick_id(F.col("inspection_id")).alias("source_record_key"),
        parse.quick_id(F.col("dot_number")).alias("usdot_number"),
        *_timed(event_date="insp_date", source_add_at="mcmis_add_date", source_change_at="change_date"),
        parse.quick_integer(F.col("viol_total")).alias("violation_count"),
        parse.quick_integer(F.col("oos_total")).alias("oos_violation_count"),
        _text("report_state").alias("state"),
    )
    reasons = parse.reasons(
        (_broken("inspection_id", "source_record_key"), "invalid_source_record_key"),
        (_broken("dot_number", "usdot_number"), "invalid_usdot_number"),
        (_broken("insp_date", "event_date"), "invalid_event_date"),
        (_broken("mcmis_add_date", "source_add_at"), "invalid_source_add_at"),
        (_broken("change_date", "source_change_at"), "invalid_source_change_at"),
        (_broken("viol_total", "violation_count"), "invalid_violation_count"),
        (_broken("oos_total", "oos_violation_count"), "invalid_oos_violation_count"),
        (_impossible(), "impossible_event_chronology"),
    )
    hashed = payload_hash(
        (F.col("usdot_number"), "plain"), *_hashed_times(), (F.col("state"), "text"), (F.col("violation_count"), "number"),
        (F.col("oos_violation_count"), "number"), (reasons, "texts"),
    )
    return parsed.select(
        *_unobserved(place), F.lit("inspections").alias("feed_name"), "source_record_key", "usdot_number",
        "event_date", "source_add_at", "source_change_at", *_observed(place),
        _reported().alias("source_proxy_reported_date"), _known_from().alias("source_proxy_valid_from"),
        "state", "violation_count", "oos_violation_count", reasons.alias("parse_reasons"), hashed.alias("record_hash"),
    )


def clean_crashes(rows: DataFrame, batches: DataFrame) -> DataFrame:
    """Typed crash vehicles with parse_reasons, model_eligibility, exclusion_reason and record_hash."""
    return _crashes(_with_batch(rows, batches, "crashes"), _PLACE)


_INCIDENT = ("report_state", "report_number", "event_date", "report_time")


def _placed(state: Column, number: Column, day: Column, time: Column) -> Column:
    """Whether a crash can be told from others without an id."""
    return state.isNotNull() & number.isNotNull() & day.isNotNull() & time.isNotNull()


def _crash_key(own: Column, state: Column, number: Column, day: Column, time: Column, sequence: Column) -> Column:
    whole = _placed(state, number, day, time) & sequence.isNotNull()
    return F.coalesce(own, F.when(whole, fallback_key(state, number, day, time, sequence)))


def _crashes(rows: DataFrame, place: tuple[str, ...]) -> DataFrame:
    parsed = rows.select(
        *place, "crash_id", "dot_number", "add_date", "change_date",
        F.col("report_date").alias("raw_date"), F.col("report_time").alias("raw_time"), F.col("report_seq_no").alias("raw_seq"),
        F.col("fatalities").alias("raw_fatalities"), F.col("injuries").alias("raw_injuries"),
        F.col("tow_away").alias("raw_tow"), F.col("federal_recordable").alias("raw_recordable"),
        parse.quick_id(F.col("crash_id")).alias("own_key"),
        parse.quick_id(F.col("dot_number")).alias("usdot_number"),
        *_timed(event_date="report_date", source_add_at="add_date", source_change_at="change_date"),
        parse.quick_time(F.col("report_time")).alias("report_time"),
        parse.quick_integer(F.col("report_seq_no")).alias("report_seq_no"),
        parse.quick_integer(F.col("fatalities")).alias("fatalities"),
        parse.quick_integer(F.col("injuries")).alias("injuries"),
        parse.source_boolean(F.col("tow_away")).alias("tow_away"),
        parse.source_boolean(F.col("federal_recordable")).alias("federal_recordable"),
        _text("report_state").alias("report_state"),
        _text("report_number").alias("report_number"),
    )
    reasons = parse.reasons(
        (_broken("crash_id", "own_key"), "invalid_source_record_key"),
        (_broken("dot_number", "usdot_number"), "invalid_usdot_number"),
        (_broken("raw_date", "event_date"), "invalid_event_date"),
        (_broken("add_date", "source_add_at"), "invalid_source_add_at"),
        (_broken("change_date", "source_change_at"), "invalid_source_change_at"),
        (_broken("raw_time", "report_time"), "invalid_report_time"),
        (_broken("raw_seq", "report_seq_no"), "invalid_report_seq_no"),
        (_broken("raw_fatalities", "fatalities"), "invalid_fatalities"),
        (_broken("raw_injuries", "injuries"), "invalid_injuries"),
        (_broken("raw_tow", "tow_away"), "invalid_tow_away"),
        (_broken("raw_recordable", "federal_recordable"), "invalid_federal_recordable"),
        (_impossible(), "impossible_event_chronology"),
    )
    placed = _placed(*[F.col(c) for c in _INCIDENT])
    key = _crash_key(F.col("own_key"), *[F.col(c) for c in _INCIDENT], F.col("report_seq_no"))
    # a bad date outranks everything; then the first parse reason; then what is missing
    excluded = (
        F.when(F.array_contains(reasons, "invalid_event_date"), "invalid_event_date")
        .when(F.size(reasons) > 0, parse.first_reason(reasons))
        .when(key.isNull(), "missing_source_record_key")
        .when(F.col("usdot_number").isNull(), "missing_usdot_number")
        .when(~F.col("federal_recordable").eqNullSafe(True), "not_federally_recordable")
        .when(~placed, "invalid_incident_key")
    )
    hashed = payload_hash(
        (F.col("usdot_number"), "plain"), *_hashed_times(), (F.col("report_state"), "text"), (F.col("report_number"), "text"),
        (F.col("report_time"), "number"), (F.col("report_seq_no"), "number"), (F.col("fatalities"), "number"),
        (F.col("injuries"), "number"), (F.col("tow_away"), "boolean"), (F.col("federal_recordable"), "boolean"),
        (reasons, "texts"),
    )
    return parsed.select(
        *_unobserved(place), F.lit("crashes").alias("feed_name"), key.alias("source_record_key"), "usdot_number",
        "event_date", "source_add_at", "source_change_at", *_observed(place),
        _reported().alias("source_proxy_reported_date"), _known_from().alias("source_proxy_valid_from"),
        "report_state", "report_number", "report_time", "report_seq_no", "fatalities", "injuries", "tow_away",
        "federal_recordable",
        F.when(excluded.isNull(), "eligible").otherwise("excluded").alias("model_eligibility"),
        excluded.alias("exclusion_reason"), reasons.alias("parse_reasons"), hashed.alias("record_hash"),
    )


def quarantine(inspections: DataFrame, crashes: DataFrame) -> DataFrame:
    """Rows of either feed with at least one parse reason."""
    columns = ("batch_id", "source_row_number", "feed_name", "source_record_key", "parse_reasons")
    both = inspections.select(*columns).unionByName(crashes.select(*columns))
    return both.where(F.size("parse_reasons") > 0)


def _candidate(df: DataFrame) -> DataFrame:
    shape = SEEN if "mask" in df.columns else CANDIDATE
    df = df.withColumnRenamed("first_observed_at", "observed_at")
    return df.select(*[(F.col(n) if n in df.columns else F.lit(None)).cast(t).alias(n) for n, t in shape.items()])


def _in_time() -> Column:
    return F.col("source_proxy_reported_date") >= F.col("event_date")


def inspection_candidates(inspections: DataFrame) -> DataFrame:
    """Typed inspections as CANDIDATE, with what a row lacks to count in the model."""
    whole = (
        (F.size("parse_reasons") == 0)
        & F.col("source_record_key").isNotNull()
        & F.col("usdot_number").isNotNull()
        & F.col("event_date").isNotNull()
        & F.col("source_proxy_reported_date").isNotNull()
    )
    why = (
        F.when(F.size("parse_reasons") > 0, parse.first_reason(F.col("parse_reasons")))
        .when(F.col("source_record_key").isNull(), "missing_source_record_key")
        .when(F.col("usdot_number").isNull(), "missing_usdot_number")
        .when(F.col("event_date").isNull(), "missing_event_date")
        .when(F.col("source_proxy_reported_date").isNull(), "missing_source_add_at")
    )
    return _candidate(
        inspections.withColumn("event_type", F.lit("inspection"))
        .withColumn("is_model_eligible", F.coalesce(whole & _in_time(), F.lit(False)))
        .withColumn("exclusion_reason", why)
    )


def crash_candidates(crashes: DataFrame) -> DataFrame:
    """Typed crash rows as CANDIDATE."""
    late = F.when(F.col("source_proxy_valid_from").isNull(), "missing_source_add_at")
    return _candidate(
        crashes.withColumn("event_type", F.lit("crash"))
        .withColumn("is_model_eligible", F.coalesce((F.col("model_eligibility") == "eligible") & _in_time(), F.lit(False)))
        .withColumn("exclusion_reason", F.coalesce("exclusion_reason", late))
    )


def change_candidates(inspections: DataFrame, crashes: DataFrame) -> DataFrame:
    """Both feeds in one shape (CANDIDATE)."""
    return inspection_candidates(inspections).unionByName(crash_candidates(crashes))


def seen_inspections(rows: DataFrame, steps: DataFrame) -> DataFrame:
    """The distinct texts of inspections, typed once, as SEEN. steps: numbered batches."""
    key = parse.quick_id(F.col("inspection_id"))
    return inspection_candidates(_inspections(seen_texts(rows, steps.where("feed_name = 'inspections'"), key), _SEEN))


def seen_candidates(inspections: DataFrame, crashes: DataFrame, steps: DataFrame) -> DataFrame:
    """The distinct texts of both feeds' rows, typed once, as SEEN: `change_candidates` for a history."""
    return seen_inspections(inspections, steps).unionByName(seen_crashes(crashes, steps))


def seen_crashes(rows: DataFrame, steps: DataFrame) -> DataFrame:
    """The distinct texts of crashes, typed once, as SEEN."""
    # the parts that make up for a missing id are read of rows without one alone
    parts = _text("report_state"), _text("report_number"), parse.source_date(F.col("report_date")), parse.report_time(F.col("report_time"))
    key = _crash_key(parse.quick_id(F.col("crash_id")), *parts, parse.nonnegative_integer(F.col("report_seq_no")))
    return crash_candidates(_crashes(seen_texts(rows, steps.where("feed_name = 'crashes'"), key), _SEEN))


def earliest_dates(inspections: DataFrame, batches: DataFrame) -> DataFrame:
    """batch_id, cutoff: the earliest event date of each batch (`history.cutoffs`) from its raw rows. Each text is parsed once a batch."""
    texts = _with_batch(inspections, batches, "inspections").select("batch_id", "insp_date").distinct()
    return texts.groupBy("batch_id").agg(F.min(parse.source_date(F.col("insp_date"))).alias("cutoff"))


def exclusion_counts(candidates: DataFrame) -> DataFrame:
    """feed_name, exclusion_reason, n_rows, n_keys of candidates that don't count in the model."""
    return (
        candidates.where(~F.col("is_model_eligible"))
        .groupBy("feed_name", F.coalesce("exclusion_reason", F.lit("other")).alias("exclusion_reason"))
        .agg(F.count("*").alias("n_rows"), F.countDistinct("source_record_key").alias("n_keys"))
    )
