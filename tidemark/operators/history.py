"""The bitemporal version history: what was known of each record, and from when to when.

Two forms with equal results. `rebuild` makes the whole history of a set of batches with window
functions over each record's appearances - one shuffle by (feed, key) and a row an appearance, or, of texts
that were united before (`clean.seen_texts`), a row a run of batches with one text. `step` adds one batch to the open versions of its feed; `operators/stored.py` keeps
what it makes. Times of knowledge come from the batches, never from the clock.

Rules: a record starts with its first eligible appearance. A later appearance opens a new version
if its payload hash or eligibility differs from the one before, or if the record was deleted in
between; else the version is just seen again. A crash that is missing from a later batch is
deleted then; an inspection only if its event date is not before the batch's earliest event date,
and otherwise it has left the feed's window: a retention expiry, which changes no version. The first
batch of a feed knows each row from the day after its source date, later ones from their own time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators.clean import BLOCK, CANDIDATE

_CARRIED = {
    "event_type": "string", "usdot_number": "string", "source_add_at": "timestamp_ntz", "source_change_at": "timestamp_ntz", "is_model_eligible": "boolean",
    "exclusion_reason": "string", "record_hash": "string", "state": "string", "violation_count": "bigint", "oos_violation_count": "bigint", "report_state": "string",
    "report_number": "string", "report_time": "bigint", "report_seq_no": "bigint", "fatalities": "bigint", "injuries": "bigint", "tow_away": "boolean",
}
#: Columns of a version and their types.
VERSION = {
    "feed_name": "string", "source_record_key": "string", **_CARRIED, "event_date": "date", "reported_date": "date", "knowledge_valid_from": "timestamp",
    "availability_quality": "string", "first_observed_at": "timestamp", "is_deleted": "boolean", "deletion_reason": "string", "first_seen_batch_id": "string",
    "last_seen_batch_id": "string", "event_version_key": "string", "knowledge_valid_to": "timestamp", "predecessor_version_key": "string",
    "superseded_by_version_key": "string", "is_current": "boolean",
}
EXPIRY = {"source_record_key": "string", "batch_id": "string", "event_version_key": "string", "observed_at": "timestamp", "retention_cutoff": "date"}
PAYLOAD = tuple(_CARRIED)


def version_key(batch: Column, feed: Column, key: Column, deleted: Column) -> Column:
    """Identity of a version: nothing else can be made by the same batch of the same record."""
    return F.md5(F.concat_ws("|", batch, feed, key, deleted.cast("string")))


def numbered(batches: DataFrame) -> DataFrame:
    """batch_id, feed_name, observed_at, no: the batches of each feed in order of arrival."""
    order = W.partitionBy("feed_name").orderBy("observed_at", "batch_id")
    return batches.select("batch_id", "feed_name", "observed_at", F.row_number().over(order).alias("no"))


#: The batch of a step among the bits of its block (`clean.seen_texts`).
_PLACE = {"block": f"cast((no - 1) div {BLOCK} as int)", "place": f"cast((no - 1) % {BLOCK} as int)"}
_HELD = "shiftright(mask, place) % 2 = 1"


def appearances(seen: DataFrame, batches: DataFrame) -> DataFrame:
    """Candidates (a row a batch) of united ones (SEEN). batches: as numbered for the masks, or the first of them."""
    steps = numbered(batches).select("batch_id", "feed_name", "observed_at", *[F.expr(v).alias(k) for k, v in _PLACE.items()])
    return seen.join(F.broadcast(steps), ["feed_name", "block"]).where(_HELD).select(*CANDIDATE)


def cutoffs(candidates: DataFrame, steps: DataFrame) -> DataFrame:
    """batch_id, cutoff: the earliest event date of each batch of inspections."""
    mine = candidates.where("feed_name = 'inspections'")
    if "mask" in candidates.columns:
        places = steps.where("feed_name = 'inspections'").select("batch_id", *[F.expr(v).alias(k) for k, v in _PLACE.items()])
        # the masks that occur, before they are told apart by batches
        mine = mine.groupBy("block", "mask").agg(F.min("event_date").alias("event_date")).join(F.broadcast(places), "block").where(_HELD)
    return mine.groupBy("batch_id").agg(F.min("event_date").alias("cutoff"))


def _runs(candidates: DataFrame, steps: DataFrame) -> DataFrame:
    """candidates (`_packed`) with no, upto: the first and last of the successive batches that a row stands in. One row a run."""
    told = steps.select("batch_id", "feed_name", "no", "last_no", "observed_at")
    if "mask" not in candidates.columns:
        rows = candidates.join(F.broadcast(told.drop("feed_name")), "batch_id")
        return rows.withColumn("upto", F.col("no"))
    told = told.select("*", *[F.expr(v).alias(k) for k, v in _PLACE.items()])
    starts = F.expr(f"{_HELD} and (place = 0 or shiftright(mask, place - 1) % 2 = 0)")
    rows = candidates.join(F.broadcast(told), ["feed_name", "block"]).where(starts)
    # the ones from a run's first bit on; batches behind the last one given are not looked at
    ones = F.expr("cast(bit_count(shiftright(mask, place) & ~(shiftright(mask, place) + 1)) as int)")
    return rows.withColumn("upto", F.least(F.col("no") + ones - 1, "last_no")).drop("block", "mask", "place")


def _ahead(steps: DataFrame) -> DataFrame:
    """feed, at, chain: from each batch on, those whose cutoff is below all cutoffs before them; of crashes the batch alone.

    The first batch from `at` on with a cutoff of d or less is the first such in the chain, which is short: windows
    move forward, so a later cutoff is rarely below an earlier one. One row a batch.
    """
    a, b = steps.select(F.col("feed_name").alias("feed"), F.col("no").alias("at")), steps
    pairs = a.join(b, (F.col("feed") == F.col("feed_name")) & F.when(F.col("feed") == "crashes", F.col("no") == F.col("at")).otherwise(F.col("no") >= F.col("at")))
    before = F.min("cutoff").over(W.partitionBy("feed", "at").orderBy("no").rowsBetween(W.unboundedPreceding, -1))
    lower = (F.col("feed") == "crashes") | (F.col("cutoff").isNotNull() & (F.col("before").isNull() | (F.col("cutoff") < F.col("before"))))
    chain = F.array_sort(F.collect_list(F.struct("no", "batch_id", "observed_at", "cutoff"))).alias("chain")
    return pairs.withColumn("before", before).where(lower).groupBy("feed", "at").agg(chain)


#: What is looked at before the versions are whole. The rest rides along as one struct: a window or join writes each column of a row anew,
#: and a struct is one column. All its fields are read in one place, as Spark takes single ones out of it before the windows.
_APART = ("feed_name", "source_record_key", "record_hash", "is_model_eligible", "event_date", "source_proxy_reported_date", "source_proxy_valid_from")


def _packed(candidates: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Keyed candidates with those of PAYLOAD that `columns` name in one struct `row`.

    A keyless text loses its batches in place of a filter, which would be moved before the union of texts and make each row's key there.
    """
    rest = [c for c in PAYLOAD if c in columns and c not in _APART]
    row, keyed = F.struct(*(rest or ["feed_name"])).alias("row"), F.col("source_record_key").isNotNull()
    if "mask" not in candidates.columns:
        return candidates.where(keyed).select("batch_id", *_APART, row)
    # texts lie where their records are, by `record`; behind the filter on batches it is the key
    apart = [F.col("record").alias(c) if c == "source_record_key" else F.col(c) for c in _APART]
    return candidates.select("block", F.when(keyed, F.coalesce("mask", F.lit(0))).otherwise(0).alias("mask"), *apart, row)


#: A record; its key comes first, as sorts compare the first bytes of the first column by themselves and two feeds' names tell little apart.
_RECORD = ("source_record_key", "feed_name")


def _appearances(candidates: DataFrame, steps: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """The runs of records' appearances at which something may happen, from each record's first eligible one on, with what stands around them.

    A run (`_runs`) that equals the one before it, in the batch after it and with the next batch behind it, changes nothing and
    goes after the first pass; most do. before_no: the last batch before the run that has the record; final_no: the last one of all.
    reach: the batch up to which the record is there. deleted_in: the batch between it and the next run that deletes the record, if any.
    """
    rows = _runs(_packed(candidates, columns), steps)
    record = W.partitionBy(*_RECORD).orderBy("no")
    so_far, before = record.rowsBetween(W.unboundedPreceding, W.currentRow), record.rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumns(
        {
            "_started": F.max(F.col("is_model_eligible").cast("int")).over(before) == 1,
            "before_no": F.max("upto").over(before),
            **{f"before_{n}": F.lag(c).over(record) for n, c in (("hash", "record_hash"), ("eligible", "is_model_eligible"))},
            "next_no": F.lead("no").over(record),
            "final_no": F.max("upto").over(record.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)),
        }
    )
    first = ~F.coalesce("_started", F.lit(False))
    other = ~F.col("record_hash").eqNullSafe(F.col("before_hash")) | (F.col("is_model_eligible") != F.col("before_eligible"))
    rows = rows.where(F.col("is_model_eligible") | ~first).withColumns(
        {"differs": first | other, "next_no": F.coalesce("next_no", F.col("last_no") + 1), "reach": F.greatest("before_no", "upto"), "before_no": F.when(~first, F.col("before_no"))}
    )
    gap = F.col("next_no") > F.col("reach") + 1
    rows = rows.where(F.col("differs") | gap | (F.col("no") > F.col("before_no") + 1))
    rows = rows.drop("_started", "before_hash", "before_eligible", "last_no", "upto")
    # one row a batch
    rows = rows.join(F.broadcast(steps.select("feed_name", F.col("no").alias("reach"), F.col("observed_at").alias("last_observed"))), ["feed_name", "reach"])
    dated = lambda at: F.when(F.col("is_model_eligible") | ~(F.col("event_date") > F.to_date(at)), F.col("event_date"))
    rows = rows.withColumns({"own_date": dated("observed_at"), "end_date": dated("last_observed")})
    # the stored date is that of the row that opened the version; equal rows keep it while it lasts
    opened = F.last(F.when(F.col("differs"), F.struct("own_date")), True).over(so_far)["own_date"]
    crash = F.col("feed_name") == "crashes"
    rows = rows.withColumn("version_date", F.when(crash, F.col("end_date")).otherwise(opened))
    # one row a batch
    rows = rows.join(F.broadcast(_ahead(steps)), gap & (F.col("feed_name") == F.col("feed")) & (F.col("reach") + 1 == F.col("at")), "left").drop("feed", "at")
    gone = F.filter("chain", lambda s: (s["no"] < F.col("next_no")) & (crash | (F.col("version_date") >= s["cutoff"])))
    rows = rows.withColumn("deleted_in", F.when(gap, F.get(gone, F.lit(0)))).drop("chain")
    # the row behind a gap is kept, so it stands next to the row that its record was deleted after
    reborn = F.lag(F.col("deleted_in").isNotNull()).over(record)
    return rows.withColumn("opens", F.col("differs") | F.coalesce(reborn, F.lit(False)))


def rebuild(
    candidates: DataFrame, batches: DataFrame, columns: tuple[str, ...] = tuple(VERSION), starts: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """(versions, retention expiries) of all batches (batch_id, feed_name, observed_at, all applied).

    candidates: a row a batch, or united (SEEN); the batches may then end before those that the masks were numbered by.
    columns: those of VERSION that versions are made with. starts: the `cutoffs` of the batches, where they are known already;
    without them the candidates are read twice.
    """
    last = F.max("no").over(W.partitionBy("feed_name"))
    starts = cutoffs(candidates, numbered(batches)) if starts is None else starts
    steps = numbered(batches).join(starts, "batch_id", "left").withColumn("last_no", last)
    # all windows have one order, so the rows are sorted once
    seen = _appearances(candidates, steps, columns)
    first, d = F.col("no") == 1, F.col("deleted_in")
    # a row gives a version, a deletion, both or neither, in one pass that keeps the rows where they are
    both, dead_only, live_only = [F.array(*[F.lit(x) for x in xs]) for xs in ((False, True), (True,), (False,))]
    gives = F.when(F.col("opens") & d.isNotNull(), both).when(d.isNotNull(), dead_only).otherwise(live_only)
    either = lambda dead, live: F.when(F.col("is_deleted"), dead).otherwise(live)
    observed = either(d["observed_at"], F.col("observed_at"))
    made = {
        "step": either(d["no"], F.col("no")), "event_date": either(F.col("version_date"), F.col("own_date")), "first_observed_at": observed,
        "reported_date": F.when(~F.col("is_deleted") & first, F.col("source_proxy_reported_date")).otherwise(F.to_date(observed)),
        "knowledge_valid_from": F.when(~F.col("is_deleted") & first, F.col("source_proxy_valid_from")).otherwise(observed),
        "availability_quality": F.when(~F.col("is_deleted") & first, "source_proxy").otherwise("observed"),
        "deletion_reason": F.when(F.col("is_deleted"), "source_deleted"), "first_seen_batch_id": either(d["batch_id"], F.col("batch_id")),
        "own_last": F.when(F.col("is_deleted"), d["no"]), "before_no": either(F.col("reach"), F.col("before_no")),
    }
    versions = seen.where(F.col("opens") | d.isNotNull()).withColumn("is_deleted", F.explode(gives))
    versions = versions.select("feed_name", "source_record_key", "record_hash", "is_model_eligible", "row", "final_no", "is_deleted", *[v.alias(n) for n, v in made.items()])
    key = version_key(F.col("first_seen_batch_id"), F.col("feed_name"), F.col("source_record_key"), F.col("is_deleted"))
    chain = W.partitionBy(*_RECORD).orderBy("step")
    # a version was last seen in the batch of the appearance before what follows it, a deletion in its own
    ends = F.coalesce("own_last", F.lead("before_no").over(chain), "final_no")
    versions = versions.withColumn("event_version_key", key).withColumns(
        {
            "_last": ends,
            "knowledge_valid_to": F.lead("first_observed_at").over(chain),
            "predecessor_version_key": F.lag("event_version_key").over(chain),
            "superseded_by_version_key": F.lead("event_version_key").over(chain),
        }
    )
    names = steps.select("feed_name", F.col("no").alias("_last"), F.col("batch_id").alias("last_seen_batch_id"))
    versions = versions.join(F.broadcast(names), ["feed_name", "_last"])
    versions = versions.withColumn("is_current", F.col("knowledge_valid_to").isNull())
    versions = versions.select(*[(F.col(c) if c in versions.columns else F.col("row")[c]).alias(c) for c in VERSION if c in columns])
    # batches that missed a living record whose date lies before their window
    end = F.coalesce(d["no"], F.col("next_no")) - 1
    opened_by = F.last(F.when(F.col("opens"), F.col("batch_id")), True).over(W.partitionBy(*_RECORD).orderBy("no").rowsBetween(W.unboundedPreceding, W.currentRow))
    lapsed = seen.where("feed_name = 'inspections'").withColumn("opened_by", opened_by).where(end > F.col("reach"))
    lapsed = lapsed.select("source_record_key", "feed_name", "opened_by", "version_date", F.explode(F.sequence(F.col("reach") + 1, end)).alias("no"))
    missed = steps.where("feed_name = 'inspections'").select("no", "batch_id", "observed_at", "cutoff")
    expiries = (
        lapsed.join(F.broadcast(missed), "no")
        .where("version_date < cutoff")
        .select(
            "source_record_key",
            "batch_id",
            version_key(F.col("opened_by"), F.col("feed_name"), F.col("source_record_key"), F.lit(False)).alias("event_version_key"),
            "observed_at",
            F.col("cutoff").alias("retention_cutoff"),
        )
    )
    return versions, expiries


def pending(batches: DataFrame, applied: DataFrame) -> DataFrame:
    """Batches that are not applied yet. Replays of an applied batch are none; one that changed is an error."""
    changed = batches.join(
        applied.select("batch_id", F.col("feed_name").alias("f"), F.col("observed_at").alias("o")), "batch_id"
    ).where((F.col("f") != F.col("feed_name")) | (F.col("o") != F.col("observed_at")))
    if changed.limit(1).count():
        raise ValueError("a published batch changed its feed or its time")
    fresh = batches.join(F.broadcast(applied.select("batch_id")), "batch_id", "left_anti")
    newest = applied.groupBy(F.col("feed_name").alias("f")).agg(F.max("observed_at").alias("newest"))
    if fresh.join(F.broadcast(newest), (F.col("f") == F.col("feed_name")) & (F.col("observed_at") < F.col("newest"))).limit(1).count():
        raise ValueError("a batch of this feed that was observed later is applied already; its history has to be made anew")
    return fresh


#: What a step looks at in an open version, and in a candidate; the rest of either rides along as one struct (as in `_packed`).
_OLD_APART = ("event_version_key", "record_hash", "is_model_eligible", "event_date", "is_deleted")
_NEW_APART = ("record_hash", "is_model_eligible", "event_date", "source_proxy_reported_date", "source_proxy_valid_from")


def step(
    prior: DataFrame, candidates: DataFrame, feed: str, batch_id: str, observed_at: Column, has_history: bool, copies: Observation | None = None
) -> DataFrame:
    """What one batch of a feed makes of the feed's open versions: VERSION's columns, part and retention_cutoff.

    part: open (still current, or new) or closed (ended by this batch). retention_cutoff: on open versions that the batch
    misses outside the feed's window, the start of that window. candidates: of this batch only. A key that stands in it twice
    is an error: raised here or, where `copies` is given, left to be told by its n (rows of one key, the most of them) once the step is written.
    """
    least = candidates.agg(F.min("event_date")).first()[0] if feed == "inspections" else None
    cutoff = F.lit(least).cast("date")
    rows = candidates.where(F.col("source_record_key").isNotNull())
    n_rest, o_rest = [c for c in PAYLOAD if c not in _NEW_APART], [c for c in VERSION if c not in (*_OLD_APART, "source_record_key")]
    now = rows.select("source_record_key", *[F.col(c).alias(f"n_{c}") for c in _NEW_APART], F.struct(*n_rest).alias("n_row"), F.lit(True).alias("present"))
    # the join's order by key serves the count
    now = now.withColumn("n_copies", F.count("*").over(W.partitionBy("source_record_key")))
    if copies is None:
        if now.where("n_copies > 1").limit(1).count():
            raise ValueError(f"batch {batch_id} holds a key twice")
        now = now.drop("n_copies")
    both = prior.select("source_record_key", *_OLD_APART, F.struct(*o_rest).alias("o_row")).join(now, "source_record_key", "full")
    if copies is not None:
        both = both.observe(copies, F.max("n_copies").alias("n"))
    was = lambda c: F.col(c) if c in (*_OLD_APART, "source_record_key") else F.col("o_row")[c]
    new = lambda c: F.col(f"n_{c}") if c in _NEW_APART else F.col("n_row")[c]
    had, present = F.col("event_version_key").isNotNull(), F.coalesce("present", F.lit(False))
    same = (F.col("record_hash") == F.col("n_record_hash")) & (F.col("is_model_eligible") == F.col("n_is_model_eligible")) & ~F.col("is_deleted")
    opens = present & F.when(had, ~same).otherwise(F.col("n_is_model_eligible"))
    in_window = F.lit(True) if feed == "crashes" else F.coalesce(F.col("event_date") >= cutoff, F.lit(False))
    dies = had & ~present & ~F.col("is_deleted") & in_window
    both = both.withColumn("opens", F.coalesce(opens, F.lit(False))).withColumn("dies", F.coalesce(dies, F.lit(False)))
    made = version_key(F.lit(batch_id), F.lit(feed), F.col("source_record_key"), F.col("dies"))
    ended = F.col("opens") | F.col("dies")
    seen = present & had & ~F.col("opens")
    lapsed = had & ~present & ~F.col("is_deleted") & (F.col("event_date") < cutoff) & (F.lit(feed) == "inspections")
    old = {c: was(c) for c in VERSION} | {
        "knowledge_valid_to": F.when(ended, observed_at).otherwise(was("knowledge_valid_to")),
        "is_current": ~ended,
        "superseded_by_version_key": F.when(ended, made).otherwise(was("superseded_by_version_key")),
        "last_seen_batch_id": F.when(seen & ~F.col("is_deleted"), F.lit(batch_id)).otherwise(was("last_seen_batch_id")),
    }
    future = ~F.col("n_is_model_eligible") & (F.col("n_event_date") > F.to_date(observed_at))
    clock = (lambda proxy, own: own) if has_history else (lambda proxy, own: proxy)
    fresh = {
        "feed_name": F.lit(feed),
        "source_record_key": F.col("source_record_key"),
        "event_version_key": made,
        "predecessor_version_key": F.col("event_version_key"),
        "superseded_by_version_key": F.lit(None),
        "knowledge_valid_to": F.lit(None),
        "is_current": F.lit(True),
        "is_deleted": F.col("dies"),
        "deletion_reason": F.when(F.col("dies"), "source_deleted"),
        "first_observed_at": observed_at,
        "first_seen_batch_id": F.lit(batch_id),
        "last_seen_batch_id": F.lit(batch_id),
        "event_date": F.when(F.col("dies"), F.col("event_date")).when(~F.coalesce(future, F.lit(False)), F.col("n_event_date")),
        "reported_date": F.when(F.col("dies"), F.to_date(observed_at)).otherwise(clock(F.col("n_source_proxy_reported_date"), F.to_date(observed_at))),
        "knowledge_valid_from": F.when(F.col("dies"), observed_at).otherwise(clock(F.col("n_source_proxy_valid_from"), observed_at)),
        "availability_quality": F.when(F.col("dies") | F.lit(has_history), "observed").otherwise("source_proxy"),
    }
    fresh |= {c: F.when(F.col("dies"), was(c)).otherwise(new(c)) for c in PAYLOAD}

    def version(columns: dict[str, Column], part: Column, cutoff: Column) -> Column:
        cells = [columns[n].cast(t).alias(n) for n, t in VERSION.items()]
        return F.struct(*cells, part.alias("part"), cutoff.cast("date").alias("retention_cutoff"))

    both_versions = F.array(
        F.when(had, version(old, F.when(ended, "closed").otherwise("open"), F.when(lapsed, cutoff))),
        F.when(ended, version(fresh, F.lit("open"), F.lit(None))),
    )
    return both.select(F.inline(F.array_compact(both_versions)))


def lapses(made: DataFrame, batch_id: str, observed_at: Column) -> DataFrame:
    """The retention expiries among the versions of a step."""
    return made.where(F.col("retention_cutoff").isNotNull()).select(
        "source_record_key", F.lit(batch_id).alias("batch_id"), "event_version_key", observed_at.alias("observed_at"), "retention_cutoff"
    )


def apply_batch(
    versions: DataFrame, candidates: DataFrame, feed: str, batch_id: str, observed_at: Column, has_history: bool
) -> tuple[DataFrame, DataFrame]:
    """(versions, new retention expiries) after one batch of a feed; other feeds' versions and those that are closed pass through."""
    current = (F.col("feed_name") == feed) & F.col("is_current")
    made = step(versions.where(current), candidates, feed, batch_id, observed_at, has_history)
    return versions.where(~current).unionByName(made.select(*versions.columns)), lapses(made, batch_id, observed_at)


def visible_at(t: Column) -> Column:
    """Versions known at an instant: both bounds are strict, so at a correction neither side shows."""
    return (F.col("knowledge_valid_from") < t) & (F.col("knowledge_valid_to").isNull() | (F.col("knowledge_valid_to") > t))
