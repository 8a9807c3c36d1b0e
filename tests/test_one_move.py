"""Features moved an event once a month that it served, labels and current events staged all versions, a replay shuffled its texts for each history."""

from pyspark.sql import functions as F
from test_one_shuffle import _moved

from tidemark.operators import dataset, features, incidents
from tidemark.plans import jobs

SF = "/root/testdata/sf0.001"


def _told(df):
    return sorted(tuple(str(x) for x in r) for r in df.select(*sorted(df.columns)).collect())


def _staged(monkeypatch):
    found, plain = [], jobs.staged
    monkeypatch.setattr(jobs, "staged", lambda df: found.append(df.columns) or plain(df))
    return found


def test_labels_move_events_to_their_carrier_and_nothing_else(spark, monkeypatch):
    found = _staged(monkeypatch)
    moved = [line for line in _moved(jobs.labels(spark, SF)) if "usdot_number" in line or "carrier_crash_key" in line]
    assert found == [["batch_id", "cutoff"]] and len(moved) == 1 and "hashpartitioning(usdot_number#" in moved[0] and "scoring_date" not in moved[0]


def test_labels_in_one_pass_equal_labels_joined(spark):
    versions = jobs.versions(spark, SF, jobs.NEEDED).localCheckpoint()
    events = incidents.events_union(versions, jobs.EVENT).localCheckpoint()
    grid = features.month_grid(jobs.batches(spark)).where(F.add_months("scoring_date", 6) <= F.lit(jobs.CUTOFF))
    plain = features.training_features(events, grid)
    joined, once = dataset.labels(plain, incidents.crashes(versions), jobs.CUTOFF), dataset.labelled(events, grid, jobs.CUTOFF)
    assert once.columns == joined.columns and _told(once) == _told(joined) and once.where("label = 1").count() > 10
    # the versions behind some of the rows, by the plain join of versions and months
    some = plain.where("cast(usdot_number as bigint) % 3 = 1 and month(scoring_date) % 4 = 1").localCheckpoint()
    t, inspection = F.col("scoring_date"), F.col("event_type") == "inspection"
    both = events.join(some.select("usdot_number", "scoring_date"), "usdot_number")
    shown = (F.col("knowledge_valid_from") < t.cast("timestamp")) & (F.col("knowledge_valid_to").isNull() | (F.col("knowledge_valid_to") > t.cast("timestamp")))
    reach = F.when(inspection, F.add_months(t, -6)).otherwise(F.add_months(t, -24))
    back = ~F.col("is_deleted") & (F.col("event_date") < t) & (F.col("reported_date") < t) & (F.col("event_date") >= reach) & shown
    ahead = ~inspection & dataset.visible_on(jobs.CUTOFF) & (F.col("event_date") >= t) & (F.col("event_date") < F.add_months(t, 6))
    used = dataset.contributions(some, events, jobs.CUTOFF)
    assert _told(used) == _told(both.where(back | ahead).select(*used.columns).distinct()) and used.count() > 50
    # versions are not multiplied by months on their way
    assert "explode" not in used._jdf.queryExecution().optimizedPlan().toString()


def test_current_events_stage_no_versions_and_join_no_stretches(spark, monkeypatch):
    found = _staged(monkeypatch)
    made = jobs.current_events(spark, SF)
    assert found == [["batch_id", "cutoff"]]
    vehicles = incidents.crashes(jobs.versions(spark, SF)).select(*incidents.VEHICLE).localCheckpoint()
    want = incidents.segments(vehicles).where("is_current")
    assert _told(incidents.current_segments(vehicles)) == _told(want) and want.count() > 100
    assert made.where("event_type = 'crash'").count() == want.where("not is_deleted").count()


def test_a_replay_deals_texts_out_once_and_stages_none(spark, monkeypatch):
    found = _staged(monkeypatch)
    made = jobs.replay_identity(spark, SF)
    assert found == [["batch_id", "cutoff"]]
    made.collect()
    plan = made._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("Initial Plan")]
    assert final.count("Exchange hashpartitioning(record#") - final.count("ReusedExchange") <= 2
