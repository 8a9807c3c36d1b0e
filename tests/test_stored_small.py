"""The stored history kept every state that it had replaced, and a feed's first batches took a step each."""

import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import clean, history
from tidemark.operators.stored import StoredHistory
from tidemark.plans import jobs
from tidemark.sources import commits, tables
from tidemark.sources.staging import staged_small
from tidemark.streaming import arrivals

SF = "/root/testdata/sf0.001"
UNITED = {"inspections": clean.seen_inspections, "crashes": clean.seen_crashes}


def told(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def united(feed, rows, known):
    return UNITED[feed](rows, history.numbered(known))


def raw(spark, feed, ids):
    rows = tables.raw_rows(spark, SF, feed).where("source_row_number % 37 = 1").where(F.col("batch_id").isin(ids))
    return spark.createDataFrame(rows.collect(), rows.schema)


def batches(feed):
    return [(b, datetime.fromisoformat(o)) for b, f, _, o in tables.BATCHES if f == feed]


def typed(spark, feed):
    known = tables.snapshot_batches(spark)
    if feed == "inspections":
        return lambda rows: clean.inspection_candidates(clean.clean_inspections(rows, known))
    return lambda rows: clean.crash_candidates(clean.clean_crashes(rows, known))


@pytest.mark.parametrize("feed", ["inspections", "crashes"])
def test_first_batches_at_once_equal_a_step_each(spark, tmp_path, feed):
    ids = batches(feed)[:4]
    rows = raw(spark, feed, [b for b, _ in ids])
    one, each = StoredHistory(spark, f"{tmp_path}/one"), StoredHistory(spark, f"{tmp_path}/each")
    mine = lambda b: rows.where(F.col("batch_id") == b)
    assert one.begin(feed, [(b, at, mine(b), mine(b).count()) for b, at in ids[:3]], lambda r, k: united(feed, r, k)) == 3
    for b, at in ids[:3]:
        each.apply(b, feed, at, typed(spark, feed), mine(b), mine(b).count())
    assert len(one.commits()) == 1 and len(each.commits()) == 3
    one.apply(*ids[3][:1], feed, ids[3][1], typed(spark, feed), mine(ids[3][0]))
    each.apply(*ids[3][:1], feed, ids[3][1], typed(spark, feed), mine(ids[3][0]))
    cells = "batch_id string, source_row_number bigint"
    for what in (lambda s: s.versions(), lambda s: s.expiries(), lambda s: s.rows(cells, feed), lambda s: s.applied()):
        assert told(what(one)) == told(what(each))
    with pytest.raises(ValueError, match="begun"):
        one.begin(feed, [], lambda r, k: united(feed, r, k))


def test_first_batches_stop_at_one_that_lacks_rows_and_refuse_doubled_keys(spark, tmp_path):
    ids = batches("inspections")
    rows = raw(spark, "inspections", [b for b, _ in ids])
    mine = lambda b: rows.where(F.col("batch_id") == b)
    make = lambda r, k: united("inspections", r, k)
    store = StoredHistory(spark, f"{tmp_path}/short")
    assert store.begin("inspections", [(b, at, mine(b), mine(b).count() + (i == 1)) for i, (b, at) in enumerate(ids[:3])], make) == 1
    assert [r["batch_id"] for r in store.applied().collect()] == [ids[0][0]]
    again = mine(ids[2][0]).limit(1)
    for i, more in enumerate((again, again.withColumn("viol_total", F.lit("77")))):
        store = StoredHistory(spark, f"{tmp_path}/{i}")
        with pytest.raises(ValueError, match="twice"):
            store.begin("inspections", [(b, at, mine(b).unionByName(more) if i == 2 else mine(b), None) for i, (b, at) in enumerate(ids[:3])], make)
        assert not store.commits()
        store = StoredHistory(spark, f"{tmp_path}/step{i}")
        with pytest.raises(ValueError, match="twice"):
            store.apply(ids[2][0], "inspections", ids[2][1], typed(spark, "inspections"), mine(ids[2][0]).unionByName(more))
        assert not store.commits()


def test_a_stream_begins_feeds_at_once_and_fails_where_it_did(spark, tmp_path):
    rows = {f: raw(spark, f, [b for b, _ in batches(f)]) for f in UNITED}
    rows_of = lambda m: rows[m["feed_name"]].where(F.col("batch_id") == m["batch_id"])
    store = StoredHistory(spark, f"{tmp_path}/history", alone=True)
    made = [(b, f, at, rows[f].where(F.col("batch_id") == b).count() + (b == "crash-3")) for f in UNITED for b, at in batches(f)[:4]]
    spark.createDataFrame(made, arrivals.MANIFEST).coalesce(1).write.json(f"{tmp_path}/in")
    with pytest.raises(Exception, match="its manifest"):
        arrivals.load_history(spark, f"{tmp_path}/in", store, f"{tmp_path}/checkpoint", rows_of, lambda r, m: typed(spark, m["feed_name"])(r), united)
    found = {r["batch_id"] for r in store.applied().collect()}
    assert {"crash-1", "crash-2", "insp-1", "insp-2", "insp-3"} <= found and "crash-3" not in found and "crash-4" not in found


def test_a_store_used_alone_keeps_the_latest_open_versions_only(spark, tmp_path):
    ids = batches("crashes")
    rows = raw(spark, "crashes", [b for b, _ in ids])
    kept, alone = StoredHistory(spark, f"{tmp_path}/kept"), StoredHistory(spark, f"{tmp_path}/alone", alone=True)
    for s in (kept, alone):
        for b, at in ids:
            s.apply(b, "crashes", at, typed(spark, "crashes"), rows.where(F.col("batch_id") == b))
    places = lambda s: [c["no"] for c in s.commits() if commits.exists(spark, f"{s.root}/data/{c['data']}/versions/feed=crashes/part=open")]
    assert places(kept) == list(range(6)) and places(alone) == [5]
    assert told(alone.versions()) == told(kept.versions())
    assert kept.sweep() == [] and places(kept) == [5] and told(kept.versions()) == told(alone.versions())


def test_the_jobs_stores_are_used_alone(spark):
    store = jobs._arrivals_loaded(spark, SF)
    # three first batches of each feed in a step, the other three of each in one of their own
    assert store.alone and len(store.commits()) == 8


def test_a_settled_write_leaves_no_shuffle(spark):
    tracker = lambda: {b.toString() for b in _blocks(spark)}
    before = tracker()
    made = staged_small(spark.range(1000).repartition(3, "id").groupBy("id").count())
    left = lambda: [b for b in tracker() - before if b.startswith("shuffle_")]
    # they are deleted in the background
    for _ in range(50):
        if not left():
            break
        time.sleep(0.1)
    assert not left() and made.count() == 1000


def _blocks(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return [found.apply(i) for i in range(found.size())]
