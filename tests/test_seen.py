"""Rows that snapshots repeat were typed, staged and put in order once a snapshot."""

import random

from pyspark.sql import functions as F

from tidemark.operators import clean, history
from tidemark.plans import jobs
from tidemark.sources import tables

BATCHES = "batch_id string, feed_name string, observed_at timestamp"


def _told(df):
    return sorted(tuple(str(x) for x in r) for r in df.select(*sorted(df.columns)).collect())


def _texts(dice, feed, ids):
    """(batch, row): rows of some ids in each batch, with few distinct texts, gaps, and keys that are spelled in two ways."""
    rows = []
    for b in ids:
        for k in range(1, 13):
            if dice.random() < 0.3:
                continue
            key, day = dice.choice([str(k), f"{k}.0"]), dice.choice(["19970105", "19980105", "20070101", "x"])
            cells = dict.fromkeys(tables.COLUMNS[feed], "1") | {"dot_number": dice.choice(["7", None]), "report_state": "A", "change_date": None, "federal_recordable": "Y"}
            if feed == "inspections":
                cells |= {"inspection_id": key, "insp_date": day, "mcmis_add_date": "19980110 0900", "viol_total": dice.choice(["3", "3", "03"])}
            else:
                cells |= {"crash_id": key, "report_date": day, "add_date": "19980110 0900", "report_time": "930", "fatalities": dice.choice(["0", "0", "00"])}
            rows.append((f"{feed}-{b}", len(rows), *[cells[c] for c in tables.COLUMNS[feed]]))
    return rows


def test_united_texts_give_the_same_history_beyond_a_block(spark):
    dice = random.Random(5)
    n = clean.BLOCK + 3
    known = spark.createDataFrame([(f"{f}-{b}", f, f"{1998 + b // 12}-{b % 12 + 1:02d}-15 12:00:00") for f in tables.COLUMNS for b in range(n)], "batch_id string, feed_name string, t string")
    known = known.select("batch_id", "feed_name", F.col("t").cast("timestamp").alias("observed_at"))
    raw = {
        f: spark.createDataFrame(_texts(dice, f, range(n)), "batch_id string, source_row_number bigint, " + ", ".join(f"{c} string" for c in cells))
        for f, cells in tables.COLUMNS.items()
    }
    loaded = known.withColumn("status", F.lit("loaded"))
    plain = clean.change_candidates(clean.clean_inspections(raw["inspections"], loaded), clean.clean_crashes(raw["crashes"], loaded)).localCheckpoint()
    seen = clean.seen_candidates(raw["inspections"], raw["crashes"], history.numbered(known)).localCheckpoint()
    assert seen.columns == list(clean.SEEN) and seen.count() < plain.count()
    assert _told(history.appearances(seen, known)) == _told(plain)
    # all batches, and the first of them
    for some in (known, known.where("observed_at < '2000-05-01'")):
        mine = plain.join(some.select("batch_id"), "batch_id", "left_semi")
        for a, b in zip(history.rebuild(seen, some), history.rebuild(mine, some)):
            assert _told(a) == _told(b)


def test_doubled_rows_are_counted_and_change_no_history(spark):
    raw = tables.raw_inspections(spark, "/root/testdata/sf0.001").where("source_row_number % 40 = 1")
    steps = history.numbered(jobs.batches(spark))
    once, twice = (clean.seen_inspections(r, steps).localCheckpoint() for r in (raw, raw.unionByName(raw.where("batch_id = 'insp-3'"))))
    assert once.where("copies > 0").count() == 0
    assert twice.agg(F.sum("copies")).first()[0] == raw.where("batch_id = 'insp-3'").count() > 0
    assert _told(once.drop("copies")) == _told(twice.drop("copies"))


def test_histories_type_each_text_once(spark, monkeypatch):
    found, plain = [], jobs.staged
    monkeypatch.setattr(jobs, "staged", lambda df: found.append(df) or plain(df))
    jobs.versions(spark, "/root/testdata/sf0.001")
    rows = jobs.candidates(spark, "/root/testdata/sf0.001").count()
    assert 2 * found[0].count() < rows
