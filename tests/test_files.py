import csv
import gzip
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from tidemark.sources import files
from tidemark.streaming import arrivals


def test_csv_round_trip(spark, tmp_path):
    """Random cells of awkward characters through the CSV writer of the standard library, behind a byte-order mark."""
    dice = random.Random(12)
    columns = ["k", "x y", "z"]
    cells = [[dice.choice(["", "0", "007"]), "".join(dice.choice('aß,"\n\\ \'') for _ in range(dice.randrange(6))), str(n)] for n in range(300)]
    buffer = io.StringIO()
    writer = csv.writer(buffer, lineterminator="\n")
    writer.writerows([columns, *cells])
    src = tmp_path / "snapshot.csv.gz"
    src.write_bytes(gzip.compress(b"\xef\xbb\xbf" + buffer.getvalue().encode()))
    rows = files.read_contract_csv(spark, str(src), columns, empty_as_null=False).orderBy("source_row_number").collect()
    assert [list(r) for r in rows] == [[i, *c] for i, c in enumerate(cells, 1)]
    empty = sum(c[0] == "" for c in cells)
    assert files.read_contract_csv(spark, str(src), columns, empty_as_null=True).where("k is null").count() == empty > 0
    done = files.derive_parquet(spark, str(src), str(tmp_path / "out"), columns).first()
    assert done["equal"] and done["source_rows"] == done["derived_rows"] == 300 and done["nulls"] == 0
    with pytest.raises(ValueError, match="header"):
        files.read_contract_csv(spark, str(src), columns[::-1], True)


def test_manifests(spark):
    feeds = {"crashes": {"dataset": "d", "url": "u", "fingerprint": "f", "columns": 3}}
    key = "raw/feed=crashes/acquisition_date=2026-01-02/snapshot.csv.gz"
    schema = "feed_name string, dataset_id string, url string, n_columns int, schema_fingerprint string, object_key string, object_sha256 string, observed_at string, acquisition_date string"
    good = ("crashes", "d", "u", 3, "f", key, "s", "2026-01-02T10:00:00Z", "2026-01-02")
    bad = ("crashes", "d", "v", 3, "f", key, "s", "2026-01-03T10:00:00Z", "2026-01-02")
    df = spark.createDataFrame([good, bad], schema)
    made = files.batch_id(*[F.col(c) for c in ("feed_name", "dataset_id", "observed_at", "object_key", "object_sha256")])
    df = df.withColumn("batch_id", made)
    got = sorted(r["violated"] for r in files.manifest_violations(df, feeds).collect())
    assert got == [[], ["url", "acquisition_date", "object_key"]]
    assert files.backfill(df, "crashes", "2026-01-01", "2026-01-02").count() == 2
    for a in (("x", "1", "2"), ("crashes", "2", "1")):
        with pytest.raises(ValueError):
            files.backfill(df, *a)


def test_notifications(spark):
    one = {"Records": [{"s3": {"bucket": {"name": "b"}, "object": {"key": "raw/feed%3Dx/manifest.json", "versionId": "1"}}}]}
    other = {"Records": [{"s3": {"bucket": {"name": "b"}, "object": {"key": "raw/other.csv"}}}]}
    bodies = [json.dumps(one), json.dumps({"Type": "Notification", "Message": json.dumps(one)}), json.dumps({"Event": "s3:TestEvent"}), "nonsense", json.dumps(other)]
    found, rejected = arrivals.flatten(spark.createDataFrame([(b,) for b in bodies], "body string"))
    assert [tuple(r) for r in found.collect()] == [("b", "raw/feed=x/manifest.json", "1")]
    assert sorted(r["reason"] for r in rejected.collect()) == ["malformed", "not_a_manifest"]


def test_incremental_load_is_idempotent(spark, tmp_path):
    src, table = tmp_path / "in", tmp_path / "table"
    src.mkdir()
    line = lambda b: json.dumps({"batch_id": b, "feed_name": "crashes", "observed_at": "2026-01-01T00:00:00Z", "row_count": 1})
    (src / "1.json").write_text(line("a") + "\n" + line("a") + "\n" + line("b") + "\n")
    arrivals.load_new(spark, str(src), str(table), str(tmp_path / "ck"))
    (src / "2.json").write_text(line("b") + "\n" + line("c") + "\n")
    arrivals.load_new(spark, str(src), str(table), str(tmp_path / "ck"))
    arrivals.load_new(spark, str(src), str(table), str(tmp_path / "ck"))
    assert sorted(r["batch_id"] for r in spark.read.parquet(str(table)).collect()) == ["a", "b", "c"]


def test_write_once(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "i int, s string")
    path = files.write_once(df, str(tmp_path))
    assert files.write_once(df, str(tmp_path)) == path and spark.read.parquet(path).count() == 1
