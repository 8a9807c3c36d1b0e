"""Feeds made from the star-schema tables, in the form in which the real feeds arrive.

orders stand for inspections and order lines for vehicles in crashes, as text rows in six
snapshots a feed. Of each snapshot some rows are missing, some changed and some malformed, by
rules on their keys, so that every path of the history is met. Where a folder snapshots/ lies beside the
tables (`write_snapshots`), the rows are read from there.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.commits import exists
from tidemark.sources.staging import settled, shared_dir

#: (batch_id, feed_name, number, observed_at) of the snapshots.
_DAYS = ("1998-01-15", "1999-03-10", "2000-06-20", "2000-12-05", "2001-03-20", "2001-09-05")
BATCHES = [(f"insp-{n}", "inspections", n, f"{d} 12:00:00") for n, d in enumerate(_DAYS, 1)]
BATCHES += [(f"crash-{n}", "crashes", n, f"{d} 12:05:00") for n, d in enumerate(_DAYS, 1)]
#: A snapshot that has arrived and is not loaded.
PENDING = ("crash-7", "crashes", 7, "2001-12-01 12:00:00", "pending")
#: Months that the inspections feed reaches back.
WINDOW_MONTHS = 36


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def snapshot_batches(spark: SparkSession) -> DataFrame:
    """batch_id, feed_name, batch_no, observed_at, status of the snapshots, and one that is not loaded."""
    rows = [(b, f, n, o, "loaded") for b, f, n, o in BATCHES] + [PENDING]
    df = spark.createDataFrame(rows, "batch_id string, feed_name string, batch_no int, observed_text string, status string")
    return df.select("batch_id", "feed_name", "batch_no", F.col("observed_text").cast("timestamp").alias("observed_at"), "status")


#: Text columns of each feed's rows.
COLUMNS = {
    "inspections": ("inspection_id", "dot_number", "report_state", "report_number", "insp_date", "mcmis_add_date", "change_date", "viol_total", "oos_total"),
    "crashes": (
        "crash_id", "report_state", "report_number", "report_date", "report_time", "report_seq_no", "dot_number", "add_date", "change_date", "fatalities",
        "injuries", "tow_away", "federal_recordable",
    ),
}


def write_snapshots(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """Both feeds' text rows as tables partitioned by acquisition date, as snapshots arrive.

    A task writes its rows of all dates side by side, one file a date, so no row is moved or sorted for it.
    """
    days = snapshot_batches(spark).select("batch_id", acquisition_date())
    writers = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(writers)
    spark.conf.set(writers, len(BATCHES))
    try:
        for feed in COLUMNS:
            rows = raw_rows(spark, sf_dir, feed).join(F.broadcast(days), "batch_id")
            # small row groups, as several are open at once
            with settled(spark):
                rows.write.option("parquet.block.size", 32 << 20).option("compression", "zstd").partitionBy("acquisition_date").parquet(f"{folder}/{feed}")
    finally:
        spark.conf.set(writers, before)


def acquisition_date() -> Column:
    return F.date_format("observed_at", "yyyy-MM-dd").alias("acquisition_date")


def snapshots(spark: SparkSession, sf_dir: str) -> str:
    """The folder of the partitioned snapshots: snapshots/ beside the tables if there is one, else a new one in the shared folder."""
    if exists(spark, f"{sf_dir}/snapshots"):
        return f"{sf_dir}/snapshots"
    folder = f"{shared_dir(spark)}/snapshots-{uuid.uuid4().hex}"
    write_snapshots(spark, sf_dir, folder)
    return folder


def read_snapshots(spark: SparkSession, folder: str, feed: str) -> DataFrame:
    """A feed's rows with acquisition_date as the partition column."""
    cells = ", ".join(f"{c} string" for c in COLUMNS[feed])
    return spark.read.schema(f"batch_id string, source_row_number bigint, {cells}, acquisition_date string").parquet(f"{folder}/{feed}")


def compiled(spark: SparkSession) -> None:
    """Lets no stage run as one method that the JVM leaves to its interpreter (beyond 8000 bytes), unless the session sets a limit of its own.

    Typed rows and histories are wide projections: with the default limit they become such methods and take several times as long.
    """
    if spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "65535":
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


def raw_rows(spark: SparkSession, sf_dir: str, feed: str) -> DataFrame:
    """All of a feed's text rows: batch_id, source_row_number and its columns, from the snapshots beside the tables or made from the tables."""
    compiled(spark)
    if exists(spark, f"{sf_dir}/snapshots"):
        return read_snapshots(spark, f"{sf_dir}/snapshots", feed).drop("acquisition_date")
    return {"inspections": _made_inspections, "crashes": _made_crashes}[feed](spark, sf_dir)


def raw_inspections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_rows(spark, sf_dir, "inspections")


def raw_crashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_rows(spark, sf_dir, "crashes")


def _snapshots(rows: DataFrame, feed: str, key: Column, added: Column) -> DataFrame:
    """A row for each snapshot of the feed that was taken after it was added and does not miss it."""
    batches = F.array(
        *[
            F.struct(F.lit(b).alias("batch_id"), F.lit(n).alias("batch_no"), F.to_timestamp(F.lit(o)).alias("observed_at"), F.to_date(F.lit(o[:10])).alias("day"))
            for b, f, n, o in BATCHES
            if f == feed
        ]
    )
    held = rows.withColumn("s", F.explode(batches)).select("*", "s.*").drop("s")
    return held.where((added < F.col("day")) & ((key * 31 + F.col("batch_no")) % 11 != 0))


def _with_spelled(rows: DataFrame) -> DataFrame:
    """rows with d_text and added_text: both dates as feeds spell them, once for all snapshots of a row."""
    return rows.withColumns({f"{c}_text": F.date_format(c, "yyyyMMdd") for c in ("d", "added")})


def _spelled_once(rows: DataFrame, cells: dict[str, Column], kept: tuple[str, ...]) -> DataFrame:
    """rows with the cells that all snapshots of a row share, made before the snapshots are told apart, and the columns that the rest needs."""
    return rows.select(*kept, *[v.alias(n) for n, v in cells.items()])


def _made_inspections(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(
        (F.col("o_orderkey") + 1).alias("k"), (F.col("o_custkey") + 1).alias("c"), F.to_date("o_orderdate").alias("d"), F.col("o_orderstatus").alias("st")
    )
    k = F.col("k")
    o = _with_spelled(o.withColumn("added", F.expr("date_add(d, cast((k - 1) % 60 as int))")))
    spelled = {
        "inspection_id": F.when(k % 97 == 3, F.concat(F.lit("+00"), k.cast("string"), F.lit(".0"))).otherwise(k.cast("string")),
        "dot_number": F.when(k % 97 == 17, F.lit(" ")).when(k % 97 == 19, F.lit(None).cast("string")).otherwise(F.col("c").cast("string")),
        "report_state": F.when(k % 97 == 23, F.lit("  ")).otherwise(F.col("st")),
        "report_number": F.concat(F.lit("I-"), k.cast("string")),
        "insp_date": F.when(k % 97 == 5, F.lit("20230230")).when(k % 97 == 29, F.lit("21000101")).otherwise(F.col("d_text")),
        "mcmis_add_date": F.concat(F.col("added_text"), F.when(k % 97 == 31, F.lit(" 2400")).otherwise(F.lit(" 0900"))),
        "change_date": F.concat(F.col("added_text"), F.lit(" 1000")),
        "oos_total": F.least((k - 1) % 3, (k - 1) % 7).cast("string"),
    }
    o = _spelled_once(o, spelled, ("k", "d", "added"))
    s = _snapshots(o, "inspections", k, F.col("added")).where(F.col("d") >= F.add_months("day", -WINDOW_MONTHS))
    changed = (k * 31 + F.col("batch_no")) % 11 == 1
    viol = (k - 1) % 7 + F.when(changed, 1).otherwise(0)
    s = s.withColumn("viol_total", F.when(k % 97 == 11, F.lit("12.5")).otherwise(viol.cast("string")))
    return s.select("batch_id", k.alias("source_row_number"), *COLUMNS["inspections"])


def _made_crashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each vehicle (order line)."""
    # by order, so that lines are moved once for their grouping and for their order
    lines = (
        table(spark, sf_dir, "lineitem")
        .select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_linestatus")
        .repartition("l_orderkey")
        .groupBy("l_orderkey", "l_linenumber")
        .agg(F.min("l_partkey").alias("p"), F.min("l_returnflag").alias("rf"), F.min("l_linestatus").alias("ls"))
    )
    o = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") + 1).alias("c"), F.to_date("o_orderdate").alias("d"), F.col("o_orderstatus").alias("st"))
    v = lines.join(o, lines.l_orderkey == o.o_orderkey).withColumn("k", F.col("l_orderkey") * 8 + F.col("l_linenumber") + 1)
    k = F.col("k")
    v = _with_spelled(v.withColumn("added", F.expr("date_add(d, cast(p % 90 as int))")))
    spelled = {
        "crash_id": F.when(k % 89 == 7, F.lit(None).cast("string")).otherwise(k.cast("string")),
        "report_state": F.when(k % 89 == 13, F.lit(" ")).otherwise(F.col("st")),
        "report_number": F.concat(F.lit("C-"), F.col("l_orderkey").cast("string")),
        "report_date": F.when(k % 89 == 17, F.lit("20261340")).otherwise(F.col("d_text")),
        "report_time": F.when(k % 89 == 19, F.lit("2360")).otherwise((F.col("l_orderkey") % 24 * 100 + F.col("l_orderkey") % 60).cast("string")),
        "report_seq_no": F.col("l_linenumber").cast("string"),
        "dot_number": F.when(k % 89 == 23, F.lit(None).cast("string")).otherwise(F.col("c").cast("string")),
        "add_date": F.concat(F.col("added_text"), F.lit(" 1100")),
        "change_date": F.concat(F.col("added_text"), F.lit(" 1200")),
        "injuries": F.when(k % 89 == 29, F.lit("bad")).otherwise((F.col("p") % 5).cast("string")),
        "tow_away": F.when(F.col("ls") == "F", F.lit("Y")).otherwise(F.lit("no")),
        "federal_recordable": F.when(F.col("rf") != "N", F.lit("Y")).otherwise(F.lit("N")),
    }
    v = _spelled_once(v, spelled, ("k", "l_linenumber", "added"))
    s = _snapshots(v, "crashes", k, F.col("added"))
    changed = (k * 31 + F.col("batch_no")) % 11 == 1
    s = s.withColumn("fatalities", (F.col("l_linenumber") % 3 + F.when(changed, 1).otherwise(0)).cast("string"))
    return s.select("batch_id", k.alias("source_row_number"), *COLUMNS["crashes"])
