"""Tables written between the steps of a job, in the folder that all executors share.

A written table cuts lineage and survives lost executors: its readers never recompute what stands before it.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session. Where it is unset, a new local folder on a local master, and else an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def staged(df: DataFrame) -> DataFrame:
    """df written as Parquet below the shared folder and read again."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Deletes a query's shuffle files when the query has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def settled(spark: SparkSession) -> Iterator[None]:
    """For writes: what they shuffled goes with their end. Else it stays on the disks until the driver happens to collect garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def staged_small(df: DataFrame) -> DataFrame:
    """As `staged`, for wide tables: packed tightly, and with the write's shuffles deleted."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/stage-{uuid.uuid4().hex}"
    with settled(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
