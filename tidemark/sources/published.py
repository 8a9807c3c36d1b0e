"""Datasets that are written once and appear whole.

A dataset is written aside, read back, held against what it was made from, and published by one marker under its name.
A run that is killed before leaves a folder without a marker, which the next run ignores and writes anew. The same
content under a name again is no write; other content is a conflict.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.keys import fingerprint
from tidemark.sources import commits as marks


def _marker(folder: str, name: str) -> str:
    return f"{folder}/published/{name}.json"


def find(spark: SparkSession, folder: str, name: str) -> dict | None:
    """fingerprint, n_rows and data (its path) of a published dataset."""
    path = _marker(folder.rstrip("/"), name)
    return json.loads(marks.content(spark, path)) if marks.exists(spark, path) else None


def publish(df: DataFrame, folder: str, name: str | None = None) -> str:
    """The path of the dataset, which has the rows of df. name: by default the fingerprint of its content."""
    spark, folder = df.sparkSession, folder.rstrip("/")
    told = fingerprint(df).first()
    name = name or told["fingerprint"]
    known = find(spark, folder, name)
    if known is None:
        data = f"{folder}/data/{name}-{uuid.uuid4().hex}"
        df.write.parquet(data)
        if fingerprint(spark.read.schema(df.schema).parquet(data)).first() != told:
            raise ValueError(f"{name}: what was written differs from its source")
        marks.publish(spark, _marker(folder, name), json.dumps({"fingerprint": told["fingerprint"], "n_rows": told["n_rows"], "data": data}))
        return data
    if known["fingerprint"] != told["fingerprint"]:
        raise ValueError(f"{name} is published with other rows")
    if fingerprint(spark.read.schema(df.schema).parquet(known["data"])).first() != told:
        raise ValueError(f"{name}: {known['data']} holds other rows than were published")
    return known["data"]


def sweep(spark: SparkSession, folder: str) -> list[str]:
    """Deletes what killed runs left. Only while nobody writes."""
    folder = folder.rstrip("/")
    names = [n.removesuffix(".json") for n in marks.children(spark, f"{folder}/published") if n[0] not in "._"]
    return marks.sweep(spark, f"{folder}/data", {find(spark, folder, n)["data"].rsplit("/", 1)[1] for n in names})
