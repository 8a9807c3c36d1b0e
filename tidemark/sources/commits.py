"""Commit markers: what a job wrote counts from the moment its marker stands.

A marker is a small file that appears whole under its name or not at all: it is written aside and renamed. Whatever
was written before it and has no marker is left over from a killed run; readers don't see it, a repeated run writes
anew, and `sweep` deletes it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def filesystem(spark: SparkSession, path: str):
    """(Hadoop file system of the path, the path as its object)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = filesystem(spark, path)
    return fs.exists(p)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none if there is no such folder."""
    fs, p = filesystem(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def content(spark: SparkSession, path: str) -> str:
    """A small file's text."""
    fs, p = filesystem(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    fs, p = filesystem(spark, path)
    fs.delete(p, True)


def publish(spark: SparkSession, path: str, content: str) -> None:
    """Writes the marker. One that stands already stays, and is an error."""
    fs, target = filesystem(spark, path)
    folder, name = path.rsplit("/", 1)
    aside = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_{name}.{uuid.uuid4().hex}")
    out = fs.create(aside, False)
    out.write(content.encode())
    out.close()
    if fs.exists(target) or not fs.rename(aside, target):
        fs.delete(aside, False)
        raise FileExistsError(path)


def sweep(spark: SparkSession, folder: str, named: set[str]) -> list[str]:
    """Deletes the folder's children that no marker names. Only while no job writes there."""
    left = [n for n in children(spark, folder) if n not in named]
    for n in left:
        remove(spark, f"{folder}/{n}")
    return left
