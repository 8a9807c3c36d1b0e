"""Corpus pipeline: STAGES are applied to `documents` in order, each on what its predecessor kept.

All stages but the last return the columns of their input, whatever their names; n_chars follows the text.

Defined results: a null or empty text is judged by its lack of features, has no lines to cut, is a copy
of every other such text, holds no window and has no pieces (a null one null); null doc_ids stay null;
rows equal in doc_id and text fare alike in every stage, and one of them is left by near_duplicates; a
null source is a source of its own; without labels of both classes all rows are kept; an empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.decontaminate import drop_contaminated
from tidemark.llm.lines import drop_boilerplate
from tidemark.llm.pieces import MODEL, encode
from tidemark.llm.quality import keep_accepted, train
from tidemark.llm.similar import drop_similar
from tidemark.llm.text import read_table
from tidemark.sources.staging import staged


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the classifier, learned from `labels`, rejects."""
    labels = read_table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return keep_accepted(docs, train(docs, labels))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts boilerplate lines of each source from its documents; all documents stay."""
    return drop_boilerplate(docs, "n_chars")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group linked by five-word shingle similarity of 0.8 or more, the one with the smallest doc_id.

    Links are sought in the SimHash balls and, beyond their reach, by MinHash bands; each is verified.
    """
    return drop_similar(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item."""
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str, model: str = MODEL) -> DataFrame:
    """doc_id, n_pieces and the sampled pieces of each document that is left; model: a vocabulary file."""
    return encode(docs, model)


STAGES = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("pieces", pieces),
]

#: Classifier, fingerprints and pieces are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage over the whole documents table."""
    docs = read_table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = staged(docs)
    return docs
