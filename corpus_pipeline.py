"""A training-corpus pipeline of five stages over ``documents``.

Each stage takes what its predecessor kept, as a table, and its decisions take
effect: documents that the quality classifier rejects go; lines of chunks that
an earlier document has go (and documents that have no other line); one document
of each group of near duplicates stays; sources are drawn to their target
weights (a document may be drawn more than once); the texts that are left are
segmented into pieces.

Stages but the last return the columns of ``documents``.  Null texts score as
empty ones; rows with a null id are never near duplicates of others; an empty
table passes every stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partqc.llm import jaccard, linededup, mixing, quality, sentencepiece
from partqc.llm.common import documents, table
from partqc.session import checkpoint_root


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = quality.score_quality(docs, table(spark, sf_dir, "labels"))
    return scored.filter("predicted = 1").select(docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = linededup.drop_repeated_chunks(docs)
    kept = kept.filter((F.col("n_removed_lines") == 0) | F.col("kept_text").rlike(r"[^\x20\x09-\x0D]"))
    new = {"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("long")}
    return kept.select(*[new.get(c, F.col(c)).alias(c) for c in docs.columns])


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = jaccard.jaccard_components(docs)
    gone = groups.filter("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(docs).select(docs.columns)


def segment(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentencepiece.encode(docs.select("doc_id", "source", "lang", "text")).select(
        "doc_id", "source", "lang", F.size("ids").cast("long").alias("n_pieces"), "score", "round_trip", "ids")


STAGES = [
    ("quality", keep_quality),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", keep_one_of_near_duplicates),
    ("mixing", mix),
    ("sentencepiece", segment),
]

#: Fitting a classifier and segmenting are no SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each result written as Parquet under
    ``spark.checkpoint.dir`` and read again."""
    root = f"{checkpoint_root(spark)}/corpus-pipeline/{uuid.uuid4().hex}"
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
