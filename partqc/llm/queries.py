"""The registered queries of the subpackage: one per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partqc.llm import (ann, common, covertree, fingerprint, jaccard, langid, licenses, linededup, lm,
                        merkle, mixing, pii, quality, sentencepiece)


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited_pairs(common.documents(spark, sf_dir))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir).select("doc_id", "text")
    return sentencepiece.encode(docs).select(
        "doc_id", F.size("ids").cast("long").alias("n_pieces"), "score",
        F.transform("others", lambda x: x["loss"]).alias("next_losses"), "round_trip", "ids", "others")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(common.documents(spark, sf_dir))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir).select("doc_id", "text")
    return quality.score_quality(docs, common.table(spark, sf_dir, "labels")).drop("text")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(common.documents(spark, sf_dir)).select(
        "doc_id", "source", "n_tokens", "epoch", "block_rank")


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(common.documents(spark, sf_dir))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = common.table(spark, sf_dir, "labels").filter("quality = 1")
    return lm.word_difference(common.documents(spark, sf_dir), good)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_language(common.documents(spark, sf_dir))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir).select("doc_id", "text")
    return linededup.drop_repeated_chunks(docs).select("doc_id", "n_lines", "n_removed_lines", "kept_text")


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(common.table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.encode(common.table(spark, sf_dir, "embeddings"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.prove(common.documents(spark, sf_dir), altered={"n_chars": F.col("n_chars") + 1},
                        is_altered=F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0)


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(common.documents(spark, sf_dir)).drop("matches")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_fingerprints, op2_sentencepiece, op3_pii, op4_quality, op5_mixing, op6_jaccard_join,
                            op7_lm_scoring, op8_language_id, op9_line_dedup, op10_nearest, op11_vector_codes,
                            op12_merkle_manifest, op13_license_scan)
}
