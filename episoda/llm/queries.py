"""The driver's queries over the corpus operators: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from episoda.llm import bpe_automaton, common, exact_dedup, licenses, media, packing, quality, simhash, token_output, toxicity, url_filter


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(common.table(spark, sf_dir, "documents"), keep_ids=False)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(common.table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hexadecimal().alias("fingerprint"), "component_id")


def op3_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.token_matrices(common.table(spark, sf_dir, "documents"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score(docs, quality.fit(docs, common.table(spark, sf_dir, "labels")))
    held_out = common.bucket_of("doc_id", quality.FOLDS) == 0
    good = (F.col("quality_score") >= quality.THRESHOLD).cast("int")
    return scored.select("doc_id", held_out.alias("held_out"), F.col("quality_score").alias("score"), good.alias("predicted"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_groups(common.table(spark, sf_dir, "documents"))


def op6_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = media.document_media(common.table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge(common.table(spark, sf_dir, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op8_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe_automaton.encode_and_decode(common.table(spark, sf_dir, "documents"))
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(common.table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.fit(docs, common.table(spark, sf_dir, "labels")))
    held_out = common.bucket_of("doc_id", toxicity.FOLDS) == toxicity.HELD_OUT
    bad = (F.col("toxic_score") >= toxicity.THRESHOLD).cast("int")
    return scored.select("doc_id", held_out.alias("held_out"), F.col("toxic_score").alias("score"), bad.alias("predicted"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_best_fit_packing, op2_simhash_near_dedup, op3_token_output, op4_quality_classifier, op5_exact_dedup, op6_media_columns, op7_url_filter, op8_bpe_automaton, op9_license_scan, op10_toxicity)
}

#: Each text whole; DuckDB's [\\x20\\x09-\\x0D] is the operator's white space. A hash cannot tell equal texts from collisions, the text itself can.
_OP5 = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents),
g AS (SELECT doc_id, body, min(doc_id) OVER (PARTITION BY body) AS keep_id, count(*) OVER (PARTITION BY body) AS group_size FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM g
"""

ORACLE_SQL: dict[str, str] = {"op5_exact_dedup": _OP5, "op7_url_filter": url_filter.oracle_sql(), "op9_license_scan": licenses.oracle_sql()}
