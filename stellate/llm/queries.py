"""The operators bound to the benchmark tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stellate.llm import (
    decontamination, embedding_dedup, importance, jaccard_join, language_model, licenses, line_quality, packing, pii,
    toxicity, url_filter, warc, whitening)
from stellate.llm.common import held_out, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_best_fit_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_documents(table(spark, d, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op3_lm_scoring(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return language_model.score(docs, held_out(docs["doc_id"], 7, 2))


@query
def op8_ngram_jaccard_join(spark: SparkSession, d: str) -> DataFrame:
    return jaccard_join.join_documents(table(spark, d, "documents"))


@query
def op4_toxicity(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    labels = table(spark, d, "labels").select("doc_id", F.col("toxic").alias("label"))
    held = held_out(F.col("doc_id"), 3, 1)
    scored = toxicity.score(docs, toxicity.train(docs, labels, ~held), ["doc_id"])
    return scored.withColumn("held_out", held).withColumn(
        "predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int"))


@query
def op9_pii(spark: SparkSession, d: str) -> DataFrame:
    return pii.find(table(spark, d, "documents"))


@query
def op10_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    return line_quality.judge(table(spark, d, "documents"), "source")


@query
def op2_benchmark_decontamination(spark: SparkSession, d: str) -> DataFrame:
    return decontamination.matches(table(spark, d, "documents"), table(spark, d, "benchmark"))


@query
def op5_license_scans(spark: SparkSession, d: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, d, "documents"))


ORACLE["op5_license_scans"] = licenses.oracle()


@query
def op6_url_filters(spark: SparkSession, d: str) -> DataFrame:
    return url_filter.verdicts(table(spark, d, "pages"))


@query
def op7_warc(spark: SparkSession, d: str) -> DataFrame:
    return warc.read(*warc.write(table(spark, d, "pages"))).drop("url")


ORACLE["op7_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
k AS (SELECT *, max(page_id) OVER (PARTITION BY payload) AS keeper FROM p),
t AS (SELECT *, octet_length(encode(payload)) AS bytes FROM k),
r AS (SELECT *, bytes >= 1000 AND page_id <> keeper AS again FROM t)
SELECT page_id, CAST(bytes AS BIGINT) AS payload_bytes, sha1(payload) AS payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN keeper END AS refers_to
FROM r"""


@query
def op11_importance_resampling(spark: SparkSession, d: str) -> DataFrame:
    return importance.resample(table(spark, d, "documents"), table(spark, d, "benchmark")).drop("n_words")


ORACLE["op11_importance_resampling"] = importance.oracle()


@query
def op12_embedding_whitening(spark: SparkSession, d: str) -> DataFrame:
    return whitening.whiten(table(spark, d, "embeddings"))


@query
def op13_embedding_near_dedup(spark: SparkSession, d: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, d, "embeddings"))
