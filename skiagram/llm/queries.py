"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skiagram.llm import bpe, html_text, jaccard, language, mixing, packing, quality, repeats, runs, token_files, topk, toxicity
from skiagram.llm.shared import documents


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.encode_and_read(documents(spark, sf_dir), _tokenizer("byte_bpe_50k.json"), 2)


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identified(documents(spark, sf_dir).select("doc_id", "text", "lang"))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.components(documents(spark, sf_dir).select("doc_id", "text"), 3, 90, 100)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir).select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(documents(spark, sf_dir).select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op6_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digests(documents(spark, sf_dir).select("doc_id", "text"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.encode_column(documents(spark, sf_dir), _tokenizer("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding", F.col("id") % 100 == 0).select("query_id", "rank", "vec_id", "score")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(documents(spark, sf_dir).select("doc_id", "source"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(documents(spark, sf_dir).select("doc_id", "text"), _tokenizer("byte_bpe_50k.json"), 1)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digests(runs.periodic_runs(runs.with_planted_periods(documents(spark, sf_dir))))


QUERIES = {f.__name__: f for f in (op1_token_files, op2_language, op3_ngram_jaccard, op4_toxicity, op5_quality, op6_suffix_array, op7_byte_bpe, op8_main_text, op9_exact_top_k, op10_mixing, op11_packing, op12_periodic_runs)}

ORACLE_SQL = {
    "op9_exact_top_k": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""",
}
