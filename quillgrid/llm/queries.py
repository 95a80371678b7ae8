"""Queries of this subpackage, one per operator, each over its whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship
from . import exact_dedup, language_model, line_dedup, mixing, ngram_join, oracles, pieces, quality_classifier, quality_rules, token_counts, toxicity
from .shared import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For operators whose work on each text is heavy."""
    return spread(table(spark, sf_dir, "documents"))


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(documents(spark, sf_dir))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.line_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_deleted", F.sha2("text", 256).alias("text_sha256"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(documents(spark, sf_dir))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pieces.encode(documents(spark, sf_dir), pieces.piece_path())
    return out.select("doc_id", "n_bytes", "n_tokens", F.xxhash64("ids").alias("ids_hash"), "lossless")


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.quality_classifier(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = language_model.lm_score(documents(spark, sf_dir)).drop("perplexity")
    return out.withColumns({c: F.round(c, 6) for c in ("base_score", "score")})


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("copies", "_source")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.token_counts(docs, token_counts.tokenizer_path(), token_counts.fresh_cache(spark))


def queries() -> dict:
    return {f.__name__: f for f in (op1_ngram_join, op2_line_dedup, op3_quality_rules, op4_exact_dedup, op5_toxicity, op6_sentencepiece, op7_quality_classifier, op8_lm_score, op9_mixing, op10_token_counts)}


def oracle_sql() -> dict[str, str]:
    return {"op1_ngram_join": oracles.NGRAM_JOIN, "op8_lm_score": oracles.LM_SCORE, "op9_mixing": oracles.MIXING, "op2_line_dedup": line_dedup.ORACLE, "op3_quality_rules": quality_rules.ORACLE, "op4_exact_dedup": exact_dedup.ORACLE}
