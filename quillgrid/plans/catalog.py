"""All queries of the engine by name, with the SQL that states what each returns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import queries_chem, queries_files, queries_records, queries_stats, queries_text  # noqa: F401
from .registry import QUERIES, SQL


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The delivered table: records deduplicated, joined in full, best value chosen, checked and qualified."""
    return QUERIES["promotion_policy"](spark, sf_dir)


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
