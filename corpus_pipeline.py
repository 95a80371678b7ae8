"""A corpus pipeline: toxic documents go, copies go, near copies go, sources are mixed, texts become token ids.

Each stage takes (spark, docs, sf_dir) and returns rows; all but the last return the columns of ``docs``, with their values as they
came. No rows in, no rows out. Null texts count as empty, null ids are allowed, other columns go through unread.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillgrid.llm import exact_dedup, mixing, ngram_join, pieces, toxicity
from quillgrid.llm.shared import spread, written
from quillgrid.session import ship


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of 0.3 or more go; the scorer learns from ``labels`` and the documents given.

    Empty texts score the fitted intercept; repeated rows stay or go together; without labels of both kinds all have one score."""
    ship(spark)
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays; null and empty texts are equal; a null doc_id stays only if its text has no other;
    of rows that repeat the id and text one stays."""
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group that n-gram Jaccard links of 0.8 or more connect, the document of least doc_id stays. Null ids and texts without a word stay;
    rows that repeat the id and text that stay, stay."""
    ship(spark)
    return ngram_join.keep_one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice. Texts without a word are not taken; null sources are one source;
    repeated rows are drawn each for itself; reruns agree."""
    return mixing.take_mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens, token_ids, lossless, one row for each row. Empty texts have no ids; rows that repeat an id and text have the same."""
    ship(spark)
    return pieces.encode(docs, pieces.piece_path()).select("doc_id", "n_bytes", "n_tokens", "ids", "lossless").withColumnRenamed("ids", "token_ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources", mix_sources),
    ("SentencePiece encoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, "stage")
    return docs


#: Learned scores, keyed hashes of ids and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None
