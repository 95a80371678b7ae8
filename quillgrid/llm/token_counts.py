"""Token counts through a digest cache."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import shared, textkernel

CACHE = T.StructType([T.StructField("digest", T.BinaryType()), T.StructField("tokenizer", T.StringType()), T.StructField("n_tokens", T.LongType())])
#: Texts go to the tokenizer in groups of about so many characters, so memory does not depend on the batch.
GROUP_CHARS = 1 << 20


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenizer_version(path: str) -> str:
    """Digest of the vocabulary file and of the library's version: a change of either makes new entries."""
    lib = __import__("sentencepiece" if path.endswith(".model") else "tokenizers")
    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + b"\0" + lib.__version__.encode()).hexdigest()


@lru_cache(maxsize=4)
def _counter(path: str):
    if path.endswith(".model"):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in sp.encode(texts, num_threads=1)]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return lambda texts: [len(x) for x in t.encode_batch_fast(texts, add_special_tokens=False)]


def count_tokens(texts: list[str], path: str) -> list[int]:
    count, out, group, chars = _counter(path), [], [], 0
    for t in texts:
        group.append(t)
        chars += len(t)
        if chars >= GROUP_CHARS:
            out += count(group)
            group, chars = [], 0
    return out + (count(group) if group else [])


def token_counts(docs: DataFrame, path: str, cache_path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text", normalise=None) -> DataFrame:
    """One row per input row: id, n_bytes, n_tokens, over_limit; new counts are appended to the cache.

    The cache is a Parquet table (digest, tokenizer, n_tokens) at ``cache_path``, which may not exist yet.
    Digests are sha256 of the normalised text (default: unchanged). One text per digest is chosen by an
    aggregation that first reduces within each task, so copies meet the tokenizer once and a hot text
    costs a row per task; of those, an anti-join on (digest, tokenizer) leaves the misses, which are
    encoded and appended. All rows then get their count by a join of digests.
    Two writers may append the same digest; reads take one entry per digest, and entries of one digest are equal.
    Null text counts as empty (0 bytes, 0 tokens). Repeated rows and ids each get their row. Other columns are ignored.
    """
    spark = docs.sparkSession
    version = tokenizer_version(path)
    text = F.coalesce(F.col(text_col), F.lit(""))
    text = normalise(text) if normalise else text
    digest = F.unhex(F.sha2(text, 256))
    have = _cached(spark, cache_path).filter(F.col("tokenizer") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    misses = docs.select(digest.alias("digest"), text.alias("_t")).groupBy("digest").agg(F.first("_t").alias("_t")).join(have.select("digest"), "digest", "left_anti")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = count_tokens(b.column(1).to_pylist(), path)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([version] * len(n), pa.string()), pa.array(n, pa.int64())], names=["digest", "tokenizer", "n_tokens"])

    misses.select("digest", "_t").mapInArrow(textkernel.releasing(encode), CACHE).write.mode("append").parquet(cache_path)
    counts = _cached(spark, cache_path).filter(F.col("tokenizer") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    rows = docs.select(F.col(id_col).alias("_id"), digest.alias("digest"), F.octet_length(text).cast("long").alias("n_bytes"))
    return rows.join(counts, "digest").select(F.col("_id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def _cached(spark: SparkSession, path: str) -> DataFrame:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], CACHE)
    return spark.read.schema(CACHE).parquet(path)


def fresh_cache(spark: SparkSession) -> str:
    return f"{shared.shared_dir(spark)}/token_cache"
