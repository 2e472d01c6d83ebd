"""Token counts through a cache keyed by the digests of content and tokenizer."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from importlib.metadata import version
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from care_measures.llm.common import ROW, documents, keyed, new_path, stored
from care_measures.llm.tokenizing import encoder
from care_measures.llm.words import blocks

CACHE = "digest binary, tokenizer string, n_tokens long"
LIMIT = 512


def tokenizer_version(path: str) -> str:
    """Digest of the vocabulary file and of the library's version: counts of another version are never used."""
    return hashlib.sha256(Path(path).read_bytes() + version("tokenizers").encode()).hexdigest()


def _counter(path: str, name: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = np.concatenate([encoder(path).counts(texts) for _, texts in blocks(batch)] or [np.zeros(0, np.int64)])
            yield pa.RecordBatch.from_arrays(
                [batch["digest"].cast(pa.binary()), pa.array([name] * len(counts), pa.string()), pa.array(counts, pa.int64())],
                ["digest", "tokenizer", "n_tokens"])
    return count


def token_counts(docs: DataFrame, tokenizer_path: str, cache_path: str) -> DataFrame:
    """One row per row of docs: __row, doc_id, n_bytes, n_tokens.

    The cache is a Parquet folder in a place that all executors share; it may be missing or empty. Distinct contents that
    it lacks for this tokenizer are encoded and appended; counts are then joined from it. Whole texts are encoded, without added special
    tokens; special strings in a text are what the library makes of them.

    A null text is an empty one and has no tokens. Copies and repeated rows are encoded once. An empty table gives no rows;
    other columns are not read. A content that two runs appended at the same time is read once."""
    spark, name = docs.sparkSession, tokenizer_version(tokenizer_path)
    # the content is the text as it stands: a tokenizer tells apart all that a normal form would join
    rows = keyed(docs).withColumn("digest", F.unhex(F.sha2("text", 256)))
    spark.createDataFrame([], CACHE).write.mode("append").parquet(cache_path)
    mine = lambda: spark.read.schema(CACHE).parquet(cache_path).filter(F.col("tokenizer") == name)
    misses = rows.groupBy("digest").agg(F.first("text").alias("text")).join(mine(), "digest", "left_anti")
    misses.mapInArrow(_counter(tokenizer_path, name), CACHE).write.mode("append").parquet(cache_path)
    known = stored(mine().groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")), "token-counts")
    return rows.select(ROW, "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "digest").join(known, "digest").drop("digest")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    counts = token_counts(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), new_path(spark, "token-cache"))
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"))
