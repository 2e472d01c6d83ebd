"""Exact deduplication by deterministic block naming, in DataFrame operations only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from care_measures.llm.common import ROW, documents, keyed, stored

BLOCK_BYTES = 4096


def _named(rows: DataFrame, values: list[str], hash_of: Callable[..., Column]) -> DataFrame:
    """rows with the integer name (h, r) of their values, and without the values.

    h is a 64-bit hash, r the place of the values among the sorted distinct values that share h. Equal values have one
    name and different ones never share it; only values whose hashes clash have to be sorted against each other.
    The distinct values are found by an aggregate that combines before the shuffle, so a block of a third of all rows
    costs a row per task."""
    rows = rows.withColumn("h", hash_of(*values))
    clashes = stored(rows.select("h", *values).distinct().groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h"), "clashes")
    if clashes.isEmpty():
        return rows.withColumn("r", F.lit(0)).drop(*values)
    sorted_values = rows.join(clashes, "h", "left_semi").select("h", *values).distinct()
    ranks = stored(
        sorted_values.withColumn("r", F.row_number().over(Window.partitionBy("h").orderBy(*values)) - 1)
        .select(F.col("h").alias("h2"), *[F.col(v).alias(f"{v}2") for v in values], "r"), "ranks")
    same = F.col("h") == F.col("h2")
    for v in values:
        same = same & F.col(v).eqNullSafe(F.col(f"{v}2"))
    return rows.join(ranks, same, "left").withColumn("r", F.coalesce("r", F.lit(0))).drop("h2", *values, *[f"{v}2" for v in values])


def exact_dedup(docs: DataFrame, block_bytes: int = BLOCK_BYTES, hash_of: Callable[..., Column] = F.xxhash64) -> DataFrame:
    """One row per row of docs: __row, doc_id, keep_id, group_size, kept, text_sha256.

    Texts are cut into blocks of block_bytes bytes; blocks get integer names, then adjacent pairs of names do, until
    each document has one. Documents are equal when level and name are. The number of levels is the logarithm of
    the longest text's blocks, and every level but the first holds integers of long documents only.

    A null text is an empty text, and empty texts are equal. Of equal texts the row with the largest doc_id stays; a null
    doc_id is smaller than any other, and of rows with the same doc_id the one read last stays. Repeated rows are
    copies like others. An empty table gives no rows; other columns are not read."""
    text = F.col("text").cast("binary")
    blocks = keyed(docs).withColumn("n", F.greatest(F.lit(1), F.ceil(F.octet_length("text") / block_bytes).cast("int"))).select(
        ROW, "doc_id", F.sha2("text", 256).alias("sha"), "n",
        F.posexplode(F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.substring(text, i * block_bytes + 1, F.lit(block_bytes)))).alias("pos", "block"),
    ).withColumn("sha", F.when(F.col("pos") == 0, F.col("sha")))
    level, done = stored(_named(blocks, ["block"], hash_of), "level"), []
    while True:
        done.append(level.filter("n = 1").select(ROW, "doc_id", "sha", F.lit(len(done)).alias("level"), "h", "r"))
        longer = level.filter("n > 1")
        if longer.isEmpty():
            break
        half = lambda side, c: F.max(F.when(F.col("pos") % 2 == side, F.col(c)))
        pairs = longer.groupBy(ROW, F.floor(F.col("pos") / 2).cast("int").alias("half")).agg(
            F.max("doc_id").alias("doc_id"), F.max("sha").alias("sha"), F.ceil(F.max("n") / 2).cast("int").alias("n"),
            half(0, "h").alias("ah"), half(0, "r").alias("ar"), half(1, "h").alias("bh"), half(1, "r").alias("br"),
        ).withColumnRenamed("half", "pos")
        level = stored(_named(pairs, ["ah", "ar", "bh", "br"], hash_of), "level")
    named = done[0]
    for more in done[1:]:
        named = named.unionByName(more)
    key = ["level", "h", "r"]
    groups = stored(named.groupBy(*key).agg(F.count("*").alias("group_size"), F.max(F.struct("doc_id", ROW)).alias("keep")), "groups")
    return named.join(groups, key).select(
        ROW, "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
        (F.col(ROW) == F.col(f"keep.{ROW}")).alias("kept"), F.col("sha").alias("text_sha256"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir)).drop(ROW)


SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""
