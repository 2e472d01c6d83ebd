"""Sharding by vector bin packing: bytes, tokens and rows are balanced jointly."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from care_measures.llm.common import ROW, documents, keyed, stored

SHARDS, CELLS = 24, 16384
#: A token: bytes between white space.
WORD = r"[^\x20\x09-\x0D]+"
DIMENSIONS, WEIGHTS = ("bytes", "tokens", "rows"), np.array([4.0, 1.0, 1.0])


def place(items: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each item (rows: shares of the total in each dimension).

    Largest items first; each goes where the dot product of its vector with the residual capacity is highest. Bytes
    weigh most, as they are what a shard costs to read."""
    items = items * WEIGHTS[: items.shape[1]]
    out, residual = np.zeros(len(items), np.int64), np.ones((shards, 1)) * (WEIGHTS[: items.shape[1]] / shards)
    for i in np.argsort(-items.max(axis=1), kind="stable"):
        out[i] = k = int(np.argmax(residual @ items[i]))
        residual[k] -= items[i]
    return out


def shard(docs: DataFrame, shards: int = SHARDS, cells: int = CELLS) -> DataFrame:
    """One row per row of docs: __row, doc_id, size, text_crc32, tokens, shard, slot.

    Equal texts are a group. Small groups are gathered by hash into `cells` cells, so that the driver places a bounded
    number of items whatever the number of groups. A group with over 8 cells' share of bytes, tokens or rows (there are 3 * cells / 8 of them at
    most) is counted in pieces; it still goes to one shard as a whole unless it exceeds a shard's share. Slots
    are numbered inside cells and pieces from the rows that stand before them in their shard.

    size is the text's UTF-8 bytes plus 8, tokens its words (longest runs without white space; none in an empty text). A null text has no bytes and is in a group with
    the empty ones; its crc32 is 0. Repeated rows and null or equal doc_ids are rows like others. An empty table gives no
    rows; other columns are not read."""
    spark, text = docs.sparkSession, F.col("text")
    rows = stored(keyed(docs).select(
        ROW, "doc_id", (F.octet_length("text") + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64("text").alias("h"), F.regexp_count("text", F.lit(WORD)).cast("long").alias("tokens"),
    ), "sizes")
    sums = [F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")]
    total = np.array([x or 1 for x in rows.agg(*sums).first()], float)
    share = 8 / cells
    hot = rows.groupBy("h").agg(*sums).filter(" or ".join(f"{d} > {share * t}" for d, t in zip(DIMENSIONS, total, strict=True))).collect()
    pieces, first, group = [], cells, {}
    for h, *sizes in sorted(hot):
        most = float((np.array(sizes) / total).max())
        n = int(np.ceil(most / share))
        pieces.append((h, first, n))
        # units that have to stay together
        group |= {} if most > 1 / shards else {u: first for u in range(first, first + n)}
        first += n
    split = stored(spark.createDataFrame(pieces, "h long, first long, pieces long"), "hot-groups")
    unit = F.when(F.col("first").isNull(), F.pmod("h", F.lit(cells))).otherwise(F.col("first") + F.pmod(F.xxhash64(ROW), F.col("pieces")))
    units = rows.join(split, "h", "left").select(ROW, "doc_id", "size", "text_crc32", "tokens", unit.alias("unit"))
    counted = sorted(units.groupBy("unit").agg(*sums).collect())  # bounded by the cells and pieces
    numbers = {}
    for u, *_ in counted:
        numbers.setdefault(group.get(u, u), len(numbers))
    items = np.zeros((len(numbers), 3))
    for u, *sizes in counted:
        items[numbers[group.get(u, u)]] += np.array(sizes) / total
    shard_of, filled, places = place(items, shards), [0] * shards, []
    for u, _, _, n in counted:
        k = int(shard_of[numbers[group.get(u, u)]])
        places.append((u, k, filled[k]))
        filled[k] += n
    placed = stored(spark.createDataFrame(places, "unit long, shard int, before long"), "placed")
    slot = F.row_number().over(Window.partitionBy("unit").orderBy("doc_id", ROW)) - 1 + F.col("before")
    return units.join(placed, "unit").select(ROW, "doc_id", "size", "text_crc32", "tokens", "shard", slot.cast("long").alias("slot"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(documents(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
