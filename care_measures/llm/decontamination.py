"""Benchmark decontamination: suffix arrays of the training texts, searched for every suffix of the test items."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from care_measures.llm.common import ROW, documents, keyed, numbered, stored
from care_measures.llm.words import LOWER, HashTable, Words, blocks, separators

WIDTH = 13
#: Bytes of benchmark text that are searched for in one pass over the documents.
ITEM_BYTES = 64_000_000
_GAPS = separators(bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))
_MATCH = pa.struct([("item_id", pa.int64()), ("doc_start", pa.int64()), ("item_start", pa.int64()), ("n_words", pa.int64())])
_OUT = pa.schema([(ROW, pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("matches", pa.list_(_MATCH))])
OUT = f"{ROW} long, doc_id long, n_words long, n_hit long, matches array<struct<item_id: long, doc_start: long, item_start: long, n_words: long>>"


def _packed(tokens: np.ndarray, at: np.ndarray, lengths: np.ndarray, width: int, bits: int, fill: int) -> list[np.ndarray]:
    """The first `width` tokens from each place, several to an integer; `fill` stands beyond lengths."""
    columns, each = [], 64 // bits
    for first in range(0, width, each):
        key = np.zeros(len(at), np.uint64)
        for j in range(first, min(width, first + each)):
            inside = lengths > j
            token = np.where(inside, tokens[np.where(inside, at + j, 0)], fill)
            key = (key << np.uint64(bits)) | token.astype(np.uint64)
        columns.append(key)
    return columns


def _bound(array: list[np.ndarray], keys: list[np.ndarray], after: bool) -> np.ndarray:
    """Binary search of all keys at once: the first place in the sorted array that is not below (after: above) each."""
    low, high = np.zeros(len(keys[0]), np.int64), np.full(len(keys[0]), len(array[0]), np.int64)
    while (low < high).any():
        mid = (low + high) // 2
        at = np.minimum(mid, len(array[0]) - 1)
        below, equal = np.zeros(len(mid), bool), np.ones(len(mid), bool)
        for column, key in zip(array, keys, strict=True):
            held = column[at]
            below |= equal & (held < key)
            equal &= held == key
        up = (low < high) & (below | equal if after else below)
        low, high = np.where(up, mid + 1, low), np.where((low < high) & ~up, mid, high)
    return low


class Items:
    """Test items as word numbers, and the search keys of their suffixes."""

    def __init__(self, ids: list, texts: list[bytes], width: int):
        words = Words(texts, LOWER, _GAPS)
        distinct, first, numbers = np.unique(words.hashes, return_index=True, return_inverse=True)
        self.width, self.hashes = width, distinct
        self.bits = max(1, int(len(distinct) + 2).bit_length())
        self.bits = next(b for b in (8, 16, 21, 32) if b >= self.bits)
        counts = words.counts()
        item = np.repeat(np.arange(len(ids)), counts)
        place = np.arange(len(item)) - words.ranges[:-1][item]
        # a suffix counts if a window starts it: so many words in all, or the whole of a shorter item
        starts = np.flatnonzero((counts[item] - place >= width) | (place == 0))
        self.ids, self.item, self.place = ids, item[starts], place[starts]
        self.lengths = np.minimum(width, counts[self.item])
        tokens = numbers + 1
        self.low = _packed(tokens, starts, self.lengths, width, self.bits, 0)
        self.high = _packed(tokens, starts, self.lengths, width, self.bits, (1 << self.bits) - 1)
        self.shortest = int(self.lengths.min()) if len(starts) else 0

    def table(self) -> HashTable:
        table = HashTable(max(4, int(len(self.hashes)).bit_length() + 2))
        table.add(self.hashes)
        return table


def _matches(words: Words, items: Items, table: HashTable) -> tuple[np.ndarray, ...]:
    """Maximal verbatim matches of windows: text, item, first word in each, number of words; sorted by text and place."""
    none = tuple(np.zeros(0, np.int64) for _ in range(5))
    tokens = table.find(words.hashes).astype(np.int64) + 1
    n = len(tokens)
    if not n or not len(items.item):
        return none
    text = np.repeat(np.arange(len(words.ranges) - 1), words.counts())
    stop = np.minimum.accumulate(np.where(tokens == 0, np.arange(n), n)[::-1])[::-1]
    room = np.minimum(stop, words.ranges[1:][text]) - np.arange(n)
    suffixes = np.flatnonzero(room >= items.shortest)
    if not len(suffixes):
        return none
    keys = _packed(tokens, suffixes, room[suffixes], items.width, items.bits, 0)
    order = np.lexsort(keys[::-1])  # the suffix array, as deep as a window
    suffixes, keys = suffixes[order], [k[order] for k in keys]
    first, last = _bound(keys, items.low, False), _bound(keys, items.high, True)
    found = np.repeat(np.arange(len(first)), last - first)
    if not len(found):
        return none
    at = suffixes[np.repeat(first, last - first) + np.arange(len(found)) - np.repeat(np.cumsum(last - first) - (last - first), last - first)]
    item, place, length, of = items.item[found], items.place[found], items.lengths[found], text[at]
    # windows that follow each other in both are one match
    order = np.lexsort((at, at - place, item, of))
    at, item, place, length, of = at[order], item[order], place[order], length[order], of[order]
    new = np.ones(len(at), bool)
    new[1:] = (of[1:] != of[:-1]) | (item[1:] != item[:-1]) | (at[1:] != at[:-1] + 1) | (place[1:] != place[:-1] + 1)
    begin = np.flatnonzero(new)
    size = np.diff(np.append(begin, len(at))) - 1 + length[begin]
    out = of[begin], item[begin], at[begin] - words.ranges[of[begin]], place[begin], size
    order = np.lexsort((out[1], out[2], out[0]))
    return tuple(x[order] for x in out)


def covered(starts: np.ndarray, ends: np.ndarray) -> int:
    """Size of the union of intervals that are sorted by start."""
    if not len(starts):
        return 0
    reach = np.maximum.accumulate(ends)
    before = np.concatenate([[starts[0]], reach[:-1]])
    return int(np.maximum(0, reach - np.maximum(before, starts)).sum())


def _search(items: Items):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = items.table()
        for batch in batches:
            for first, texts in blocks(batch):
                words = Words(texts, LOWER, _GAPS)
                text, item, start, place, size = _matches(words, items, table)
                cuts = np.searchsorted(text, np.arange(len(texts) + 1))
                hit = [covered(start[a:b], start[a:b] + size[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                matches = pa.StructArray.from_arrays(
                    [pa.array([items.ids[i] for i in item], pa.int64()), *(pa.array(x, pa.int64()) for x in (start, place, size))], fields=list(_MATCH))
                part = batch.slice(first, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [part[ROW], part["doc_id"], pa.array(words.counts(), pa.int64()), pa.array(hit, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), matches)], schema=_OUT)
    return search


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """One row per row of docs: __row, doc_id, n_words, n_hit (words inside a matched window), matches.

    Each run of texts in a task gets a suffix array over its words, and every test suffix that starts with a window (`width` words, or a
    whole shorter item) is searched in all of them; windows in a row make up the longest verbatim matches, with places
    in the document and in the item. The items are the stated query set: they are sent to the tasks in blocks of about
    item_bytes bytes, with a pass over the documents for each block.

    Matches never cross documents. Null texts and items have no words and match nothing. An item without item_id is searched for and
    has a null id in matches. Repeated rows are documents of their own; an empty benchmark hits nothing, an empty table
    gives no rows. Other columns are not read."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    n = 1 + int(items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // item_bytes
    rows, found = keyed(docs if n == 1 else numbered(docs)), []
    for k in range(n):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).orderBy("item_id", "text").collect()  # a bounded block
        found.append(rows.mapInArrow(_search(Items([x[0] for x in part], [x[1].encode() for x in part], width)), OUT))
    if n == 1:
        return found[0]

    @F.pandas_udf("long")
    def union(matches: pd.Series) -> pd.Series:
        def one(x) -> int:
            spans = sorted((m["doc_start"], m["doc_start"] + m["n_words"]) for m in x)
            return covered(*(np.array(c, np.int64) for c in zip(*spans, strict=True))) if spans else 0
        return matches.map(one)

    parts = found[0]
    for more in found[1:]:
        parts = parts.unionByName(more)
    merged = stored(parts, "matches").groupBy(ROW).agg(F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.flatten(F.collect_list("matches")).alias("matches"))
    return merged.select(ROW, "doc_id", "n_words", union("matches").alias("n_hit"), "matches")


def contaminated(n_hit: str = "n_hit", n_words: str = "n_words"):
    return (F.col(n_hit) > 0) & (20 * F.col(n_hit) >= F.col(n_words))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    ids = F.array_sort(F.array_distinct(F.transform(F.filter("matches", lambda m: m["item_id"].isNotNull()), lambda m: m["item_id"].cast("string"))))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size(ids).cast("long").alias("n_items"), F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"),
        contaminated().alias("contaminated"))
