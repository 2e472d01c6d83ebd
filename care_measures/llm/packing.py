"""Packing documents into token sequences: non-negative least squares over length combinations that fill a window."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from care_measures.llm.common import ROW, documents, keyed, stored
from care_measures.llm.tokenizing import encoder
from care_measures.llm.words import blocks

WINDOW, END = 4096, 2
PIECES = f"{ROW} long, doc_id long, start long, length long, doc_tokens long, ids_crc32 long, ids binary"
#: Pieces that one place of the numbering holds on average.
NUMBERED_TOGETHER = 100_000


def _cut(n: int, window: int) -> list[tuple[int, int]]:
    """Starts and lengths: whole windows first, then halves of one, then what is left (no more than half a window)."""
    half = max(1, window // 2)
    out = [(at, window) for at in range(0, n - window + 1, window)]
    at = n - n % window
    if n - at > half:
        out.append((at, half))
        at += half
    if n > at:
        out.append((at, n - at))
    return out


def _tokenized(path: str, window: int, end: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(n, pa.int64()) for n in (ROW, "doc_id", "start", "length", "doc_tokens", "ids_crc32")] + [("ids", pa.binary())])
        for batch in batches:
            rows, doc_ids = batch[ROW].to_pylist(), batch["doc_id"].to_pylist()
            for first, texts in blocks(batch):
                out = []
                for i, ids in enumerate(encoder(path).ids(texts), first):
                    data = np.append(ids, np.uint32(end)).astype("<u4").tobytes()
                    for start, length in _cut(len(data) // 4, window):
                        piece = data[4 * start: 4 * (start + length)]
                        out.append((rows[i], doc_ids[i], start, length, len(data) // 4, zlib.crc32(piece), piece))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
    return cut


def combinations(counts: np.ndarray, window: int, most: int = 8, common: int = 48) -> list[tuple[tuple[int, int], ...]]:
    """Shallow combinations of occurring lengths that fill the window: (length, times), ...

    One length some times and another once, and three lengths of which two are among the most common."""
    there = counts > 0
    found = {((window, 1),)} if there[window] else set()
    for a in np.flatnonzero(there[:window]):
        a = int(a)
        for times in range(1, most + 1):
            rest = window - a * times
            if rest == 0:
                found.add(((a, times),))
            elif rest > 0 and rest != a and there[rest]:
                found.add(tuple(sorted(((a, times), (rest, 1)))))
    top = sorted(int(x) for x in np.argsort(-counts[:window], kind="stable")[:common] if there[x])
    for a in top:
        for b in top:
            c = window - a - b
            if a < b < c < window and there[c]:
                found.add(((a, 1), (b, 1), (c, 1)))
    return sorted(found)


def non_negative_least_squares(patterns: list, counts: np.ndarray, steps: int = 300) -> np.ndarray:
    """Repeats x >= 0 of the patterns that bring the lengths they use closest to their counts (accelerated projected gradient)."""
    column = np.array([j for j, p in enumerate(patterns) for _ in p])
    length = np.array([a for p in patterns for a, _ in p])
    times = np.array([float(t) for p in patterns for _, t in p])
    product = lambda x: np.bincount(length, x[column] * times, len(counts))
    back = lambda r: np.bincount(column, r[length] * times, len(patterns))
    v = np.ones(len(patterns))
    for _ in range(30):
        v = back(product(v))
        norm = np.linalg.norm(v)
        v /= norm
    x = y = np.zeros(len(patterns))
    t = 1.0
    for _ in range(steps):
        new = np.maximum(0, y - back(product(y) - counts) / (1.05 * norm))
        t, before = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        y, x = new + (before - 1) / t * (new - x), new
    return x


def plan(counts: np.ndarray, window: int) -> tuple[list[tuple[tuple[tuple[int, int], ...], int]], int]:
    """Patterns and how often each is repeated, so that every piece is used once; and the number of sequences.

    Its size depends on the window alone, whatever the number of pieces."""
    left, out = counts.astype(np.int64).copy(), []

    def take(pattern, repeats: int) -> None:
        if repeats > 0:
            out.append((pattern, repeats))
            for a, t in pattern:
                left[a] -= t * repeats

    patterns = combinations(counts, window)
    if patterns:
        repeats = non_negative_least_squares(patterns, counts.astype(float))
        for j in np.argsort(-repeats, kind="stable"):
            take(patterns[j], min(int(repeats[j]), *(int(left[a]) // t for a, t in patterns[j])))
    while left.any():
        # what is left: the longest piece, then always the longest that still fits, repeated as long as the lengths last
        room, pattern, free = window, {}, left.copy()
        while room:
            fitting = np.flatnonzero(free[: room + 1])
            if not len(fitting):
                break
            a = int(fitting[-1])
            t = min(int(free[a]), room // a)
            pattern[a], free[a], room = t, free[a] - t, room - a * t
        pattern = tuple(sorted(pattern.items()))
        take(pattern, min(int(left[a]) // t for a, t in pattern))
    return out, sum(n for _, n in out)


def _placed(repeats: list, window: int):
    """A function from (length, number among the pieces of that length) to (sequence, offset)."""
    used, rows, sequence = np.zeros(window + 1, np.int64), [], 0
    for pattern, n in repeats:
        offset = 0
        for a, t in pattern:
            rows.append((a, used[a], sequence, t, offset))
            used[a] += t * n
            offset += a * t
        sequence += n
    rows.sort()
    length, first, sequence, times, offset = (np.array(c, np.int64) for c in zip(*rows, strict=True)) if rows else [np.zeros(0, np.int64)] * 5
    begins = np.searchsorted(length, np.arange(window + 2))

    def place(lengths: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at, high = begins[lengths], begins[lengths + 1]
        while ((high - at) > 1).any():
            mid = (at + high) // 2
            below = first[np.minimum(mid, len(first) - 1)] <= numbers
            at, high = np.where((high - at > 1) & below, mid, at), np.where((high - at > 1) & ~below, mid, high)
        k = numbers - first[at]
        return sequence[at] + k // times[at], offset[at] + k % times[at] * lengths
    return place


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end: int = END) -> DataFrame:
    """One row per piece: __row, doc_id, start, length, doc_tokens, ids_crc32, ids (little-endian, 4 bytes each), sequence_id, offset.

    Documents are tokenized whole, ended by an id, and cut at whole and half windows. The histogram of piece lengths
    (at most `window` numbers) gives the plan: how often each combination of lengths is repeated. Pieces of a length are
    numbered where they are, by counts per bucket, and read their place from the plan; no length's pieces meet in one task.

    A null text is an empty one: a piece with the end id alone. Repeated rows are documents of their own. An empty table
    gives no rows; other columns are not read."""
    spark = docs.sparkSession
    pieces = stored(keyed(docs).mapInArrow(_tokenized(tokenizer_path, window, end), PIECES), "pieces")
    bars = pieces.groupBy("length").count().collect()  # bounded by the window
    counts = np.zeros(window + 1, np.int64)
    for length, n in bars:
        counts[length] = n
    place = _placed(plan(counts, window)[0], window)
    buckets = 64 + int(counts.sum()) // NUMBERED_TOGETHER
    spread = pieces.select(ROW, "start", "length", F.pmod(F.xxhash64(ROW, "start"), F.lit(buckets)).alias("bucket"))
    sizes = spread.groupBy("length", "bucket").count()
    before = stored(sizes.select("length", "bucket", (F.sum("count").over(Window.partitionBy("length").orderBy("bucket")) - F.col("count")).alias("before")), "numbering")
    numbered = spread.withColumn("n", F.row_number().over(Window.partitionBy("length", "bucket").orderBy(ROW, "start")) - 1)
    numbered = numbered.join(before, ["length", "bucket"]).withColumn("n", F.col("n") + F.col("before"))

    @F.pandas_udf("sequence_id long, offset long")
    def where(length: pd.Series, n: pd.Series) -> pd.DataFrame:
        sequence, offset = place(length.to_numpy(), n.to_numpy())
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    placed = numbered.select(ROW, "start", where("length", "n").alias("at")).select(ROW, "start", "at.*")
    return pieces.join(placed, [ROW, "start"])


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    packed = pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
