"""Periodic runs of words: an online sparse diagonal DP over each text."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from care_measures.llm.common import ROW, documents, keyed

MIN_WORDS = 24
MIN_EXPONENT = 3
#: Words of several texts that are searched at once; a longer text is searched by itself.
TOGETHER = 200_000
_NONE = np.empty(0, np.int64)


def _names(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Integer names of pairs of names: equal exactly for equal pairs."""
    return np.unique(first * (int(second.max(initial=0)) + 1) + second, return_inverse=True)[1]


def runs(words: np.ndarray, min_words: int = MIN_WORDS, min_exponent: int = MIN_EXPONENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, lengths and smallest periods of the runs of a sequence of word numbers, by start, then period.

    A word at i lies on diagonal q when it has an earlier occurrence at i - q; the match length of (i, q) is that of
    (i - 1, q) and one more. A diagonal whose match length reaches max(min_words - q, (min_exponent - 1) q) ends a run.
    The DP is sparse: an earlier occurrence makes a diagonal active only if the k words that end there agree too, and of
    these occurrences only the nearest does. For k = 16, 32, 64, ... this is done for periods q <= k (and > k / 2, from
    the second k on). No run is lost: its diagonal matches k words or more, and k >= q words inside a run whose smallest
    period is q do not recur nearer than q. None has a smaller period: the smaller one would be the nearest. So every
    position is on one active diagonal for each k, and a text of n words takes O(n log n) steps however often its words
    recur. The names of k words are the exact ranks of pairs of names of k / 2 words; only those that recur go on."""
    if min_exponent < 3:
        raise ValueError("min_exponent must be 3 or more: periods are told apart by what agrees over two of them")
    base = 1
    while min(max(min_words - q, (min_exponent - 1) * q) for q in range(1, 4 * base + 1)) >= 2 * base:
        base *= 2
    n, at, name = len(words), np.arange(len(words)), words.astype(np.int64)
    k, found = 1, []
    while len(at):
        order = np.argsort(name, kind="stable")
        same = name[order][1:] == name[order][:-1]
        if k >= base:
            i, lag = at[order[1:][same]], np.diff(at[order])[same]
            near = (lag <= k) & ((lag > k // 2) | (k == base))
            i, lag = i[near], lag[near]
            turn = np.lexsort((i, lag))
            i, lag = i[turn], lag[turn]
            begins = np.flatnonzero(np.concatenate([[True], (np.diff(i) != 1) | (np.diff(lag) != 0)]) if len(i) else _NONE)
            ends = np.concatenate([begins[1:], [len(i)]])[: len(begins)] - 1
            q, matched = lag[begins], i[ends] - i[begins] + k
            enough = matched >= np.maximum(min_words - q, (min_exponent - 1) * q)
            found.append((i[begins][enough] - k + 1 - q[enough], (matched + q)[enough], q[enough]))
        recurs = np.zeros(len(at), bool)
        recurs[order[1:][same]] = True
        recurs[order[:-1][same]] = True
        at, name = at[recurs], name[recurs]
        # The 2k words ending at p: the k ending at p - k and the k ending at p.
        held = np.full(n, -1, np.int64)
        held[at] = name
        before = np.where(at >= k, held[at - k], -1)
        at, name, before = at[before >= 0], name[before >= 0], before[before >= 0]
        name = _names(before, name)
        k *= 2
    start, length, period = (np.concatenate([f[j] for f in found] or [_NONE]) for j in range(3))
    turn = np.lexsort((period, start))
    return start[turn], length[turn], period[turn]


def _found(texts: list[list[bytes]], min_words: int, min_exponent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The runs of each of a few texts, searched together: a word that no text has stands between two of them."""
    numbers: dict[bytes, int] = {}
    flat: list[int] = []
    starts = []
    for j, words in enumerate(texts):
        starts.append(len(flat))
        flat.extend(numbers.setdefault(w, len(numbers)) for w in words)
        flat.append(-1 - j)
    ids = np.array(flat, np.int64) + len(texts)
    start, length, period = runs(ids, min_words, min_exponent)
    cut = np.searchsorted(start, [*starts, len(flat)])
    for first, a, b in zip(starts, cut, cut[1:]):
        yield start[a:b] - first, length[a:b], period[a:b]


def _collapsed(words: list[bytes], start: np.ndarray, length: np.ndarray, period: np.ndarray) -> bytes:
    if not len(start):
        return b" ".join(words)
    step = np.zeros(len(words) + 1, np.int64)
    np.add.at(step, start + period, 1)
    np.add.at(step, start + length, -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(step[:-1]) == 0)])


_OUT = pa.schema([(ROW, pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()),
                  ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
                  ("collapsed", pa.large_binary())])
_DDL = f"{ROW} long, doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed binary"


def _search(min_words: int, min_exponent: int, prepare: Callable | None, finish: Callable, out: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ids, texts = (batch[c].to_pylist() for c in (ROW, "doc_id", "text"))
            rows, waiting, held = [], [], 0

            def flush() -> Iterator[pa.RecordBatch]:
                if waiting:
                    found = _found([w for _, _, w in waiting], min_words, min_exponent)
                    rows.extend(finish(key, i, w, *f) for (key, i, w), f in zip(waiting, found))
                    yield pa.RecordBatch.from_pydict(dict(zip(out.names, zip(*rows))), out)
                rows.clear()
                waiting.clear()

            for key, i, text in zip(keys, ids, texts):
                words = text.encode().split()
                if prepare:
                    words = prepare(i, words)
                waiting.append((key, i, words))
                held += len(words) + 1
                if held >= TOGETHER:
                    yield from flush()
                    held = 0
            yield from flush()

    return run


def _plain(key, i, words, start, length, period):
    found = [dict(zip(("start", "length", "period"), map(int, r))) for r in zip(start, length, period)]
    return key, i, len(words), found, _collapsed(words, start, length, period)


def periodic_runs(docs: DataFrame, min_words: int = MIN_WORDS, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """One row per row of docs: __row, doc_id, n_words, runs (start, length, period; by start, then period) and collapsed:
    the words no run repeats, joined by one space, in UTF-8.

    Words are divided by blank, tab, line feed, vertical tab, form feed and carriage return. A run is a longest stretch
    with smallest period q of at least min_words words and min_exponent periods (3 or more). A word goes if a run contains
    it after the run's first q words.

    A null or empty text has no words, no runs and an empty collapsed text. Repeated rows are searched each by itself, a
    null doc_id is kept, other columns are not read, an empty table gives no row. A text is searched in one task, in
    memory in proportion to its words, and rows are never shuffled."""
    return keyed(docs).mapInArrow(_search(min_words, min_exponent, None, _plain, _OUT), _DDL)


# The query: some texts end in a planted run, and results are digests.

def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """A tenth of the texts, by doc_id, repeat from word a on the p words that begin there."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


_DIGEST = pa.schema([("doc_id", pa.int64()), *[(c, pa.int64()) for c in ("n_runs", "start", "length", "period", "exponent_milli")],
                     ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string()), ("n_words", pa.int64()), ("n_kept", pa.int64())])


def _digest(key, i, words, start, length, period):
    found = list(zip(start.tolist(), length.tolist(), period.tolist()))
    best = None
    for s, n, q in found:  # by start, then period: the first of equal exponents stays
        if best is None or n * best[2] > best[1] * q:
            best = s, n, q
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    collapsed = _collapsed(words, start, length, period)
    return (i, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2], hashlib.sha256(listed.encode()).hexdigest(),
            hashlib.sha256(collapsed).hexdigest(), len(words), collapsed.count(b" ") + 1 if collapsed else 0)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = keyed(documents(spark, sf_dir))
    ddl = ", ".join(f"{f.name} {'string' if pa.types.is_string(f.type) else 'long'}" for f in _DIGEST)
    return docs.mapInArrow(_search(MIN_WORDS, MIN_EXPONENT, planted, _digest, _DIGEST), ddl)
