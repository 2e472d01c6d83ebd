"""Removal of repeated byte strings by distributed prefix doubling over content-sampled positions."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from care_measures.llm.common import ROW, documents, keyed, numbered, stored, temporary
from care_measures.llm.words import blocks, mix, powers

#: Bytes of a string that is removed where it stands again; bytes of the names that positions are sampled by.
LENGTH, SEED = 100, 32
#: Windows around a sampled position that are told apart in one step.
STEP = 8
#: Words of 64 bits in the filters that are sent to the tasks, as powers of two: 16 MB, and up to 64 MB so that there are eight bits a name
#: as long as it goes. They only spare work.
FILTER_BITS, MOST_FILTER_BITS = 21, 23
_SPAN = LENGTH - SEED
_PAD = b"\xff" * LENGTH
_U = np.uint64
_RNG = np.random.default_rng(1993)
_BYTE = _RNG.integers(0, 2**63, 256, dtype=np.uint64)
_K = _RNG.integers(0, 2**62, 24, dtype=np.uint64) * _U(2) + _U(1)
_BASE = int(_RNG.integers(0, 2**62)) * 2 + 1
_UNBASE = pow(_BASE, -1, 2**64)
_BLOCK = 400_000
#: Places that a task holds before it sends them on, and rows of texts it cuts at once.
_HELD, _ROWS = 200_000, 256


class Names:
    """Names of the strings at every position of a block of texts.

    Names of 1, 2, 4, ... 64 bytes come from each other by doubling: the name of twice the length is that of the pair of
    names at offsets 0 and the length. Names depend on the bytes alone, so they are the same in every task. Texts
    are kept apart by bytes that no text holds."""

    def __init__(self, texts: list[bytes]):
        self.array = np.frombuffer(_PAD + b"".join(t + _PAD for t in texts), np.uint8)
        self.sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.starts = LENGTH + np.concatenate([[0], np.cumsum(self.sizes + LENGTH)])
        name, k = _BYTE[self.array], 0
        for offset in (1, 2, 4, 8, 16, 32):
            if offset == SEED:
                self.seed = mix(name)
            name = name[:-offset] * _K[k] + name[offset:] * _K[k + 1]
            name ^= name >> _U(32)
            k += 2
        self.double, self._sums = name, None

    def wide(self, first: np.ndarray, *further: np.ndarray) -> np.ndarray:
        """Names of the union of 64-byte strings at these places."""
        out = self.double[first] * _K[16]
        for j, at in enumerate(further):
            out += self.double[at] * _K[17 + j]
        return mix(out)

    def second(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A second, independent name of the strings from begin to end."""
        if self._sums is None:
            self._sums = np.concatenate([[_U(0)], np.cumsum(_BYTE[self.array] * powers(_BASE, len(self.array)))])
        return mix((self._sums[end] - self._sums[begin]) * powers(_UNBASE, len(self.array) + 1)[begin])

    def sampled(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sampled positions, and the first and last window (start of LENGTH bytes) that belongs to each.

        A window belongs to the leftmost of the least names in it, of which the upper half counts: equal windows have their sample at the
        same place, so a window that stands twice has a sample whose name does. The lower half of what is compared is the place."""
        least, width = self.seed & _U(0xFFFFFFFF00000000) | np.arange(len(self.seed), dtype=np.uint64), 1
        while 2 * width <= _SPAN + 1:
            least, width = np.minimum(least[:-width], least[width:]), 2 * width
        least = np.minimum(least[: len(least) - (_SPAN + 1 - width)], least[_SPAN + 1 - width:])
        n = np.maximum(0, self.sizes - LENGTH + 1)
        windows = np.repeat(self.starts[:-1] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        at = (least[windows] & _U(0xFFFFFFFF)).astype(np.int64)
        new = np.ones(len(windows), bool)
        new[1:] = at[1:] != at[:-1]
        first = np.flatnonzero(new)
        last = windows[np.append(first[1:], len(windows)) - 1] if len(first) else first
        return at[first], windows[first], last

    def seeds(self, at: np.ndarray) -> np.ndarray:
        """Names of the strings of SEED bytes at sampled positions, mixed anew: those sampled are the least of many, and would crowd into a
        small part of a filter."""
        return mix(self.seed[at])

    def text_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, at, side="right") - 1


def _holds(bits: np.ndarray, names: np.ndarray) -> np.ndarray:
    size = len(bits).bit_length() - 1
    return (bits[(names >> _U(64 - size)).astype(np.int64)] >> ((names >> _U(58 - size)) & _U(63))) & _U(1) == 1


def _place_names(row: np.ndarray, start: np.ndarray) -> np.ndarray:
    return mix(row.view(np.uint64) ^ mix(start.view(np.uint64)))


def _filter_bits(names: int) -> int:
    return min(MOST_FILTER_BITS, max(FILTER_BITS, (8 * names // 64).bit_length()))


def _filter(names: DataFrame, column: str) -> Broadcast:
    """A filter that all names of a column pass, of a size that suits their number."""
    names = stored(names.select(column), "names")
    size = _filter_bits(names.count())
    word = F.shiftrightunsigned(column, 64 - size)
    bit = F.shiftrightunsigned(column, 58 - size).bitwiseAND(63).cast("int")
    got = names.select(word.alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    table, bits = got.toArrow(), np.zeros(1 << size, np.uint64)
    bits[table["word"].to_numpy()] = table["bits"].to_numpy().view(np.uint64)
    return names.sparkSession.sparkContext.broadcast(bits)


def _counted(parts: list[np.ndarray]) -> pa.RecordBatch:
    keys, n = np.unique(np.concatenate(parts) if parts else np.zeros(0, np.uint64), return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n, pa.int64())], ["name", "n"])


def _seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Names of the sampled positions of a task and how often they stand there."""
    parts, held = [], 0
    for batch in batches:
        for _, texts in blocks(batch, size=_BLOCK):
            names = Names(texts)
            parts.append(names.seeds(names.sampled()[0]))
            held += len(parts[-1])
            if held > _HELD:
                yield _counted(parts)
                parts, held = [], 0
    yield _counted(parts)


PLACES = f"a long, b long, doc_order long, {ROW} long, start long, end long, name long, covered boolean"
_PLACES = pa.schema([(c, pa.int64()) for c in ("a", "b", "doc_order", ROW, "start", "end", "name")] + [("covered", pa.bool_())])


def _spans(row: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The union of intervals of each row, as its runs."""
    order = np.lexsort((start, row))
    row, start, end = row[order], start[order], end[order]
    new = np.ones(len(row), bool)
    if len(row):
        # running ends within a row: rows are lifted apart, so one accumulation serves all
        lift = np.concatenate([[0], np.cumsum(row[1:] != row[:-1])]) * (int(end.max()) + 2)
        reach = np.maximum.accumulate(end + lift)
        new[1:] = (row[1:] != row[:-1]) | (start[1:] + lift[1:] > reach[:-1])
        first = np.flatnonzero(new)
        stop = np.append(first[1:], len(row)) - 1
        return row[first], start[first], reach[stop] - lift[stop]
    return row, start, end


def _in_slices(batch: pa.RecordBatch, rows: int) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def _own_firsts(found: Iterator[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """The first place of each name pair in each run of a task; later ones are covered whatever other runs hold."""
    parts, held = [], 0
    for part in found:
        parts.append(part)
        held += len(part[0])
        if held >= _HELD:
            yield from _firsts(parts)
            parts, held = [], 0
    if parts:
        yield from _firsts(parts)


def _firsts(parts: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
    a, b, doc, row, start, end, name = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.lexsort((start, row, doc, b, a))
    a, b, doc, row, start, end, name = (c[order] for c in (a, b, doc, row, start, end, name))
    first = np.ones(len(a), bool)
    first[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    yield from _in_slices(pa.RecordBatch.from_arrays(
        [pa.array(c[first].view(np.int64)) for c in (a, b, doc, row, start, end, name)] + [pa.array(np.zeros(int(first.sum()), bool))], schema=_PLACES), 50_000)
    row, start, end = _spans(row[~first], start[~first], end[~first])
    key, none = _place_names(row, start).view(np.int64), np.zeros(len(row), np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(c) for c in (key, row, none, row, start, end, none)] + [pa.array(np.ones(len(row), bool))], schema=_PLACES)


def _contexts(shared: Broadcast):
    """For sampled positions whose name may stand elsewhere: names of all that their windows hold."""
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
        for batch in batches:
            doc, row = batch["doc_order"].to_numpy(), batch[ROW].to_numpy()
            for first, texts in blocks(batch, size=_BLOCK):
                names = Names(texts)
                at, low, high = names.sampled()
                seeds = names.seeds(at)
                keep = _holds(shared.value, seeds)
                low, high, seeds = low[keep], high[keep], seeds[keep]
                text = names.text_of(low)
                origin = names.starts[text]
                a = names.wide(low, (low + high + LENGTH - 64) // 2, high + LENGTH - 64)
                yield [a, names.second(low, high + LENGTH), doc[first + text], row[first + text], low - origin, high - origin + LENGTH, seeds]
    return lambda batches: _own_firsts(found(batches))


class Undecided:
    """Filters of the names that a round leaves undecided, and of their places that no earlier one equals. The others are covered, and
    whoever stands again as they do stands again as the first place of their name does, so that only first places go on."""

    def __init__(self, places: DataFrame):
        firsts = places.filter("NOT again").select(ROW, "start", "name")
        self.names = _filter(firsts.groupBy("name").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "name")
        self.places = _filter(firsts.mapInArrow(_first_places(self.names), "name long"), "name")

    def keep(self, names: np.ndarray, row: np.ndarray, start: np.ndarray) -> np.ndarray:
        return _holds(self.names.value, names) & _holds(self.places.value, _place_names(row, start))

    def destroy(self) -> None:
        self.names.destroy()
        self.places.destroy()


def _first_places(undecided: Broadcast):
    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, start, name = (batch[c].to_numpy() for c in (ROW, "start", "name"))
            keep = _holds(undecided.value, name.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(_place_names(row[keep], start[keep]).view(np.int64))], ["name"])
    return places


def _steps(names: Names, row: np.ndarray, mixed: Undecided) -> tuple[np.ndarray, ...]:
    """Groups of STEP windows of the sampled positions that are left: text, first and last window, and the name of what all of the group hold."""
    at, low, high = names.sampled()
    text = names.text_of(low)
    keep = mixed.keep(names.seeds(at), row[text], low - names.starts[text])
    at, low, high, text = at[keep], low[keep], high[keep], text[keep]
    near, far = (at - high) // STEP, (at - low) // STEP
    n = far - near + 1
    who = np.repeat(np.arange(len(at)), n)
    group = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + near[who]
    core = at[who] - STEP * group
    first, last = np.maximum(core - STEP + 1, low[who]), np.minimum(core, high[who])
    return text[who], first, last, names.wide(core, core + LENGTH - STEP + 1 - 64)


def _groups(mixed: Undecided):
    """For groups of windows of the positions that are left: names of all that the group holds."""
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
        for batch in batches:
            doc, row = batch["doc_order"].to_numpy(), batch[ROW].to_numpy()
            for block, texts in blocks(batch, size=_BLOCK):
                names = Names(texts)
                text, first, last, core = _steps(names, row[block:], mixed)
                origin = names.starts[text]
                a = names.wide(first, last + LENGTH - 64)
                yield [a, names.second(first, last + LENGTH), doc[block + text], row[block + text], first - origin, last - origin + LENGTH, core]
    return lambda batches: _own_firsts(found(batches))


def _windows(mixed: Undecided, cores: Undecided):
    """For groups of windows that are left: names of their windows."""
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
        for batch in batches:
            doc, row = batch["doc_order"].to_numpy(), batch[ROW].to_numpy()
            for block, texts in blocks(batch, size=_BLOCK):
                names = Names(texts)
                text, first, last, core = _steps(names, row[block:], mixed)
                keep = cores.keep(core, row[block + text], first - names.starts[text])
                first, n = first[keep], (last - first + 1)[keep]
                at = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
                text = np.repeat(text[keep], n)
                start = at - names.starts[text]
                yield [names.wide(at, at + LENGTH - 64), names.second(at, at + LENGTH), doc[block + text], row[block + text], start, start + LENGTH, np.zeros(len(at), np.uint64)]
    return lambda batches: _own_firsts(found(batches))


def _ranked(places: DataFrame, name: str) -> DataFrame:
    """(__row, start, end, name, again): whether the string at a place has stood earlier.

    A task sends one place for a string in each run of places it holds at once, so a string of a third of all rows costs few."""
    place = F.row_number().over(Window.partitionBy("a", "b").orderBy("doc_order", ROW, "start"))
    return stored(places.withColumn("place", place).select(ROW, "start", "end", "name", (F.col("covered") | (F.col("place") > 1)).alias("again")), name)


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The spans of each row as runs, by start."""
    for batch in batches:
        lists = batch["spans"]
        spans = lists.flatten()
        row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
        row, start, end = _spans(row, *(spans.field(k).to_numpy() for k in ("start", "end")))
        offsets = pa.array(np.searchsorted(row, np.arange(len(lists) + 1)), pa.int32())
        runs = pa.StructArray.from_arrays([pa.array(start), pa.array(end)], fields=list(_SPANS.value_type))
        yield pa.RecordBatch.from_arrays([batch[ROW], pa.ListArray.from_arrays(offsets, runs)], [ROW, "spans"])


def _texts(touched: Broadcast):
    """Rows, and the texts of those that may have something to remove; of the others what is kept is known."""
    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in _in_slices(whole, _ROWS)):
            pick = _holds(touched.value, mix(batch[ROW].to_numpy().view(np.uint64).copy()))
            own = batch["text"].cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch[ROW], batch["doc_id"], pa.array([len(t) for t in own], pa.int64()), pa.array([t if p else None for t, p in zip(own, pick, strict=True)], pa.binary()),
                 pa.array([None if p else hashlib.sha256(t).hexdigest() for t, p in zip(own, pick, strict=True)], pa.string())],
                [ROW, "doc_id", "n_bytes", "bytes", "sha"])
    return texts


def _cut(with_text: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in _in_slices(whole, _ROWS)):
            rows = []
            for data, sha, spans in zip(batch["bytes"].to_pylist(), batch["sha"].to_pylist(), batch["spans"].to_pylist(), strict=True):
                spans = [(s["start"], s["end"]) for s in spans or []]
                if data is not None:
                    edges = [0, *(x for s in spans for x in s), len(data)]
                    data = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                    sha = hashlib.sha256(data).hexdigest()
                rows.append((sum(b - a for a, b in spans), len(spans), sha, data if with_text else None))
            removed, n, sha, kept = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch[ROW], batch["doc_id"], batch["n_bytes"], pa.array(removed, pa.int64()), pa.array(n, pa.int64()), pa.array(sha, pa.string()), pa.array(kept, pa.binary())],
                [ROW, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"])
    return cut


def suffix_dedup(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """One row per row of docs: __row, doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept_text (null: the text as it is,
    or with_text is false).

    A byte is removed if a string of LENGTH bytes around it also starts earlier: in a row with smaller doc_id (of equal ones, one read
    earlier; a null doc_id counts as the largest) or earlier in the same text. Prefix doubling names strings of 32 bytes
    at every position, sampled positions are ranked by these names, and those whose name is unique drop out. What is left is named anew
    at growing precision: all that the windows of a position hold, all that eight windows in a row hold, and at last the single
    windows of LENGTH bytes; where a name has stood earlier all its windows are covered, and only where what the windows have
    in common stands in different surroundings is the next round needed, for the first place of each name alone. Every round is a shuffle
    of names of what is still undecided; the texts are not moved but those of which something is removed.

    A null text is an empty one; texts shorter than LENGTH lose nothing. Repeated rows are copies of the first. An empty table gives no rows;
    other columns are not read."""
    docs = numbered(docs)
    rows = keyed(docs)
    ordered = rows.select(ROW, F.coalesce("doc_id", F.lit(2**63 - 1)).alias("doc_order"), "text")
    again = lambda df, c: df.groupBy(c).agg(F.sum("n").alias("n")).filter("n > 1").select(c)

    def covered(places: DataFrame) -> DataFrame:
        found = places.filter("again").groupBy(ROW).agg(F.collect_list(F.struct("start", "end")).alias("spans"))
        return stored(found.mapInArrow(_merged, f"{ROW} long, spans array<struct<start: long, end: long>>"), "spans")

    # Each round's places go once their spans and the names that are still undecided are known.
    with temporary():
        shared = _filter(again(rows.select("text").mapInArrow(_seeds, "name long, n long"), "name"), "name")
    with temporary() as keep:
        contexts = _ranked(ordered.mapInArrow(_contexts(shared), PLACES), "contexts")
        mixed, first = Undecided(contexts), covered(contexts)
        keep(first)
    shared.destroy()
    with temporary() as keep:
        groups = _ranked(ordered.mapInArrow(_groups(mixed), PLACES), "groups")
        cores, second = Undecided(groups), covered(groups)
        keep(second)
    with temporary() as keep:
        third = covered(_ranked(ordered.mapInArrow(_windows(mixed, cores), PLACES), "windows"))
        keep(third)
    mixed.destroy()
    cores.destroy()
    with temporary() as keep:
        found = first.unionByName(second).unionByName(third).groupBy(ROW).agg(F.flatten(F.collect_list("spans")).alias("spans"))
        spans = stored(found.mapInArrow(_merged, f"{ROW} long, spans array<struct<start: long, end: long>>"), "spans")
        keep(spans)
    with temporary():
        touched = _filter(spans.mapInArrow(_row_names, "name long"), "name")
    texts = rows.mapInArrow(_texts(touched), f"{ROW} long, doc_id long, n_bytes long, bytes binary, sha string")
    return texts.join(spans, ROW, "left").mapInArrow(_cut(with_text), f"{ROW} long, doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text binary")


def _row_names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(mix(batch[ROW].to_numpy().view(np.uint64).copy()).view(np.int64))], ["name"])


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(documents(spark, sf_dir), with_text=False).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
