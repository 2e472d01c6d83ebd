"""Words of many texts at once, as numpy arrays: places, 64-bit hashes, and a table from hashes to small integers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_U = np.uint64
_RANDOM = np.random.default_rng(20240601)
_OF_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) | _U(1)
_BASE = int(_RANDOM.integers(1, 2**62)) * 2 + 1
_UNBASE = pow(_BASE, -1, 2**64)
_powers: dict[int, np.ndarray] = {}

#: Lower-cases A-Z.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def separators(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


def powers(base: int, n: int) -> np.ndarray:
    held = _powers.get(base)
    if held is None or len(held) < n:
        held = np.empty(max(n, 1 << 20), np.uint64)
        held[0], size = 1, 1
        while size < len(held):
            step = min(size, len(held) - size)
            held[size: size + step] = held[:step] * _U(pow(base, size, 2**64))
            size += step
        _powers[base] = held
    return held[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit over all others."""
    h = h ^ (h >> _U(31))
    h *= _U(0x7FB5D329728EA185)
    h ^= h >> _U(27)
    h *= _U(0x81DADEF4BC2DD44D)
    h ^= h >> _U(33)
    return h


def distinct(keys: np.ndarray) -> np.ndarray:
    """The distinct keys in order: np.unique puts them into a hash table first, which takes ten times as long as sorting them."""
    keys = np.sort(keys)
    return keys[np.concatenate([np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1]])]


def blocks(batch: pa.RecordBatch, column: str = "text", size: int = 500_000) -> Iterator[tuple[int, list[bytes]]]:
    """The texts of a batch as UTF-8 in runs of about size bytes, with the place of the first: never a part of a text."""
    texts, block, first, held = batch[column].cast(pa.binary()).to_pylist(), [], 0, 0
    for i, t in enumerate(texts):
        block.append(t)
        held += len(t)
        if held >= size:
            yield first, block
            block, first, held = [], i + 1, 0
    if block:
        yield first, block


class Words:
    """The words of a block of texts: starts and ends in `bytes`, `hashes`, and for each text its range of words.

    Texts are translated (a map of bytes), and words are the longest runs of bytes that are no separators."""

    def __init__(self, texts: list[bytes], translate: bytes | None, separator: np.ndarray):
        gap = bytes([int(np.flatnonzero(separator)[0])])
        self.bytes = gap.join(texts) + gap
        if translate:
            self.bytes = self.bytes.translate(translate)
        self.array = np.frombuffer(self.bytes, np.uint8)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.text_starts = np.concatenate([[0], np.cumsum(lengths + 1)])
        apart = separator[self.array]
        edges = np.flatnonzero(apart[1:] != apart[:-1]) + 1
        if not apart[0]:
            edges = np.concatenate([[0], edges])
        self.starts, self.ends = edges[::2], edges[1::2]
        n = len(self.array)
        sums = np.empty(n + 1, np.uint64)
        sums[0] = 0
        np.cumsum(_OF_BYTE[self.array] * powers(_BASE, n), out=sums[1:])
        self.hashes = mix((sums[self.ends] - sums[self.starts]) * powers(_UNBASE, n)[self.starts])
        self.ranges = np.searchsorted(self.starts, self.text_starts)

    def word(self, i: int) -> bytes:
        return self.bytes[self.starts[i]: self.ends[i]]

    def counts(self) -> np.ndarray:
        return np.diff(self.ranges)


class HashTable:
    """Numbers 64-bit keys 0, 1, 2, ... in the order they are added; find gives -1 for keys not added."""

    def __init__(self, bits: int = 16):
        self.keys, self.size = np.empty(1 << (bits - 1), np.uint64), 0
        self._slots, self._bits = np.full(1 << bits, -1, np.int32), bits

    def find(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int32)
        mask, at = (1 << self._bits) - 1, np.arange(len(keys))
        slot = (keys >> _U(64 - self._bits)).astype(np.int64)
        while len(at):
            held = self._slots[slot]
            same = (held >= 0) & (self.keys[held] == keys[at])
            out[at[same]] = held[same]
            on = (held >= 0) & ~same
            at, slot = at[on], (slot[on] + 1) & mask
        return out

    def add(self, new: np.ndarray) -> None:
        """Adds keys that are distinct and not in the table."""
        while self.size + len(new) > len(self.keys):
            self._grow()
        self.keys[self.size: self.size + len(new)] = new
        self._place(np.arange(self.size, self.size + len(new), dtype=np.int32))
        self.size += len(new)

    def _grow(self) -> None:
        keys = np.empty(2 * len(self.keys), np.uint64)
        keys[: self.size] = self.keys[: self.size]
        self.keys, self._bits = keys, self._bits + 1
        self._slots = np.full(1 << self._bits, -1, np.int32)
        self._place(np.arange(self.size, dtype=np.int32))

    def _place(self, ids: np.ndarray) -> None:
        mask = (1 << self._bits) - 1
        slot = (self.keys[ids] >> _U(64 - self._bits)).astype(np.int64)
        while len(ids):
            free = self._slots[slot] < 0
            self._slots[slot[free]] = ids[free]
            lost = self._slots[slot] != ids
            ids, slot = ids[lost], (slot[lost] + 1) & mask


def missing(table: HashTable, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the keys (-1: not there) and for each distinct key that is not there one of its places."""
    found = table.find(keys)
    at = np.flatnonzero(found < 0)
    _, first = np.unique(keys[at], return_index=True)
    return found, at[first]


_held: dict = {}


def held(key: str, make):
    """What make() gives, kept by this Python worker from task to task until it is asked for with another key: one thing at a
    time, so that what one operator keeps is not there while the next one works."""
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]


def forget() -> None:
    """Lets go of what this worker keeps for an operator that is done, and of memory that Arrow has freed."""
    _held.clear()
    pa.default_memory_pool().release_unused()
