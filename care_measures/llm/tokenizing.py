"""Tokenizing with a memory of words: exact ids of the library, while each different word of a worker is encoded once."""

from __future__ import annotations

import os
import re

import numpy as np

from care_measures.llm.words import HashTable, Words, held, missing, separators

#: Words that a Python worker remembers; then it starts anew, so memory is bounded.
MEMORY_WORDS = 1_500_000
#: White space, in anyone's sense, other than blank and newline.
_ODD = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0 ᠎ -‏    　﻿]")
_ODD_ASCII = [bytes([c]) for c in b"\t\r\x0b\x0c\x1c\x1d\x1e\x1f"]
_GAPS = separators(b" \n")
_FIRST, _LINE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_JOINED = 200


class WordEncoder:
    """Encodes texts with a tokenizer file, word by word.

    A vocabulary's pre-tokenizer cuts every text into pieces that are merged each on its own, and where a word ends and white
    space begins there is always a cut. With a byte-level vocabulary a piece may take the blank in front of a word, so
    words are remembered with the white space before them; texts with other white space than single blanks and newlines between words are
    encoded whole. With a vocabulary that drops white space, each blank or newline cuts. Special tokens hold no white space,
    so they are found in words as in whole texts."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.keeps_blanks = len(self._ids(" b\n b")) != len(self._ids("b b"))
        # between words a newline is an id of its own; where white space is dropped, a sign that is rare in texts
        self.mark = "\n" if self.keeps_blanks else " \u2022 "
        self.mark_id = self._ids(self.mark)[0] if len(self._ids(self.mark)) == 1 else -1
        self._forget()

    def _forget(self) -> None:
        self.table = HashTable(18)
        self.starts, self.sizes = np.zeros(1, np.int64), np.zeros(0, np.int32)
        self.flat = np.zeros(0, np.uint32)

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _simple(self, text: bytes) -> bool:
        if not self.keeps_blanks:
            return True
        if not text or text[0] in b" \n" or text[-1] in b" \n" or any(x in text for x in (b"  ", b" \n", b"\n ", b"\n\n")):
            return False
        return not (any(c in text for c in _ODD_ASCII) if text.isascii() else _ODD.search(text.decode()))

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of ids, and ids, of words: many words joined by a mark, which is a piece and an id of its own, make one call."""
        joined = self.tokenizer.encode_batch_fast([self.mark.join([*words[i: i + _JOINED], ""]) for i in range(0, len(words), _JOINED)], add_special_tokens=False)
        ids = np.concatenate([np.zeros(0, np.uint32), *[np.array(e.ids, np.uint32) for e in joined]])
        marks = np.flatnonzero(ids == self.mark_id)
        return np.diff(marks, prepend=-1) - 1, np.delete(ids, marks)

    def _learn(self, words: Words, keys: np.ndarray, places: np.ndarray, leads: np.ndarray | None) -> None:
        texts = [words.word(i).decode() for i in places]
        if leads is not None:
            texts = [("", " ", "\n")[k] + t for k, t in zip(leads[places], texts, strict=True)]
        marked = np.array([self.mark_id < 0 or self.mark.strip(" ") in t for t in texts], bool)
        sizes, flat = self._encode([t for t, m in zip(texts, marked, strict=True) if not m])
        alone = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast([t for t, m in zip(texts, marked, strict=True) if m], add_special_tokens=False)]
        sizes = np.concatenate([sizes, np.fromiter(map(len, alone), np.int64, len(alone))])
        self.table.add(keys[np.concatenate([places[~marked], places[marked]])])
        self.sizes = np.concatenate([self.sizes, sizes.astype(np.int32)])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes, dtype=np.int64)])
        self.flat = np.concatenate([self.flat, flat, *alone])

    def _numbers(self, texts: list[bytes]) -> tuple[Words, np.ndarray]:
        if self.table.size > MEMORY_WORDS:
            self._forget()
        words = Words(texts, None, _GAPS)
        keys, leads = words.hashes, None
        if self.keeps_blanks:
            before = words.array[words.starts - 1]
            leads = np.where(before == 10, 2, 1)
            leads[words.ranges[:-1]] = 0
            keys = np.where(leads == 0, keys ^ _FIRST, np.where(leads == 2, keys ^ _LINE, keys))
        found, places = missing(self.table, keys)
        if len(places):
            self._learn(words, keys, places, leads)
            found = self.table.find(keys)
        return words, found

    def counts(self, texts: list[bytes]) -> np.ndarray:
        """Number of tokens of each text."""
        out = np.zeros(len(texts), np.int64)
        simple = np.array([self._simple(t) for t in texts], bool)
        some = np.flatnonzero(simple)
        if len(some):
            words, numbers = self._numbers([texts[i] for i in some])
            sums = np.concatenate([[0], np.cumsum(self.sizes[numbers], dtype=np.int64)])
            out[some] = np.diff(sums[words.ranges])
        for i in np.flatnonzero(~simple):
            out[i] = len(self._ids(texts[i].decode()))
        return out

    def ids(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of each text."""
        out = [None] * len(texts)
        simple = np.array([self._simple(t) for t in texts], bool)
        some = np.flatnonzero(simple)
        if len(some):
            words, numbers = self._numbers([texts[i] for i in some])
            sizes = self.sizes[numbers]
            sums = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
            flat = self.flat[np.repeat(self.starts[numbers] - sums[:-1], sizes) + np.arange(sums[-1])]
            cuts = sums[words.ranges]
            for k, i in enumerate(some):
                out[i] = flat[cuts[k]: cuts[k + 1]]
        for i in np.flatnonzero(~simple):
            out[i] = np.array(self._ids(texts[i].decode()), np.uint32)
        return out


def encoder(path: str) -> WordEncoder:
    """This Python worker's encoder for a file; it outlives a task."""
    return held(f"encoder {path}", lambda: WordEncoder(path))
