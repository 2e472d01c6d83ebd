"""Toxicity scores: Levenshtein automata run over a trie of learned terms, with context windows around every find."""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from care_measures.llm.common import ROW, documents, fold, keyed, stored
from care_measures.llm.words import LOWER, HashTable, Words, blocks, held, missing, separators

#: Labelled documents of each class that the lexicon and the weights are learned from.
SAMPLE = 6000
#: Lengths of the stems among the terms.
STEMS = (4, 5, 6)
#: A term stands in so many toxic sample documents at least, and in toxic ones so many times as often as in others.
LEAST, RATIO = 4, 30.0
WINDOW = 8
_GAPS = separators(bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))
#: Typographic double and single quotation marks, which would else be parts of words.
_DOUBLE, _SINGLE, _QUOTES = re.compile(rb"\xe2\x80[\x9c-\x9f]|\xc2[\xab\xbb]"), re.compile(rb"\xe2\x80[\x98-\x9b]"), b'"`'
WHOLE, STEM, NEAR = 1, 2, 3
FEATURES = 8
MEMORY_WORDS = 1_500_000
#: Letters of a term that misspellings are looked for; longer ones are found as they are. A state is the bits of an integer.
LONGEST = 60
#: Letters of a term that one edit, or two in words of nine letters or more, may be made in.
_LEAST_LETTERS = (5, 8)
#: Words whose automata are run side by side.
AT_ONCE = 1 << 14


class Lexicon:
    """A trie of terms. Whole terms are matched whole or within an edit or two, stems at the start of a word."""

    def __init__(self, terms: list[tuple[str, bool, float]]):
        self.root: dict = {}
        for term, is_stem, weight in sorted(terms):
            node = self.root
            for c in term:
                node = node.setdefault(c, {})
            node[STEM if is_stem else WHOLE] = weight
        # by edits, the lengths of words that may be within them of a term
        lengths = {len(t) for t, is_stem, _ in terms if not is_stem and len(t) <= LONGEST}
        self._lengths = [{n + d for n in lengths if n >= least for d in range(-e, e + 1)} for e, least in enumerate(_LEAST_LETTERS, 1)]

    def look_up(self, word: str) -> tuple[int, float]:
        """Kind of the best find for a word (0: none) and its weight."""
        kind, weight = self.look_up_all([word])
        return int(kind[0]), float(weight[0])

    def look_up_all(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for many words at once."""
        kind, weight, left = np.zeros(len(words), np.int8), np.zeros(len(words)), ([], [])
        for i, word in enumerate(words):
            kind[i], weight[i] = self._exact(word)
            two = len(word) >= 9
            if not kind[i] and len(word) >= 4 and len(word) in self._lengths[two]:
                left[two].append(i)
        for edits, places in enumerate(left, 1):
            for at in range(0, len(places), AT_ONCE):
                some = places[at: at + AT_ONCE]
                weight[some] = self._near([words[i] for i in some], edits)
                kind[some] = np.where(weight[some] > 0, NEAR, 0)
        return kind, weight

    def _exact(self, word: str) -> tuple[int, float]:
        node, best = self.root, (0, 0.0)
        for i, c in enumerate(word):
            node = node.get(c)
            if node is None:
                break
            if STEM in node:
                best = max(best, (STEM, node[STEM]), key=lambda x: x[1])
            if i == len(word) - 1 and WHOLE in node:
                return WHOLE, node[WHOLE]
        return best

    def _near(self, words: list[str], edits: int) -> np.ndarray:
        """The largest weight of a whole term within so many edits of each word (0: none).

        The automata that accept all within the edits of a word are run over the trie, those of all words side by side: the
        states of an automaton are sets of starts of its word, one for each number of edits, held as the bits of integers. A
        branch of the trie is left by the words whose sets are empty."""
        width, one = max(map(len, words)), np.uint64(1)
        letters = np.array(words, f"U{width}").view(np.uint32).reshape(len(words), width)
        end = one << np.fromiter(map(len, words), np.uint64, len(words))
        full, bit, best, at = (end << one) - one, one << np.arange(width, dtype=np.uint64), np.zeros(len(words)), {}
        stack = [(self.root, np.arange(len(words)), [np.full(len(words), (2 << e) - 1, np.uint64) for e in range(edits + 1)], 0)]
        while stack:
            node, who, state, depth = stack.pop()
            if WHOLE in node and _LEAST_LETTERS[edits - 1] <= depth <= LONGEST:
                hit = who[state[-1] & end[who] > 0]
                best[hit] = np.maximum(best[hit], node[WHOLE])
            for c, child in node.items():
                if c in (WHOLE, STEM):
                    continue
                if c not in at:
                    at[c] = np.where(letters == ord(c), bit, np.uint64(0)).sum(axis=1, dtype=np.uint64)
                here, most = at[c][who], full[who]
                new = [(state[0] & here) << one]
                for e in range(1, edits + 1):
                    new.append(((state[e] & here) << one | state[e - 1] << one | state[e - 1] | new[-1] << one) & most)
                alive = np.flatnonzero(new[-1])
                if len(alive):
                    stack.append((child, who[alive], [s[alive] for s in new], depth + 1))
        return best


def _quoted(words: Words, text: int, at: int) -> bool:
    """Whether a quotation mark stands on both sides within the window, in the same text."""
    first, last = words.ranges[text], words.ranges[text + 1] - 1
    origin, end = words.text_starts[text], words.text_starts[text + 1] - 1
    left = words.bytes[max(origin, words.starts[max(first, at - WINDOW)] - 1): words.starts[at]]
    right = words.bytes[words.ends[at]: min(end, words.ends[min(last, at + WINDOW)] + 1)]
    return any(q in left for q in _QUOTES) and any(q in right for q in _QUOTES)


def _plain(text: bytes) -> bytes:
    """The text with ASCII quotation marks."""
    return text if text.isascii() else _SINGLE.sub(b"'", _DOUBLE.sub(b'"', text))


class Scorer:
    """Features of texts; remembers which words the lexicon finds."""

    def __init__(self, terms: list[tuple[str, bool, float]]):
        self.lexicon = Lexicon(terms)
        self._forget()

    def _forget(self) -> None:
        self.table, self.kind, self.weight = HashTable(18), np.zeros(0, np.int8), np.zeros(0)

    def features(self, texts: list[bytes]) -> np.ndarray:
        """For each text: finds of each kind outside quotations, quoted finds, summed and largest weight, finds close to another, finds a word."""
        if self.table.size > MEMORY_WORDS:
            self._forget()
        words = Words([_plain(t) for t in texts], LOWER, _GAPS)
        number, new = missing(self.table, words.hashes)
        if len(new):
            kind, weight = self.lexicon.look_up_all([words.word(i).decode() for i in new])
            self.table.add(words.hashes[new])
            self.kind, self.weight = np.concatenate([self.kind, kind]), np.concatenate([self.weight, weight])
            number = self.table.find(words.hashes)
        out = np.zeros((len(texts), FEATURES))
        if not len(number):
            return out
        finds = np.flatnonzero(self.kind[number])
        text = np.searchsorted(words.ranges, finds, side="right") - 1
        kind, weight = self.kind[number[finds]], self.weight[number[finds]]
        quoted = np.array([_quoted(words, t, i) for t, i in zip(text, finds, strict=True)], bool)
        close = np.zeros(len(finds), bool)
        close[1:] = (text[1:] == text[:-1]) & (finds[1:] - finds[:-1] <= WINDOW)
        for k in (WHOLE, STEM, NEAR):
            np.add.at(out[:, k - 1], text[(kind == k) & ~quoted], 1)
        np.add.at(out[:, 3], text[quoted], 1)
        np.add.at(out[:, 4], text[~quoted], weight[~quoted])
        np.maximum.at(out[:, 5], text[~quoted], weight[~quoted])
        np.add.at(out[:, 6], text[close], 1)
        out[:, 7] = 100 * out[:, :4].sum(axis=1) / np.maximum(1, words.counts())
        return np.log1p(out)


def _terms_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many toxic and other texts of a task each word and stem stands."""
    seen = (Counter(), Counter())
    for batch in batches:
        for toxic, text in zip(batch["toxic"].to_pylist(), batch["text"].cast(pa.binary()).to_pylist(), strict=True):
            words = set(_plain(text).translate(LOWER).decode().translate(_TO_BLANK).split())
            stems = {(w[:n], n) for w in words for n in STEMS if len(w) >= n and w[:n].isalpha()}
            seen[int(toxic > 0)].update(words)
            seen[int(toxic > 0)].update(stems)
    keys = list(seen[1])
    yield pa.RecordBatch.from_arrays(
        [pa.array([k if isinstance(k, str) else k[0] for k in keys], pa.string()), pa.array([not isinstance(k, str) for k in keys], pa.bool_()),
         pa.array([seen[1][k] for k in keys], pa.int64()), pa.array([seen[0][k] for k in keys], pa.int64())], ["term", "is_stem", "toxic", "other"])
    keys = [k for k in seen[0] if k not in seen[1]]
    yield pa.RecordBatch.from_arrays(
        [pa.array([k if isinstance(k, str) else k[0] for k in keys], pa.string()), pa.array([not isinstance(k, str) for k in keys], pa.bool_()),
         pa.array([0] * len(keys), pa.int64()), pa.array([seen[0][k] for k in keys], pa.int64())], ["term", "is_stem", "toxic", "other"])


_TO_BLANK = {c: " " for c in range(128) if _GAPS[c]}


def sampled_labels(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """(doc_id, text, toxic): up to `sample` documents of each class, those with the smallest hashes of doc_id.

    A doc_id with several labels is toxic if one of them is; labels without doc_id or class are left out."""
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    picked = [known.filter(c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for c in ("toxic > 0", "toxic <= 0")]
    chosen = stored(picked[0].unionByName(picked[1]), "sampled-labels")
    return stored(keyed(docs).join(chosen, "doc_id").select(ROW, "doc_id", "text", F.col("toxic").cast("int").alias("toxic")), "sampled-documents")


def condensed(rows: list[tuple[str, bool, int, float]]) -> list[tuple[str, bool, float]]:
    """The lexicon from counted words and stems (term, is_stem, toxic documents, log odds).

    A stem stays if it stands in twice as many toxic documents as any one word that begins with it, so that it speaks for
    endings that were not seen; words and longer stems that begin with a stem that stays are left to it."""
    most: dict[str, int] = {}
    for term, is_stem, n, _ in rows:
        if not is_stem:
            for k in STEMS:
                most[term[:k]] = max(n, most.get(term[:k], 0))
    stems: set[str] = set()
    for term, is_stem, n, _ in sorted(rows, key=lambda r: (len(r[0]), r[0])):
        if is_stem and n >= 2 * most.get(term, 0) and not any(term[:k] in stems for k in STEMS if k < len(term)):
            stems.add(term)
    return [(term, is_stem, odds) for term, is_stem, _, odds in rows if (term in stems if is_stem else not any(term[:k] in stems for k in STEMS))]


def learn_terms(sample: DataFrame) -> list[tuple[str, bool, float]]:
    """Words and stems that stand in toxic documents far more often than in others, with their log odds."""
    n = {r["toxic"] > 0: r["count"] for r in sample.groupBy("toxic").count().collect()}
    toxic, other = max(1, n.get(True, 0)), max(1, n.get(False, 0))
    counted = sample.select("text", "toxic").mapInArrow(_terms_of, "term string, is_stem boolean, toxic long, other long").groupBy("term", "is_stem").agg(
        F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    odds = F.log((F.col("toxic") / toxic) / ((F.col("other") + 0.5) / other))
    best = counted.filter((F.col("toxic") >= LEAST) & (odds >= float(np.log(RATIO)))).orderBy(F.desc("toxic"), "term", "is_stem")  # as many as the bounded sample holds
    return condensed([(r["term"], r["is_stem"], r["toxic"], float(r["odds"])) for r in best.withColumn("odds", odds).collect()])


def _features(terms: list[tuple[str, bool, float]], extra: str):
    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(terms)
        for batch in batches:
            for first, texts in blocks(batch):
                part = batch.slice(first, len(texts))
                rows = scorer.features(texts)
                yield pa.RecordBatch.from_arrays([part[extra], pa.array(list(rows), pa.list_(pa.float64()))], [extra, "features"])
    return features


def _scores(terms: list[tuple[str, bool, float]], weights: np.ndarray):
    schema, key = pa.schema([(ROW, pa.int64()), ("doc_id", pa.int64()), ("score", pa.float64()), ("n_finds", pa.int64())]), uuid.uuid4().hex

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = held(key, lambda: Scorer(terms))
        for batch in batches:
            for first, texts in blocks(batch):
                part, rows = batch.slice(first, len(texts)), scorer.features(texts)
                finds = np.rint(np.expm1(rows[:, :4]).sum(axis=1)).astype(np.int64)
                score = 1 / (1 + np.exp(-np.clip(weights[0] + rows @ weights[1:], -30, 30)))
                yield pa.RecordBatch.from_arrays([part[ROW], part["doc_id"], pa.array(score), pa.array(finds)], schema=schema)
    return score


def logistic_regression(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, steps: int = 30) -> np.ndarray:
    """Intercept and weights, by Newton's method with a quadratic penalty on the weights."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w, ridge = np.zeros(x.shape[1]), penalty * np.eye(x.shape[1])
    ridge[0, 0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        w += step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
    return w


def toxicity(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """One row per row of docs: __row, doc_id, score (0 to 1), n_finds.

    labelled (doc_id, text, toxic) is a bounded sample of labelled documents: the lexicon (words, and stems that stand for
    any ending) and the weights of the features come from it. Whole texts are searched for words of the lexicon, spelled right or
    wrong; finds between quotation marks within eight words on both sides count apart, and finds close to each other once more.

    A null text is an empty one; texts without finds all have one score. With labels of one class only every score is that
    class's, 0 or 1, and without any it is 0. Repeated rows are scored alike; an empty table gives no rows. Other columns are not read."""
    terms = learn_terms(labelled)
    rows = labelled.select(ROW, "text").mapInArrow(_features(terms, ROW), f"{ROW} long, features array<double>").join(labelled.select(ROW, "toxic"), ROW).collect()
    x = np.array([r["features"] for r in rows]).reshape(-1, FEATURES)
    y = np.array([float(r["toxic"] > 0) for r in rows])
    if len(set(y)) < 2:
        share = float(y.max(initial=0.0))
        return keyed(docs).select(ROW, "doc_id", F.lit(share).alias("score"), F.lit(0).cast("long").alias("n_finds"))
    weights = logistic_regression(x, y)
    return keyed(docs).mapInArrow(_scores(terms, weights), f"{ROW} long, doc_id long, score double, n_finds long")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity(docs, sampled_labels(docs, labels.filter(fold(5) != 0), SAMPLE))
    return scored.select("doc_id", (fold(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
