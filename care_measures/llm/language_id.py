"""Language identification: a bidirectional gated recurrent network over bytes, trained in numpy."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from care_measures.llm.common import ROW, documents, fold, keyed
from care_measures.llm.words import LOWER, blocks

#: What is learned from: up to TRAIN_WINDOWS windows a language, WINDOWS_EACH of a document, TRAIN_LENGTH characters long.
TRAIN_WINDOWS, WINDOWS_EACH, TRAIN_LENGTH = 2000, 4, 120
STATE, STEPS, BATCH = 8, 300, 128
PARTS = 8
#: A window labels CORE bytes and reads up to BEFORE bytes on both sides of them, so that its states are warm there.
CORE, BEFORE = 224, 32
#: Windows that are read in step.
TOGETHER = 1024
UNKNOWN = "und"
_LETTER = re.compile(rb"[A-Za-z]")


def _softsign(x: np.ndarray) -> None:
    """x / (1 + |x|) in place: squashes as tanh does, at a small part of its cost."""
    size = np.abs(x)
    size += 1
    x /= size


def _gate(x: np.ndarray) -> None:
    """A sigmoid made of softsign, in place."""
    _softsign(x)
    x *= 0.5
    x += 0.5


def _gate_slope(y: np.ndarray) -> np.ndarray:
    """The slope of a gate where its value is y."""
    return 0.5 * (1 - abs(2 * y - 1)) ** 2


class BiGRU:
    """Two gated recurrent layers, one per direction, over bytes, and a softmax over languages at every position.

    Windows are rows of bytes, the longest first; `lengths` says how many bytes of each count."""

    def __init__(self, languages: int, state: int = STATE, seed: int = 7):
        rng, h = np.random.default_rng(seed), state
        self.state = h
        self.p = {"v": rng.normal(0, 0.3, (2 * h, languages)), "c": np.zeros(languages)}
        for d in "fb":
            self.p |= {f"g{d}": rng.normal(0, 0.3, (256, 3 * h)), f"u{d}": rng.normal(0, 0.3, (h, 3 * h))}
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def _run(self, x: np.ndarray, active: np.ndarray, d: str, tape: list | None) -> np.ndarray:
        """States after each byte of x (positions by windows), read forward or backward. At position i the first active[i] windows go on."""
        t, n, h = *x.shape, self.state
        gate = [slice(k * h, (k + 1) * h) for k in range(3)]
        gz, gr, gn = (np.ascontiguousarray(self.p[f"g{d}"][:, k]) for k in gate)
        uz, ur, un = (np.ascontiguousarray(self.p[f"u{d}"][:, k]) for k in gate)
        s, out = np.zeros((n, h), gz.dtype), np.zeros((t, n, h), gz.dtype)
        for i in range(t) if d == "f" else range(t - 1, -1, -1):
            k = active[i]
            byte, before = x[i, :k], s[:k]
            z, reset, new, r = gz.take(byte, axis=0), gr.take(byte, axis=0), gn.take(byte, axis=0), before @ un
            z += before @ uz
            reset += before @ ur
            _gate(z)
            _gate(reset)
            new += reset * r
            _softsign(new)
            if tape is not None:
                tape.append((i, k, before.copy(), z, reset, new, r))
            change = before - new
            change *= z
            np.add(new, change, out=out[i, :k])
            s[:k] = out[i, :k]
        return out

    def probabilities(self, x: np.ndarray, lengths: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """For each language, position and window, what the network says there; beyond a window's length, nothing of use."""
        x = np.ascontiguousarray(x.T).astype(np.intp)
        active = np.searchsorted(-lengths, -np.arange(len(x)), "left")
        tapes, h = ([], []) if keep is not None else (None, None), self.state
        forward, backward = self._run(x, active, "f", tapes[0]), self._run(x, active, "b", tapes[1])
        out = self.p["v"][:h].T @ forward.reshape(-1, h).T
        out += self.p["v"][h:].T @ backward.reshape(-1, h).T
        out += self.p["c"][:, None]
        out -= out.max(axis=0)
        np.exp(out, out=out)
        out /= out.sum(axis=0)
        if keep is not None:
            keep |= {"x": x, "states": np.concatenate([forward, backward], axis=2), "tapes": tapes}
        return out.reshape(-1, *x.shape)

    def gradients(self, x: np.ndarray, y: np.ndarray, lengths: np.ndarray | None = None) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss over all positions and its gradients, by backpropagation through time."""
        lengths = np.full(len(x), x.shape[1]) if lengths is None else lengths
        keep: dict = {}
        d_logits, h = np.ascontiguousarray(self.probabilities(x, lengths, keep).transpose(1, 2, 0)), self.state
        n, real = len(x), np.arange(x.shape[1])[:, None] < lengths
        loss = -np.log(np.maximum(d_logits[:, np.arange(n), y], 1e-30))[real].mean()
        d_logits[:, np.arange(n), y] -= 1
        d_logits *= real[:, :, None] / d_logits.dtype.type(real.sum())
        grads = {"v": np.einsum("tnh,tnl->hl", keep["states"], d_logits), "c": d_logits.sum((0, 1))}
        d_states = d_logits @ self.p["v"].T
        for d, tape, part in zip("fb", keep["tapes"], (d_states[:, :, :h], d_states[:, :, h:]), strict=True):
            u, carry, places, d_inputs = self.p[f"u{d}"], np.zeros((n, h), d_logits.dtype), [], []
            du = np.zeros_like(u)
            for i, k, before, z, reset, new, r in reversed(tape):
                ds = part[i, :k] + carry[:k]
                d_new = ds * (1 - z) * (1 - abs(new)) ** 2
                d_z = ds * (before - new) * _gate_slope(z)
                d_reset = d_new * r * _gate_slope(reset)
                d_recurrent = np.concatenate([d_z, d_reset, d_new * reset], axis=1)
                du += before.T @ d_recurrent
                places.append(keep["x"][i, :k])
                d_inputs.append(np.concatenate([d_z, d_reset, d_new], axis=1))
                carry[:k] = ds * z + d_recurrent @ u.T
            at = np.concatenate(places)[:, None] * (3 * h) + np.arange(3 * h)
            dg = np.bincount(at.ravel(), np.concatenate(d_inputs).ravel(), 256 * 3 * h).reshape(256, 3 * h)
            grads |= {f"u{d}": du, f"g{d}": dg.astype(u.dtype)}
        return float(loss), grads

    def train(self, windows: list[bytes], y: np.ndarray, steps: int = STEPS, rate: float = 0.01) -> float:
        """Adam over batches of windows, in a fixed random order each time all are read; the mean loss of the last tenth of the steps."""
        rng, names, order, losses = np.random.default_rng(11), list(self.p), np.zeros(0, np.int64), []
        mean, square = ({k: np.zeros_like(self.p[k]) for k in names} for _ in range(2))
        for step in range(1, steps + 1):
            if not len(order):
                order = rng.permutation(len(windows))
            batch, order = sorted(order[:BATCH], key=lambda i: -len(windows[i])), order[BATCH:]
            value, grads = self.gradients(*rectangle([windows[i] for i in batch], y[batch]))
            losses.append(value)
            for k in names:
                mean[k] = 0.9 * mean[k] + 0.1 * grads[k]
                square[k] = 0.99 * square[k] + 0.01 * grads[k] ** 2
                change = mean[k] / (1 - 0.9**step) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)
                self.p[k] -= (rate / (1 + 4 * step / steps) ** 0.5 * change).astype(np.float32)
        return float(np.mean(losses[-max(1, steps // 10):]))


def rectangle(windows: list[bytes], y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows, the longest first, as rows of one array; their labels; their lengths."""
    lengths = np.array([len(w) for w in windows])
    out = np.zeros((len(windows), int(lengths.max())), np.uint8)
    for row, w in zip(out, windows, strict=True):
        row[: len(w)] = np.frombuffer(w, np.uint8)
    return out, y, lengths


class Identifier:
    """Languages of texts, by what the network says about every byte of them."""

    def __init__(self, network: BiGRU, languages: list[str]):
        self.network, self.languages = network, languages

    def read(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """For each text and language: the probabilities summed over all positions, and the positions that it is likeliest at.

        A text is cut in windows of CORE bytes; the network reads BEFORE bytes more on both sides, as far as the text goes.
        What it says about a window does not depend on what else is read with it."""
        data = np.frombuffer(b"".join(texts).translate(LOWER), np.uint8)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(sizes)
        windows = -(-sizes // CORE)
        owner = np.repeat(np.arange(len(texts)), windows)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
        first, end = (ends - sizes)[owner], ends[owner]
        core = first + nth * CORE
        core_end = np.minimum(core + CORE, end)
        start = np.maximum(core - BEFORE, first)
        lengths = np.minimum(core_end + BEFORE, end) - start
        order = np.argsort(-lengths, kind="stable")
        sums, labels = np.zeros((len(texts), len(self.languages))), np.zeros((len(texts), len(self.languages)), np.int64)
        for at in range(0, len(order), TOGETHER):
            some = order[at: at + TOGETHER]
            steps = np.arange(lengths[some[0]])
            x = data[np.minimum(start[some][:, None] + steps, len(data) - 1)]
            said = self.network.probabilities(x, lengths[some])
            place = start[some] + steps[:, None]
            own = (place >= core[some]) & (place < core_end[some])
            free, most = own.copy(), said.max(axis=0)
            for k, mine in enumerate(said):
                best = free & (mine == most)
                free &= ~best
                np.add.at(labels[:, k], owner[some], best.sum(axis=0))
                mine *= own
                np.add.at(sums[:, k], owner[some], mine.sum(axis=0, dtype=np.float64))
        return sums, labels


def has_letter(text: bytes) -> bool:
    return bool(_LETTER.search(text)) or not text.isascii() and any(c.isalpha() for c in text.decode(errors="ignore"))


def learn(docs: DataFrame, train_windows: int = TRAIN_WINDOWS) -> tuple[BiGRU, list[str]]:
    """A network trained on docs (doc_id, text, lang): in each language on up to train_windows windows, WINDOWS_EACH of a document, at places drawn by
    hash over the whole text. Documents without lang or text are not learned from."""
    labelled = docs.filter("lang IS NOT NULL AND text <> ''").select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text")
    turns = labelled.select("*", F.explode(F.array(*[F.lit(k) for k in range(WINDOWS_EACH)])).alias("turn"))
    drawn = F.xxhash64("turn", "doc_id")
    place = F.pmod(drawn, F.greatest(F.length("text") - TRAIN_LENGTH, F.lit(0)) + 1) + 1
    windows = turns.select("lang", F.xxhash64("doc_id", "turn").alias("draw"), "doc_id", F.substr("text", place.cast("int"), F.lit(TRAIN_LENGTH)).alias("window"))
    # An equal share of each of PARTS hash classes, small enough for Spark to cut the rows down before it shuffles them.
    windows = windows.withColumn("part", F.pmod("draw", F.lit(PARTS)))
    first = Window.partitionBy("lang", "part").orderBy("draw", "doc_id", "window")
    sample = windows.withColumn("k", F.row_number().over(first)).filter(F.col("k") <= train_windows // PARTS).select("lang", "window")
    rows = sorted((r["lang"], r["window"].encode().translate(LOWER)) for r in sample.collect())
    languages = sorted({lang for lang, _ in rows})
    network = BiGRU(max(1, len(languages)))
    if rows:
        network.train([w for _, w in rows], np.array([languages.index(lang) for lang, _ in rows]))
    return network, languages


def _identified(network: BiGRU, languages: list[str]):
    schema = pa.schema([(ROW, pa.int64()), ("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("n_labelled", pa.int64())])

    def identify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        identifier = Identifier(network, languages)
        for batch in batches:
            for first, texts in blocks(batch):
                part, n = batch.slice(first, len(texts)), len(texts)
                names, scores, labelled = [UNKNOWN] * n, np.zeros(n), np.zeros(n, np.int64)
                if languages:
                    sums, labels = identifier.read(texts)
                    best = sums.argmax(axis=1)
                    letters = np.array([has_letter(t) for t in texts])
                    names = [languages[k] if known else UNKNOWN for k, known in zip(best, letters, strict=True)]
                    scores = np.where(letters, np.minimum(1.0, sums[np.arange(n), best] / np.maximum(1e-9, sums.sum(axis=1))), 0.0)
                    labelled = np.where(letters, labels[np.arange(n), best], 0)
                yield pa.RecordBatch.from_arrays(
                    [part[ROW], part["doc_id"], pa.array(names, pa.string()), pa.array(scores), pa.array(labelled)], schema=schema)
    return identify


def identify(docs: DataFrame, network: BiGRU, languages: list[str]) -> DataFrame:
    """One row per row of docs: __row, doc_id, lang_pred, score (0 to 1), n_labelled.

    The network reads every byte of a whole text, lower-cased, in windows that overlap, and labels every position; a
    document's score is the mean of its positions' probabilities, and n_labelled the number of its bytes labelled lang_pred.

    A text that is null, empty or without letters is `und` with score 0 and no labels, and so is everything when no
    language was learned. Of languages that are equally likely the first in order is named. Repeated rows get the same
    answer; an empty table gives no rows. Other columns are not read."""
    schema = f"{ROW} long, doc_id long, lang_pred string, score double, n_labelled long"
    return keyed(docs).mapInArrow(_identified(network, languages), schema)


def train_rows(docs: DataFrame) -> DataFrame:
    return docs.filter(fold(3) != 1)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = identify(docs, *learn(train_rows(docs)))
    return found.select("doc_id", (fold(3) == 1).alias("held_out"), "lang_pred", "score", "n_labelled")
