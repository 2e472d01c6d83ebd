"""Language-model scores: context-tree weighting over bytes, learned from counts of the whole training corpus.

A gram is DEPTH bytes of context and the byte after them, as an integer whose highest byte is the nearest byte of context and whose
lowest is the next byte, so that grams in order stand as the context tree's nodes do: whoever has a context's grams has its subtree."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from care_measures.llm.common import ROW, documents, fold, keyed, stored, temporary
from care_measures.llm.words import LOWER, HashTable, Words, blocks, distinct, mix, separators

#: Bytes of context at most; the depth whose nodes are mixed on the driver: 65,536 contexts of 255 decisions at the very most.
DEPTH, UPPER = 5, 2
#: Bytes of text scored together, and grams that a task works on at once (more where one node just below UPPER has more).
TOGETHER, CHUNK = 32_000_000, 100_000
#: Begins and ends every text; no byte of UTF-8.
EDGE = 255
_GAPS = separators(b" \t\n\x0b\x0c\r")


def _edged(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts one after the other, each after DEPTH edges and before one, and the starts of their first bytes."""
    pad = bytes([EDGE]) * DEPTH
    array = np.frombuffer(pad + b"".join(t + pad for t in texts), np.uint8)
    return array, DEPTH + np.concatenate([[0], np.cumsum([len(t) + DEPTH for t in texts])]).astype(np.int64)


def _places(starts: np.ndarray) -> np.ndarray:
    """Places of all bytes that are predicted: those of each text and one edge after it."""
    sizes = np.diff(starts) - DEPTH + 1
    return np.repeat(starts[:-1] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())


def grams_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The grams of all bytes and ends of the texts, and how many each text has."""
    array, starts = _edged(texts)
    wide = array.astype(np.int64)
    grams = wide[DEPTH:].copy()
    for j in range(1, DEPTH + 1):
        grams |= wide[DEPTH - j: len(wide) - j] << (8 * (DEPTH + 1 - j))
    return grams[_places(starts) - DEPTH], np.diff(starts) - DEPTH + 1


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
    keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return [(keys, np.bincount(at, np.concatenate([n for _, n in parts]), len(keys)).astype(np.int64))]


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each gram stands in the training texts of a task; those of other texts alone are there with 0."""
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        trained = batch["trained"].to_numpy(zero_copy_only=False).astype(np.int64)
        for first, texts in blocks(batch):
            grams, sizes = grams_of(texts)
            both, n = np.unique(grams << 1 | np.repeat(trained[first: first + len(texts)], sizes), return_counts=True)
            parts.append((both >> 1, n * (both & 1)))
            if len(parts) > 1 and sum(len(k) for k, _ in parts) > 4 * max(len(parts[0][0]), 250_000):
                parts = _merged(parts)
    if parts:
        keys, n = _merged(parts)[0]
        for at in range(0, len(keys), CHUNK):
            yield pa.RecordBatch.from_arrays([pa.array(keys[at: at + CHUNK]), pa.array(n[at: at + CHUNK])], ["gram", "n"])


def _runs_of_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The batches, cut where the block changes."""
    for batch in batches:
        own = batch["block"].to_numpy()
        cuts = [0, *(np.flatnonzero(own[1:] != own[:-1]) + 1), len(own)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b > a:
                yield int(own[a]), batch.slice(a, b - a)


def _block_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct grams of each block of documents."""
    block, parts = None, []

    def done():
        keys = distinct(np.concatenate(parts))
        for at in range(0, len(keys), CHUNK):
            some = keys[at: at + CHUNK]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), block, np.int64)), pa.array(some)], ["block", "gram"])

    for own, batch in _runs_of_blocks(batches):
        if own != block:
            if parts:
                yield from done()
            block, parts = own, []
        parts += [distinct(grams_of(texts)[0]) for _, texts in blocks(batch)]
        if sum(map(len, parts)) > 4 * max(len(parts[0]), 250_000):
            parts = [distinct(np.concatenate(parts))]
    if parts:
        yield from done()


def _blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows with the number of their block: rows of a task that stand together, of about TOGETHER bytes; its first row names it."""
    block, size = None, 0
    for batch in batches:
        of = []
        for row, length in zip(batch[ROW].to_pylist(), pc.binary_length(batch["text"]).to_pylist(), strict=True):
            if block is None or size >= TOGETHER:
                block, size = row, 0
            size += length
            of.append(block)
        yield pa.RecordBatch.from_arrays([batch[ROW], batch["doc_id"], batch["text"], pa.array(of, pa.int64())], [ROW, "doc_id", "text", "block"])


def _block_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct words of each block of documents and how often its training texts hold them."""
    block, table, counts = None, HashTable(18), np.zeros(0, np.int64)

    def done():
        for at in range(0, table.size, CHUNK):
            keys = table.keys[at: min(at + CHUNK, table.size)]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), block, np.int64)), pa.array(keys.view(np.int64)), pa.array(counts[at: at + len(keys)])], ["block", "word", "n"])

    for own, batch in _runs_of_blocks(batches):
        if own != block:
            if block is not None:
                yield from done()
            block, table, counts = own, HashTable(18), np.zeros(0, np.int64)
        trained = batch["trained"].to_numpy(zero_copy_only=False).astype(np.int64)
        for first, texts in blocks(batch):
            words = Words(texts, LOWER, _GAPS)
            keys, inverse = np.unique(words.hashes, return_inverse=True)
            n = np.bincount(inverse, np.repeat(trained[first: first + len(texts)], words.counts()), len(keys)).astype(np.int64)
            new = table.find(keys) < 0
            table.add(keys[new])
            counts = np.concatenate([counts, np.zeros(int(new.sum()), np.int64)])
            counts[table.find(keys)] += n
    if block is not None:
        yield from done()


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for x > 0, by Stirling's series eight steps higher."""
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    product = x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5) * (x + 6) * (x + 7)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - np.log(product)


def _estimates(total: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Krichevsky-Trofimov: log probability of the decisions seen, and probability of a one next."""
    log = log_gamma(total - ones + 0.5) + log_gamma(ones + 0.5) - log_gamma(total + 1.0) - np.log(np.pi)
    return log, (ones + 0.5) / (total + 1)


class _Level:
    """The nodes of one depth: `codes` (context and next byte) in order, their counts, and the code of each gram."""

    def __init__(self, grams: np.ndarray, n: np.ndarray, depth: int):
        node = grams >> (8 * (DEPTH + 1 - depth))
        self.codes, self.of = np.unique(node << 8 | grams & 255, return_inverse=True)
        self.n = np.bincount(self.of, n, len(self.codes))

    def decisions(self, bit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For decision number `bit` of a byte: context and bits before it, how often met, how often a one, and the place of each gram."""
        keys = self.codes >> (8 - bit)
        new = np.concatenate([[True], keys[1:] != keys[:-1]])
        first = np.flatnonzero(new)
        total, ones = np.add.reduceat(self.n, first), np.add.reduceat(self.n * (self.codes >> (7 - bit) & 1), first)
        return keys[first], total, ones, (np.cumsum(new) - 1)[self.of]


def _weights(log_own: np.ndarray, log_children: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What a node's own estimate weighs against its children's, and the log of their mixture with equal prior weights."""
    both = np.logaddexp(log_own, log_children)
    return np.exp(log_own - both), both - np.log(2)


def subtrees(grams: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
    """Mixes the subtrees below depth UPPER, whose grams (sorted) and counts are given whole.

    First, for each gram and bit of its next byte, the probability of that bit in its subtree; -1 where the subtree has not
    met that decision in training. Second, for each decision at depth UPPER: code, how often met, how often a one, and the sum of
    its children's log mixtures. A context never met predicts as the one it extends."""
    levels = {d: _Level(grams, n, d) for d in range(DEPTH, UPPER - 1, -1)}
    bits, upper = np.empty((len(grams), 8)), []
    for bit in range(8):
        actual, p, met, mixed, below = (grams >> (7 - bit) & 1).astype(bool), None, None, None, None
        for d in range(DEPTH, UPPER - 1, -1):
            keys, total, ones, of = levels[d].decisions(bit)
            if p is not None:
                parent = (below >> (bit + 8)) << bit | below & ((1 << bit) - 1)
                children = np.bincount(np.searchsorted(keys, parent), mixed, len(keys))
            if d == UPPER:
                upper.append(((keys >> bit) << 8 | 1 << bit | keys & ((1 << bit) - 1), total, ones, children))
                break
            log_own, own = _estimates(total, ones)
            own = np.where(actual, own[of], 1 - own[of])
            if p is None:
                p, mixed = own, log_own
            else:
                keep, mixed = _weights(log_own, children)
                keep = keep[of]
                p = np.where(met, keep * own + (1 - keep) * p, own)
            met, below = total[of] > 0, keys
        bits[:, bit] = np.where(met, p, -1)
    return bits, tuple(np.concatenate(part) for part in zip(*upper, strict=True))


def _whole_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted grams and counts in chunks that end where a node just below UPPER does."""
    grams, counts, held, enough = [], [], 0, CHUNK
    for batch in batches:
        grams.append(batch["gram"].to_numpy()), counts.append(batch["n"].to_numpy())
        held += batch.num_rows
        if held >= enough:
            g, n = np.concatenate(grams), np.concatenate(counts)
            node = g >> (8 * (DEPTH - UPPER))
            cut = int(np.searchsorted(node, node[-1]))
            if cut:
                yield g[:cut], n[:cut]
            grams, counts, held = [g[cut:]], [n[cut:]], len(g) - cut
            enough = max(CHUNK, 2 * held)
    if held:
        yield np.concatenate(grams), np.concatenate(counts)


_MIXED = pa.schema([("gram", pa.int64()), ("bits", pa.binary()), ("code", pa.int64()), ("total", pa.int64()), ("ones", pa.int64()), ("below", pa.float64())])


def _mixed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of grams (gram, bits) and rows of decisions at depth UPPER (code, total, ones, below)."""
    for grams, n in _whole_nodes(batches):
        bits, (code, total, ones, below) = subtrees(grams, n)
        data = pa.py_buffer(bits.astype(np.float32).tobytes())
        packed = pa.Array.from_buffers(pa.binary(), len(grams), [None, pa.py_buffer(np.arange(0, 32 * len(grams) + 1, 32, dtype=np.int32).tobytes()), data])
        nothing = lambda size, kind: pa.nulls(size, kind)
        k = len(grams)
        yield pa.RecordBatch.from_arrays([pa.array(grams), packed, *[nothing(k, f.type) for f in list(_MIXED)[2:]]], schema=_MIXED)
        k = len(code)
        yield pa.RecordBatch.from_arrays(
            [nothing(k, pa.int64()), nothing(k, pa.binary()), pa.array(code), pa.array(total.astype(np.int64)), pa.array(ones.astype(np.int64)), pa.array(below)], schema=_MIXED)


class UpperTree:
    """The nodes down to depth UPPER, for all decisions there: the probability of either bit is `fixed` + `share` * what the
    subtree says, or `alone` where the subtree has not met the decision."""

    def __init__(self, code: np.ndarray, total: np.ndarray, ones: np.ndarray, below: np.ndarray):
        order = np.argsort(code)
        self.code = code[order]
        total, ones, mixed = total[order].astype(float), ones[order].astype(float), below[order]
        node, place = self.code, np.arange(len(code))
        self.fixed, self.alone, self.share = [0.0, 0.0], [0.5, 0.5], 1.0
        met_below = None
        for depth in range(UPPER, -1, -1):
            if depth < UPPER:
                parent = (node >> 16) << 8 | node & 255
                node, up = np.unique(parent, return_inverse=True)
                total, ones, mixed = (np.bincount(up, x, len(node)) for x in (total, ones, mixed))
                place = up[place]
            log_own, own = _estimates(total, ones)
            keep, mixed = _weights(log_own, mixed)
            k, met = keep[place], met_below
            for bit in (0, 1):
                p = (own if bit else 1 - own)[place]
                if met is None:
                    self.fixed[bit], self.alone[bit] = k * p, p
                else:
                    self.fixed[bit] = np.where(met, k * p + (1 - k) * self.fixed[bit], p)
                    self.alone[bit] = np.where(met, k * p + (1 - k) * self.alone[bit], p)
            self.share = (1 - k) if met is None else np.where(met, (1 - k) * self.share, 0.0)
            met_below = total[place] > 0

    def logs(self, grams: np.ndarray, bits: np.ndarray) -> np.ndarray:
        """log10 of the probability of each gram's next byte after its context."""
        out, node = np.zeros(len(grams)), grams >> (8 * (DEPTH + 1 - UPPER)) << 8
        for bit in range(8):
            at = np.searchsorted(self.code, node | 1 << bit | (grams & 255) >> (8 - bit))
            one, below = (grams >> (7 - bit) & 1).astype(bool), bits[:, bit]
            fixed, alone = (np.where(one, x[1][at], x[0][at]) for x in (self.fixed, self.alone))
            out += np.log10(np.where(below >= 0, fixed + self.share[at] * below, alone))
        return out


def learn_tree(rows: DataFrame) -> DataFrame:
    """(gram, log): for every gram of rows (text, trained), log10 of the probability of its byte under a tree of all contexts
    of up to DEPTH bytes, learned from the rows that are trained on.

    Counts are gathered by Spark; a task mixes whole subtrees below depth UPPER. The driver gets only the decisions at that
    depth, whose number the depth bounds, and sends back what they say."""
    with temporary() as keep:
        counted = rows.select("trained", "text").mapInArrow(_grams, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
        below = F.shiftright("gram", 8 * (DEPTH - UPPER))
        mixed = stored(counted.repartition(below).sortWithinPartitions("gram").mapInArrow(
            _mixed, "gram long, bits binary, code long, total long, ones long, below double"), "subtrees")
        top = mixed.filter("code IS NOT NULL").groupBy("code").agg(*[F.sum(c).alias(c) for c in ("total", "ones", "below")]).toPandas()
        tree = rows.sparkSession.sparkContext.broadcast(UpperTree(*[top[c].to_numpy() for c in ("code", "total", "ones", "below")]))

        def logs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bits = np.frombuffer(b"".join(batch["bits"].to_pylist()), np.float32).reshape(-1, 8).astype(float)
                yield pa.RecordBatch.from_arrays([batch["gram"], pa.array(tree.value.logs(batch["gram"].to_numpy(), bits).astype(np.float32))], ["gram", "log"])

        out = stored(mixed.filter("gram IS NOT NULL").select("gram", "bits").mapInArrow(logs, "gram long, log float"), "gram-logs")
        keep(out)
    return out


#: Rows of a task that are sent back to the blocks together.
PACK = 1_000_000


def _packed(key: str, value: str, kind: type):
    """Rows (block, key, value) as one row for each block and up to PACK rows of a task: (block, gram, keys, values), bytes of both."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def done() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held)
            block = rows["block"].to_numpy()
            order = np.argsort(block, kind="stable")
            block, keys, values = block[order], rows[key].to_numpy()[order].astype(np.int64), rows[value].to_numpy()[order].astype(kind)
            starts = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
            cuts = np.append(starts, len(block))
            as_bytes = lambda x: pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer((cuts * x.itemsize).astype(np.int32).tobytes()), pa.py_buffer(x.tobytes())])
            return pa.RecordBatch.from_arrays([pa.array(block[starts]), pa.array(np.full(len(starts), key == "gram")), as_bytes(keys), as_bytes(values)], ["block", "gram", "keys", "values"])

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(b.num_rows for b in held) >= PACK:
                yield done()
                held = []
        if held:
            yield done()
    return pack


PACKED = "block long, gram boolean, keys binary, values binary"
OUT_SCHEMA = pa.schema([(ROW, pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()),
                        ("score", pa.float64()), ("bits_per_byte", pa.float64())])
OUT = f"{ROW} long, doc_id long, n_tokens long, n_known long, base_score double, score double, bits_per_byte double"


def score(docs: DataFrame, is_training) -> DataFrame:
    """One row per row of docs: __row, doc_id, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    score is the log10 probability of a whole text and its end under context-tree weighting, learned from all rows
    for which is_training holds, with a node for every context of up to DEPTH bytes that the corpus has; bits_per_byte is the
    code length that it gives, the end counted as a byte. base_score is that of a text's words and an end under add-one word frequencies.
    Words and grams are counted over the whole corpus, and what was found comes back to each block of documents, so no task holds
    the vocabulary or the tree.

    A null text is an empty one: an end alone. Repeated rows count as often as they stand there. Without training rows all
    words are unknown and the tree predicts evenly. An empty table gives no rows; other columns are not read."""
    rows = stored(keyed(docs).mapInArrow(_blocked, f"{ROW} long, doc_id long, text string, block long"), "blocks").withColumn("trained", is_training)
    logs = learn_tree(rows)
    words, own = rows.select("block", "trained", "text").mapInArrow(_block_words, "block long, word long, n long"), Window.partitionBy("word")
    # a word comes once from each block, so one shuffle counts it and brings the count to its blocks
    with temporary() as keep:
        known = stored(words.select("block", "word", F.sum("n").over(own).alias("count"), F.row_number().over(own.orderBy("block")).alias("k")).filter("count > 0"), "known-words")
        keep(known)
    tokens, types = (int(x or 0) for x in known.filter("k = 1").agg(F.sum("count"), F.count("*")).first())
    ends = rows.filter("trained").count()
    tokens, types = tokens + ends, types + (ends > 0)
    least = float(np.log10(tokens + types + 1))

    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        found, out = {}, []
        for gram, kind in ((False, np.int64), (True, np.float32)):
            rows = right.filter(pc.equal(right["gram"], gram))
            keys, values = (np.frombuffer(b"".join(rows[c].to_pylist()), of) for c, of in (("keys", np.uint64), ("values", kind)))
            table = HashTable(18)
            table.add(mix(keys) if gram else keys)
            found[gram] = table, np.append(values.astype(float), 0.0)
        (table, counts), (grams, logs) = found[False], found[True]
        counts = np.log10(counts + 1)
        for batch in left.to_batches():
            for first, texts in blocks(batch):
                part, places = batch.slice(first, len(texts)), Words(texts, LOWER, _GAPS)
                number = table.find(places.hashes)
                base = np.diff(np.concatenate([[0], np.cumsum(counts[number])])[places.ranges])
                hits = np.diff(np.concatenate([[0], np.cumsum(number >= 0)])[places.ranges])
                n = places.counts() + 1
                keys, sizes = grams_of(texts)
                sums = np.concatenate([[0], np.cumsum(logs[grams.find(mix(keys.view(np.uint64)))])])
                log = np.diff(sums[np.concatenate([[0], np.cumsum(sizes)])])
                out.append(pa.table({
                    ROW: part[ROW], "doc_id": part["doc_id"], "n_tokens": pa.array(n, pa.int64()), "n_known": pa.array(hits + (ends > 0), pa.int64()),
                    "base_score": pa.array(base + np.log10(ends + 1) - n * least), "score": pa.array(log), "bits_per_byte": pa.array(-log / np.log10(2) / sizes)}))
        return pa.concat_tables(out) if out else OUT_SCHEMA.empty_table()

    block_grams = rows.select("block", "text").mapInArrow(_block_grams, "block long, gram long").join(logs, "gram")
    found = known.select("block", "word", "count").mapInArrow(_packed("word", "count", np.int64), PACKED).unionByName(
        block_grams.select("block", "gram", "log").mapInArrow(_packed("gram", "log", np.float32), PACKED))
    scores = rows.select(ROW, "doc_id", "text", "block").groupBy("block").cogroup(found.groupBy("block")).applyInArrow(scored, OUT)
    return scores.withColumn("train_tokens", F.lit(tokens).cast("long"))


def op4_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score(documents(spark, sf_dir), fold(7) != 2)
    return scored.select("doc_id", (fold(7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")
