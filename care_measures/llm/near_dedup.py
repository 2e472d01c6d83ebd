"""Near-duplicate groups by SetSketch registers: banded, estimated jointly by likelihood, then verified on full sets."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from care_measures.llm.common import ROW, documents, done_with, keyed, numbered, stored, temporary
from care_measures.llm.words import LOWER, Words, blocks, forget, mix, separators

SHINGLE, PERCENT = 5, 85
#: At a similarity of 0.85 a pair shares no band with probability 7e-9.
BANDS, BAND_SIZE = 32, 5
REGISTERS = BANDS * BAND_SIZE
#: SetSketch parameters: base of the exponential spacing, rate, largest register.
BASE, RATE, LARGEST = 1.001, 20.0, 65535
#: Candidates whose estimate is further below the threshold than that are dropped: over six standard errors at 160 registers.
MARGIN = 0.2
#: Shingles and rows that are compared with as many others in one task.
BLOCK_SHINGLES, BLOCK_ROWS = 1 << 20, 2048
#: Shingles that leave a Python worker at once, and pairs that are listed or estimated at once.
SHINGLES, PAIRS = 1 << 19, 1 << 21
#: A shingle of so few pairs of rows that this many times them are fewer than all pairs is counted pair by pair.
SPARSE = 256
_GAPS = separators(b" \t\n\x0b\x0c\r")
_RNG = np.random.default_rng(85)
_FLIPS, _FACTORS = _RNG.integers(0, 2**63, REGISTERS, dtype=np.uint64), _RNG.integers(0, 2**62, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACES = _RNG.integers(0, 2**62, SHINGLE + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of all texts, one after the other, and where each text's begin.

    A shingle is five words in a row; a text of fewer words is one shingle."""
    words = Words(texts, LOWER, _GAPS)
    h, n = words.hashes, len(words.hashes)
    full = np.zeros(n, np.uint64)
    for j in range(SHINGLE):
        full[: n - j] += mix(h[j:] * _PLACES[j])
    full = mix(full)
    sets = []
    for a, b in zip(words.ranges[:-1], words.ranges[1:], strict=True):
        if b - a >= SHINGLE:
            s = np.sort(full[a: b - SHINGLE + 1])
            sets.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        elif b > a:
            sets.append(mix(mix(h[a:b] * _PLACES[: b - a]).sum(keepdims=True) + _PLACES[SHINGLE] * np.uint64(b - a)))
        else:
            sets.append(np.zeros(0, np.uint64))
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)
    return np.concatenate(sets) if sets else np.zeros(0, np.uint64), starts


def registers(flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """SetSketch registers of each set that is not empty (rows): exponential minima, spaced by powers of BASE and truncated."""
    least = np.empty((len(starts) - 1, REGISTERS), np.uint64)
    for j in range(REGISTERS):
        least[:, j] = np.minimum.reduceat((flat ^ _FLIPS[j]) * _FACTORS[j], starts[:-1])
    exponential = -np.log1p(-((least >> np.uint64(11)).astype(float) + 0.5) / 2.0**53) / RATE
    return np.clip(np.floor(1 - np.log(exponential) / np.log(BASE)), 0, LARGEST).astype(np.uint16)


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The registers of the union of two sets."""
    return np.maximum(a, b)


def similarity(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Most likely Jaccard similarity of each pair, given how many registers are greater, smaller and equal, and the sizes."""
    more, less = (a > b).sum(axis=1).astype(float), (a < b).sum(axis=1).astype(float)
    same = a.shape[1] - more - less
    u = n_a / (n_a + n_b)
    v = 1 - u
    p = lambda x: -np.log1p(-np.clip(x, 1e-12, 1) * (BASE - 1) / BASE) / np.log(BASE)
    best, at = np.full(len(u), -np.inf), np.zeros(len(u))
    for share in np.linspace(0, 1, 101):
        j = share * np.minimum(u / v, v / u)
        up, down = p(u - v * j), p(v - u * j)
        value = more * np.log(up) + less * np.log(down) + same * np.log(np.maximum(1e-12, 1 - up - down))
        at, best = np.where(value > best, j, at), np.maximum(value, best)
    return at


_SKETCH = pa.schema([(ROW, pa.int64()), ("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()), ("keys", pa.list_(pa.int64()))])
SKETCH = f"{ROW} long, doc_id long, n_shingles long, digest binary, keys array<long>"


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forget()
    for batch in batches:
        for first, texts in blocks(batch):
            part, (flat, starts) = batch.slice(first, len(texts)), shingle_sets(texts)
            sizes = np.diff(starts)
            some = np.flatnonzero(sizes)
            digests = [hashlib.blake2b(flat[a:b].tobytes(), digest_size=16).digest() if b > a else None for a, b in zip(starts[:-1], starts[1:], strict=True)]
            keys = [None] * len(texts)
            if len(some):
                own = registers(flat, np.append(starts[:-1][some], len(flat)))
                spread = mix(own.reshape(len(some), BANDS, BAND_SIZE).astype(np.uint64) * _PLACES[:BAND_SIZE] + np.arange(1, BAND_SIZE + 1, dtype=np.uint64))
                bands = mix(spread.sum(axis=2)).view(np.int64)
                for k, i in enumerate(some):
                    keys[i] = bands[k]
            yield pa.RecordBatch.from_arrays(
                [part[ROW], part["doc_id"], pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], schema=_SKETCH)


_SETS = pa.schema([(ROW, pa.int64()), ("n_shingles", pa.int64()), ("registers", pa.binary()), ("shingles", pa.binary())])
SETS = f"{ROW} long, n_shingles long, registers binary, shingles binary"


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sets of texts that have one, and their registers."""
    for batch in batches:
        for first, texts in blocks(batch):
            flat, starts = shingle_sets(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.slice(first, len(texts))[ROW], pa.array(np.diff(starts), pa.int64()), pa.array([r.tobytes() for r in registers(flat, starts)], pa.binary()),
                 pa.array([flat[a:b].tobytes() for a, b in zip(starts[:-1], starts[1:], strict=True)], pa.binary())], schema=_SETS)


def _array(column: pa.Array, dtype) -> list[np.ndarray]:
    return [np.frombuffer(x, dtype) for x in column.to_pylist()]


def _estimated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            a, b = (np.stack(_array(batch[c], np.uint16)) for c in ("ra", "rb"))
            estimate = similarity(a, b, batch["na"].to_numpy().astype(float), batch["nb"].to_numpy().astype(float))
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"], pa.array(estimate)], ["a", "b", "estimate"])


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = np.sort(np.concatenate([x, y]))
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(both) - common)


def _verified(percent: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [_linked(x, y, percent) for x, y in zip(_array(batch["sa"], np.uint64), _array(batch["sb"], np.uint64), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return verify


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each shingle of each set."""
    for batch in batches:
        sets, row, component = _array(batch["shingles"], np.uint64), batch[ROW].to_numpy(), batch["component"].to_numpy()
        sizes = np.array([len(s) for s in sets], np.int64)
        for at in np.split(np.arange(len(sets)), np.flatnonzero(np.diff(np.cumsum(sizes) // SHINGLES)) + 1):
            if len(at):
                shingle = np.concatenate(sets[at[0]: at[-1] + 1]).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (np.repeat(row[at], sizes[at]), np.repeat(component[at], sizes[at]), shingle)], [ROW, "component", "shingle"])


def rarest(own: DataFrame, percent: int) -> DataFrame:
    """(__row, component, shingle, indexed): the rarest shingles of each set, as many as decide, without those of one component only.

    Two sets that are linked share one of the larger set's first n - ceil(t n) + 1 and of the smaller set's first
    n - ceil(2 t / (1 + t) n) + 1, in any order that all sets have in common. Here what one component has alone comes first, and
    then what fewer sets have. Shingles are counted one by one, so what is rare stays so however many there are."""
    of_shingle, of_row = Window.partitionBy("shingle"), Window.partitionBy(ROW)
    every = own.mapInArrow(_shingles, f"{ROW} long, component long, shingle long")
    for name, value in (("used", F.count("*")), ("low", F.min("component")), ("high", F.max("component"))):
        every = every.withColumn(name, value.over(of_shingle))
    met = every.filter("low != high").drop("low", "high").withColumn("met", F.count("*").over(of_row))
    met = met.withColumn("nth", F.row_number().over(of_row.orderBy("used", "shingle")))
    met = met.join(own.select(ROW, "n_shingles"), ROW).withColumn("nth", F.expr("n_shingles - met + nth"))
    upto = lambda share, whole: F.expr(f"n_shingles - (n_shingles * {share} + {whole - 1}) div {whole} + 1")
    return met.filter(F.col("nth") <= upto(percent, 100)).select(
        ROW, "component", "shingle", (F.col("nth") <= upto(2 * percent, 100 + percent)).alias("indexed"))


LINKS = "a long, b long"


def common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many members each of the left sets (rows) has in common with each of the right ones (columns)."""
    sides = []
    for sets in (left, right):
        flat, of = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        order = np.argsort(flat)
        flat, of = flat[order], of[order]
        starts = np.flatnonzero(np.concatenate([np.ones(min(1, len(flat)), bool), flat[1:] != flat[:-1]]))
        sides.append((flat[starts], of, starts, np.diff(np.append(starts, len(flat)))))
    (a, of_a, starts_a, n_a), (b, of_b, starts_b, n_b) = sides
    counts = np.zeros((len(left), len(right)), np.int32)
    at = np.searchsorted(b, a)
    there = np.flatnonzero(at < len(b))
    there = there[b[at[there]] == a[there]]
    starts_a, n_a, starts_b, n_b = starts_a[there], n_a[there], starts_b[at[there]], n_b[at[there]]
    pairs = n_a * n_b
    often = pairs * SPARSE >= counts.size

    def held(sets: int, of: np.ndarray, starts: np.ndarray, n: np.ndarray) -> np.ndarray:
        table, column = np.zeros((sets, len(n)), np.float32), np.repeat(np.arange(len(n)), n)
        table[of[np.arange(n.sum()) + np.repeat(starts - (np.cumsum(n) - n), n)], column] = 1
        return table

    heavy = np.flatnonzero(often)
    for k in range(0, len(heavy), 1024):
        some = heavy[k: k + 1024]
        counts += (held(len(left), of_a, starts_a[some], n_a[some]) @ held(len(right), of_b, starts_b[some], n_b[some]).T).astype(np.int32)
    light = np.flatnonzero(~often)
    for some in np.split(light, np.flatnonzero(np.diff(np.cumsum(pairs[light]) // PAIRS)) + 1):
        if len(some):
            many, column = pairs[some], np.repeat(some, pairs[some])
            i, j = np.divmod(np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many), n_b[column])
            np.add.at(counts.reshape(-1), of_a[starts_a[column] + i] * len(right) + of_b[starts_b[column] + j], 1)
    return counts


def _compared(percent: int):
    """Links between the texts of two blocks (or inside one), all of different components before; no more than connect them.

    Links need both enough common shingles and the estimate of their registers. Shingles are counted for all pairs of the blocks
    at once, which takes far less time a pair than the estimate, and so comes first."""
    def compare(table: pa.Table) -> pa.Table:
        row, label, n = (table[c].to_numpy() for c in (ROW, "component", "n"))
        lower = table["lower"].to_numpy(zero_copy_only=False)
        left, right = np.flatnonzero(lower), np.flatnonzero(~lower)
        found, label = [], label.copy()
        if len(left) and (label != label[0]).any():
            registers = np.stack(_array(table["registers"], np.uint16))
            sets = _array(table["shingles"], np.uint64)
            inside = not len(right)
            right = left if inside else right
            both = common([sets[i] for i in left], [sets[j] for j in right])
            linked = (100 + percent) * both.astype(np.int64) >= percent * (n[left][:, None] + n[right])
            linked &= label[left][:, None] != label[right]
            one, other = np.nonzero(np.triu(linked) if inside else linked)
            one, other = left[one], right[other]
            for at in range(0, len(one), PAIRS // REGISTERS):
                i, j = one[at: at + PAIRS // REGISTERS], other[at: at + PAIRS // REGISTERS]
                still = label[i] != label[j]
                i, j = i[still], j[still]
                estimate = similarity(registers[i], registers[j], n[i].astype(float), n[j].astype(float))
                near = np.flatnonzero(estimate >= percent / 100 - MARGIN)
                for k in near[np.lexsort((j[near], i[near], -estimate[near]))]:
                    if label[i[k]] != label[j[k]] and _linked(sets[i[k]], sets[j[k]], percent):
                        label[label == label[i[k]]] = label[j[k]]
                        found.append((min(row[i[k]], row[j[k]]), max(row[i[k]], row[j[k]])))
        return pa.table({"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())})
    return compare


def crossing(apart: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): links that connect all rows of apart (__row, component) that are linked but in different components.

    Linked sets share a rare shingle; what rare shingles connect is a family, so sets that have only much-used lines and
    passages in common never meet. In a family, sets are told apart by size into classes (linked sizes are in one class or
    the next) and classes into blocks of about BLOCK_SHINGLES, and each pair of blocks is compared in a task of its own that
    returns links only."""
    own = stored(apart.join(sets, ROW), "apart-sets")
    rare = stored(rarest(own, percent), "prefixes")
    met = rare.groupBy("shingle").agg(F.min(ROW).alias("first"), F.min("component").alias("low"), F.max("component").alias("high"), F.bool_or("indexed").alias("indexed"))
    met = stored(met.filter("low != high AND indexed").select("shingle", "first"), "met")
    family = components(rare.join(met, "shingle").select(F.col("first").alias("a"), F.col(ROW).alias("b")).filter("a != b").distinct())
    size_class = F.floor(F.log("n_shingles") / float(np.log(100 / percent))).cast("int")
    members = own.join(family.select(F.col("node").alias(ROW), F.col("component").alias("family")), ROW).withColumn("size_class", size_class)
    members = stored(members.select(ROW, "component", "family", "size_class", F.col("n_shingles").alias("n"), "registers", "shingles"), "members")
    done_with(own, rare, met)
    parts = stored(members.groupBy("family", "size_class").agg(F.ceil(F.greatest(F.count("*") / BLOCK_ROWS, F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("parts")), "parts")
    beside = lambda step: parts.select("family", (F.col("size_class") + step).alias("size_class"), F.col("parts").alias("above" if step < 0 else "below"))
    parts = parts.join(beside(-1), ["family", "size_class"], "left").join(beside(1), ["family", "size_class"], "left").fillna(0, ["above", "below"])
    placed = members.join(parts, ["family", "size_class"]).withColumn("part", F.pmod(F.xxhash64(ROW), F.col("parts")).cast("int"))
    pair = lambda c, i, up, j, low: F.struct(c.alias("size_class"), i.alias("i"), F.lit(up).alias("up"), j.alias("j"), low.alias("lower"))
    c, part, many = F.col("size_class"), F.col("part"), lambda n: F.sequence(F.lit(1), F.col(n))
    same = F.transform(many("parts"), lambda k: pair(c, F.least(part, k - 1), 0, F.greatest(part, k - 1), part <= k - 1))
    upward = F.when(F.col("above") > 0, F.transform(many("above"), lambda k: pair(c, part, 1, k - 1, F.lit(True))))
    downward = F.when(F.col("below") > 0, F.transform(many("below"), lambda k: pair(c - 1, k - 1, 1, part, F.lit(False))))
    empty = F.slice(same, 1, 0)
    spread = placed.withColumn("pair", F.explode(F.concat(same, F.coalesce(upward, empty), F.coalesce(downward, empty))))
    compared = spread.select("family", "pair.size_class", "pair.i", "pair.up", "pair.j", "pair.lower", ROW, "component", "n", "registers", "shingles")
    links = _compared(percent)
    return compared.groupBy("family", "size_class", "i", "up", "j").applyInArrow(lambda table: links(table), LINKS)


def components(links: DataFrame) -> DataFrame:
    """(node, component): the least node that each node of the links (a, b) reaches.

    Each round takes the least label around a node and then the label of that label, so rounds grow as the logarithm of a
    chain. Nothing but the number of changes reaches the driver; a node with very many links is reduced before the shuffle."""
    both = stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("component")), "labels")
    while True:
        around = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        nearer = labels.join(around, "node").select("node", "component", F.least("component", "near").alias("near"))
        nearer = stored(nearer, "labels")
        target = labels.select(F.col("node").alias("near"), F.col("component").alias("further"))
        jumped = nearer.join(target, "near", "left").select("node", "component", F.least("near", F.coalesce("further", "near")).alias("new"))
        jumped = stored(jumped, "labels")
        if jumped.filter("new != component").isEmpty():
            return labels
        labels = jumped.select("node", F.col("new").alias("component"))


def near_dedup(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per row of docs: __row, doc_id, n_shingles, component_id, kept.

    Documents whose sets of five-word shingles have 100 * intersection >= percent * union are linked; a component is
    what links reach, named by its smallest doc_id, and one row of it is kept. Documents with equal sets are one class, which
    is sketched and compared once. In each bucket of a band every class is compared with the first one; afterwards
    classes of a bucket that are still in different components are compared with each other if they share a rare shingle, as all
    linked ones do. So no link between components is lost, and neither the pairs inside a large group of copies nor those that
    share much-used passages only are formed. Pairs with the first one pass the likelihood estimate of their registers before
    full sets are fetched; those of a family have their common shingles counted first. Every link passes the estimate and is
    confirmed on full sets.

    A null text is an empty one; texts without words have no shingles and are linked with nothing. A null doc_id counts as the
    largest; of rows with equal doc_id the first one read is kept. Repeated rows are one class. An empty table gives
    no rows; other columns are not read."""
    with temporary() as keep:
        docs = numbered(docs)
        rows = keyed(docs)
        sketches = stored(rows.mapInArrow(_sketches, SKETCH), "sketches")
        # what is wide, keys and texts, is shuffled once at most, and deleted before the next step stores sets
        classes = sketches.filter("n_shingles > 0").groupBy("digest").agg(F.min(F.struct(ROW, "keys")).alias("first"))
        classes = stored(classes.select("digest", F.col(f"first.{ROW}").alias("class"), "first.keys"), "classes")
        named = sketches.select(ROW, "doc_id", "n_shingles", "digest").join(classes.select("digest", "class"), "digest", "left")
        named = stored(named.select(ROW, "doc_id", "n_shingles", F.coalesce("class", ROW).alias("class")), "classed")
        done_with(sketches)
        bands = classes.select(F.col("class").alias(ROW), F.posexplode("keys").alias("band", "key"))
        shared = stored(bands.groupBy("band", "key").agg(F.count("*").alias("n"), F.min(ROW).alias("first")).filter("n > 1").drop("n"), "buckets")
        crowded = stored(bands.join(shared, ["band", "key"]), "crowded")
        done_with(classes, shared)
        busy = stored(crowded.select(ROW).distinct(), "busy")
        sets = stored(rows.join(busy, ROW, "left_semi").mapInArrow(_sets, SETS), "sets")
        done_with(docs, busy)
        sketched = sets.select(ROW, "n_shingles", "registers")
        least = percent / 100 - MARGIN

        def estimated(pairs: DataFrame) -> DataFrame:
            side = lambda s: sketched.select(F.col(ROW).alias(s), F.col("n_shingles").alias(f"n{s}"), F.col("registers").alias(f"r{s}"))
            return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(_estimated, "a long, b long, estimate double").filter(F.col("estimate") >= least)

        def verified(pairs: DataFrame) -> DataFrame:
            side = lambda s: sets.select(F.col(ROW).alias(s), F.col("shingles").alias(f"s{s}"))
            return stored(pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b").mapInArrow(_verified(percent), "a long, b long"), "verified")

        star = crowded.filter(F.col(ROW) != F.col("first")).select(F.col("first").alias("a"), F.col(ROW).alias("b")).distinct()
        best = stored(estimated(star).groupBy("b").agg(F.max(F.struct("estimate", "a")).alias("best")).select("best.a", "b"), "best")
        links = verified(best)
        found = components(links)
        placed = crowded.drop("first").join(found.withColumnRenamed("node", ROW), ROW, "left").withColumn("component", F.coalesce("component", ROW))
        placed = stored(placed, "placed")
        split = stored(placed.groupBy("band", "key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low != high").select("band", "key"), "split")
        apart = stored(placed.join(split, ["band", "key"]).select(ROW, "component").distinct(), "apart")
        more = stored(crossing(apart, sets, percent), "across")
        if not more.isEmpty():
            found = components(links.unionByName(more))
        named = stored(named.join(found.withColumnRenamed("node", "class"), "class", "left").select(ROW, "doc_id", "n_shingles", F.coalesce("component", "class").alias("component")), "named")
        chosen = stored(named.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", ROW)).alias("first")), "chosen")
        keep(named, chosen)
    return named.join(chosen, "component").select(ROW, "doc_id", "n_shingles", F.col("first.doc_id").alias("component_id"), (F.col(ROW) == F.col(f"first.{ROW}")).alias("kept"))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(documents(spark, sf_dir)).drop(ROW)
