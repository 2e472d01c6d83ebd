"""Near copies that are not linked: what is counted, estimated and compared."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from care_measures.llm import common, near_dedup


def of_family(sets, labels=None, lower=None):
    n = np.array([len(s) for s in sets], np.int64)
    kept = near_dedup.registers(np.concatenate(sets), np.concatenate([[0], np.cumsum(n)]))
    return pa.table({
        common.ROW: np.arange(len(sets)), "component": np.arange(len(sets)) if labels is None else np.array(labels), "n": n,
        "lower": np.ones(len(sets), bool) if lower is None else np.array(lower),
        "registers": [r.tobytes() for r in kept], "shingles": [s.tobytes() for s in sets]})


def near_copies(n, changed, size=400, seed=3):
    """Sets that have all but some of a base each, at a similarity of about 0.75 for 30 of 400."""
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**63, size, dtype=np.uint64)
    return [np.sort(np.concatenate([rng.permutation(base)[changed:], rng.integers(0, 2**63, changed, dtype=np.uint64)])) for _ in range(n)]


def plus(hashes, more):
    return np.sort(np.concatenate([hashes, np.array(list(more), np.uint64)]))


@pytest.mark.parametrize("sparse", [1, 256, 10**9])
@pytest.mark.parametrize("pairs", [7, 1 << 21])
def test_common_against_set_operations(sparse, pairs, monkeypatch):
    monkeypatch.setattr(near_dedup, "SPARSE", sparse)
    monkeypatch.setattr(near_dedup, "PAIRS", pairs)
    rng = np.random.default_rng(5)
    left, right = ([np.unique(rng.integers(0, 300, rng.integers(0, 120), dtype=np.uint64)) for _ in range(k)] for k in (17, 11))
    left[4] = right[2] = np.zeros(0, np.uint64)
    assert near_dedup.common(left, right).tolist() == [[len({*a.tolist()} & {*b.tolist()}) for b in right] for a in left]


def test_only_linked_pairs_are_estimated(monkeypatch):
    sets = near_copies(200, 30)
    sets += [plus(sets[7][2:], [1, 2]), plus(sets[9][1:], [3])]
    done, real = [], near_dedup.similarity
    monkeypatch.setattr(near_dedup, "similarity", lambda a, b, *n: (done.append(len(a)), real(a, b, *n))[1])
    links = near_dedup._compared(85)(of_family(sets)).to_pylist()
    assert sorted((x["a"], x["b"]) for x in links) == [(7, 200), (9, 201)]
    assert sum(done) == 2


def test_links_between_blocks_connect_and_no_more():
    one, other = near_copies(1, 0)[0], near_copies(3, 30, seed=8)
    sets = [one, *(plus(one[k:], range(k)) for k in (1, 2, 3)), *other]
    table = of_family(sets, labels=[0, 0, 2, 3, 4, 5, 5], lower=[True, True, True, False, False, False, False])
    assert len(near_dedup._compared(85)(table).to_pylist()) == 2  # 3 to the component 0 and to 2
    assert near_dedup._compared(85)(of_family(sets, lower=[False] * 7)).num_rows == 0
    assert near_dedup._compared(85)(of_family(sets, labels=[1] * 7)).num_rows == 0


def test_much_used_shingles_make_no_family(spark, monkeypatch):
    """All shingles would fall into one place of a small table of counts, where the passage came before what is rare."""
    passage = np.arange(60, dtype=np.uint64)
    sets = [plus(passage, range(1000 * (i + 1), 1000 * (i + 1) + 150)) for i in range(40)]
    sets.append(plus(sets[5][:-2], [700, 701]))
    kept = of_family(sets).to_pylist()
    common._ship(spark.sparkContext.applicationId)
    apart = spark.createDataFrame([(r[common.ROW], r["component"]) for r in kept], f"{common.ROW} long, component long")
    full = spark.createDataFrame([(r[common.ROW], r["n"], bytearray(r["registers"]), bytearray(r["shingles"])) for r in kept], near_dedup.SETS)
    seen, real = {}, near_dedup.stored

    def stored(df, name):
        out = real(df, name)
        if name == "members":
            seen[name] = {r[0] for r in out.select(common.ROW).collect()}
        return out

    monkeypatch.setattr(near_dedup, "stored", stored)
    links = near_dedup.crossing(apart, full, 85).collect()
    assert seen["members"] == {5, 40}
    assert [(r["a"], r["b"]) for r in links] == [(5, 40)]


def test_rarest_shingles_decide(spark):
    """Linked sets share a shingle that the larger one has among its probed and the smaller one among its indexed."""
    rng = np.random.default_rng(11)
    bases = [rng.integers(0, 2**63, 60, dtype=np.uint64) for _ in range(12)]
    sets = [plus(rng.permutation(bases[i % 12])[rng.integers(0, 9):], rng.integers(0, 2**63, rng.integers(0, 5))) for i in range(120)]
    common._ship(spark.sparkContext.applicationId)
    own = spark.createDataFrame([(i, i, len(s), bytearray(s.tobytes())) for i, s in enumerate(sets)], f"{common.ROW} long, component long, n_shingles long, shingles binary")
    probed, indexed = ([set() for _ in sets] for _ in range(2))
    for r in near_dedup.rarest(own, 85).collect():
        probed[r[common.ROW]].add(r["shingle"])
        if r["indexed"]:
            indexed[r[common.ROW]].add(r["shingle"])
    linked = [(i, j) for i in range(120) for j in range(120) if i != j and len(sets[i]) >= len(sets[j]) and near_dedup._linked(sets[i], sets[j], 85)]
    assert len(linked) > 50 and all(probed[i] & indexed[j] for i, j in linked)
    assert all(len(p) <= len(s) - -(-85 * len(s) // 100) + 1 for p, s in zip(probed, sets))
