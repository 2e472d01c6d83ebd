"""Each operator against a brute-force version, an exact round trip or held-out accuracy, and its edge cases."""

from __future__ import annotations

import functools
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from care_measures.llm import (
    common, decontamination, exact_dedup, language_id, language_model, near_dedup, packing, sharding, suffix_dedup, token_counts, tokenizing, toxicity, words,
)

WORDS = re.compile("[^\x20\x09-\x0D]+")
ITEM_WORDS = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def lower(text: str) -> str:
    return text.translate({c: c + 32 for c in range(65, 91)})


def pairs_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=lambda t: tuple((x is None, x) for x in t))


# exact dedup

def expected_groups(texts):
    by = defaultdict(list)
    for i, t, *_ in texts:
        by[t or ""].append(i)
    return sorted((len(by[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()) for _, t, *_ in texts)


@pytest.mark.parametrize("hashes", [None, 3])
def test_exact_dedup_groups_equal_texts_whatever_the_hash(odd_docs, hashes):
    hash_of = F.xxhash64 if hashes is None else lambda *c: F.pmod(F.xxhash64(*c), F.lit(hashes))
    rows = exact_dedup.exact_dedup(odd_docs, 64, hash_of).collect()
    assert sorted((r["group_size"], r["text_sha256"]) for r in rows) == expected_groups([(r["doc_id"], r["text"]) for r in odd_docs.collect()])
    kept = [r for r in rows if r["kept"]]
    assert len(kept) == len({r["text_sha256"] for r in rows}) == len({r["text_sha256"] for r in kept})
    assert {r["doc_id"] for r in kept if r["group_size"] == 3 and r["doc_id"]} == {7, 3}
    assert all(r["keep_id"] == 8 for r in rows if r["doc_id"] == 8)


# near dedup

def brute_components(texts):
    sets = []
    for _, t, *_ in texts:
        w = WORDS.findall(lower(t or ""))
        sets.append(frozenset(tuple(w[j: j + 5]) for j in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    return sets, [find(x) for x in range(len(texts))]


def near_documents():
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(4000)]
    out, base = [], [str(x) for x in rng.choice(vocabulary, 120)]
    for i in range(120):  # a cloud around one text, whose similarities lie on both sides of the threshold
        words = list(base)
        for at in rng.integers(0, 120, rng.integers(0, 3)):
            words[at] = str(rng.choice(vocabulary))
        out.append((i, " ".join(words), "en"))
    passage = [str(x) for x in rng.choice(vocabulary, 60)]
    for i in range(200, 260):  # a shared passage in texts that are no near-duplicates
        out.append((i, " ".join(passage + [str(x) for x in rng.choice(vocabulary, 30)]), "en"))
    return out


def test_near_dedup_against_all_pairs(spark, tmp_path):
    texts = near_documents()
    spark.createDataFrame(texts, "doc_id long, text string, lang string").write.parquet(str(tmp_path / "d"))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_dedup.near_dedup(spark.read.parquet(str(tmp_path / "d"))).collect()}
    sets, roots = brute_components(texts)
    least = defaultdict(lambda: 10**9)
    for (i, *_), r in zip(texts, roots):
        least[r] = min(least[r], i)
    assert got == {i: (len(s), least[r], least[r] == i) for (i, *_), s, r in zip(texts, sets, roots)}
    assert len(set(roots)) > 60


def test_near_dedup_edges(odd_docs):
    rows = near_dedup.near_dedup(odd_docs).collect()
    assert len(rows) == 14 and sum(r["kept"] for r in rows if r["component_id"] == 1) == 1
    assert sum(r["component_id"] == 1 for r in rows) == 3
    assert [r["component_id"] for r in rows if r["doc_id"] in (2, 3, 4)] == [r["doc_id"] for r in rows if r["doc_id"] in (2, 3, 4)]
    assert {r["doc_id"] for r in rows if r["component_id"] == 8} == {8, None}


def test_near_dedup_drops_what_no_later_step_reads(spark, tmp_path, monkeypatch):
    spark.createDataFrame(near_documents(), "doc_id long, text string, lang string").write.parquet(str(tmp_path / "d"))
    folder, held, real = Path(common.shared_dir(spark)) / "llm", {}, near_dedup.stored
    before = {x.name for x in folder.iterdir()} if folder.is_dir() else set()

    def stored(df, name):
        out = real(df, name)
        held.setdefault(name, {x.name.rsplit("-", 1)[0] for x in folder.iterdir() if x.name not in before})
        return out

    monkeypatch.setattr(near_dedup, "stored", stored)
    monkeypatch.setattr(common, "stored", stored)
    near_dedup.near_dedup(spark.read.parquet(str(tmp_path / "d"))).collect()
    assert "numbered" in held["sets"] and not {"numbered", "sketches", "classes"} & held["best"]
    assert not {"apart-sets", "prefixes"} & held["parts"]


def test_near_dedup_keeps_tables_of_its_caller(spark, odd_docs):
    docs = common.numbered(odd_docs)
    near_dedup.near_dedup(docs).collect()
    assert docs.count() == 14


def test_sketch_estimates_and_merges():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    a, b = np.sort(x[:2000]), np.sort(x[500:2500])
    ra, rb = near_dedup.registers(a, np.array([0, 2000])), near_dedup.registers(b, np.array([0, 2000]))
    estimate = near_dedup.similarity(ra, rb, np.array([2000.0]), np.array([2000.0]))[0]
    assert abs(estimate - 1500 / 2500) < 0.12
    union = np.unique(x[:2500])
    assert (near_dedup.merged(ra, rb) == near_dedup.registers(union, np.array([0, len(union)]))).all()


# decontamination

def brute_contamination(texts, items):
    windows = defaultdict(set)
    for i, t in items:
        w = ITEM_WORDS.findall(lower(t or ""))
        for j in range(max(1, len(w) - 12)) if w else []:
            windows[tuple(w[j: j + 13])].add(i)
    out = []
    for i, t in texts:
        w = ITEM_WORDS.findall(lower(t or ""))
        hit, found = [False] * len(w), set()
        for n in {len(k) for k in windows}:
            for j in range(len(w) - n + 1):
                if tuple(w[j: j + n]) in windows:
                    hit[j: j + n] = [True] * n
                    found |= windows[tuple(w[j: j + n])]
        out.append((i, len(w), sum(hit), tuple(sorted(found))))
    return sorted(out, key=lambda t: (t[0] is None, t))


@pytest.mark.parametrize("item_bytes", [64_000_000, 700])
def test_contamination_against_brute_force(spark, sf, corpus, item_bytes):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    items += [(900, "Short item"), (901, None), (902, ""), (903, corpus[3][1][:400]), (903, corpus[5][1][:300])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.contamination(common.documents(spark, sf), bench, item_bytes=item_bytes)
    rows = sorted((r["doc_id"], r["n_words"], r["n_hit"], tuple(sorted({m["item_id"] for m in r["matches"]}))) for r in got.collect())
    assert rows == brute_contamination([(i, t) for i, t, _ in corpus], items)


def test_contamination_edges(spark, odd_docs):
    bench = spark.createDataFrame([(1, "quick BROWN fox"), (None, "schnelle fuchs"), (2, "!!")], "item_id long, text string")
    rows = {(r["doc_id"], r["n_hit"]) for r in decontamination.contamination(odd_docs, bench).collect()}
    assert {(1, 3), (7, 3), (8, 2), (None, 2), (None, 0), (2, 0), (10, 0)} <= rows
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r["n_hit"] for r in decontamination.contamination(odd_docs, none).collect()} == {0}


# suffix dedup

def brute_removed(texts, length=100):
    seen, out = set(), []
    for i, t in sorted(texts, key=lambda x: (x[0] is None, x[0])):
        b = (t or "").encode()
        cover = [False] * len(b)
        for p in range(len(b) - length + 1):
            if b[p: p + length] in seen:
                cover[p: p + length] = [True] * length
            seen.add(b[p: p + length])
        kept = bytes(c for c, r in zip(b, cover) if not r)
        out.append((i, len(b), sum(cover), sum(cover[j] and (j == 0 or not cover[j - 1]) for j in range(len(b))), hashlib.sha256(kept).hexdigest()))
    return out


def test_suffix_dedup_against_brute_force(spark, sf, corpus):
    got = suffix_dedup.suffix_dedup(common.documents(spark, sf))
    assert pairs_of(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(brute_removed([(i, t) for i, t, _ in corpus]))


def test_suffix_dedup_edges(spark, odd_docs, tmp_path):
    texts = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    key = lambda t: (t[0] is None, t)
    assert pairs_of(suffix_dedup.suffix_dedup(odd_docs), *columns) == sorted(brute_removed(texts), key=key)
    rng = np.random.default_rng(2)
    base = "".join(rng.choice(list("abcdé "), 700))
    texts = [(i, base[a: a + n] + "".join(rng.choice(list("xyz"), k)) + base[c: c + n]) for i, (a, n, k, c) in enumerate(rng.integers(1, 350, (60, 4)).tolist())]
    texts += [(100, "a" * 500), (101, "ab" * 300), (102, "b" + "a" * 99), (103, base[:99]), (104, base[:100])]
    spark.createDataFrame(texts, "doc_id long, text string").repartition(5).write.parquet(str(tmp_path / "d"))
    got = suffix_dedup.suffix_dedup(spark.read.parquet(str(tmp_path / "d")))
    assert pairs_of(got, *columns) == sorted(brute_removed(texts))


def test_suffix_dedup_samples_own_every_window_and_spread_over_the_filter():
    rng = np.random.default_rng(3)
    texts = [rng.choice(np.arange(97, 123, dtype=np.uint8), int(n)).tobytes() for n in rng.integers(0, 4000, 40)] + [b"a" * 300, b"ab" * 200, b"", b"x" * 99]
    names = suffix_dedup.Names(texts)
    at, low, high = names.sampled()
    windows = np.concatenate([np.arange(a, b + 1) for a, b in zip(low, high)])
    assert windows.tolist() == [int(o) + k for o, t in zip(names.starts, texts) for k in range(len(t) - suffix_dedup.LENGTH + 1)]
    assert (low <= at).all() and (at >= high).all() and (at + suffix_dedup.SEED <= low + suffix_dedup.LENGTH).all()
    seeds = np.unique(names.seeds(at))
    assert 0.45 < (seeds >> np.uint64(63)).mean() < 0.55  # the least of many names would all lie in the lower half


def test_suffix_dedup_contexts_reach_as_far_as_windows_do():
    """Equal windows in different surroundings make equal contexts, so that nothing is left for the next round."""
    rng = np.random.default_rng(4)
    passage, ends = rng.choice(list("abcdefgh"), 600), rng.choice(list("ijklmnop"), (2, 2, 200))
    texts = ["".join([*a, *passage, *b]) for a, b in ends]
    places = []
    for text in texts:
        names = suffix_dedup.Names([text.encode()])
        at, low, high = names.sampled()
        inner = (low >= names.starts[0] + 200) & (high + suffix_dedup.LENGTH <= names.starts[0] + 800)
        places.append((names.seeds(at), inner))
    shared = SimpleNamespace(value=np.full(1 << suffix_dedup.FILTER_BITS, 2**64 - 1, np.uint64))
    names = []
    for row, text in enumerate(texts):
        batch = pa.RecordBatch.from_pydict({"doc_order": [row], "__row": [row], "text": [text]})
        names.append({r["name"]: (r["a"], r["b"], r["end"] - r["start"]) for out in suffix_dedup._contexts(shared)(iter([batch])) for r in out.to_pylist() if not r["covered"]})
    within = [int(x) for x in places[0][0][places[0][1]].view(np.int64)]
    assert len(within) > 8 and all(names[0][x] == names[1][x] for x in within)


def test_suffix_dedup_rounds_send_first_places_only(spark, tmp_path, monkeypatch):
    """What an earlier round covered is not sent again, and what only the later rounds can cover is found all the same."""
    rng = np.random.default_rng(6)
    draw = lambda letters, n: "".join(rng.choice(list(letters), n))
    passages = [draw("abcdefgh", 600) for _ in range(4)]
    texts = [(i, draw("ijklmnop", 150) + passages[i % 4][i % 7: 600 - i % 5] + draw("qrstuvwx", 150)) for i in range(80)]
    texts += [(0, texts[0][1]), (None, texts[5][1]), (None, passages[0]), (90, None), (91, passages[1][:99])]
    spark.createDataFrame(texts, "doc_id long, text string").repartition(6).write.parquet(str(tmp_path / "d"))
    rounds, ranked = {}, suffix_dedup._ranked

    def kept(places, name):
        out = ranked(places, name)
        rounds[name] = out.collect()
        return out

    monkeypatch.setattr(suffix_dedup, "_ranked", kept)
    got = suffix_dedup.suffix_dedup(spark.read.parquet(str(tmp_path / "d")))
    assert pairs_of(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(brute_removed(texts), key=lambda t: (t[0] is None, t))
    covered = defaultdict(list)
    for name in ("contexts", "groups", "windows"):
        sent = [(r["__row"], r["start"], r["end"]) for r in rounds[name]]
        assert sent and not any(a <= start and end <= b for row, start, end in sent for a, b in covered[row])
        for r in rounds[name]:
            if r["again"]:
                covered[r["__row"]].append((r["start"], r["end"]))


@pytest.mark.parametrize("n", [0, 50, 4000])
def test_suffix_dedup_filters_grow_with_their_names(spark, monkeypatch, n):
    monkeypatch.setattr(suffix_dedup, "FILTER_BITS", 4)
    rng = np.random.default_rng(8)
    own, others = (rng.integers(0, 2**64, k, dtype=np.uint64) for k in (n, 5000))
    filled = suffix_dedup._filter(spark.createDataFrame([(int(x),) for x in own.view(np.int64)], "name long").repartition(3), "name").value
    assert suffix_dedup._holds(filled, own).all() and suffix_dedup._holds(filled, others).mean() < 0.2
    assert 1024 <= 64 * len(filled) <= max(1024, 16 * n)


# tokens and packing

@pytest.mark.parametrize("path", [BYTE, WORD])
def test_word_encoder_gives_the_library_ids(path, corpus):
    from tokenizers import Tokenizer

    texts = [t for _, t, _ in corpus[:60]] + [
        "", " ", "\n", " a", "a ", "a  b\n\nc \n d", "x<|endoftext|>  <|endoftext|> y it's\tA 12", "İstanbul ΣAS é ̈ x", "\x00a\x1fc", "don't 'll\n's", "• x•y", "a b c d", "ﬁ ① Ⅷ\r\nx"]
    library = Tokenizer.from_file(path)
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    encoder = tokenizing.WordEncoder(path)
    data = [t.encode() for t in texts]
    assert [x.tolist() for x in encoder.ids(data)] == want
    assert encoder.counts(data).tolist() == [len(x) for x in want]


def test_token_counts_use_and_fill_the_cache(spark, odd_docs, tmp_path):
    from tokenizers import Tokenizer

    library, cache = Tokenizer.from_file(BYTE), str(tmp_path / "cache")
    for _ in range(2):
        got = token_counts.token_counts(odd_docs, BYTE, cache)
        want = sorted(((i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in ((r["doc_id"], r["text"]) for r in odd_docs.collect())), key=lambda t: (t[0] is None, t))
        assert pairs_of(got, "doc_id", "n_bytes", "n_tokens") == want
        assert spark.read.parquet(cache).count() == len({t or "" for _, t, _ in [(0, r["text"], 0) for r in odd_docs.collect()]})


def check_packed(rows, ids, window=packing.WINDOW):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r[common.ROW]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    for own in by_doc.values():
        own.sort(key=lambda r: r["start"])
        data = b"".join(bytes(r["ids"]) for r in own)
        assert all(zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] for r in own)
        assert [r["start"] for r in own] == np.cumsum([0] + [r["length"] for r in own])[:-1].tolist()
        assert np.frombuffer(data, "<u4").tolist() in ids[own[0]["doc_id"]] and own[0]["doc_tokens"] == len(data) // 4
    for own in by_sequence.values():
        own.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in own] == np.cumsum([0] + [r["length"] for r in own])[:-1].tolist()
        assert sum(r["length"] for r in own) <= window
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    return len(by_sequence)


def test_packing_round_trip(spark, sf, corpus, odd_docs):
    from tokenizers import Tokenizer

    library, ids = Tokenizer.from_file(WORD), defaultdict(list)
    for i, t, *_ in corpus + [(r["doc_id"], r["text"]) for r in odd_docs.collect()]:
        ids[i].append(library.encode(t or "", add_special_tokens=False).ids + [2])
    rows = packing.pack(common.documents(spark, sf), WORD).collect()
    total = sum(r["length"] for r in rows)
    assert check_packed(rows, ids) <= 1.02 * total / packing.WINDOW + 1
    rows = packing.pack(odd_docs, WORD, window=64).collect()
    assert len({r[common.ROW] for r in rows}) == 14
    check_packed(rows, ids, 64)


def test_plan_uses_every_piece_once_and_fills_windows():
    counts = np.zeros(4097, np.int64)
    rng = np.random.default_rng(3)
    np.add.at(counts, rng.integers(1, 2049, 50_000), 1)
    counts[4096] = 700
    repeats, sequences = packing.plan(counts, 4096)
    used = np.zeros(4097, np.int64)
    for pattern, n in repeats:
        assert sum(a * t for a, t in pattern) <= 4096
        for a, t in pattern:
            used[a] += t * n
    assert (used == counts).all() and sequences <= 1.001 * (counts * np.arange(4097)).sum() / 4096 + 1


# sharding

def test_sharding(spark, odd_docs):
    docs = common.documents(spark, "/root/testdata/sf0.01")
    rows, text = sharding.shard(docs).collect(), {r["doc_id"]: r["text"] for r in docs.collect()}
    of, slots, sizes = defaultdict(set), defaultdict(list), Counter()
    for r in rows:
        assert r["size"] == len(text[r["doc_id"]].encode()) + 8 and r["text_crc32"] == zlib.crc32(text[r["doc_id"]].encode())
        of[text[r["doc_id"]]].add(r["shard"])
        slots[r["shard"]].append(r["slot"])
        sizes[r["shard"]] += r["size"]
    assert all(len(s) == 1 for s in of.values()) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len(sizes) == 24 and max(sizes.values()) < 1.03 * min(sizes.values())
    rows = sharding.shard(odd_docs, shards=3).collect()
    assert len(rows) == 14 and {r["size"] for r in rows if r["doc_id"] in (2, 3)} == {8}
    words = {i: len(WORDS.findall(lower(t or ""))) for i, t in ((r["doc_id"], r["text"]) for r in odd_docs.collect()) if i is not None}
    assert all(r["tokens"] == words[r["doc_id"]] for r in rows if r["doc_id"] is not None)


def test_shards_balance_bytes_tokens_and_rows(spark):
    rows = sharding.shard(common.documents(spark, "/root/testdata/sf0.01")).collect()
    for of, least in (("size", 0.97), ("tokens", 0.9), (None, 0.9)):
        sums = Counter()
        for r in rows:
            sums[r["shard"]] += r[of] if of else 1
        assert min(sums.values()) >= least * max(sums.values())


def test_a_group_of_a_third_of_all_rows_is_split(spark, tmp_path):
    spark.createDataFrame([(i, "hot text" if i % 3 else f"text {i}") for i in range(3000)], "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    rows = sharding.shard(spark.read.parquet(str(tmp_path / "d"))).collect()
    counts = Counter(r["shard"] for r in rows)
    assert len(counts) == 24 and max(counts.values()) < 1.2 * min(counts.values())


# learned operators

def test_levenshtein_automaton_over_the_trie():
    terms = [("idiot", False, 3.0), ("worthless", False, 2.0), ("lowei", True, 4.0), ("bad", False, 1.0)]
    lexicon = toxicity.Lexicon(terms)

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(row[-1] + 1, last[j] + 1, last[j - 1] + (x != y)))
        return row[-1]

    rng = np.random.default_rng(4)
    for term in ("idiot", "worthless"):
        for _ in range(300):
            w = list(term)
            for _ in range(rng.integers(0, 3)):
                k, at = rng.integers(0, 3), rng.integers(0, len(w))
                w[at: at + (k != 1)] = [str(rng.choice(list("abcdiotwrhles")))] if k < 2 else []
            word = "".join(w)
            kind, _ = lexicon.look_up(word)
            most = 2 if len(word) >= 9 else 1
            near = any(distance(t, word) <= most for t in ("idiot", "worthless") if len(t) >= (8 if most == 2 else 5))
            assert kind == (toxicity.WHOLE if word in ("idiot", "worthless") else toxicity.NEAR if near and len(word) >= 4 else 0)
    assert lexicon.look_up("wxrthleqs")[0] == toxicity.NEAR and lexicon.look_up("w" * 100)[0] == 0
    assert lexicon.look_up("loweischaft")[0] == toxicity.STEM and lexicon.look_up("bax")[0] == 0


def test_quotations_are_told_from_abuse():
    scorer = toxicity.Scorer([("idiot", False, 3.0)])
    f = scorer.features([b"you idiot go away", "he wrote “you idiot” in the letter".encode(), b"", b"nothing here"])
    assert f[0, 0] > 0 and f[0, 3] == 0 and f[1, 0] == 0 and f[1, 3] > 0 and not f[2:].any()


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    from care_measures.llm.registry import QUERIES

    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op2_toxicity"](spark, sf).collect() if r["held_out"] and r["doc_id"] in labels]
    right = Counter((labels[r["doc_id"]], r["predicted"]) for r in rows)
    assert right[1, 1] >= 0.8 * (right[1, 1] + right[1, 0]) and right[0, 1] <= 0.01 * len(rows)


def test_toxicity_edges(spark, odd_docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (6, 0), (None, 1), (8, None)], "doc_id long, toxic int")
    rows = toxicity.toxicity(odd_docs, toxicity.sampled_labels(odd_docs, labels, 10)).collect()
    assert len(rows) == 14 and all(0 <= r["score"] <= 1 for r in rows)
    none = toxicity.toxicity(odd_docs, toxicity.sampled_labels(odd_docs, labels.filter("false"), 10)).collect()
    assert {r["score"] for r in none} == {0.0}
    assert {r["score"] for r in toxicity.toxicity(odd_docs, toxicity.sampled_labels(odd_docs, labels.filter("toxic = 0 AND doc_id = 6"), 10)).collect()} == {0.0}


def test_network_gradients():
    network = language_id.BiGRU(3, state=4, seed=1)
    network.p = {k: v.astype(np.float64) for k, v in network.p.items()}
    x, y = np.array([[32, 97, 98, 32], [32, 99, 97, 32]], np.uint8), np.array([0, 2])
    _, grads = network.gradients(x, y)
    for name, at in (("v", (1, 2)), ("uf", (2, 5)), ("ub", (0, 9)), ("gf", (97, 3)), ("gb", (32, 10)), ("c", (1,))):
        p, e = network.p[name], 1e-3
        p[at] += e
        up = network.gradients(x, y)[0]
        p[at] -= 2 * e
        down = network.gradients(x, y)[0]
        p[at] += e
        assert abs((up - down) / (2 * e) - grads[name][at]) < 1e-3


def test_network_gradients_of_windows_of_unequal_length():
    network = language_id.BiGRU(2, state=3, seed=2)
    network.p = {k: v.astype(np.float64) for k, v in network.p.items()}
    x, y, lengths = language_id.rectangle([b"abcd", b"ca", b"b"], np.array([0, 1, 1]))
    loss, grads = network.gradients(x, y, lengths)
    for name, at in (("v", (0, 1)), ("uf", (1, 4)), ("ub", (2, 8)), ("gf", (97, 0)), ("gb", (98, 7)), ("c", (0,))):
        p, e = network.p[name], 1e-5
        p[at] += e
        up = network.gradients(x, y, lengths)[0]
        p[at] -= 2 * e
        down = network.gradients(x, y, lengths)[0]
        p[at] += e
        assert abs((up - down) / (2 * e) - grads[name][at]) < 1e-6
    parts = [network.gradients(np.frombuffer(w, np.uint8)[None], y[i: i + 1])[0] * len(w) for i, w in enumerate((b"abcd", b"ca", b"b"))]
    assert abs(loss - sum(parts) / 7) < 1e-9


def _read_plainly(network, text: bytes) -> np.ndarray:
    """What the network says at each position of a text, one byte and one window at a time."""
    h, p, out = network.state, network.p, []
    soft = lambda v: v / (1 + abs(v))

    def states(window, d):
        s, said = np.zeros(h), []
        for byte in window:
            g, r = p[f"g{d}"][byte], s @ p[f"u{d}"]
            z, reset = (0.5 + 0.5 * soft(g[k * h: (k + 1) * h] + r[k * h: (k + 1) * h]) for k in (0, 1))
            new = soft(g[2 * h:] + reset * r[2 * h:])
            s = z * s + (1 - z) * new
            said.append(s)
        return said
    for core in range(0, len(text), language_id.CORE):
        start, end = max(0, core - language_id.BEFORE), min(len(text), core + language_id.CORE + language_id.BEFORE)
        window = text[start: end].lower()
        both = np.hstack([states(window, "f"), states(window[::-1], "b")[::-1]])
        e = np.exp(both @ p["v"] + p["c"])
        out.append((e / e.sum(axis=1, keepdims=True))[core - start: core - start + language_id.CORE])
    return np.concatenate(out) if out else np.zeros((0, p["c"].size))


def test_every_position_is_labelled_as_by_plain_reading(monkeypatch):
    monkeypatch.setattr(language_id, "TOGETHER", 3)
    network, rng = language_id.BiGRU(3, state=4, seed=5), np.random.default_rng(8)
    core, before = language_id.CORE, language_id.BEFORE
    texts = [bytes(rng.integers(32, 255, n).astype(np.uint8)) for n in (0, 1, 5, core - 1, core, core + 1, core + before, 3 * core + 7, 0, 2 * core)]
    sums, labels = language_id.Identifier(network, ["a", "b", "c"]).read(texts)
    for text, total, label in zip(texts, sums, labels, strict=True):
        said = _read_plainly(network, text.translate(language_id.LOWER))
        assert np.allclose(said.sum(axis=0), total, atol=1e-3)
        assert label.sum() == len(text) and abs(label - np.bincount(said.argmax(axis=1), minlength=3)).sum() <= 2


def test_language_of_texts_longer_than_a_block(spark):
    network = language_id.BiGRU(2, seed=3)
    texts = ["Ab ", "lang " * 150_000, "né " * 700_000, "Ab "]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    rows = {r["doc_id"]: r for r in language_id.identify(docs, network, ["x", "y"]).collect()}
    plain = language_id.Identifier(network, ["x", "y"])
    for i, t in enumerate(texts):
        sums, labels = plain.read([t.encode()])
        best = int(sums[0].argmax())
        assert rows[i]["lang_pred"] == "xy"[best] and rows[i]["n_labelled"] == labels[0, best] <= len(t.encode())
        assert abs(rows[i]["score"] - sums[0, best] / sums[0].sum()) < 1e-6


def test_language_held_out(spark, sf, corpus):
    from care_measures.llm.registry import QUERIES

    rows = [r for r in QUERIES["op10_language_id"](spark, sf).collect() if r["held_out"]]
    lang = {i: g for i, _, g in corpus}
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in rows) >= 0.97 * len(rows)


def test_language_edges(odd_docs, no_docs):
    model = language_id.learn(odd_docs)
    rows = language_id.identify(odd_docs, *model).collect()
    assert {r["lang_pred"] for r in rows if r["doc_id"] in (2, 3, 4, 5)} == {"und"} and len(rows) == 14
    assert {r["lang_pred"] for r in rows} <= {"und", "en", "de"}
    nothing = language_id.identify(odd_docs, *language_id.learn(no_docs)).collect()
    assert {(r["lang_pred"], r["score"]) for r in nothing} == {("und", 0.0)}


# language model

def test_base_scores_against_counts(spark, odd_docs):
    rows = language_model.score(odd_docs, common.fold(7) != 2).collect()
    texts = [(r["doc_id"], r["text"] or "") for r in odd_docs.collect()]
    training = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2
    tokens = lambda t: WORDS.findall(lower(t)) + [None]
    counts = Counter(x for i, t in texts if training(i) for x in tokens(t))
    n, v = sum(counts.values()), len(counts)
    want = sorted((len(tokens(t)), sum(counts[x] > 0 for x in tokens(t)), n, round(sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in tokens(t)), 6)) for _, t in texts)
    assert sorted((r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in rows) == want


def context_tree_weighting(texts):
    """Brute force: log10 of the probability of byte y after the bytes before it, from counts of training texts."""
    depth, edge = language_model.DEPTH, language_model.EDGE
    counts = defaultdict(lambda: [0, 0])
    for t in texts:
        padded = [edge] * depth + list(t) + [edge]
        for i in range(depth, len(padded)):
            for d in range(depth + 1):
                for bit in range(8):
                    counts[tuple(padded[i - d: i]), bit, padded[i] >> (8 - bit)][padded[i] >> (7 - bit) & 1] += 1
    children = defaultdict(list)
    for context, bit, before in counts:
        if context:
            children[context[1:], bit, before].append((context, bit, before))
    log_own = lambda z, o: math.lgamma(z + 0.5) + math.lgamma(o + 0.5) - math.lgamma(z + o + 1) - math.log(math.pi)

    @functools.cache
    def weights(node):
        own = log_own(*counts[node])
        if len(node[0]) == depth:
            return 1.0, own
        both = np.logaddexp(own, sum(weights(c)[1] for c in children[node]))
        return math.exp(own - both), both - math.log(2)

    def one(history, bit, before, d=0):
        node = (history[depth - d:], bit, before)
        if node not in counts:
            return None
        zeros, ones = counts[node]
        own, deeper = (ones + 0.5) / (zeros + ones + 1), one(history, bit, before, d + 1) if d < depth else None
        keep = weights(node)[0]
        return own if deeper is None else keep * own + (1 - keep) * deeper

    def log(history, y):
        out = 0.0
        for bit in range(8):
            p = one(history, bit, y >> (8 - bit))
            p = 0.5 if p is None else p
            out += math.log10(p if y >> (7 - bit) & 1 else 1 - p)
        return out

    def of(text):
        padded = [edge] * depth + list(text) + [edge]
        return sum(log(tuple(padded[i - depth: i]), padded[i]) for i in range(depth, len(padded)))
    return of, log


def test_chunks_of_whole_nodes_mix_as_all_at_once(monkeypatch):
    grams, n = np.unique(language_model.grams_of([b"abracadabra " * 20, b"the cat sat on the mat", b"", "läuft".encode()])[0], return_counts=True)
    n[::5] = 0
    batches = [pa.record_batch({"gram": grams[a: a + 3], "n": n[a: a + 3]}) for a in range(0, len(grams), 3)]
    monkeypatch.setattr(language_model, "CHUNK", 4)
    chunks = list(language_model._whole_nodes(batches))
    assert len(chunks) > 5 and (np.concatenate([g for g, _ in chunks]) == grams).all() and (np.concatenate([k for _, k in chunks]) == n).all()
    bits, upper = language_model.subtrees(grams, n)
    parts = [language_model.subtrees(*c) for c in chunks]
    assert np.allclose(np.concatenate([b for b, _ in parts]), bits)
    want, got = dict(zip(upper[0], np.stack(upper[1:], 1))), defaultdict(float)
    for _, u in parts:
        for code, sums in zip(u[0], np.stack(u[1:], 1)):
            got[code] = got[code] + sums
    assert want.keys() == got.keys() and all(np.allclose(want[c], got[c]) for c in want)


def test_scores_against_brute_force_context_tree_weighting(spark, odd_docs):
    texts = [(r["doc_id"], (r["text"] or "").encode()) for r in odd_docs.collect()]
    training = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2
    of, log = context_tree_weighting([t for i, t in texts if training(i)])
    assert abs(sum(10 ** log(tuple(b"e qui"), y) for y in range(256)) - 1) < 1e-9
    rows = language_model.score(odd_docs, common.fold(7) != 2).collect()
    got = sorted((r["doc_id"] or 0, round(r["score"], 3), round(r["bits_per_byte"], 4)) for r in rows)
    want = sorted((i or 0, of(t), of(t) / -math.log10(2) / (len(t) + 1)) for i, t in texts)
    assert np.allclose(np.array(got), np.array(want), rtol=1e-4, atol=2e-3)


def test_scores_without_training_rows(odd_docs):
    for r in language_model.score(odd_docs, F.lit(False)).collect():
        assert (r["n_known"], r["train_tokens"]) == (0, 0) and abs(r["bits_per_byte"] - 8) < 1e-6


def test_model_scores_held_out_texts(spark, sf):
    from care_measures.llm.registry import QUERIES

    rows = [r for r in QUERIES["op4_language_model"](spark, sf).collect() if r["held_out"]]
    assert rows and sum(r["bits_per_byte"] for r in rows) / len(rows) < 3.5


def test_block_grams_are_sorted_not_hashed(monkeypatch):
    """np.unique of whole grams goes through a hash table, ten times as slow as the sort in words.distinct."""
    for keys in (np.zeros(0, np.int64), np.array([7]), np.array([5, -3, 5, 2**62, -3]), np.arange(3, dtype=np.uint64)[::-1]):
        assert words.distinct(keys).tolist() == np.unique(keys).tolist() and words.distinct(keys).dtype == keys.dtype
    texts = ["abracadabra " * 20, "", "läuft"]
    expected = np.unique(language_model.grams_of([t.encode() for t in texts])[0]).tolist()
    monkeypatch.setattr(np, "unique", None)
    batch = pa.RecordBatch.from_pydict({"block": [3, 3, 3], "text": texts})
    assert [r["gram"] for out in language_model._block_grams(iter([batch])) for r in out.to_pylist()] == expected


def test_log_gamma():
    x = np.array([0.5, 1.0, 3.7, 100.5, 1e6])
    assert np.allclose(language_model.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-9)


# all of them

def test_empty_tables(spark, no_docs):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    for made in (
        exact_dedup.exact_dedup(no_docs), near_dedup.near_dedup(no_docs), suffix_dedup.suffix_dedup(no_docs), sharding.shard(no_docs), packing.pack(no_docs, WORD),
        decontamination.contamination(no_docs, bench), token_counts.token_counts(no_docs, BYTE, common.new_path(spark, "c")), language_id.identify(no_docs, *language_id.learn(no_docs)),
        language_model.score(no_docs, F.lit(True)), toxicity.toxicity(no_docs, toxicity.sampled_labels(no_docs, labels, 5)),
    ):
        assert made.count() == 0


def test_pipeline_against_brute_force(spark, sf, corpus, tmp_path):
    import corpus_pipeline

    docs, kept = common.documents(spark, sf), {i: t for i, t, _ in corpus if any(c.isalpha() for c in t)}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]

    def exact(texts):
        last = {t: max(j for j, x in texts.items() if x == t) for t in texts.values()}
        return {i: t for i, t in texts.items() if last[t] == i}

    def near(texts):
        rows = sorted(texts.items())
        _, roots = brute_components(rows)
        first = {}
        for (i, _), r in zip(rows, roots):
            first.setdefault(r, i)
        return {i: texts[i] for i in first.values()}

    def clean(texts):
        return {i: texts[i] for i, n, hit, _ in brute_contamination(list(texts.items()), items) if not (hit and 20 * hit >= n)}

    for k, ((_, stage), brute) in enumerate(zip(corpus_pipeline.STAGES[:4], (lambda t: t, exact, near, clean))):
        kept = brute(kept)
        stage(spark, docs, sf).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        assert {r["doc_id"]: r["text"] for r in docs.collect()} == kept and docs.columns == common.documents(spark, sf).columns
    packed = corpus_pipeline.STAGES[4][1](spark, docs, sf).collect()
    assert {r["doc_id"] for r in packed} == set(kept)
