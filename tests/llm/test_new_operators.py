"""Operators 11 to 13 against brute force, on odd tables and on whole small tables."""
from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from care_measures.llm import periodic_runs, personal_data, registry, whitening

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def runs_of(words):
    """Every run, by trying each period at each place."""
    n, out = len(words), []
    for q in range(1, n // 3 + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            j = i
            while j < n and words[j] == words[j - q]:
                j += 1
            run = words[i - q: j]
            if len(run) >= max(24, 3 * q) and not any(run[p:] == run[:-p] for p in range(1, q)):
                out.append((i - q, len(run), q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def op11_row(doc_id, text):
    words = SPACE.findall(text or "")
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = runs_of(words)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            digest("".join(f"{s},{m},{q}\n" for s, m, q in found)), digest(" ".join(w for i, w in enumerate(words) if i not in gone)))


def op11_rows(df):
    rows = df.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256").collect()
    return sorted(str(tuple(r)) for r in rows)


def test_runs_against_brute_force():
    rng = random.Random(7)
    for _ in range(400):
        n = rng.choice([0, 1, 23, 24, 25, 60, 150])
        words = [rng.randrange(rng.choice([1, 2, 3, 40])) for _ in range(n)]
        for _ in range(rng.randrange(3) if n > 5 else 0):
            a = rng.randrange(n)
            p = 1 + rng.randrange(max(1, (n - a) // 2))
            for i in range(a, min(n, a + rng.randrange(1, 150))):
                words[i] = words[a + (i - a) % p]
        assert list(zip(*(x.tolist() for x in periodic_runs.runs(np.array(words, np.int64))))) == runs_of(words)


def test_runs_with_other_limits_and_exponents():
    words = np.array([1, 2, 3] * 4 + [9, 8], np.int64)
    assert [x.tolist() for x in periodic_runs.runs(words, 12, 4)] == [[0], [12], [3]]
    assert [x.tolist() for x in periodic_runs.runs(words, 13, 3)] == [[], [], []]
    with pytest.raises(ValueError):
        periodic_runs.runs(words, 12, 2)


def test_long_texts_of_one_word_and_of_long_periods():
    assert [x.tolist() for x in periodic_runs.runs(np.zeros(300_000, np.int64))] == [[0], [300_000], [1]]
    period = np.random.default_rng(1).integers(0, 1000, 50_000)
    words = np.concatenate([period[-5:] + 1, period, period, period, period[:10], period[:5] + 2000])
    assert [x.tolist() for x in periodic_runs.runs(words)] == [[5], [150_010], [50_000]]


def test_op11_on_odd_documents(spark, odd_docs, no_docs, tmp_path):
    for docs in (odd_docs, no_docs):
        rows = [op11_row(r["doc_id"], r["text"]) for r in docs.collect()]
        docs.write.mode("overwrite").parquet(f"{tmp_path}/t/documents.parquet")
        assert op11_rows(periodic_runs.op11_periodic_runs(spark, f"{tmp_path}/t")) == sorted(map(str, rows))


def test_op11_on_the_whole_table(spark, sf):
    rows = [op11_row(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sum(r[1] for r in rows) > 0
    assert op11_rows(periodic_runs.op11_periodic_runs(spark, sf)) == sorted(map(str, rows))


def test_runs_and_collapsed_texts(spark):
    docs = spark.createDataFrame([(1, "x " + "a b " * 14 + "c"), (2, None), (None, "a b"), (3, ("w " * 250_000))], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_words"], [tuple(x) for x in r["runs"]], bytes(r["collapsed"])) for r in periodic_runs.periodic_runs(docs).collect()}
    assert got == {1: (30, [(1, 28, 2)], b"x a b c"), 2: (0, [], b""), None: (2, [], b"a b"), 3: (250_000, [(0, 250_000, 1)], b"w")}


# Personal data

BASE = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text):
    out = []
    for no, (kind, pattern) in enumerate(BASE):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m[0].split("."))
                    or kind == "card" and 12 <= len(digits) <= 19 and luhn(digits) or kind == "phone" and 9 <= len(digits) <= 15):
                out.append((m.start(), no, f"{kind}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(out)]


PERSONAL = [
    "a@b.c_x@d.e.f and x@y@z.org, ü@b.de a.b+c%d@mail-1.example.com.", "1.2.3.4.5.6.7.8 256.1.1.1 0000255.0.0.1 1.2.3 ß 10.0.0.1",
    "4111 1111 1111 1111 4111-1111-1111-1111 and 4111111111111111", "4465758382889437 4465758382889437", "+1 (663) 555-6869, +49 30 1234567-, +1 + 2 (",
    "call +1 663 555 68690000000000", "pay to GB82 WEST 1234 5698 7654 32 or DE89370400440532013000 not DE88370400440532013000",
    "ssn 123-45-6789, and in other places, far from those words, order 123-45-6789, social security 666-45-6789", 'token = "2e03422dad6b454724135a384f69ba12c7de6c8f4"', "hash 2e03422dad6b454724135a384f69ba12c7de6c8f4",
    "1" * 3_000 + "@" + "a." * 4_000, "a-" * 3_000 + "@x.y", "+" * 1000 + "1 2 3 4 5 6 7 8 9", "0-" * 9 + "0" * 9, "", None, "\n\t", "🤦🏼‍♂️ é a@b.c 🤦 1.1.1.1",
]


def personal(docs):
    return sorted(map(tuple, personal_data.summary(personal_data.find(docs)).drop("__row", "scores").collect()), key=str)


def expected_counts(doc_id, text):
    base = base_spans(text)
    return (doc_id, *(sum(s.startswith(f"{k}:") for s in base) for k, _ in BASE), hashlib.sha256(",".join(base).encode()).hexdigest())


def test_base_spans_are_those_of_plain_expressions(spark, odd_docs, no_docs):
    docs = spark.createDataFrame(list(enumerate(PERSONAL)) + [(0, PERSONAL[0]), (None, PERSONAL[1])], "doc_id long, text string")
    for table in (docs, odd_docs, no_docs):
        got = personal(table)
        assert [g[:6] for g in got] == sorted((expected_counts(r["doc_id"], r["text"]) for r in table.collect()), key=str)
        for doc_id, *_, spans in got:
            assert len(set(spans.split(","))) == len(spans.split(","))


def test_spans_the_checks_and_the_context_add(spark):
    docs = spark.createDataFrame(list(enumerate(PERSONAL)), "doc_id long, text string")
    added = {g[0]: [s for s in g[6].split(",") if s and s not in base_spans(PERSONAL[g[0]])] for g in personal(docs)}
    at = lambda i, kind, part: f"{kind}:{PERSONAL[i].index(part)}:{PERSONAL[i].index(part) + len(part)}"
    assert added[3] == ["card:0:16", "card:17:33"]
    assert added[6] == [at(6, "iban", "GB82 WEST 1234 5698 7654 32"), at(6, "iban", "DE89370400440532013000")]
    assert added[7] == [at(7, "ssn", "123-45-6789")]
    assert added[8] == [at(8, "secret", PERSONAL[8][9:-1])] and not added[9]


def test_scores_rise_and_fall_with_context(spark):
    docs = spark.createDataFrame([(1, "version 1.2.3.4"), (2, "server 1.2.3.4"), (3, "it is 1.2.3.4")], "doc_id long, text string")
    assert {r["doc_id"]: r["score"] for r in personal_data.find(docs).collect()} == {1: 30, 2: 90, 3: 60}


def test_personal_data_has_no_python_on_its_path(spark, sf):
    plan = registry.QUERIES["op12_personal_data"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange") == 1 + plan.count("Exchange SinglePartition")


# Whitening

def table(spark, tmp_path, rows, extra=""):
    spark.createDataFrame(rows, "vec_id long, embedding array<float>" + extra).write.mode("overwrite").parquet(f"{tmp_path}/w/embeddings.parquet")
    return f"{tmp_path}/w"


def whitened(spark, sf_dir):
    return whitening.op13_whitening(spark, sf_dir).toPandas()


def check_whitening(got, ids, vectors, k):
    x = np.floor(64 * np.array(vectors, np.float64)).astype(np.int64) + 1_000_000
    n, total = len(x), x.sum(axis=0)
    c = (n * x - total) / n
    values, u = np.linalg.eigh(c.T @ c / n)
    values, u = values[::-1][:k], u[:, ::-1][:, :k]
    assert len(got) == n * k and set(got["n"]) == {n}
    deviation = dict(zip(ids, ((n * x - total) ** 2).sum(axis=1)))
    assert all(deviation[i] == d for i, d in zip(got["vec_id"], got["deviation"]))
    wide = got.pivot(index="vec_id", columns="component", values="whitened").loc[ids].to_numpy()
    want = c @ u / np.sqrt(values)
    assert np.allclose(np.abs((wide * want).sum(axis=0)), (want * want).sum(axis=0), rtol=1e-9)
    assert np.allclose(wide * np.sign((wide * want).sum(axis=0)), want, atol=1e-7)
    assert got["identity_error"].nunique() == 1 and got["identity_error"].max() < 1e-9 and got["residual"].max() < 1e-12
    explained = got.groupby("component")["explained"].first().to_numpy()
    assert np.allclose(explained, values / np.trace(c.T @ c / n), rtol=1e-10)


def test_whitening_of_the_whole_table(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    check_whitening(whitened(spark, sf), [r["vec_id"] for r in rows], [r["embedding"] for r in rows], 32)


def test_whitening_of_odd_tables(spark, tmp_path):
    rng = np.random.default_rng(3)
    good = [(i, [float(v) for v in rng.standard_normal(6)], 1, 2) for i in range(40)]
    bad = [(100, None, 1, 2), (101, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1, 2), (102, [float("nan")] * 6, 1, 2), (103, [float("inf")] * 6, 1, 2), (104, [], 1, 2), (105, [1.0], 1, 2)]
    where = table(spark, tmp_path, good + bad, ", x int, n int")
    check_whitening(whitened(spark, where), [g[0] for g in good], [np.float32(g[1]) for g in good], 6)


def test_whitening_of_repeated_null_and_equal_rows(spark, tmp_path):
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [3.0, 1.0]), (2, [0.0, 0.0])]
    got = whitened(spark, table(spark, tmp_path, rows))
    assert len(got) == 8 and got["vec_id"].isna().sum() == 2 and set(got["n"]) == {4}
    assert not len(whitened(spark, table(spark, tmp_path, [(1, [1.0, 2.0])] * 3)))
    assert not len(whitened(spark, table(spark, tmp_path, [])))
    line = whitened(spark, table(spark, tmp_path, [(i, [float(i), float(2 * i), 0.0]) for i in range(9)]))
    assert set(line["component"]) == {1} and abs(line["explained"].iloc[0] - 1) < 1e-12


@pytest.mark.parametrize("d, kind", [(150, "flat"), (400, "falling"), (120, "tied"), (30, "short")])
def test_jacobi_davidson_against_a_dense_solver(d, kind):
    rng = np.random.default_rng(11)
    values = {"flat": 1 + rng.random(d), "falling": 1 / np.arange(1.0, d + 1), "tied": np.repeat(np.arange(d // 4, 0, -1.0), 4),
              "short": np.concatenate([np.arange(9, 0, -1.0), np.zeros(d - 9)])}[kind]
    q = np.linalg.qr(rng.standard_normal((d, d)))[0]
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    got, u, residuals = whitening.jacobi_davidson(lambda block: a @ block, d, 20)
    assert np.allclose(got, np.sort(values)[::-1][:20], atol=1e-12) and residuals.max() < 1e-12
    assert np.abs(u.T @ u - np.eye(20)).max() < 1e-13 and np.abs(a @ u - u * got).max() < 1e-11
