from __future__ import annotations

import pytest
from pyspark.sql import Row

TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog and runs away into the deep dark wood today", "en"),
    (2, None, "en"), (3, "", None), (4, "\n\t  \n", "de"), (5, "12 345 -- !!", "en"), (6, "kurz", "de"),
    (7, "The quick brown fox jumps over the lazy dog and runs away into the deep dark wood today", "en"),
    (7, "The quick brown fox jumps over the lazy dog and runs away into the deep dark wood today", "en"),
    (None, "Der schnelle Fuchs läuft über die Straße und der Hund schläft weiter im Garten", "de"),
    (None, None, None), (8, "Der schnelle Fuchs läuft über die Straße und der Hund schläft weiter im Garten", "de"),
    (9, "A b  c\n\nd e\x00f <|endoftext|> it's  • ünï", "en"), (10, "ab" * 3000, "en"), (11, "long words " * 3000, "en"),
]


@pytest.fixture
def odd_docs(spark, tmp_path):
    """Nulls, empty and long texts, ties, repeated rows, and extra columns whose names operators use inside."""
    rows = [Row(doc_id=i, text=t, lang=g, source="s", n_chars=len(t or ""), row=1, h=2, n=3, pos="x", component=None, start=4, block=5) for i, t, g in TEXTS]
    schema = "doc_id long, text string, lang string, source string, n_chars long, row int, h int, n int, pos string, component int, start int, block int"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "odd"))
    return spark.read.parquet(str(tmp_path / "odd"))


@pytest.fixture
def no_docs(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string").write.parquet(str(tmp_path / "none"))
    return spark.read.parquet(str(tmp_path / "none"))


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def corpus(spark, sf):
    return [(r["doc_id"], r["text"] or "", r["lang"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
