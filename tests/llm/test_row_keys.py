"""Row keys hold whatever the number of tasks is when a table is read again."""
from __future__ import annotations

import importlib
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from care_measures.llm import common, near_dedup


@pytest.fixture
def many_files(spark, tmp_path):
    rows = spark.range(0, 2000, 1, 20).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("a b c d"), "id").alias("text"),
                                              F.lit("en").alias("lang"), F.lit(1).alias("__row"), F.lit("x").alias("__doc"), F.lit(2).alias("a`b"))
    rows.write.parquet(str(tmp_path / "many"))
    return lambda: spark.read.parquet(str(tmp_path / "many"))


@pytest.fixture
def parallelism(spark):
    def change(n):
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", n)

    yield change
    spark.conf.unset("spark.sql.leafNodeDefaultParallelism")


def test_rows_are_kept_by_key_when_parallelism_changes(many_files, parallelism):
    parallelism(4)
    docs = common.numbered(many_files())
    chosen = common.keyed(docs).filter("doc_id % 3 = 0").select(common.ROW).collect()
    parallelism(16)
    kept = common.keep_rows(docs, docs.sparkSession.createDataFrame(chosen, "__row long"))
    assert kept.columns == many_files().columns
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(0, 2000, 3))
    assert common.numbered(docs) is docs


def test_only_numbered_tables_keep_rows_by_key(many_files):
    with pytest.raises(ValueError):
        common.keep_rows(many_files(), many_files().select(F.lit(1).alias("__row")))


def test_near_dedup_when_parallelism_changes(many_files, parallelism, monkeypatch):
    turns = iter(range(10_000))
    real = near_dedup.stored

    def stored(df, name):
        parallelism(3 + next(turns) % 5)
        return real(df, name)

    monkeypatch.setattr(near_dedup, "stored", stored)
    rows = near_dedup.near_dedup(many_files()).collect()
    assert len(rows) == 2000 and all(r["kept"] and r["component_id"] == r["doc_id"] for r in rows)


@pytest.mark.parametrize("stage", [0, 1, 2, 3])
def test_stages_keep_odd_columns(spark, sf, many_files, stage):
    pipeline = importlib.import_module("corpus_pipeline")
    out = pipeline.STAGES[stage][1](spark, many_files(), sf)
    assert out.columns == many_files().columns and out.count() == 2000


def test_a_shared_folder_is_needed_outside_local_mode():
    def session(master, **conf):
        return SimpleNamespace(sparkContext=SimpleNamespace(master=master), conf=SimpleNamespace(get=lambda key, other: conf.get("folder", other)))

    with pytest.raises(ValueError):
        common.shared_dir(session("spark://host:7077"))
    assert common.shared_dir(session("spark://host:7077", folder="hdfs:/x")) == "hdfs:/x"
    assert common.shared_dir(session("local[4]"))
