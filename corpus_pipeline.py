"""The corpus pipeline: stages over `documents`, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from care_measures.llm import common, decontamination, exact_dedup, language_id, near_dedup, packing


_numbered_before: list[DataFrame] = []


def _numbered(docs: DataFrame) -> DataFrame:
    """docs with stored row keys. What the stage before this one stored so goes: its result has been written, and docs
    is read from there. Stages of a session run one after another."""
    _forget()
    _numbered_before.append(common.numbered(docs))
    return _numbered_before[-1]


def _forget() -> None:
    while _numbered_before:
        common.drop_stored(_numbered_before.pop())


def reject_unknown_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without text or letters, of which no language can be told, go."""
    network, languages = language_id.learn(language_id.train_rows(docs))
    docs = _numbered(docs)
    found = language_id.identify(docs, network, languages)
    return common.keep_rows(docs, found.filter(F.col("lang_pred") != language_id.UNKNOWN))


def remove_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest doc_id stays."""
    docs = _numbered(docs)
    return common.keep_rows(docs, exact_dedup.exact_dedup(docs).filter("kept"))


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest doc_id stays."""
    docs = _numbered(docs)
    return common.keep_rows(docs, near_dedup.near_dedup(docs).filter("kept"))


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with five words or more in a hundred inside benchmark passages go."""
    docs = _numbered(docs)
    found = decontamination.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return common.keep_rows(docs, found.filter(~decontamination.contaminated()))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into token sequences: one row per piece, with its ids."""
    import public_tokenizers

    _forget()
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")).drop(common.ROW)


STAGES = [
    ("language identification", reject_unknown_languages), ("exact dedup", remove_copies), ("near dedup", remove_near_copies),
    ("decontamination", remove_contaminated), ("packing", pack),
]

#: The stages learn, sketch and tokenize, which SQL cannot express; the tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
