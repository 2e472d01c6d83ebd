"""Joins over repeated code columns (diagnosis_id_1 .. diagnosis_id_4 and the like)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def slot_join(facts: DataFrame, slots: Sequence[str], dim: DataFrame, key: str) -> DataFrame:
    """Inner join of ``facts`` with ``dim`` on ``key`` = any of ``slots``.

    Written as an OR of equalities the join can only be planned as a nested loop. Exploding
    the distinct non-NULL slots turns it into one equi join with the same multiplicity: a
    code in two slots of a row matches once, two codes match twice.
    """
    ids = F.array_distinct(F.array_compact(F.array(*[F.col(s) for s in slots])))
    long = facts.withColumn("_slot", F.explode(ids))
    return long.join(dim, long["_slot"] == dim[key]).drop("_slot")


def slot_any_match(facts: DataFrame, slots: Sequence[str], codes: DataFrame, key: str) -> DataFrame:
    """Rows of ``facts`` with at least one slot in ``codes``, each kept once.

    The distinct non-NULL slots of a row are exploded under a row number and joined with the distinct codes once; a row
    that matches several times is put together again by its number. A row without slots is never shuffled, and after
    the join only rows that match are.
    """
    ids = codes.select(F.col(key).alias("_code")).where("_code IS NOT NULL").distinct()
    filled = F.array_distinct(F.array_compact(F.array(*[F.col(s) for s in slots])))
    # Numbered in a projection of its own, below the explode.
    numbered = facts.select(F.monotonically_increasing_id().alias("_row"), F.struct("*").alias("_fact"), filled.alias("_slots"))
    long = numbered.select("_row", "_fact", F.explode("_slots").alias("_slot"))
    hits = long.join(ids, F.col("_slot") == F.col("_code")).groupBy("_row").agg(F.first("_fact").alias("_fact"))
    return hits.select("_fact.*")
