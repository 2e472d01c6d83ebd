"""Evidence from coded facts: any number of code lists in one pass over the facts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def code_mask(dim: DataFrame, key: str, lists: Sequence[Column | str], name: str = "mask") -> DataFrame:
    """(``key``, ``name``) of a code dictionary: bit i is set where the code is in the i-th list. Unknown counts as not."""
    bits = [F.when(F.col(c) if isinstance(c, str) else c, F.lit(1 << i)).otherwise(0) for i, c in enumerate(lists)]
    return dim.select(key, reduce(lambda a, b: a.bitwiseOR(b), bits).alias(name))


def has(bit: int, mask: Column | str = "mask") -> Column:
    """Whether a bit of a mask is set; false without a mask."""
    return F.coalesce((F.col(mask) if isinstance(mask, str) else mask).bitwiseAND(F.lit(1 << bit)) != 0, F.lit(False))


def evidence(facts: DataFrame, patient: str, slots: Sequence[str], codes: DataFrame, code: str, found: Column, *,
             procedures: DataFrame | None = None, procedure: str | None = None, every_fact: bool = False,
             members: DataFrame | None = None, member: str | None = None, keep_null: bool = False) -> DataFrame:
    """(``patient``, mask): the bits of ``found`` over all facts of a patient.

    ``codes`` and ``procedures`` are dictionaries of ``code_mask`` with the masks ``_d`` and ``_p``; ``found`` is put
    together from them for each pair of a fact and one of its distinct slots, and may use the facts' other columns. A
    pair needs a known slot code, unless ``every_fact``; an unknown mask is NULL. Facts are cut down to ``members``
    first (with ``keep_null`` those without a patient stay), read once whatever the number of lists, and reduced to
    one row per patient and task before the shuffle.
    """
    if members is not None:
        ids = members.select(F.col(member or patient).alias("_member"))
        same = F.col(patient) == F.col("_member")
        if keep_null:
            nobody = ids.sparkSession.range(1).select(F.lit(None).cast(ids.schema["_member"].dataType).alias("_member"))
            ids, same = ids.unionByName(nobody), F.col(patient).eqNullSafe(F.col("_member"))
        facts = facts.join(ids, same, "left_semi")
    if procedures is not None:
        p = procedures.select(F.col(procedures.columns[0]).alias("_procedure"), "_p")
        facts = facts.join(p, F.col(procedure) == F.col("_procedure"), "left")
    ids = F.array_distinct(F.array_compact(F.array(*[F.col(s) for s in slots])))
    pairs = facts.withColumn("_slot", (F.explode_outer if every_fact else F.explode)(ids))
    d = codes.select(F.col(code).alias("_code"), "_d")
    pairs = pairs.join(d, F.col("_slot") == F.col("_code"), "left" if every_fact else "inner")
    return pairs.groupBy(patient).agg(F.bit_or(found).alias("mask"))
