"""Cohort membership and black-lists."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..config import ProviderRule
from ..functions.expressions import ci, is_any, not_like_all


def ids_of(df: DataFrame, key: str) -> DataFrame:
    """Distinct ids of a cohort, in a column ``id``. Duplicates go before the shuffle."""
    return df.select(F.col(key).alias("id")).distinct()


def of_cohort(facts: DataFrame, members: DataFrame, key: str, member_key: str | None = None) -> DataFrame:
    """Rows of ``facts`` whose ``key`` is among the members'. Apply it before facts are aggregated."""
    ids = members.select(F.col(member_key or key).alias("_member"))
    return facts.join(ids, F.col(key) == F.col("_member"), "left_semi")


def cohort(base: DataFrame, key: str, include: Sequence[DataFrame] = (),
           exclude: Sequence[DataFrame] = (), key_nullable: bool = False) -> DataFrame:
    """Rows of ``base`` whose ``key`` is in every ``include`` and in no ``exclude``.

    Both take frames with an ``id`` column (see ``ids_of``). Exclusion follows SQL NOT IN:
    a NULL id in the list leaves nothing, a NULL key is left out unless the list is empty
    (tested only with ``key_nullable``; keys that were joined on cannot be NULL). These
    cases are read off as scalar conditions and the join itself is a plain anti join, which
    unlike the null-aware one need not broadcast the list.
    """
    out = base
    for ids in include:
        ids = ids.select(F.col("id").alias("_id")).distinct()
        out = out.join(ids, F.col(key) == F.col("_id"), "left_semi")
    for ids in exclude:
        known = ids.where("id IS NOT NULL").select(F.col("id").alias("_id")).distinct()
        out = out.join(known, F.col(key) == F.col("_id"), "left_anti")
        out = out.where(~ids.where("id IS NULL").exists())
        if key_nullable:
            out = out.where(F.col(key).isNotNull() | ~ids.exists())
    return out


def exclude_by_name(df: DataFrame, col: str, patterns: Iterable[str] = (), names: Iterable[str] = (),
                    type_col: str | None = None, type_ids: Iterable[int] = ()) -> DataFrame:
    """Drop rows by name pattern, exact name or type. Apply to the dimension, then join."""
    keep = not_like_all(col, patterns)
    if names := tuple(names):
        keep = keep & ~is_any(col, names)
    if type_col is not None:
        keep = keep & ~F.col(type_col).isin(list(type_ids))
    return df.where(keep)


def exclude_after_hours(visits: DataFrame, rules: Sequence[ProviderRule], mode: str, *,
                        provider: str, ts: str) -> DataFrame:
    """Drop visits outside a provider's contracted hours.

    ``as_written``: every rule must hold at once. The rules name different providers, so
    with two or more of them no visit qualifies and the input is returned. ``any``: a visit
    matching one rule is dropped.
    """
    if mode not in ("as_written", "any"):
        raise ValueError(f"mode must be 'as_written' or 'any', not {mode!r}")
    if not rules or (mode == "as_written" and len({r.provider.lower() for r in rules}) > 1):
        return visits

    def hit(r: ProviderRule) -> Column:
        return ((ci(provider) == r.provider.lower()) & F.dayofweek(ts).isin(list(r.weekdays))
                & (F.hour(ts) > r.hour) & (F.minute(ts) >= r.minute))

    combine = (lambda a, b: a & b) if mode == "as_written" else (lambda a, b: a | b)
    return visits.where(~F.coalesce(reduce(combine, map(hit, rules)), F.lit(False)))
