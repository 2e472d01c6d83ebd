"""Newest or oldest row per key."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.expressions import within
from .filters import of_cohort


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                   tiebreak: Sequence[str | Column] = ()) -> DataFrame:
    """One row per key: the greatest by ``order``, then by ``tiebreak``.

    NULLs count as oldest. Filtering ``row_number() = 1`` is planned as a group limit on
    both sides of the shuffle, so each input partition sends at most one row per key.
    """
    return _first(df, keys, [_col(c).desc_nulls_last() for c in (*order, *tiebreak)])


def earliest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                     tiebreak: Sequence[str | Column] = ()) -> DataFrame:
    """One row per key: the smallest by ``order``, then by ``tiebreak``. NULLs come last."""
    return _first(df, keys, [_col(c).asc_nulls_last() for c in (*order, *tiebreak)])


def current_version(df: DataFrame, key: str, modified: str, active: Column | None = None,
                    tiebreak: Sequence[str | Column] = ()) -> DataFrame:
    """Newest version of each entity among its active rows."""
    return latest_per_key(df if active is None else df.where(active), [key], [modified], tiebreak)


def latest_if_within(df: DataFrame, key: str, modified: str, ts: str, start: date, end: date,
                     tiebreak: Sequence[str | Column] = (), members: DataFrame | None = None,
                     member: str | None = None) -> DataFrame:
    """Newest version of each entity among all its versions, where that one's ``ts`` lies in the window.

    An entity moved out of the window by a later version is not in the result. The newest
    versions inside the window (of ``members`` only, by ``member``) are candidates; then the
    key columns of the whole history, cut down to the candidates' keys, tell which of them
    have a newer version. So the other columns are read from the window alone, and of the
    history nothing is ranked. A version is newer when ``modified`` is, or is the same and
    ``ts`` is later; NULLs count as oldest.
    """
    inside = df.where(within(ts, start, end))
    if members is not None:
        inside = of_cohort(inside, members, member)
    candidates = latest_per_key(inside, [key], [modified], [ts, *tiebreak])
    ids = inside.select(F.col(key).alias("_candidate"))
    versions = df.select(F.col(key).alias("_id"), F.col(modified).alias("_modified"), F.col(ts).alias("_ts"))
    versions = versions.join(ids, F.col("_id") == F.col("_candidate"), "left_semi")
    newer = ((F.col("_modified") > F.col(modified)) | (F.col("_modified").isNotNull() & F.col(modified).isNull())
             | (F.col("_modified").eqNullSafe(F.col(modified)) & (F.col("_ts") > F.col(ts))))
    return candidates.join(versions, (F.col(key) == F.col("_id")) & newer, "left_anti")


def _first(df: DataFrame, keys: Sequence[str], order: list[Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c
