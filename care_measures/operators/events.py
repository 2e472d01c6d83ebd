"""Event logs: milestones per booking and the time between them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.expressions import ci, minute_diff


def milestones(events: DataFrame, key: str, kind: str, ts: str, seq: str,
               names: Mapping[str, str], active: Column | None = None) -> DataFrame:
    """One row per key with the time of the last recorded event of each kind.

    ``names`` maps output columns to event kinds. The last event is the one with the
    greatest ``seq``. One scan and one partial aggregate serve all kinds.
    """
    e = events if active is None else events.where(active)
    e = e.withColumn("_kind", ci(kind)).where(F.col("_kind").isin([k.lower() for k in names.values()]))
    return e.groupBy(key).agg(*[
        F.max_by(F.when(F.col("_kind") == k.lower(), F.col(ts)),
                 F.when(F.col("_kind") == k.lower(), F.col(seq))).alias(n)
        for n, k in names.items()])


def stage_durations(df: DataFrame, stages: Mapping[str, Sequence[str]]) -> DataFrame:
    """Minutes between pairs of milestones, without sign; -1 when one is missing."""
    return df.withColumns({
        name: F.coalesce(F.abs(minute_diff(a, b)), F.lit(-1)) for name, (a, b) in stages.items()})
