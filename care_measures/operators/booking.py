"""Appointment lookups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.expressions import ci


def next_booking(left: DataFrame, right: DataFrame, keys: Sequence[str], *, day: str, minute: str,
                 order: Sequence[str], payload: Sequence[str], booked_day: str | None = None) -> DataFrame:
    """``left`` with ``payload`` of the first later booking of the same ``keys``.

    A booking is later when its day is, or its day is the same and its minute is. With
    ``booked_day`` it must also have been made on or after the left row's day. First is the
    smallest by ``order``, then by ``payload``.

    Places on the axis (day, minute) are compared. A right row that was booked on its own day or
    later serves every place before its own; one booked earlier serves all up to the end of the
    day it was booked on; one without a booking day none. So each right row serves what lies up
    to a single place, and the two-sided condition is a running minimum from the latest place
    down. Both sides are reduced to one row per key and place by one partial aggregate and swept
    in one window, so no pairs of bookings are formed and the window of a key is bounded by
    the calendar's minutes.
    """
    place = lambda d, m: F.struct(d.alias("day"), m.cast("int").alias("minute"))
    own = place(F.col(day), F.col(minute) - 1)
    serves = own if booked_day is None else F.when(
        F.col(booked_day) >= F.col(day), own).when(F.col(booked_day).isNotNull(), place(F.col(booked_day), F.lit(2**31 - 1)))
    best = F.struct(*order, *payload)
    facts = right.select(*keys, serves.alias("_at"), best.alias("_best"), F.lit(False).alias("_probe")).where(
        F.col("_at.day").isNotNull())
    probes = left.select(*keys, place(F.col(day), F.col(minute)).alias("_at"),
                         F.lit(None).cast(facts.schema["_best"].dataType).alias("_best"), F.lit(True).alias("_probe"))
    both = facts.unionByName(probes).groupBy(*keys, "_at").agg(F.min("_best").alias("_best"), F.bool_or("_probe").alias("_probe"))
    w = Window.partitionBy(*keys).orderBy(F.col("_at").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = (both.select(*keys, "_at", "_probe", F.min("_best").over(w).alias("_best")).where("_probe")
             .withColumnsRenamed({k: f"_{k}" for k in keys}).drop("_probe"))
    on = [*[F.col(k) == F.col(f"_{k}") for k in keys], F.col(day) == F.col("_at.day"), F.col(minute) == F.col("_at.minute")]
    return left.join(found, on, "left").select(*[F.col(c) for c in left.columns],
                                               *[F.col("_best")[p].alias(f"next_{p}") for p in payload])


def responses_wide(resp: DataFrame, key: str, question: str, answer: str,
                   names: Mapping[str, str]) -> DataFrame:
    """One row per key, one column per question; the greatest answer if there are several."""
    r = resp.withColumn("_q", ci(question)).where(F.col("_q").isin([q.lower() for q in names.values()]))
    return r.groupBy(key).agg(*[
        F.max(F.when(F.col("_q") == q.lower(), F.col(answer))).alias(n) for n, q in names.items()])


