"""Consent in force: a stored state of the newest answers, extended month by month."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, functions as F

from .observations import PATIENT, long_observations


def extend_state(state: DataFrame | None, notes: DataFrame, controls: DataFrame, fields: Sequence[int],
                 start: date | None, end: date) -> DataFrame:
    """(patient, template_field_id, newest): each patient's newest answer to each field up to ``end``.

    ``state`` holds the answers up to the day before ``start``; without one, ``start`` is None and
    the whole history is read once. Later a month's notes are all that is read: events are
    reduced to one row per patient and field, stacked on the state and reduced again. Of answers
    at the same time the greater note id and then the greater text is the newest.
    """
    if (state is None) != (start is None):
        raise ValueError("a state is extended from a day on; without one the whole history is read")
    events = long_observations(notes, controls, {"consent": fields}, start, end).select(
        F.col(PATIENT), "template_field_id",
        F.struct(F.col("note_datetime").alias("at"), "patient_note_id", F.col("data_value").alias("value")).alias("newest"))
    both = events if state is None else state.select(PATIENT, "template_field_id", "newest").unionByName(events)
    return both.groupBy(PATIENT, "template_field_id").agg(F.max("newest").alias("newest"))


def in_force(visits: DataFrame, state: DataFrame, fields: dict[str, int]) -> DataFrame:
    """``visits`` with the state's answer to each field wherever the visit's own lookup found none."""
    wide = state.where(F.col("template_field_id").isin(list(fields.values()))).groupBy(F.col(PATIENT).alias("_patient")).agg(*[
        F.max(F.when(F.col("template_field_id") == f, F.col("newest"))).alias(f"_{n}") for n, f in fields.items()])
    out = visits.join(wide, F.col(PATIENT) == F.col("_patient"), "left")
    return out.withColumns({n: F.when(F.col(f"{n}_day").isNotNull(), F.col(n)).otherwise(F.col(f"_{n}.value")) for n in fields}).drop(
        "_patient", *[f"_{n}" for n in fields])


def covers(until: date, start: date) -> bool:
    """Whether a state up to ``until`` ends on the day before ``start``."""
    return until == start - timedelta(days=1)
