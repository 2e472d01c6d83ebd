"""Entity-attribute-value lookups: note fields by patient, day and field id.

Measures look fields up for one visit per patient. ``observe`` answers all their lookups
(same day, newest in a window, newest up to the day) in one pass over the notes of the
patients seen. Where a patient has several visits the values are first reduced to one row
per patient and day (``daily_observations``), and the lookups compare days.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.expressions import day, within
from .lookup import running_last

Fields = Mapping[str, Sequence[int]]
Keep = Callable[[Column], Column]

PATIENT = "patientprofileid"


@dataclass(frozen=True)
class Lookup:
    """Newest accepted value of some fields; ``when`` compares its day with the visit's."""

    fields: Sequence[int]
    when: Callable[[Column, Column], Column]
    keep: Keep | None = None
    prefer: Keep | None = None
    since: date | None = None  # no earlier note counts


def on_day(*fields: int, keep: Keep | None = None) -> Lookup:
    return Lookup(fields, lambda d, visit: d == visit, keep)


def up_to_day(*fields: int, since: date | None = None) -> Lookup:
    if since is None:
        return Lookup(fields, lambda d, visit: d <= visit)
    return Lookup(fields, lambda d, visit: (d <= visit) & (d >= F.lit(since)), since=since)


def in_window(*fields: int, start: date | None = None, end: date | None = None, keep: Keep | None = None,
              prefer: Keep | None = None) -> Lookup:
    def when(d: Column, visit: Column) -> Column:
        after = F.lit(True) if start is None else d >= F.lit(start)
        return after if end is None else after & (d <= F.lit(end))

    return Lookup(fields, when, keep, prefer, start)


def observe(visits: DataFrame, notes: DataFrame, controls: DataFrame, lookups: Mapping[str, Lookup],
            end: date | None = None, start: date | None = None, visit_day: str = "day") -> DataFrame:
    """``visits`` with a value and a day (``name``, ``name_day``) for each lookup.

    ``visits`` holds one row per patient. Notes from ``start`` to ``end`` are first cut down
    to the patients seen, then joined with the wanted fields and reduced by patient with a
    partial aggregate, so the field table is read once whatever the number of lookups and
    no pairs of visits and values are formed beyond one per value.
    """
    seen = visits.select(F.col(PATIENT).alias("_patient"), F.col(visit_day).alias("_visit_day"))
    long = long_observations(notes.join(seen, F.col(PATIENT) == F.col("_patient")),
                 controls, {n: x.fields for n, x in lookups.items()}, start, end, "_visit_day")
    d = day("note_datetime")
    best = long.groupBy(F.col(PATIENT).alias("_patient")).agg(*[
        _newest(x.fields, x.keep, x.prefer, x.when(d, F.col("_visit_day"))).alias(n)
        for n, x in lookups.items()])
    best = best.select("_patient", *[c for n in lookups for c in (
        F.col(n)["value"].alias(n), day(F.col(n)["at"]).alias(f"{n}_day"))])
    return visits.join(best, F.col(PATIENT) == F.col("_patient"), "left").drop("_patient")


def long_observations(notes: DataFrame, controls: DataFrame, fields: Fields, start: date | None,
          end: date | None, *extra: str) -> DataFrame:
    """(patient, timestamp, note, field, value) of the wanted fields and days."""
    ids = sorted({i for f in fields.values() for i in f})
    n = notes.select("patient_note_id", PATIENT, "note_datetime", *extra)
    if start is not None:
        n = n.where(within("note_datetime", start, end))
    elif end is not None:
        n = n.where(F.col("note_datetime") < F.date_add(F.lit(end), 1))
    c = controls.where(F.col("template_field_id").isin(ids)).select(
        "patient_note_id", "template_field_id", "data_value")
    return n.join(c, "patient_note_id")


def _newest(ids: Sequence[int], keep: Keep | None, prefer: Keep | None,
            when: Column | None = None) -> Column:
    """Newest accepted (timestamp, value) of a field; note id and value break ties."""
    value = F.col("data_value")
    ok = F.col("template_field_id").isin(list(ids))
    if when is not None:
        ok = ok & when
    if keep is not None:
        ok = ok & keep(value)
    first = [] if prefer is None else [prefer(value).alias("preferred")]
    best = F.struct(F.col("note_datetime").alias("at"), *first, F.col("patient_note_id"),
                    value.alias("value"))
    return F.max(F.when(ok, best))


def daily_observations(notes: DataFrame, controls: DataFrame, fields: Fields,
                       start: date | None = None, end: date | None = None,
                       keep: Mapping[str, Keep] | Keep | None = None) -> DataFrame:
    """One row per patient and day, one column per name: the day's newest accepted value.

    ``fields`` maps an output column to the field ids it accepts; ``keep`` is a test on the
    value, for all columns or per column.
    """
    long = long_observations(notes, controls, fields, start, end)
    best = {n: _newest(ids, keep.get(n) if isinstance(keep, Mapping) else keep, None)
            for n, ids in fields.items()}
    return (long.groupBy(PATIENT, day("note_datetime").alias("day"))
            .agg(*[c["value"].alias(n) for n, c in best.items()]))


def latest_observations(notes: DataFrame, controls: DataFrame, fields: Fields,
                        start: date | None, end: date | None,
                        keep: Mapping[str, Keep] | Keep | None = None,
                        prefer: Mapping[str, Keep] | None = None) -> DataFrame:
    """One row per patient: newest accepted value ``name`` and its day ``name_day``.

    ``prefer`` ranks values of the same timestamp before the note id does.
    """
    long = long_observations(notes, controls, fields, start, end)
    out = long.groupBy(PATIENT).agg(*[
        _newest(ids, keep.get(n) if isinstance(keep, Mapping) else keep,
                (prefer or {}).get(n)).alias(n) for n, ids in fields.items()])
    return out.select(PATIENT, *[c for n in fields for c in (
        F.col(n)["value"].alias(n), day(F.col(n)["at"]).alias(f"{n}_day"))])


def observations_exact(visits: DataFrame, daily: DataFrame, visit_day: str = "day") -> DataFrame:
    """``visits`` with the columns of ``daily`` on exactly the visit's day."""
    d = daily.withColumnsRenamed({PATIENT: "_patient", "day": "_day"})
    return visits.join(
        d, (F.col(PATIENT) == F.col("_patient")) & (F.col(visit_day) == F.col("_day")), "left"
    ).drop("_patient", "_day")


def observations_asof(visits: DataFrame, daily: DataFrame, visit_day: str = "day") -> DataFrame:
    """``visits`` with the newest non-NULL value of each column up to the visit's day."""
    names = [c for c in daily.columns if c not in (PATIENT, "day")]
    return running_last(visits, daily, [PATIENT], visit_day, "day", names)


def consent_flags(visits: DataFrame, notes: DataFrame, controls: DataFrame, telehealth: int,
                  telephone: int, end: date, visit_day: str = "day") -> DataFrame:
    """Telehealth and telephone consent in force on the visit's day."""
    daily = daily_observations(notes, controls, {"telehealth_consent": [telehealth],
                                                 "telephone_consent": [telephone]}, end=end)
    return observations_asof(visits, daily, visit_day)
