"""Steps most measures share."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import valuesets as vs
from ..functions.expressions import day, within
from ..functions.periods import Period
from ..functions.valuesets import ValueSet
from ..operators.consents import covers, in_force
from ..operators.filters import ids_of
from ..operators.observations import PATIENT, Lookup, observe, up_to_day
from ..operators.ranking import latest_per_key
from ..operators.slots import slot_join
from ..sources import views
from ..sources.tables import Source

DX_SLOTS = ("diagnosis_id_1", "diagnosis_id_2", "diagnosis_id_3", "diagnosis_id_4")


def notes(src: Source) -> DataFrame:
    return src.table("patient_note")


def controls(src: Source) -> DataFrame:
    return src.table("patient_note_control")


def noted(src: Source, p: Period) -> DataFrame:
    """Patients with any note in the month: all that a medical measure can report on, and told by one narrow, filtered
    scan. Other tables are cut down to them before they are joined or aggregated; the ranked visits decide later."""
    return views.notes_between(src, p.start, p.end).select(PATIENT)


def one_row(patients: DataFrame) -> DataFrame:
    """A single row per patient, for measures that rank by patient but not by record."""
    return latest_per_key(patients, [PATIENT], ["patientid", "birthdate", "sex"])


def latest_visit(visits: DataFrame, providers: DataFrame, departments: DataFrame | None = None,
                 ts: str = "note_datetime", tiebreak: tuple[str, ...] = ("patient_note_id",)) -> DataFrame:
    """Newest visit of each patient with a listed provider (and department), with its day.

    Only small dimensions are joined before ranking, so one row per patient and input
    partition is shuffled; conditions on the patient are applied to the result.
    """
    v = visits.join(providers.select("doctorid", "provider_name"), "doctorid")
    cols = [PATIENT, ts, "provider_name", *tiebreak]
    if departments is not None:
        v = v.join(departments.select(F.col("departmentid").alias("dept_id"), "short_name"), "dept_id")
        cols.append("short_name")
    v = latest_per_key(v.select(*cols), [PATIENT], [ts],
                       [*tiebreak, *[c for c in cols if c not in (PATIENT, ts, *tiebreak)]])
    return v.withColumn("day", day(ts))


def look_up(src: Source, visits: DataFrame, p: Period, start: date | None = None, **lookups: Lookup) -> DataFrame:
    """Add note-field lookups and the two consents in force on the visit's day.

    Consents reach back through the whole history; measures without them pass ``start``. Where the
    source has a consent state up to the month, notes are read from the month on, or from the
    earliest day that another lookup asks for, and what was answered before comes from the state.
    Apply it to the ranked visits joined with patients only, and cohort conditions to its
    result: the visits are read once to find the notes and once to be joined back, and the
    ranked visits are one shuffle both readings share.
    """
    if start is not None:
        return observe(visits, notes(src), controls(src), lookups, p.end, start)
    others = [x.since for x in lookups.values()]
    fields = {"telehealth_consent": src.config.telehealth_consent_field,
              "telephone_consent": src.config.telephone_consent_field}
    lookups |= {n: up_to_day(f) for n, f in fields.items()}
    if src.consents is None or not covers(src.consents[1], p.start):
        return observe(visits, notes(src), controls(src), lookups, p.end)
    since = None if None in others else min([p.start, *others])
    return in_force(observe(visits, notes(src), controls(src), lookups, p.end, since), src.consents[0], fields)


def diagnosed(src: Source, dim: DataFrame, codes: ValueSet | None = None, start: date | None = None,
              end: date | None = None, where: Column | None = None) -> DataFrame:
    """Ids of patients with a charge whose diagnosis, in any slot, is in ``dim`` (and the set)."""
    ch = src.table("charge_history")
    if start is not None:
        ch = ch.where(within("post_fromdate", start, end))
    if where is not None:
        ch = ch.where(where)
    dx = (dim if codes is None else codes.filter(dim, "icd9")).select("diagnosis_id")
    return ids_of(slot_join(ch.select("patient_id", *DX_SLOTS), DX_SLOTS, dx, "diagnosis_id"), "patient_id")


def pregnant(src: Source, p: Period) -> DataFrame:
    return diagnosed(src, views.diagnoses(src), ValueSet(exact=vs.SUPERVISED_PREGNANCY),
                     p.lookback(years=1, anchor="end"), p.end)


def with_fields(src: Source, fields: tuple[int, ...], start: date, end: date,
                where: Column | None = None) -> DataFrame:
    """Ids of patients with a note in the window that records one of the fields."""
    c = controls(src).where(F.col("template_field_id").isin(list(fields)))
    c = c if where is None else c.where(where)
    n = notes(src).where(within("note_datetime", start, end)).select("patient_note_id", PATIENT)
    return ids_of(n.join(c.select("patient_note_id"), "patient_note_id"), PATIENT)
