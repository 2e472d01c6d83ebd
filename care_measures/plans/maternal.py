"""Maternal and perinatal measures."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from ..functions.expressions import (PLACEHOLDERS, first_present, flag, like, or_blank, try_date, try_int,
                                     us_date, within)
from ..functions.periods import Period
from ..operators.filters import cohort
from ..operators.observations import PATIENT, in_window, observe, on_day
from ..operators.ranking import earliest_per_key, latest_per_key
from ..operators.report import report
from ..sources import views
from ..sources.tables import Source
from .common import controls, latest_visit, notes, one_row, with_fields


def _initial_ob_notes(src: Source, p: Period) -> DataFrame:
    forms = src.table("template").where(like("template_name", "%initial acog%")).select("template_id")
    return views.notes_between(src, p.start, p.end).join(forms, "template_id")


def maternal_depression(src: Source, as_of: date) -> DataFrame:
    """Last initial OB note of the month: PHQ-9 recorded that day, latest trimester first."""
    p = Period.previous_month(as_of)
    ob = _initial_ob_notes(src, p)
    v = latest_visit(ob, views.providers(src), views.departments(src))
    v = v.join(views.patients(src, as_of), PATIENT)
    # A score counts when it was recorded on the visit's day; the day's newest is taken.
    number = lambda s: ~F.trim(s).isin(list(PLACEHOLDERS)) & try_int(s).isNotNull()
    v = observe(v, ob, controls(src), {"t1": on_day(15095, keep=number), "t2": on_day(15096, keep=number),
                                       "t3": on_day(15097, keep=number)}, p.end, p.start)
    score = F.coalesce("t3", "t2", "t1")
    return report(v, {
        "Provider": "provider_name", "Clinic": "short_name", "Patient ID": "patientid",
        "Initial OB Date": us_date("note_datetime"), "PHQ9 Documented": flag(score.isNotNull()),
        "PHQ9 Score": or_blank(score)}, ["Provider", "Patient ID"])


# Outcomes that leave a patient out of the birth-weight report.
LOST_PREGNANCY = (
    "AB/TAB/EAB", "Decline to state", "Fetal Demise / Neo. Death", "Letter sent / Lost to F/U", "SAB / Miscarriage",
)


def perinatal_health(src: Source, as_of: date) -> DataFrame:
    """Deliveries of the month by birth-weight class of the first recorded of three fields."""
    p = Period.previous_month(as_of)
    value = F.col("data_value")
    lost = with_fields(src, (15476,), p.start, p.end, F.trim(value).isin(list(LOST_PREGNANCY)))

    weighed = controls(src).where(F.col("template_field_id").isin(15127, 15141, 15142)
                                  & ~F.trim(value).isin(list(PLACEHOLDERS))).select("patient_note_id")
    seen = views.notes_between(src, p.start, p.end).join(weighed, "patient_note_id", "left_semi")
    v = latest_visit(seen, views.providers(src), views.departments(src))
    # The delivery date may be recorded in a note of any day, so the notes are not limited by date.
    v = observe(v, notes(src), controls(src), {
        "due": in_window(15085, keep=lambda d: try_date(d).between(p.start, p.end)), "delivery": on_day(15085),
        "w1": on_day(15127), "w2": on_day(15141), "w3": on_day(15142)})
    v = cohort(v.where(F.col("due_day").isNotNull()), PATIENT, exclude=[lost])
    v = v.join(one_row(views.patients(src, as_of, unique=False)), PATIENT)
    weights = ("w1", "w2", "w3")

    def weight_class(prefix: str):
        return first_present(weights, lambda w: flag(like(w, prefix)))

    return report(v, {
        "Clinic": "short_name", "Provider": "provider_name", "Patient ID": "patientid", "DOS": "delivery",
        "Description": first_present(weights, F.upper), "<1500g": weight_class("very low%"),
        "1501g TO 2500g": weight_class("low%"), ">2500g": weight_class("normal%")}, ["Provider", "Patient ID"])


def prenatal_trimester(src: Source, as_of: date) -> DataFrame:
    """Initial OB notes of the month with the trimester in which care began, here or elsewhere."""
    p = Period.previous_month(as_of)
    here, elsewhere = (12164, 12166, 12168), (12165, 12167, 12169)
    ticked = (notes(src).where(within("note_datetime", p.start, p.end))
              .select("patient_note_id", PATIENT, "note_datetime")
              .join(controls(src).where((F.col("data_value") == "1")
                                        & F.col("template_field_id").isin(*here, *elsewhere)), "patient_note_id")
              .join(src.table("template_field"), "template_field_id"))
    tie = ["patient_note_id", "field_name"]
    first = earliest_per_key(ticked.where(F.col("template_field_id").isin(*here)), [PATIENT], ["note_datetime"], tie)
    last = latest_per_key(ticked.where(F.col("template_field_id").isin(*elsewhere)), [PATIENT], ["note_datetime"], tie)

    ob = views.in_hours(src, _initial_ob_notes(src, p), "note_datetime")
    v = ob.join(src.table("staff").select("doctorid", "fullname"), "doctorid")
    v = v.join(views.patients(src, as_of, unique=False), PATIENT)
    v = (v.join(first.select(PATIENT, F.col("field_name").alias("here")), PATIENT, "left")
         .join(last.select(PATIENT, F.col("field_name").alias("elsewhere")), PATIENT, "left"))
    return report(v, {
        "Provider": "fullname", "Patient ID": "patientid", "DOS": us_date("note_datetime"),
        "Description": F.coalesce(F.right("here", F.lit(7)), F.right("elsewhere", F.lit(6)), F.lit("")),
        "Begin With First Trimester": flag(F.col("here").isNotNull())}, ["Provider", "Patient ID", "DOS"])
