"""Vital-sign and counselling measures on the month's last visit."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from ..functions import valuesets as vs
from ..functions.expressions import (bp_final_controlled, bp_first_controlled, flag, like_any, not_like_all,
                                     or_blank, try_int, us_date, yes_no)
from ..functions.periods import Period
from ..functions.valuesets import ValueSet
from ..operators.filters import cohort, of_cohort
from ..operators.observations import PATIENT, in_window, on_day
from ..operators.report import report
from ..sources import views
from ..sources.tables import Source
from .common import controls, diagnosed, latest_visit, look_up, notes, one_row, pregnant


def adult_weight(src: Source, as_of: date) -> DataFrame:
    """Adults seen in the month and not pregnant: BMI, range and follow-up plan.

    As written the BMI must be recorded on the visit's day, while its range is judged by
    the newest value of the month.
    """
    p = Period.previous_month(as_of)
    v = latest_visit(views.medical_notes(src, p.start, p.end), views.without(src, views.medical_providers(src)))
    v = look_up(src, v.join(views.patients(src, as_of).where("age >= 18"), PATIENT), p, bmi=on_day(1719),
                plan=on_day(14466), month_bmi=in_window(1719, start=p.start))
    v = cohort(v, PATIENT, exclude=[pregnant(src, p)])
    in_range = F.col("month_bmi").try_cast("decimal(10,2)").between(18.5, 24.9)
    v = v.withColumns({"recorded": flag(F.col("bmi").isNotNull()),
                       "out": F.when(F.col("bmi").isNull(), 1).when(in_range, 0).otherwise(1),
                       "planned": F.coalesce(try_int("plan"), F.lit(0))})
    lacking = (F.col("recorded") == 0) | ((F.col("out") == 1) & (F.col("planned") == 0))
    return report(v, {
        "Provider": "provider_name", "Patient ID": "patientid", "Age": "age", "Last BMI": or_blank("bmi"),
        "BMI Recorded": "recorded", "Out Of Range": "out", "Wt Mgmt F/u Plan": "planned",
        "Documented": yes_no(~lacking), "Patient Consents to Telehealth Visit": "telehealth_consent",
        "Patient Consents to TelePhone Visit": "telephone_consent"}, ["Provider", "Patient ID"])


def blood_pressure(src: Source, as_of: date) -> DataFrame:
    """Patients of 18 to 85 with a reading this month: control by the first and second reading."""
    p = Period.previous_month(as_of)
    seen = views.in_hours(src, views.medical_notes(src, p.start, p.end), "note_datetime")
    v = latest_visit(seen, views.providers(src), views.departments(src))
    v = v.join(views.patients(src, as_of).where(F.col("age").between(18, 85)), PATIENT)
    number = lambda value: try_int(value).isNotNull()
    v = look_up(src, v, p, read=in_window(12848, 12849, 13259, 13260, start=p.start), s1=on_day(12848, keep=number),
                d1=on_day(12849, keep=number), s2=on_day(13259, keep=number), d2=on_day(13260, keep=number))
    v = v.where(F.col("read_day").isNotNull())
    company = F.col("company_id") == src.config.company_id
    ill = diagnosed(src, views.company_diagnoses(src).where(company),
                    ValueSet(patterns=vs.DIABETES_OR_CKD_PATTERNS), p.lookback(months=4), p.end, company)
    v = v.join(ill.select(F.col("id").alias(PATIENT), F.lit(True).alias("ill")), PATIENT, "left")
    well = F.col("ill").isNull()
    v = v.withColumn("first_ok", bp_first_controlled(F.col("age"), well, F.col("s1"), F.col("d1")))
    final = bp_final_controlled(F.col("age"), well, F.col("first_ok"), F.col("s2"), F.col("d2"))
    return report(v, {
        "Provider": "provider_name", "Clinic": "short_name", "Patient ID": "patientid", "Age": "age",
        "No DM or CKD": flag(well).cast("string"), "Last DOS": us_date("note_datetime"),
        "DOB": us_date("birthdate"), "1st Systolic BP": or_blank("s1"), "1st Diastolic BP": or_blank("d1"),
        "1st BP Controlled": flag(F.col("first_ok")).cast("string"), "2nd Systolic BP": or_blank("s2"),
        "2nd Diastolic BP": or_blank("d2"), "Final BP Controlled": yes_no(final),
        "Patient Consents to telehealth Visits": "telehealth_consent",
        "Patient Consents to telephone Visits": "telephone_consent"},
        ["Provider", "Clinic", "Patient ID", "Last DOS"])


def patient_vitals(src: Source, as_of: date) -> DataFrame:
    """Patients of 3 and over: six vitals recorded on the day of the last medical or specialty note."""
    p = Period.previous_month(as_of)
    specialty = src.table("template").where(
        like_any("template_name", ("gyn%", "ob%", "opto%", "podia%"))).select("template_id")
    cols = (PATIENT, "dept_id", "doctorid", "note_datetime")
    first = views.notes_between(src, p.start, p.end).join(specialty, "template_id").select(*cols)
    medical = views.in_hours(src, views.medical_notes(src, p.start, p.end), "note_datetime").select(*cols)
    phys = views.providers(src, include_inactive=True).where(not_like_all("provider_name", ("%cpsp%",)))
    # The union is distinct, but only one row per patient is kept, so duplicates need no pass of their own.
    v = latest_visit(first.unionByName(medical), phys, views.departments(src), tiebreak=("doctorid", "dept_id"))
    v = v.join(views.patients(src, as_of).where("age >= 3"), PATIENT)
    vitals = {"Height": on_day(1716), "Weight": on_day(1717), "BP": on_day(12848), "Temperature": on_day(1347),
              "Pulse": on_day(11253), "Respiratory": on_day(11254)}
    v = look_up(src, v, p, **vitals)
    met = F.greatest(*[F.col(n).isNull() for n in vitals])
    return report(v, {
        "Clinic": "short_name", "Provider": "provider_name", "Patient ID": "patientid", "Age": "age",
        "DOS": us_date("note_datetime"), "MET": yes_no(~met), **{n: flag(F.col(n).isNotNull()) for n in vitals},
        "Patient Consents to Telehealth Visit": "telehealth_consent",
        "Patient Consents to TelePhone Visit": "telephone_consent"}, ["Clinic", "Provider", "Patient ID"])


def pediatric_weight(src: Source, as_of: date) -> DataFrame:
    """Patients of 3 to 17, not pregnant: nutrition and activity counselling with vitals that day."""
    p = Period.previous_month(as_of)
    recorded = controls(src).where(F.col("template_field_id").isin(14358, 14646, 14359)).select("patient_note_id")
    seen = views.in_hours(src, views.medical_notes(src, p.start, p.end), "note_datetime")
    v = latest_visit(seen.join(recorded, "patient_note_id", "left_semi"), views.providers(src))
    v = look_up(src, v.join(views.patients(src, as_of).where(F.col("age").between(3, 17)), PATIENT), p,
                nutrition=in_window(14359, start=p.start), activity=in_window(14358, start=p.start),
                vitals=in_window(14646, start=p.start))
    v = cohort(v, PATIENT, exclude=[pregnant(src, p)]).withColumns({
        "nutrition": F.coalesce(try_int("nutrition"), F.lit(0)),
        "activity": F.coalesce(try_int("activity"), F.lit(0))})
    met = ((F.col("nutrition") == 1) & (F.col("activity") == 1) & F.col("vitals").isNotNull()
           & (F.col("vitals_day") == F.col("day")))
    return report(v, {
        "Provider": "provider_name", "Patient ID": "patientid", "Age": "age", "DOS": us_date("note_datetime"),
        "Nutrition Counseling Doc'd": "nutrition", "Activity Counseling Doc'd": "activity", "Met": yes_no(met),
        "Patient Consents to telehealth Visits": "telehealth_consent",
        "Patient Consents to telephone Visits": "telephone_consent"}, ["Provider", "Patient ID"])


def last_dental_exam(src: Source, as_of: date) -> DataFrame:
    """Children from 12 months to 5 years seen in the month, with a dental exam within the year."""
    p = Period.previous_month(as_of)
    children = views.patients(src, as_of, unique=False).where("agemonth >= 12 AND age <= 5")
    v = latest_visit(views.medical_notes(src, p.start, p.end), views.providers(src), views.departments(src))
    v = v.join(one_row(children), PATIENT)
    exam_day = F.col("data_value").try_cast("date")
    exams = controls(src).where((F.col("template_field_id") == 9273)
                                & exam_day.between(p.lookback(years=1, anchor="end"), p.end))
    exams = (of_cohort(notes(src).select("patient_note_id", PATIENT), v, PATIENT).join(exams, "patient_note_id")
             .groupBy(PATIENT).agg(F.max(F.struct(exam_day.alias("on"), "data_value"))["data_value"].alias("exam")))
    return report(v.join(exams, PATIENT, "left"), {
        "Provider": "provider_name", "Clinic": "short_name", "Patient ID": "patientid", "Age": "age",
        "Age In Month": "agemonth", "Last Visit Date": us_date("note_datetime"),
        "Last Dental Exam": or_blank("exam"), "Exam in Last 12 Months": yes_no(F.col("exam").isNotNull())},
        ["Provider", "Clinic", "Patient ID"])
