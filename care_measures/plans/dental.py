"""Dental measures."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import valuesets as vs
from ..functions.expressions import (age_band, ci, day, flag, is_any, like, like_any, or_blank, us_date, within, yes_no)
from ..functions.periods import Period
from ..operators.filters import cohort, ids_of
from ..operators.lookup import follow_up_within
from ..operators.observations import PATIENT
from ..operators.ranking import latest_per_key
from ..operators.report import report
from ..operators.slots import slot_join
from ..sources import views
from ..sources.tables import Source
from .common import one_row


def _chart(src: Source, start: date, end: date, codes: Column | None) -> DataFrame:
    """Completed, current chart entries of the window, with their code."""
    log = src.table("ddb_proc_log").where(
        (F.col("chart_status") == 102) & (F.col("history") == 0) & within("pldate", start, end))
    log = log.select("patid", "pldate", "proc_codeid", "provid", "clinicappliedto")
    if codes is None:
        return log
    dim = src.table("ddb_proc_code").where(codes).select("proc_codeid", "adacode")
    return log.join(dim, "proc_codeid")


def _with_provider(src: Source, chart: DataFrame) -> DataFrame:
    return chart.join(views.dental_providers(src), "provid").join(views.dental_clinics(src), "clinicappliedto")


def _exam_measure(src: Source, as_of: date, exams: Column | None, evidence: Column,
                  ages: tuple[int, int] | None) -> DataFrame:
    """Patients by their last listed exam of the month, with the last evidence code or NULL."""
    p = Period.previous_month(as_of)
    tie = ["adacode"] if exams is not None else []
    e = _with_provider(src, _chart(src, p.start, p.end, exams)).select(
        "patid", "pldate", *tie, "provider", "clinic")
    e = latest_per_key(e, ["patid"], ["pldate"], [*tie, "provider", "clinic"])
    people = views.dental_patients(src, as_of)
    if ages is not None:
        people = people.where(F.col("age").between(*ages))
    found = (_chart(src, p.start, p.end, evidence).groupBy("patid")
             .agg(F.max(F.struct("pldate", "adacode"))["adacode"].alias("evidence")))
    return e.join(people, "patid").join(found, "patid", "left")


def caries_risk(src: Source, as_of: date) -> DataFrame:
    """Examined patients of 10 to 20: caries risk coded in the month."""
    d = _exam_measure(src, as_of, is_any(F.trim("adacode"), vs.DENTAL_EXAMS), is_any("adacode", vs.CARIES_RISK), (10, 20))
    return report(d, {
        "Provider": "provider", "Clinic": "clinic", "Patient ID": "patextid", "Age": "age",
        "Procedure Code": "adacode", "DOS": us_date("pldate"),
        "Caries Risk Assesed": yes_no(F.col("evidence").isNotNull())}, ["Provider", "Patient ID"])


def diagnostic_treatment(src: Source, as_of: date) -> DataFrame:
    """Recall exams of patients of 4 to 20: X-rays taken in the month."""
    d = _exam_measure(src, as_of, is_any(F.trim("adacode"), vs.DENTAL_RECALL), is_any("adacode", vs.DENTAL_XRAYS), (4, 20))
    return report(d, {
        "Provider": "provider", "Clinic": "clinic", "Patient ID": "pataccountnumber", "Age": "age",
        "DOS": us_date("pldate"), "X-ray Code": or_blank("evidence"),
        "X-ray Completed": yes_no(F.col("evidence").isNotNull())}, ["Provider", "Patient ID"])


def fluoride(src: Source, as_of: date) -> DataFrame:
    """Children to 5 at moderate or high risk: fluoride in the month."""
    d = _exam_measure(src, as_of, is_any(F.trim("adacode"), vs.CARIES_MODERATE_HIGH), is_any("adacode", vs.FLUORIDE), (0, 5))
    return report(d, {
        "Provider": "provider", "Clinic": "clinic", "Patient ID": "pataccountnumber", "Age": "age",
        "Risk Coded": "adacode", "DOS": us_date("pldate"),
        "Fluoride Treatment": yes_no(F.col("evidence").isNotNull())}, ["Provider", "Patient ID"])


def restorative(src: Source, as_of: date) -> DataFrame:
    """Any completed procedure in the month: restorative treatment by age range."""
    d = _exam_measure(src, as_of, None, like_any("adacode", vs.RESTORATIVE_PATTERNS), None)
    return report(d, {
        "Provider": "provider", "Clinic": "clinic", "Patient ID": "pataccountnumber",
        "Age Range": age_band("age", "NA"), "DOS": us_date("pldate"),
        "Restorative Treatment": yes_no(F.col("evidence").isNotNull())}, ["Provider", "Age Range", "Patient ID"])


def crown_delivery(src: Source, as_of: date) -> DataFrame:
    """Crown impressions of the prior month: delivery within 28 days, one row per pair of dates."""
    p = Period.previous_month(as_of)
    prior = p.prior_month()
    delivered = _chart(src, prior.start, p.end, is_any("adacode", vs.CROWN_DELIVERY)).select(
        "patid", day("pldate").alias("delivered")).distinct()
    taken = _with_provider(src, _chart(src, prior.start, prior.end, is_any("adacode", vs.CROWN_IMPRESSION))).select(
        "patid", day("pldate").alias("taken"), "provider", "clinic").distinct()
    d = follow_up_within(taken.join(views.dental_patients(src, as_of), "patid"), delivered, "patid", "taken",
                         "delivered", 28, "within")
    return report(d, {
        "Provider": "provider", "Clinic": "clinic", "Patient ID": "pataccountnumber",
        "Impression Taken": us_date("taken"), "Crown Delivered": or_blank(us_date("delivered")),
        "Within 28 Days": "within"}, ["Provider", "Patient ID"])


def sealant(src: Source, as_of: date) -> DataFrame:
    """Sealant candidates of 6 to 9 with risk coded in the prior month; the placer is the provider."""
    p = Period.previous_month(as_of)
    prior = p.prior_month(end="clamped")
    candidates = ids_of(_chart(src, prior.start, p.end, is_any("adacode", vs.SEALANT_CANDIDATE)), "patid")
    placed = (_chart(src, prior.start, p.end, is_any("adacode", vs.SEALANT)).join(views.dental_providers(src), "provid")
              .select("patid", day("pldate").alias("sealed"), F.col("provider").alias("placer")).distinct())
    risk = _with_provider(src, _chart(src, prior.start, prior.end, is_any("adacode", vs.CARIES_RISK))).select(
        "patid", day("pldate").alias("assessed"), "provider", "clinic").distinct()
    people = views.dental_patients(src, as_of).where(F.col("age").between(6, 9))
    d = cohort(risk.join(people, "patid"), "patid", include=[candidates]).join(placed, "patid", "left")
    # Rows that differ only in a provider the placer replaces fall together.
    d = d.withColumn("provider", F.coalesce("placer", "provider")).select(
        "patid", "patextid", "pataccountnumber", "provider", "clinic", "age", "assessed", "sealed").distinct()
    return report(d, {
        "Provider": "provider", "Clinic": "clinic", "Patient ID": "pataccountnumber", "Age": "age",
        "Mod to High Risk Assessed": us_date("assessed"), "Sealant Date": or_blank(us_date("sealed")),
        "Sealant Placed": yes_no(F.col("sealed").isNotNull())}, ["Provider", "Patient ID"])


def phase_one_exam(src: Source, as_of: date) -> DataFrame:
    """Last dental exam charge of the year per patient: phase one completed or not."""
    p = Period.previous_month(as_of)
    ch = src.table("view_chargehistory").where(within("post_fromdate", p.lookback(years=1), p.end))
    dept = src.table("department").where(like("listname", "%dental%") & ~like("listname", "zz%")).select(
        F.col("departmentid").alias("department_id"), "short_name")
    dentist = is_any("degree", ("DMD", "DDS")) & (ci("active_yn") == "y")
    slots = ("physician_id", "physician_id_2")

    def charged(charges: DataFrame, codes: tuple[str, ...], phys: DataFrame, key: str) -> DataFrame:
        dim = views.procedures(src).where(is_any("procedure_code", codes)).select("procedure_id", "procedure_code")
        return slot_join(charges.join(dim, "procedure_id").join(dept, "department_id"), slots, phys, key)

    phys = src.table("physician").where(dentist).select(
        "phys_id", F.concat_ws(", ", "last_name", "first_name").alias("provider_name"))
    exams = charged(ch.where(F.col("status").isin(0, 1)), vs.DENTAL_EXAMS, phys, "phys_id").select(
        F.col("patient_id").alias(PATIENT), day("post_fromdate").alias("exam_day"), "post_fromdate",
        "provider_name", "procedure_code", "short_name")
    exams = latest_per_key(exams, [PATIENT], ["exam_day"],
                           ["post_fromdate", "provider_name", "procedure_code", "short_name"])
    done = charged(ch, vs.PHASE_ONE_COMPLETED, views.providers(src).where(dentist).select("doctorid"), "doctorid")
    people = views.patients(src, as_of, unique=False)
    done = ids_of(done, "patient_id").select(F.col("id").alias(PATIENT), F.lit(True).alias("done"))
    d = exams.join(one_row(people), PATIENT).join(done, PATIENT, "left")
    return report(d, {
        "Exam Provider": "provider_name", "Patient ID": "patientid", "Age Range": age_band("age2"),
        "Clinic": "short_name", "Exam Date": us_date("post_fromdate"), "Procedure Code": "procedure_code",
        "Met": flag(F.col("done"))}, ["Exam Provider", "Age Range", "Patient ID"])
