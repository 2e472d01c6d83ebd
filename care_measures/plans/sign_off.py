"""Sign-off and follow-through within business days."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from ..functions.expressions import (business_day_diff, ci, day, is_any, not_like_all, or_blank,
                                     us_date, within, yes_no)
from ..functions.periods import Period
from ..operators.filters import exclude_by_name
from ..operators.observations import PATIENT
from ..operators.report import report
from ..operators.slots import slot_join
from ..sources import views
from ..sources.tables import Source


def notes_signed_off(src: Source, as_of: date) -> DataFrame:
    """Medical and two listed specialty notes of the month, signed within one business day."""
    p = Period.previous_month(as_of)
    dept = views.departments(src).select(F.col("departmentid").alias("dept_id"), "short_name")
    cols = ("patient_note_id", PATIENT, "note_datetime", "update_datetime", "short_name", "template_id",
            "doctorid", "signedby", "provider", "template_name")
    phys = views.providers(src)
    medical = (views.in_hours(src, views.medical_notes(src, p.start, p.end, "sign_off"), "note_datetime")
               .join(dept, "dept_id").join(views.without(src, phys), "doctorid")
               .withColumn("provider", F.concat("last_name", F.lit(", "), "first_name", F.lit(", "), "degree")))
    listed = src.table("template").where(F.col("template_id").isin(2500, 2710)).select("template_id", "template_name")
    special = (views.notes_between(src, p.start, p.end).join(listed, "template_id")
               .join(dept, "dept_id").join(phys, "doctorid")
               .withColumn("provider", F.concat_ws(", ", "provider_name", "degree")))
    n = medical.select(*cols).unionByName(special.select(*cols)).distinct()
    n = n.join(views.patients(src, as_of).select(PATIENT, "patientid"), PATIENT)
    signed_day, start_day = F.col("update_datetime"), day("note_datetime")
    blank = (F.col("signedby") <= 0) | signed_day.isNull() | (signed_day < start_day)
    gap = business_day_diff(start_day, day("update_datetime"), src.config.holidays)
    return report(n, {
        "Provider": "provider", "Met Goal": yes_no(gap <= 1),
        "Signed": F.when(F.col("signedby") <= 0, 0).otherwise(1), "Clinic": "short_name",
        "Patient ID": "patientid", "Note ID": "patient_note_id", "Start Date": us_date("note_datetime"),
        "SignOff Date": F.when(blank, "").otherwise(us_date("update_datetime")),
        "template_name": "template_name"}, ["Provider", "Patient ID", "Note ID"])


def superbill_signed_off(src: Source, as_of: date) -> DataFrame:
    """Superbills created in the month for kept visits, signed within one business day.

    As written the name filter binds to the second doctor only: a first doctor matches
    whatever the name.
    """
    p = Period.previous_month(as_of)
    all_types, listed = src.table("visit_type"), (53915600, 53915594, 58788109, 58788107)
    types = views.visit_types(src, "valid").union(all_types.where(F.col("visit_type_id").isin(*listed))).distinct()
    types = exclude_by_name(types, "description", ("%cpsp%", "OB%", "nurse%", "cm%", "dental%", "mat%"))
    appts = views.in_hours(src, src.table("patientappt").where(ci("status") == "appt kept"), "booking_date")
    appts = appts.join(types, "visit_type_id").select("appointmentid", "description")

    bills = src.table("superbill").where(within("created_date", p.start, p.end)).withColumnRenamed(
        "doctorid", "doctor1id")
    dept = views.departments(src).select(F.col("departmentid").alias("dept_id"), "short_name")
    seen = bills.join(dept, "dept_id").join(appts, "appointmentid")
    phys = views.providers(src).select("doctorid", "provider_name")
    matched = slot_join(seen, ("doctor1id", "doctor2id"), phys, "doctorid").where(
        (F.col("doctorid") == F.col("doctor1id")) | not_like_all("provider_name", ("%cpsp%",)))
    people = views.patients(src, as_of, unique=False).select(PATIENT, "patientid")
    d = matched.join(people, PATIENT).select(
        "superbill_datetime", "patientid", F.when(F.col("signedby") <= 0, 0).otherwise(1).alias("signed"),
        "short_name", "provider_name", "created_date", "update_datetime", "description").distinct()
    gap = business_day_diff(day("created_date"), day("update_datetime"), src.config.holidays)
    return report(d, {
        "signed": "signed", "Clinic": "short_name", "Provider": "provider_name", "Patient ID": "patientid",
        "Start Date": us_date("created_date"), "Signedoff Date": us_date("update_datetime"),
        "description": "description", "METGOAL": yes_no(gap <= 1)}, ["Clinic", "Provider", "Patient ID", "Start Date", "description"])


# Document types that need a provider's signature.
SIGNED_DOCUMENT_TYPES = (
    "BCP", "Consult Report", "Health Assessment", "History & Physical", "Hospital Record", "Lab",
    "Old Clinical Notes", "SOAP Note", "X-Ray/Ultrasound",
)


def document_sign_off(src: Source, as_of: date, against: str = "doc_date") -> DataFrame:
    """Documents of the month signed within three and five business days.

    As written the days run from import to document date; ``against="update_datetime"``
    measures to the sign-off instead.
    """
    p = Period.previous_month(as_of)
    types = src.table("lookups").where(is_any("lookup_item", SIGNED_DOCUMENT_TYPES)).select(
        F.col("lookup_id").alias("doc_type_id"))
    docs = src.table("document").where(within("doc_date", p.start, p.end)).join(types, "doc_type_id", "left_semi")
    dept = views.departments(src).select(F.col("departmentid").alias("dept_id"), "short_name")
    staff = src.table("staff").select(F.col("staffid").alias("signedby"), "fullname")
    d = (docs.join(views.providers(src).select("doctorid", "provider_name"), "doctorid").join(dept, "dept_id")
         .join(staff, "signedby", "left")
         .join(views.patients(src, as_of, unique=False).select(PATIENT, "patientid"), PATIENT))
    signed = F.col("fullname").isNotNull()
    gap = business_day_diff(day("created_date"), day(against), src.config.holidays)
    return report(d, {
        "Provider": "provider_name", "Signed within 3 days": yes_no(signed & (gap <= 3)),
        "Signed within 5 days": yes_no(signed & (gap <= 5)), "Signed": yes_no(signed), "Clinic": "short_name",
        "Patient ID": "patientid", "Doc Date": us_date("doc_date"), "Document ID": "document_id",
        "Import Date": us_date("created_date"),
        "SignOff Date": F.when(signed, us_date("update_datetime")).otherwise(""),
        "Signed By": or_blank("fullname"), "File Name": "file_name"}, ["Provider", "Patient ID", "Document ID"])


def hospital_tracking(src: Source, as_of: date, teams: tuple[int, ...] = (8961, 8962)) -> DataFrame:
    """Team notifications of the month, completed within ten and two business days.

    Open notifications show 0 days, the value an empty text takes as a number.
    """
    p = Period.previous_month(as_of)
    rules = src.table("notification_rule").where("active_flag = 1").select("notification_rule_id")
    n = src.table("notification").where(
        (F.col("company_id") == src.config.company_id) & F.col("teamid").isin(list(teams))
        & within("notif_date", p.start, p.end))
    dept = views.departments(src).select(F.col("departmentid").alias("deptid"), "short", "short_name")
    n = (n.join(rules, "notification_rule_id").join(views.providers(src).select("doctorid", "provider_name"), "doctorid")
         .join(dept, "deptid").join(views.patients(src, as_of, unique=False).select(PATIENT, "patientid"), PATIENT))
    done = F.col("completed_datetime").isNotNull()
    gap = business_day_diff(day("notif_date"), day("completed_datetime"), src.config.holidays)
    return report(n, {
        "Patient ID": "patientid", "Notification ID": "notification_id", "Notification Date": us_date("notif_date"),
        "Template Name": "item_description", "Provider": "provider_name", "Department": "short",
        "Notification Completed": yes_no(F.col("completed_flag") == 1),
        "Completed Date": or_blank(us_date("completed_datetime")),
        "Days to Complete": F.when(done, gap).otherwise(0), "Met": yes_no(done & (gap <= 10)),
        "Met2": yes_no(done & (gap <= 2)), "short_name": "short_name", "team_name": F.trim("team_name"),
        "teamid": "teamid"})
