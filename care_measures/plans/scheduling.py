"""Appointment status, rescheduling and cycle time."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from ..functions.expressions import (ci, classify_status, day, flag, is_any, like, like_any, minute_diff,
                                     not_like_all, or_blank, us_date, within)
from ..functions.periods import Period
from ..operators.booking import next_booking, responses_wide
from ..operators.events import milestones, stage_durations
from ..operators.filters import of_cohort
from ..operators.observations import PATIENT
from ..operators.report import report
from ..sources import views
from ..sources.tables import Source

# Fixed value: staff id under which patients cancel on the portal.
PORTAL_USER = 37465493

NO_SHOW_QUESTIONS = {"reason": "NO SHOW -  REASON", "first_attempt": "NO SHOW - 1ST ATTEMPT",
                     "second_attempt": "NO SHOW - 2ND ATTEMPT"}


def appointment_status(src: Source, as_of: date) -> DataFrame:
    """Bookings of the month with status, reasons and the next booking made in the month.

    The next booking has the same visit type and a later slot. Where several qualify the
    earliest is shown, also for statuses whose written order leaves the choice open.
    """
    p = Period.previous_month(as_of)
    types = views.bookable(views.visit_types(src, "ops")).select("visit_type_id", "short_desc")
    dept = views.departments(src).select("departmentid", "short_name", "short")
    appts = src.table("patientappt")
    b = appts.where(within("booking_date", p.start, p.end) & ~is_any("status", ("booked", "registered", "confirmed")))
    b = (b.join(types, "visit_type_id").join(dept, "departmentid")
         .join(views.providers(src).select("doctorid"), "doctorid").withColumn("slot_day", day("booking_date")))
    later = (appts.where(within("booked_by_date", p.start, p.end)).join(types, "visit_type_id")
             .join(dept.select("departmentid"), "departmentid", "left_semi")
             .select(PATIENT, "short_desc", day("booking_date").alias("slot_day"), "start_minutes", "booking_date"))
    asked = of_cohort(src.table("patientapptresp"), b, "appointmentid")
    b = next_booking(b, later, (PATIENT, "short_desc"), day="slot_day", minute="start_minutes",
                     order=("slot_day",), payload=("booking_date",))
    answers = responses_wide(asked, "appointmentid", "question", "response_text",
                             NO_SHOW_QUESTIONS)
    people = views.patients(src, as_of, unique=False).select(PATIENT, "patientid").distinct()
    b = b.join(answers, "appointmentid", "left").join(people, PATIENT)

    status = ci("status")
    no_show, cancelled, kept = status == "no show", status == "cancelled", status == "appt kept"
    comment = or_blank("cancel_comment")
    reason = (F.when(kept, "")
              .when(cancelled & (comment == "") & (F.col("cancelled_by") == PORTAL_USER), "Cancelled on Patient Portal")
              .otherwise(comment))
    return report(b, {
        "Appointment ID": "appointmentid", "Dept": "short_name", "Patient ID": "patientid",
        "DOS": us_date("booking_date"),
        "Appt Status": classify_status("status", "cancelled_by", "disposition", PORTAL_USER),
        "Cancelled": "canceled",
        "Future Appt": F.when(no_show | cancelled, or_blank(us_date("next_booking_date"))).otherwise(""),
        "Cancellation Reason": reason,
        "No Show Reason": F.when(no_show & (F.trim("reason") != "-"), F.col("reason")).otherwise(""),
        "No Show 1st Comment": F.when(no_show, or_blank("first_attempt")).otherwise(""),
        "No Show 2nd Comment": F.when(no_show, or_blank("second_attempt")).otherwise(""),
        "Unknown": flag(~is_any("status", ("no show", "cancelled", "appt kept", "booked"))),
        "short": "short"}, ["Appt Status", "Patient ID", "Appointment ID"])


def no_show_rescheduled(src: Source, as_of: date) -> DataFrame:
    """No-shows of the month with the first booking made from that day on for a later slot.

    As written the period test is on date and time, so the last day counts only at midnight.
    """
    p = Period.previous_month(as_of)
    types = views.visit_types(src, "ops").select("visit_type_id", "short_desc")
    phys = views.providers(src).select("doctorid", "provider_name")
    appts = src.table("patientappt").join(types, "visit_type_id").join(phys, "doctorid").withColumn(
        "slot_day", day("booking_date"))
    missed = appts.where((ci("status") == "no show") & (F.col("booking_date") >= F.lit(p.start))
                         & (F.col("booking_date") <= F.lit(p.end)))
    missed = missed.join(views.departments(src).select("departmentid", "short_name"), "departmentid")
    later = appts.where(within("booked_by_date", p.start, p.end) & (ci("status") != "cancelled")).withColumn(
        "booked_day", day("booked_by_date"))
    v = next_booking(missed, later, (PATIENT,), day="slot_day", minute="start_minutes",
                     order=("booked_by_date", "start_minutes", "appointmentid"),
                     payload=("booking_date", "short_desc", "provider_name"), booked_day="booked_day")
    v = v.join(views.patients(src, as_of, unique=False).select(PATIENT, "patientid", "birthdate"), PATIENT)
    return report(v, {
        "Provider": "provider_name", "Clinic": "short_name", "Patient ID": "patientid", "DOB": us_date("birthdate"),
        "No Show Date": us_date("booking_date"), "Visit Type": "short_desc",
        "Rescheduled Date": or_blank(us_date("next_booking_date")), "Rescheduled Type": or_blank("next_short_desc"),
        "Rescheduled Provider": or_blank("next_provider_name")}, ["Provider", "Clinic", "Patient ID", "No Show Date", "Visit Type"])


MILESTONES = {"arrived": "Arrived", "registered": "Registered", "admitted": "Admitted",
              "discharged": "Discharged", "provider_in": "PROV IN", "exam_complete": "XM COMP"}

STAGES = {"Arrived To Registered": ("arrived", "registered"), "Registered To Admitted": ("registered", "admitted"),
          "Admitted To Provider In": ("admitted", "provider_in"),
          "Provider In To Exam Complete": ("provider_in", "exam_complete"),
          "Exam Complete To Discharge": ("exam_complete", "discharged")}


def cycle_time(src: Source, as_of: date) -> DataFrame:
    """Kept visits of the month by service line with the minutes between their milestones.

    A visit type can belong to two lines ('Behavioral ...' counts as medical and behavioral);
    it then yields a row for each. The lines are a derived column of one scan.
    """
    p = Period.previous_month(as_of)
    d = "description"
    lines = F.array_compact(F.array(
        F.when(not_like_all(d, ("Behavioral Health%", "BH%", "opt%")), "med"),
        F.when(like_any(d, ("bh%", "behavioral%")), "bh"), F.when(like(d, "opt%"), "opt")))
    types = views.visit_types(src, "ops").withColumn("Type", F.explode(lines))
    appts = src.table("patientappt").where(within("booking_date", p.start, p.end) & (ci("status") == "appt kept"))
    v = (appts.join(types, "visit_type_id").join(views.providers(src).select("doctorid", "provider_name"), "doctorid")
         .join(views.departments(src).select("departmentid", "short_name"), "departmentid"))
    log = of_cohort(src.table("appt_tracking"), appts, "bookings_id", "appointmentid")
    marks = milestones(log, "bookings_id", "tracking_type", "start_datetime",
                       "appt_tracking_id", MILESTONES, ci("active_yn") == "y")
    v = v.join(marks, v["appointmentid"] == marks["bookings_id"], "left")
    v = stage_durations(v, STAGES).join(
        views.patients(src, as_of, unique=False).select(PATIENT, "patientid"), PATIENT)
    return report(v, {
        "Clinic": "short_name", "Provider": "provider_name", "Patient ID": "patientid",
        "DOS": us_date("booking_date"), "Visit Type": d, **{s: s for s in STAGES},
        "Total Cycle Time": minute_diff("pat_arrived", "pat_discharged"),
        "Total Telehealth Cycle Time": minute_diff("pat_registered", "pat_discharged"), "Appt Id": "appointmentid",
        "Type": "Type", "Telehealth": flag(like_any(d, ("%telehealth%", "phone%")))}
    ).distinct().orderBy("Type", "Clinic", "Provider", "Patient ID", "Appt Id")
