"""Screening measures."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from ..functions import valuesets as vs
from ..functions.expressions import (ci, day, flag, is_any, leading_score, like, like_any, newer_of, or_blank,
                                     try_date, try_int, us_date, within, yes_no)
from ..functions.periods import Period
from ..functions.valuesets import ValueSet
from ..operators.evidence import code_mask, evidence, has
from ..operators.filters import cohort, ids_of, of_cohort
from ..operators.labs import lab_results
from ..operators.observations import PATIENT, in_window, latest_observations, up_to_day
from ..operators.report import report
from ..operators.slots import slot_join
from ..sources import views
from ..sources.tables import Source
from .common import DX_SLOTS, controls, diagnosed, latest_visit, look_up, noted, one_row


def _labs(src: Source, start: date, end: date, *, hist: str, values: bool = True,
          items: DataFrame | None = None, sets: DataFrame | None = None, seen: DataFrame) -> DataFrame:
    """Lab results of the patients seen: requests are cut down to them before sets, items and values are joined."""
    req = of_cohort(src.table("lab_req").where(within("obr_obs_datetime", start, end)), seen, PATIENT)
    return lab_results(req, src.table("lab_set") if sets is None else sets,
                       src.table("lab_item") if items is None else items,
                       src.table("lab_value") if values else None, hist=hist)


def cervical_cancer(src: Source, as_of: date) -> DataFrame:
    """Women of 21 to 64 seen in the month, with the date of their last Pap test in three years.

    The hysterectomy condition keeps, as written, patients with any diagnosis *other* than
    the hysterectomy code in three years; ``exclude_hysterectomy`` leaves out those with it.
    """
    p = Period.previous_month(as_of)
    since = p.lookback(years=3)
    booked = (src.table("patientappt")
              .where((F.col("visit_type_id") != 58849498) & within("booking_date", p.start, p.end))
              .select(F.col(PATIENT).alias("_p"), day("booking_date").alias("_d")).distinct())
    seen = views.in_hours(src, views.medical_notes(src, p.start, p.end), "note_datetime")
    seen = seen.join(booked, (F.col(PATIENT) == F.col("_p"))
                     & (day("note_datetime") == F.col("_d")), "left_semi")
    phys = views.medical_providers(src).withColumn(
        "provider_name", F.concat_ws(", ", "last_name", "first_name"))
    v = latest_visit(seen, phys, views.departments(src))

    hyst = F.upper(ci("icd9")) == "Z90.710"
    dx = views.company_diagnoses(src)
    ch = src.table("charge_history").where(within("post_fromdate", since, p.end))
    ch = ch.select("patient_id", *DX_SLOTS)
    others = slot_join(ch, DX_SLOTS, dx.where(~hyst).select("diagnosis_id"), "diagnosis_id")
    cut = ([ids_of(slot_join(ch, DX_SLOTS, dx.where(hyst).select("diagnosis_id"), "diagnosis_id"),
                   "patient_id")] if src.config.exclude_hysterectomy else [])
    women = views.patients(src, as_of).where(F.col("age").between(21, 64) & (ci("sex") == "f"))
    v = v.join(women, PATIENT)
    pap = _labs(src, since, p.end, hist="ignore", values=False, seen=noted(src, p),
                items=src.table("lab_item").where(like_any("result_code", vs.PAP_RESULT_PATTERNS)),
                sets=src.table("lab_set").where(like_any("obr_order_code", vs.PAP_ORDER_PATTERNS)))
    pap = pap.groupBy(PATIENT).agg(F.max("obr_obs_datetime").alias("last_pap"))
    v = cohort(look_up(src, v, p), PATIENT, include=[ids_of(others, "patient_id")], exclude=cut)
    v = v.join(pap, PATIENT, "left")
    return report(v, {
        "Provider": "provider_name", "Clinic": or_blank("short_name"), "Patient ID": "patientid",
        "DOB": us_date("birthdate"), "Age": "age", "DOS": us_date("note_datetime"),
        "Last Pap Date": or_blank(us_date("last_pap")),
        "Patient Consents to telehealth Visits": "telehealth_consent",
        "Patient Consents to telephone Visits": "telephone_consent"}, ["Patient ID"])


def chlamydia(src: Source, as_of: date) -> DataFrame:
    """Sexually active women of 13 to 24 seen in the month, tested in the last 12 months or not."""
    p = Period.previous_month(as_of)
    since = p.lookback(years=1)
    dx = views.diagnoses(src)
    icd9, icd10 = ci("icd10_yn") == "n", ci("icd10_yn") == "y"
    dx = dx.where((icd9 & ValueSet(exact=vs.SEXUALLY_ACTIVE_ICD9).matches("icd9"))
                  | (icd10 & ValueSet(patterns=vs.SEXUALLY_ACTIVE_ICD10_PATTERNS,
                                      ranges=vs.SEXUALLY_ACTIVE_ICD10_RANGES).matches("icd9")))
    seen = views.in_hours(src, views.medical_notes(src, p.start, p.end), "note_datetime")
    v = latest_visit(seen, views.medical_providers(src), views.departments(src))
    v = v.join(views.patients(src, as_of).where(F.col("age").between(13, 24) & (ci("sex") == "f")), PATIENT)

    # A charge counts by its diagnosis, however old; within the year by its procedure, or because its patient was given
    # a listed drug. One pass over the charges of the women seen tells all three.
    in_year = within("post_fromdate", since, p.end)
    codes = ValueSet(exact=vs.SEXUALLY_ACTIVE_PROCEDURES).matches("procedure_code")
    charged = evidence(
        src.table("charge_history"), "patient_id", DX_SLOTS, code_mask(dx, "diagnosis_id", [F.lit(True)], "_d"), "diagnosis_id",
        F.coalesce("_d", F.lit(0)).bitwiseOR(F.when(in_year, F.coalesce("_p", F.lit(0)).bitwiseOR(F.lit(4))).otherwise(0)),
        procedures=code_mask(views.procedures(src).where(codes), "procedure_id", [F.lit(False), F.lit(True)], "_p"),
        procedure="procedure_id", every_fact=True, members=noted(src, p), member=PATIENT)
    drugs = src.table("patient_drug").where(
        within("start_date", since, p.end) & like_any("drug_name", dict.fromkeys(vs.CONTRACEPTIVE_DRUGS)))
    given = ids_of(of_cohort(drugs, noted(src, p), PATIENT), PATIENT).select("id", F.lit(True).alias("given"))
    active = charged.join(given, F.col("patient_id") == F.col("id"), "left").where(
        has(0) | has(1) | has(2) & F.coalesce("given", F.lit(False))).select(F.col("patient_id").alias("id"))

    tests = _labs(src, since, p.end, hist="match", items=src.table("lab_item").where(
        is_any("result_desc", vs.CHLAMYDIA_RESULTS)), seen=noted(src, p)).where("result_status IS NOT NULL")
    tests = tests.groupBy(PATIENT).agg(F.max("obr_obs_datetime").alias("tested"))
    v = cohort(look_up(src, v, p), PATIENT, include=[active]).join(tests, PATIENT, "left")
    return report(v, {
        "Provider": "provider_name", "Clinic": "short_name", "Patient ID": "patientid",
        "Date Of Birth": us_date("birthdate"), "Age": "age", "Last Visit Date": us_date("note_datetime"),
        "Test Date In Last 12 mo": or_blank(us_date("tested")), "Met": yes_no(F.col("tested").isNotNull()),
        "Patient Consents to Telehealth Visit": "telehealth_consent",
        "Patient Consents to Telephone Visit": "telephone_consent"}, ["Provider", "Patient ID"])


def depression(src: Source, as_of: date) -> DataFrame:
    """Patients of 12 and over with a depression screen: score, result and follow-up plan."""
    p = Period.previous_month(as_of)
    since = p.lookback(years=1)
    filled = lambda v: F.trim(v) != ""
    number = lambda v: try_int(v).isNotNull()

    seen = views.in_hours(src, views.medical_notes(src, p.start, p.end), "note_datetime")
    v = latest_visit(seen, views.without(src, views.medical_providers(src)), views.departments(src))
    v = look_up(
        src, v.join(views.patients(src, as_of).where("age >= 12"), PATIENT), p, recent=in_window(3696, 15095, 15096, 15097, 15423, start=p.start),
        phq9=in_window(15095, 15096, 15097, 3696, 15958, start=since, keep=number, prefer=try_int),
        phq2=in_window(15423, 15957, 15815, 15816, start=since, keep=filled),
        screen1=in_window(15593), screen2=in_window(14765))
    v = cohort(v.where(F.col("recent_day").isNotNull()), PATIENT, exclude=[
        diagnosed(src, views.diagnoses(src), ValueSet(ranges=vs.DEPRESSION_RANGE), since, p.end)])
    v = v.withColumn("phq2", leading_score("phq2"))
    # The follow-up plan counts only from medical notes.
    plan = latest_observations(views.medical_notes(src, since, p.end, members=noted(src, p)), controls(src), {"plan": (15143,)},
                               since, p.end, keep=number)
    v = v.join(plan.select(PATIENT, "plan"), PATIENT, "left")

    phq2_empty = F.col("phq2").isNull() | (F.rtrim("phq2") == "0")
    score = (F.when(F.col("age") < 18, F.col("phq9"))
             .when(phq2_empty, F.coalesce("phq9", "phq2"))
             .when(F.col("phq2_day") <= F.col("phq9_day"), F.col("phq9"))
             .otherwise(F.col("phq2")))
    first, second = try_date("screen1"), try_date("screen2")
    v = v.withColumns({
        "score": score,
        "screened_on": F.when(first.between(since, p.end), first).when(second.between(since, p.end), second)})
    v = v.withColumns({"screened": F.col("screened_on").isNotNull(),
                       "positive": F.coalesce(try_int("score") > 9, F.lit(False)),
                       "planned": F.coalesce(F.col("plan") == "1", F.lit(False))})
    return report(v, {
        "Provider": "provider_name", "Clinic": "short_name", "Patient ID": "patientid", "Age": "age",
        "DOS": us_date("note_datetime"), "Last PHQ Score": or_blank("score"),
        "Last PHQ Date": or_blank(us_date("screened_on")), "Screened": flag(F.col("screened")),
        "Positive Result": flag(F.col("positive")), "Follow-Up Plan": flag(F.col("planned")),
        "Met": yes_no(F.col("screened") & (F.col("positive") == F.col("planned"))),
        "Patient Consents to Telehealth Visit": "telehealth_consent",
        "Patient Consents to Telephone Visit": "telephone_consent"}, ["Provider", "Clinic", "Patient ID"])


def colorectal_cancer(src: Source, as_of: date) -> DataFrame:
    """Patients of 45 to 75 seen in the month, with last FIT, in-office and scanned FOBT dates.

    The scanned document has, as written, no date limit.
    """
    p = Period.previous_month(as_of)
    fit = is_any("result_code", vs.FIT_RESULTS)
    office = like("result_code", "RESULT_1") & like("result_desc", "Occult%")
    seen = views.in_hours(src, views.medical_notes(src, p.start, p.end), "note_datetime")
    v = latest_visit(seen, views.without(src, views.medical_providers(src)), views.departments(src))
    people = one_row(views.patients(src, as_of, unique=False).where(F.col("age").between(45, 75)))
    v = v.join(people, PATIENT)
    lab = _labs(src, p.lookback(years=2), p.end, hist="match", items=src.table("lab_item").where(fit | office), seen=noted(src, p))
    lab = lab.groupBy(PATIENT).agg(F.max(F.when(fit, F.col("obr_obs_datetime"))).alias("fit"),
                                   F.max(F.when(office, F.col("obr_obs_datetime"))).alias("office"))
    scan = (of_cohort(src.table("document").where(like("file_name", "%FOBT%")), noted(src, p), PATIENT)
            .groupBy(PATIENT).agg(F.max("doc_date").alias("scanned")))
    v = look_up(src, v, p).join(lab, PATIENT, "left").join(scan, PATIENT, "left")
    return report(v, {
        "Provider": "provider_name", "Clinic": "short_name", "Patient ID": "patientid", "Gender": "sex",
        "DOB": us_date("birthdate"), "Age": "age", "DOS": us_date("note_datetime"),
        "Last FIT Date": or_blank(us_date("fit")), "In Office FOBT": or_blank(us_date("office")),
        "Last FOBT Scanned": or_blank(us_date("scanned")),
        "Patient Consents to Telehealth Visit": "telehealth_consent",
        "Patient Consents to Telephone Visit": "telephone_consent"})


def diabetic_a1c(src: Source, as_of: date) -> DataFrame:
    """Adults with diabetes seen in the month: newest A1c from lab or note, met below 9.

    A lab code written with wildcards under an equality matches nothing and is left out.
    """
    p = Period.previous_month(as_of)
    since = p.lookback(years=1)
    number = lambda v: v.try_cast("decimal(10,2)").isNotNull() & (v != "")
    seen = views.in_hours(src, views.medical_notes(src, p.start, p.end), "note_datetime")
    v = latest_visit(seen, views.without(src, views.medical_providers(src)), views.departments(src))
    diabetic = diagnosed(src, views.company_diagnoses(src), ValueSet(patterns=vs.DIABETES_PATTERNS), since, p.end)
    people = views.patients(src, as_of, unique=False)
    adults = ids_of(people.where("age >= 18"), PATIENT)
    v = v.join(one_row(people), PATIENT)
    lab = _labs(src, since, p.end, hist="zero", seen=noted(src, p), items=src.table("lab_item").where(
        is_any("result_code", vs.A1C_RESULTS))).where(number(F.col("result_value")))
    lab = lab.groupBy(PATIENT).agg(
        F.max(F.struct("obr_obs_datetime", "lab_result_item_id", "result_value")).alias("lab"))
    lab = lab.select(PATIENT, F.col("lab.result_value").alias("lab"),
                     day(F.col("lab.obr_obs_datetime")).alias("lab_day"))
    v = look_up(src, v, p, note=in_window(3680, start=since, keep=number))
    v = cohort(v, PATIENT, include=[diabetic, adults]).join(lab, PATIENT, "left")
    a, ad, b, bd = (F.col(c) for c in ("note", "note_day", "lab", "lab_day"))
    v = v.withColumns({"result": newer_of(ad, a, bd, b), "result_day": newer_of(ad, ad, bd, bd)})
    return report(v, {
        "Provider": or_blank("provider_name"), "Clinic": or_blank("short_name"), "Patient ID": "patientid",
        "DOB": us_date("birthdate"), "Age": "age", "Last DOS": us_date("note_datetime"),
        "Last hgb A1c Result": or_blank("result"), "Result Date": or_blank(us_date("result_day")),
        "Met": yes_no(F.col("result").try_cast("decimal(10,2)") < 9),
        "Patient Consents to telehealth Visits": "telehealth_consent",
        "Patient Consents to telephone Visits": "telephone_consent"}, ["Provider", "Patient ID"])


def tobacco(src: Source, as_of: date) -> DataFrame:
    """Adults with a tobacco field in two years, seen in the month: use and cessation."""
    p = Period.previous_month(as_of)
    since = p.lookback(months=6)
    seen = views.in_hours(src, views.medical_notes(src, p.start, p.end, "tobacco"), "note_datetime")
    v = latest_visit(seen, views.providers(src, include_inactive=True), views.departments(src))
    v = look_up(
        src, v.join(views.patients(src, as_of).where("age >= 18"), PATIENT), p,
        asked=in_window(14375, 14451, 14452, 14450, 14449, start=p.lookback(years=2)),
        uses=up_to_day(14449), not_user=up_to_day(14450), cessation1=up_to_day(14451, since=since),
        cessation2=up_to_day(14375, since=since))
    v = v.where(F.col("asked_day").isNotNull())

    billed = views.procedures(src).where(F.col("procedure_number").isin(848, 849)).select("procedure_id")
    charges = src.table("charge_history").where(within("post_fromdate", since, p.end))
    billed = ids_of(charges.join(billed, "procedure_id"), "patient_id").select(
        F.col("id").alias(PATIENT), F.lit(True).alias("billed"))
    v = v.join(billed, PATIENT, "left")

    received = F.col("billed").isNotNull() | F.coalesce(F.col("cessation1") == "1", F.lit(False)) \
        | F.coalesce(F.col("cessation2") == "1", F.lit(False))
    not_user, uses = F.col("not_user"), F.col("uses")
    v = v.withColumn("received", received)
    return report(v, {
        "Provider": "provider_name", "Clinic": "short_name", "Patient ID": "patientid",
        "DOS": us_date("note_datetime"), "Use Doc''d": flag((uses == "1") | (not_user == "1")),
        "Not Tobacco User": F.coalesce(try_int("not_user"), F.lit(0)),
        "Uses Tobacco": F.coalesce(try_int("uses"), F.lit(0)),
        "Cessation Received": F.when((not_user == "1") | (uses == "0"), 0).otherwise(flag(F.col("received"))),
        "Met": yes_no((not_user == "1") | ((uses == "1") & F.col("received"))),
        "Patient Consent to Telehealth Visit": "telehealth_consent",
        "Patient Consent to Telephone Visit": "telephone_consent"}, ["Provider", "Patient ID"])
