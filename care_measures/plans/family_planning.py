"""Family-planning measures."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import valuesets as vs
from ..functions.expressions import PLACEHOLDERS, ci, day, flag, is_any, like, or_blank, us_date, within, yes_no
from ..functions.periods import Period
from ..functions.valuesets import ValueSet
from ..operators.evidence import code_mask, evidence, has
from ..operators.filters import cohort, ids_of, of_cohort
from ..operators.lookup import bracket_lookup
from ..operators.observations import PATIENT, daily_observations, observations_asof, observations_exact
from ..operators.ranking import latest_per_key
from ..operators.report import report
from ..operators.slots import slot_join
from ..sources import views
from ..sources.tables import Source
from .common import DX_SLOTS, controls, notes

CLINICIANS = ("MD", "PA", "MS PA-C", "NP", "DO")


PLANNED, CARED, ENDED = range(3)


def _care(src: Source, start: date, end: date, reproductive_health: ValueSet, members: DataFrame) -> DataFrame:
    """(patient_id, mask) of the members: any charge for contraception, for reproductive health, for a termination.

    A charge needs a known procedure and a known diagnosis, one of the two listed; terminations
    count active codes only. Charges without a patient are a row of their own.
    """
    lists = {"planned": (vs.CONTRACEPTION_PROCEDURES, ValueSet(exact=vs.CONTRACEPTION_DIAGNOSES)),
             "cared": (vs.REPRODUCTIVE_HEALTH_PROCEDURES, reproductive_health),
             "ended": (vs.TERMINATION_PROCEDURES, ValueSet(exact=vs.TERMINATION_DIAGNOSES))}
    px, dx = views.company_procedures(src), views.company_diagnoses(src)
    for name, (procedures, diagnoses) in lists.items():
        px = ValueSet(exact=procedures).mark(px, "procedure_code", f"_p_{name}")
        dx = diagnoses.mark(dx, "icd9", f"_d_{name}")
    active = ci("active_yn") == "y"
    # Bits 0 to 2 are the lists, bit 3 an active code.
    px = code_mask(px, "procedure_id", [*[f"_p_{n}" for n in lists], active], "_p")
    dx = code_mask(dx, "diagnosis_id", [*[f"_d_{n}" for n in lists], active & (F.col("company_id") == src.config.company_id)], "_d")
    both_active = has(3, F.col("_p").bitwiseAND(F.col("_d")))
    listed = F.col("_p").bitwiseOR(F.col("_d")).bitwiseAND(F.when(both_active, 7).otherwise(3))
    ch = src.table("charge_history").where(within("post_fromdate", start, end))
    return evidence(ch, "patient_id", DX_SLOTS, dx, "diagnosis_id", listed, procedures=px, procedure="procedure_id",
                    members=members, member=PATIENT, keep_null=True)


def _planning(src: Source, start: date, end: date, members: DataFrame) -> DataFrame:
    """(patient_id, mask) of the members: a charge for a family-planning visit, and one for a sterilisation or menopause.

    As written the first needs a known procedure *and* a known diagnosis for either to count,
    the second a diagnosis only. Charges without a patient are a row of their own.
    """
    px = code_mask(views.procedures(src), "procedure_id", [
        ValueSet(exact=vs.FAMILY_PLANNING_VISIT_PROCEDURES).matches("procedure_code")], "_p")
    dx = code_mask(views.diagnoses(src), "diagnosis_id", [
        ValueSet(exact=codes).matches("icd9") for codes in (vs.CONTRACEPTION_DIAGNOSES, vs.STERILISED_OR_MENOPAUSAL)], "_d")
    found = F.when(F.col("_p").isNotNull(), F.col("_p").bitwiseOR(F.col("_d"))).otherwise(F.col("_d").bitwiseAND(F.lit(2)))
    ch = src.table("charge_history").where(within("post_fromdate", start, end))
    return evidence(ch, "patient_id", DX_SLOTS, dx, "diagnosis_id", found, procedures=px, procedure="procedure_id",
                    members=members, member=PATIENT, keep_null=True)


def _kept_appts(src: Source, p: Period) -> DataFrame:
    return src.table("patientappt").where((ci("status") == "appt kept") & within("booking_date", p.start, p.end))


def _kept(src: Source, p: Period) -> DataFrame:
    """Kept medical visits of the month with a clinician, by day."""
    types = views.visit_types(src, "medical").select("visit_type_id", "short_desc")
    phys = views.providers(src).where(is_any("degree", CLINICIANS)).select("doctorid", "provider_name", "degree")
    return (_kept_appts(src, p).join(types, "visit_type_id").join(phys, "doctorid")
            .join(views.departments(src).select("departmentid", "short_name"), "departmentid")
            .select(F.col(PATIENT), day("booking_date").alias("dos"), "short_desc", "short_name", "provider_name",
                    "degree"))


def _coverage(src: Source, start: date, end: date, members: DataFrame) -> DataFrame:
    """Description of the financial class on each member's newest charge."""
    slots = ("financial_class_id_1", "financial_class_id_2", "financial_class_id_3")
    ch = of_cohort(src.table("charge_history").where(within("post_fromdate", start, end)), members, "patient_id", PATIENT)
    ch = slot_join(ch.select("patient_id", "post_fromdate", *slots), slots, src.table("financial_class"),
                   "financial_class_id")
    return latest_per_key(ch.select("patient_id", "post_fromdate", F.col("description").alias("coverage")),
                          ["patient_id"], ["post_fromdate"], ["coverage"]).drop("post_fromdate")


def _language(src: Source, members: DataFrame) -> DataFrame:
    """Whether a translator is needed; the greatest text where codes disagree."""
    codes = of_cohort(src.table("patient_shortcode").where(like("code", "%TRANSLAT%")), members, "patient_id", PATIENT)
    text = (F.when(like("code", "YES TRANSLAT%"), "TRANSLATION NEEDED - YES")
            .when(like("code", "NO TRANSLAT%"), "TRANSLATION NOT NEEDED - NO"))
    return codes.groupBy("patient_id").agg(F.max(text).alias("language"))


def _poverty(src: Source, members: DataFrame) -> DataFrame:
    """Poverty status of each member's newest version that falls in a bracket."""
    p = of_cohort(src.table("patient"), members, "patient_id", PATIENT).where((F.col("company_id") == src.config.company_id) & (ci("active_yn") == "y"))
    found = bracket_lookup(p.select("patient_id", "company_id", "family_size", "income", "modified_date"),
                           src.table("fee_matrix_detail"))
    return latest_per_key(found, ["patient_id"], ["modified_date"], ["poverty_status"]).select(
        "patient_id", "poverty_status")


def _listed(src: Source, key: str, name: str) -> DataFrame:
    return src.table("lists").select(F.col("medlistsid").alias(key), F.col("description").alias(name))


def family_planning(src: Source, as_of: date, reproductive_health: ValueSet | None = None) -> DataFrame:
    """Demographic extract of kept visits of patients with family-planning care.

    ``reproductive_health`` is the long diagnosis list; by default the site's value set of
    that name, else the codes in its ``value_set_code`` table.
    """
    p = Period.previous_month(as_of)
    since = p.lookback(years=1)
    if reproductive_health is None:
        reproductive_health = src.config.value_sets.get("reproductive_health") or ValueSet(
            table=src.table("value_set_code").where("set_name = 'reproductive_health'"))
    sex, age = ci("sex"), F.col("age")
    people = views.registered_patients(src, as_of).where(
        ((sex == "m") & age.between(12, 60)) | ((sex == "f") & age.between(12, 55)))
    k = _kept(src, p).select(F.col(PATIENT), "dos", "short_name", "degree").distinct()
    v = k.join(people.withColumnRenamed("patient_id", PATIENT), PATIENT)
    # All other tables are cut down to the patients with a kept appointment, told by one narrow scan.
    members = _kept_appts(src, p).select(PATIENT)
    care = _care(src, since, p.end, reproductive_health, members)
    listed = care.where(has(PLANNED) & has(CARED) & ~has(ENDED)).select(F.col("patient_id").alias("_id"))
    v = v.join(listed, F.col(PATIENT) == F.col("_id"), "left_semi")
    # As written, a termination charge without a patient would leave nothing.
    v = v.where(~care.where(F.col("patient_id").isNull() & has(ENDED)).exists())
    for key, name in (("employment_status_id", "employment"), ("race_id", "race"), ("ethnicity_id", "ethnicity")):
        v = v.join(_listed(src, key, name), key, "left")
    for side in (_coverage(src, since, p.end, members), _language(src, members), _poverty(src, members)):
        v = v.join(side.withColumnRenamed("patient_id", PATIENT), PATIENT, "left")

    year = p.start.year
    with_template = notes(src).join(src.table("template").select("template_id"), "template_id", "left_semi")
    with_template = of_cohort(with_template, members, PATIENT)
    methods = daily_observations(with_template, controls(src), {"method": (7220,)}, date(year, 1, 1),
                                 date(year, 12, 31), keep=lambda m: F.trim(m) != "")
    v = observations_asof(v, methods, "dos")
    return report(v, {
        "Agency": F.lit(src.config.agency), "Site": or_blank("short_name"), "Patient ID": "patient_number",
        "DOB": us_date("birth_date"), "Sex": "sex", "Age": "age", "Race": "race", "Ethnicity": "ethnicity",
        "Family Size": F.coalesce("family_size", F.lit(1)),
        "Weekly Income": F.coalesce(F.col("income").cast("double"), F.lit(0.0)), "Visit Date": us_date("dos"),
        "Provider Type": or_blank("degree"), "Principle Health Coverage": or_blank("coverage"), "Zip Code": "zip",
        "Limited English Proficiency": or_blank("language"), "Homeless": or_blank("employment"),
        "Birth Control Method": or_blank("method"), "Poverty Level": "poverty_status"}
    ).distinct().orderBy("Patient ID", "Visit Date", "Site")


def missed_opportunity(src: Source, as_of: date) -> DataFrame:
    """Family-planning patients' last kept visit: was a family-planning note written this year?"""
    p = Period.previous_month(as_of)
    since = p.lookback(years=1)
    v = latest_per_key(_kept(src, p), [PATIENT], ["dos"], ["short_name", "provider_name", "short_desc"])
    people = views.registered_patients(src, as_of).where(F.col("age").between(12, 50))
    v = v.join(people.withColumnRenamed("patient_id", PATIENT), PATIENT)
    members = _kept_appts(src, p).select(PATIENT)
    charged = _planning(src, since, p.end, members)
    v = cohort(v, PATIENT, include=[charged.where(has(0)).select(F.col("patient_id").alias("id"))],
               exclude=[charged.where(has(1)).select(F.col("patient_id").alias("id"))])

    def written(match: Column) -> DataFrame:
        forms = src.table("template").where(match).select("template_id")
        return of_cohort(notes(src).join(forms, "template_id", "left_semi"), members, PATIENT)

    title = like("template_name", "%title%")
    filled = lambda m: ~F.trim(F.coalesce(m, F.lit(""))).isin(list(PLACEHOLDERS))
    done = ids_of(written(title).where(within("note_datetime", p.year_start(), p.end)), PATIENT)
    v = v.join(done.select(F.col("id").alias(PATIENT), F.lit(True).alias("done")), PATIENT, "left")
    v = observations_asof(v, daily_observations(written(title), controls(src), {"title_method": (7220,)}, since,
                                                p.end, keep=filled), "dos")
    v = observations_exact(v, daily_observations(written(~title), controls(src), {"visit_method": (7220, 9340)},
                                                 p.start, p.end, keep=filled), "dos")
    completed = F.col("done").isNotNull()
    return report(v, {
        "Patient ID": "patient_number", "Date of Birth": us_date("birth_date"), "Gender": "sex", "Age": "age",
        "DOS": us_date("dos"), "Clinic": "short_name", "Provider": "provider_name", "Completed": flag(completed),
        "Missed": flag(~completed), "Met Goal": yes_no(completed), "Visit Type": "short_desc",
        "Title X BC": or_blank("title_method"), "Visit BC": or_blank("visit_method")},
        ["Clinic", "Provider", "Patient ID"])
