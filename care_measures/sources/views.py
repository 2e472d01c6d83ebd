"""Shared views the measures are written against.

Their definitions are inferred from where they are used; each docstring says what was
assumed. Fact views take the days wanted, so the date range reaches the scan before rows
are de-duplicated.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from ..functions.expressions import (age_months, age_years, ci, is_any, label_map, like,
                                     not_like_all, within)
from ..functions import valuesets as vs
from ..operators.filters import exclude_after_hours, exclude_by_name
from ..operators.ranking import current_version, latest_if_within
from .tables import Source


def patients(src: Source, as_of: date, unique: bool = True) -> DataFrame:
    """Patient view with ages on the run date; ``unique`` keeps the rank-1 row of a patient.

    Assumed: age in whole 8766-hour years, and the second age column the same as the first.
    """
    p = src.table("view_patient")
    if unique:
        p = p.where("rn = 1")
    age = age_years("birthdate", as_of)
    return p.select("patientprofileid", "patientid", "birthdate", "sex", age.alias("age"),
                    age.alias("age2"), age_months("birthdate", as_of).alias("agemonth"))


def registered_patients(src: Source, as_of: date) -> DataFrame:
    """Newest active, undeleted version of each of the site's patients, with age."""
    ok = (ci("active_yn") == "y") & (ci("deleted_yn") != "y") & (F.col("company_id") == src.config.company_id)
    p = current_version(src.table("patient"), "patient_id", "modified_date", ok,
                        ["patient_number", "birth_date", "sex", "zip", "family_size", "income"])
    return p.withColumn("age", age_years("birth_date", as_of))


def notes_between(src: Source, start: date, end: date) -> DataFrame:
    return src.table("patient_note").where(within("note_datetime", start, end))


def latest_notes(src: Source, start: date, end: date, members: DataFrame | None = None) -> DataFrame:
    """Newest version of each note, if that one was written in the window (for ``members`` only).

    A note whose newest version has another date belongs to that date alone.
    """
    return latest_if_within(src.table("patient_note"), "patient_note_id", "update_datetime", "note_datetime", start, end,
                            ["patientprofileid", "doctorid", "dept_id", "template_id", "signedby"], members,
                            "patientprofileid")


def visit_templates(src: Source, patterns: tuple[str, ...], types: tuple[int, ...],
                    names: tuple[str, ...] = ()) -> DataFrame:
    """Templates left after a black-list."""
    own = (src.config.own_name_pattern,) if src.config.own_name_pattern else ()
    return exclude_by_name(
        src.table("template"), "template_name", (*vs.TEMPLATE_PATTERNS, *patterns, *own),
        (*vs.TEMPLATE_NAMES, *names), "template_type_id", types
    ).select("template_id", "template_name")


def medical_notes(src: Source, start: date, end: date, variant: str = "medical",
                  members: DataFrame | None = None) -> DataFrame:
    """Newest note versions of medical templates, with the template name.

    Assumed: the full medical-note view drops the same templates as the blood-pressure
    report's written-out copy. ``variant`` selects the sign-off or tobacco black-list.
    """
    blacklist = {
        "medical": (vs.MEDICAL_PATTERNS, vs.MEDICAL_TYPES, ()),
        "sign_off": (vs.SIGN_OFF_PATTERNS, vs.SIGN_OFF_TYPES, vs.SIGN_OFF_NAMES),
        "tobacco": (vs.TOBACCO_PATTERNS, vs.TOBACCO_TYPES, ()),
    }[variant]
    return latest_notes(src, start, end, members).join(visit_templates(src, *blacklist), "template_id")


def providers(src: Source, include_inactive: bool = False) -> DataFrame:
    """Active providers, one row per doctor; or the full list they are taken from."""
    p = src.table("active_phys")
    return p if include_inactive else p.where((ci("active_yn") == "y") & (F.col("rn") == 1))


def medical_providers(src: Source) -> DataFrame:
    """Active providers without dentists, podiatrists and social workers or missing NPI."""
    p = providers(src).where(
        ~is_any("degree", ("DDS", "DPM", "LCSW", "")) & (F.trim("individual_npi") != ""))
    names = src.config.non_medical_providers
    return p.where(~is_any("provider_name", names)) if names else p


def without(src: Source, df: DataFrame, col: str = "provider_name") -> DataFrame:
    """Leave out the providers the site excludes from visit measures."""
    names = src.config.excluded_providers
    return df.where(~is_any(col, names)) if names else df


def in_hours(src: Source, visits: DataFrame, ts: str, doctor: str = "doctorid") -> DataFrame:
    """Visits less those of the after-hours list, which names active providers."""
    cfg = src.config
    if cfg.after_hours == "as_written" and len({r.provider.lower() for r in cfg.provider_rules}) != 1:
        return visits
    names = providers(src).select(F.col("doctorid").alias("_doctor"),
                                  F.col("provider_name").alias("_rule_name"))
    out = visits.join(names, F.col(doctor) == F.col("_doctor"), "left")
    return exclude_after_hours(out, cfg.provider_rules, cfg.after_hours, provider="_rule_name",
                               ts=ts).drop("_doctor", "_rule_name")


def departments(src: Source) -> DataFrame:
    return src.table("department").select("departmentid", "short_name", "short", "listname")


def diagnoses(src: Source) -> DataFrame:
    """Active diagnosis codes of the site."""
    return company_diagnoses(src).where((ci("active_yn") == "y")
                                        & (F.col("company_id") == src.config.company_id))


def company_diagnoses(src: Source) -> DataFrame:
    return src.table("diagnosis")


def procedures(src: Source) -> DataFrame:
    """Active procedure codes."""
    return company_procedures(src).where(ci("active_yn") == "y")


def company_procedures(src: Source) -> DataFrame:
    return src.table("procedure")


def visit_types(src: Source, subset: str) -> DataFrame:
    """Visit types of the ``ops``, ``valid`` or ``medical`` list."""
    ids = getattr(src.config, f"{subset}_visit_types")
    t = src.table("visit_type")
    return t if ids is None else t.where(F.col("visit_type_id").isin(list(ids)))


def dental_patients(src: Source, as_of: date) -> DataFrame:
    """Newest active version of each dental patient; rows with *both* names 'test' go."""
    ok = (F.col("status") == 1) & ((ci("lastname") != "test") | (ci("firstname") != "test"))
    p = current_version(src.table("ddb_pat"), "patid", "ddb_last_mod", ok,
                        ["patextid", "pataccountnumber", "birthdate"])
    return p.select("patid", "patextid", "pataccountnumber", age_years("birthdate", as_of).alias("age"))


def dental_providers(src: Source) -> DataFrame:
    own = src.config.own_name_pattern
    p = src.table("ddb_rsc").where(
        (F.col("rsctype") == 1) & (F.col("activeflag") == 1) & (F.col("isnonperson") == 0)
        & ~is_any("name_last", ("DEF_PROV", "Walk-In", "test")) & ~is_any("name_first", ("test",)))
    if own:
        name = own.strip("%")
        p = p.where(~like("name_last", name) & ~like("name_first", name))
    return p.select(F.col("urscid").alias("provid"),
                    F.concat_ws(", ", "name_last", "name_first").alias("provider"))


def dental_clinics(src: Source) -> DataFrame:
    return src.table("ddb_clinic").select(
        F.col("urscid").alias("clinicappliedto"),
        label_map("rscid", vs.CLINIC_LABELS).alias("clinic"))


def bookable(types: DataFrame) -> DataFrame:
    """Visit types less nurse, walk-in and calendar entries."""
    return types.where(
        not_like_all("description", ("%nurse%", "%cpsp%", "Walk IN%", "Walk-IN%"))
        & ~is_any("short_desc", ("HOLIDAY", "MEETING", "PTO", "ADMIN", "DO NOT USE")))
