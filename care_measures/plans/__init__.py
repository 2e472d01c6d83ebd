"""The measures: each takes a source and a run date and returns the report as a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame

from ..sources.tables import Source
from . import dental, family_planning, maternal, scheduling, screening, sign_off, visits

Measure = Callable[[Source, date], DataFrame]

_MEASURES: dict[str, Measure] = {
    "m01_adult_weight": visits.adult_weight,
    "m02_appointment_status": scheduling.appointment_status,
    "m03_cervical_cancer": screening.cervical_cancer,
    "m04_chlamydia": screening.chlamydia,
    "m05_depression": screening.depression,
    "m06_notes_signed_off": sign_off.notes_signed_off,
    "m07_superbill_signed_off": sign_off.superbill_signed_off,
    "m08_colorectal_cancer": screening.colorectal_cancer,
    "m09_blood_pressure": visits.blood_pressure,
    "m10_cycle_time": scheduling.cycle_time,
    "m11_caries_risk": dental.caries_risk,
    "m12_crown_delivery": dental.crown_delivery,
    "m13_diagnostic_treatment": dental.diagnostic_treatment,
    "m14_fluoride": dental.fluoride,
    "m15_phase_one_exam": dental.phase_one_exam,
    "m16_restorative": dental.restorative,
    "m17_sealant": dental.sealant,
    "m18_diabetic_a1c": screening.diabetic_a1c,
    "m19_document_sign_off": sign_off.document_sign_off,
    "m20_hospital_tracking": sign_off.hospital_tracking,
    "m21_last_dental_exam": visits.last_dental_exam,
    "m22_maternal_depression": maternal.maternal_depression,
    "m23_no_show_rescheduled": scheduling.no_show_rescheduled,
    "m24_patient_vitals": visits.patient_vitals,
    "m25_pediatric_weight": visits.pediatric_weight,
    "m26_perinatal_health": maternal.perinatal_health,
    "m27_prenatal_trimester": maternal.prenatal_trimester,
    "m28_family_planning": family_planning.family_planning,
    "m29_missed_opportunity": family_planning.missed_opportunity,
    "m30_tobacco": screening.tobacco,
}


def measures() -> dict[str, Measure]:
    """All measures by name."""
    return dict(_MEASURES)
