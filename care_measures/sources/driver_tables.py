"""Clinical tables derived from the star-schema tables the repository is tested on.

Each table is one SELECT over the given tables, written so that Spark and other SQL engines
read it alike; ``{name}`` stands for a given table and ``@BASE@`` for the first day. Fact
tables grow with orders, lineitem and events; dimensions come from nation, part and supplier.
"""

from __future__ import annotations

import re
from datetime import date
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from ..config import ProviderRule, SiteConfig
from .schemas import schema
from .tables import Source

AS_OF = date(1998, 7, 15)
FIRST_DAY = "1997-02-01 00:00:00"
GIVEN = ("nation", "customer", "supplier", "part", "orders", "lineitem", "events")

CONFIG = SiteConfig(
    own_name_pattern="%agency%",
    excluded_providers=("Last3, First3",),
    non_medical_providers=("Last9, First9", "Last16, First16"),
    provider_rules=(ProviderRule("Last1, First1", (3, 5), 17, 30),
                    ProviderRule("Last2, First2", (2, 3, 4, 5, 6), 18)),
    valid_visit_types=(0, 1, 2, 3, 5, 8, 11),
    medical_visit_types=(0, 1, 2, 3, 5, 8, 10, 11),
)

# The part of the reproductive-health diagnosis list that the derived tables have codes near. A site loads
# its whole list as ``value_set_code`` table; the last three rows show what else such a table may hold.
_REPRODUCTIVE_HEALTH = (
    "B20", "Z21", "Z71.7", "A60.00", "A60.01", "A54.9", "A54.29", "A54.01", "A54.02", "E28.2", "N70.01", "N70.02",
    "N73.0", "N72", "N76.0", "N76.1", "N76.2", "N76.3", "N80.0", "N80.1", "Z20.2", "Z30.8", "Z72.53", "Z72.51", "Z72.52",
)
_CODE_RULES = (("N93.0", "N93.9", "range"), ("N60.%", None, "pattern"), ("n64.5_", None, "pattern"))


def _day(n: str) -> str:
    return f"@BASE@ + INTERVAL '1' DAY * CAST({n} AS INT)"


def _minutes(n: str) -> str:
    return f"INTERVAL '1' MINUTE * CAST({n} AS INT)"


def _case(expr: str, values: list, default: str = "NULL") -> str:
    """CASE expr WHEN 0 THEN values[0] WHEN 1 THEN values[1] ... ELSE default END."""
    shown = [v if isinstance(v, int) else f"'{v}'" for v in values]
    return f"CASE {expr} " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(shown)) + f" ELSE {default} END"


# Note fields recorded per line item, by slot. Three slot lists give every note a mix of vital
# signs and screening answers; the kind says what a field's value looks like.
_VITALS = [1716, 1717, 12848, 1347, 11253, 11254, 12849]
_FIELDS_A = [1719, 14466, 3696, 15095, 15096, 15097, 15423, 15143, 15593, 14765, 13259, 13260, 9273,
             14358, 14359, 14646, 15085, 15127, 15141, 15142, 7220, 9340, 14375, 14449, 14450]
_FIELDS_B = [14451, 3680, 16001, 16002, 12164, 12165, 12166, 12167, 12168, 12169, 15476, 15957, 15958,
             15815, 1719, 14466, 15423, 14449, 14359, 14646, 16001, 16002, 7220, 15085, 15127]
_KINDS = {"date": (9273, 15593, 14765, 15085),
          "tick": (14466, 14358, 14359, 15143, 12164, 12165, 12166, 12167, 12168, 12169, 14375, 14449, 14450, 14451),
          "systolic": (12848, 13259), "diastolic": (12849, 13260), "bmi": (1719,), "a1c": (3680,),
          "outcome": (15476,), "weight": (15127, 15141, 15142), "method": (7220, 9340),
          "consent": (16001, 16002), "answer": (15423, 15957, 15815), "done": (14646,)}


def _slots(fields: list[int], slot: str) -> str:
    """Line items with the field of their slot; the slot table is read off nation's keys."""
    kind = {f: k for k, fs in _KINDS.items() for f in fs}
    kinds = [kind.get(f, "number") for f in fields]
    return f"""SELECT l_orderkey AS patient_note_id, field_id AS template_field_id, kind, l_suppkey AS k,
            l_partkey AS p, CAST(l_quantity AS INT) AS q
          FROM {{lineitem}} JOIN (SELECT n_nationkey AS slot, {_case('n_nationkey', fields)} AS field_id,
            {_case('n_nationkey', kinds)} AS kind FROM {{nation}}) AS slots ON {slot} = slot"""


# Dimension attributes are read off a row's name, not its key, so that a filter on an attribute is
# not inferred to be a filter on the fact side's foreign key.
_NATIONS = "(SELECT n_nationkey, CAST(substr(n_name, 8) AS INT) AS n FROM {nation}) AS nations"
_SUPPLIERS = "(SELECT s_suppkey, CAST(substr(s_name, 10) AS INT) AS n FROM {supplier}) AS suppliers"
_DEGREE = "CASE WHEN n > 19 THEN 'MD' ELSE " + _case(
    "n % 7", ["MD", "NP", "PA", "DO", "DDS", "DPM"]) + " END"
_LAST = "CASE WHEN n = 8 THEN 'CPSP Last8' ELSE concat('Last', CAST(n AS STRING)) END"
_FIRST = "concat('First', CAST(n AS STRING))"
_BIRTH = "DATE '1910-01-01' + CAST((c_custkey * 7919) % 32000 AS INT)"

TABLES: dict[str, str] = {
    "view_patient": f"""
        SELECT c_custkey AS patientprofileid, concat('P', CAST(c_custkey AS STRING)) AS patientid,
          {_BIRTH} AS birthdate, CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS sex,
          concat('F', CAST(c_custkey AS STRING)) AS first, c_name AS last,
          CASE WHEN c_custkey % 25 = 0 THEN 2 ELSE 1 END AS rn FROM {{customer}}""",
    "patient": f"""
        SELECT c_custkey AS patient_id, concat('N', CAST(c_custkey AS STRING)) AS patient_number,
          {_BIRTH} AS birth_date, {_day('c_custkey % 400')} AS modified_date,
          CASE WHEN c_custkey % 37 = 0 THEN 'N' ELSE 'Y' END AS active_yn, 'N' AS deleted_yn,
          9 AS company_id, CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS sex,
          concat('9', CAST(c_custkey % 90 + 1000 AS STRING)) AS zip,
          CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE CAST(c_custkey % 9 + 1 AS INT) END AS family_size,
          CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE CAST(abs(c_acctbal) AS DECIMAL(12,2)) END AS income,
          CAST(c_custkey % 5 AS INT) AS race_id, CAST(c_custkey % 3 AS INT) AS ethnicity_id,
          CAST(c_custkey % 40 AS INT) AS employment_status_id FROM {{customer}}
        UNION ALL
        SELECT c_custkey, concat('OLD', CAST(c_custkey AS STRING)), DATE '1960-01-01',
          {_day('c_custkey % 400 - 30')}, 'Y', 'N', 9, 'F', '00000', 1, CAST(1 AS DECIMAL(12,2)),
          1, 1, 1 FROM {{customer}}""",
    "patient_note": f"""
        SELECT o_orderkey AS patient_note_id, o_custkey AS patientprofileid,
          CAST((o_orderkey * 7 + o_custkey) % 25 AS INT) AS doctorid,
          CAST((o_orderkey * 3 + o_custkey * 5) % 25 AS INT) AS dept_id,
          CAST({_case('(o_orderkey + o_custkey * 2) % 25', list(range(23)) + [2500, 2710])} AS INT) AS template_id,
          {_day('(o_orderkey * 37) % 529')} + {_minutes('480 + (o_orderkey * 7) % 720')} AS note_datetime,
          {_day('(o_orderkey * 37) % 529 + o_orderkey % 7 - 1')} + {_minutes('600')} AS update_datetime,
          CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE CAST(o_orderkey % 5 - 1 AS INT) END AS signedby
        FROM {{orders}}
        UNION ALL
        SELECT o_orderkey, o_custkey, CAST((o_orderkey * 7 + o_custkey) % 25 AS INT),
          CAST((o_orderkey + o_custkey) % 25 AS INT), CAST((o_orderkey + o_custkey) % 4 AS INT),
          {_day('(o_orderkey * 37) % 529 - CASE WHEN o_orderkey % 3 = 0 THEN 31 ELSE 0 END')} + {_minutes('480 + (o_orderkey * 7) % 720')},
          {_day('(o_orderkey * 37) % 529 - 9')}, NULL FROM {{orders}} WHERE o_orderstatus = 'P'""",
    "patient_note_control": f"""
        SELECT patient_note_id, template_field_id, CASE
          WHEN k % 17 = 0 THEN '' WHEN k % 19 = 0 THEN '...'
          WHEN kind = 'number' THEN CAST(q % 28 AS STRING) WHEN kind = 'tick' THEN CAST(q % 2 AS STRING)
          WHEN kind = 'date' THEN CAST(CAST({_day('(p * 13 + patient_note_id) % 529')} AS DATE) AS STRING)
          WHEN kind = 'systolic' THEN CAST(q + 90 + p % 2 * 30 AS STRING)
          WHEN kind = 'diastolic' THEN CAST(q + 50 AS STRING)
          WHEN kind = 'bmi' THEN concat(CAST(15 + q % 25 AS STRING), '.', CAST(k % 10 AS STRING))
          WHEN kind = 'a1c' THEN concat(CAST(4 + q % 9 AS STRING), '.', CAST(k % 10 AS STRING))
          WHEN kind = 'outcome' THEN {_case('q % 6', ['SAB / Miscarriage', 'Decline to state'], "'Live Birth'")}
          WHEN kind = 'weight' THEN
            {_case('q % 3', ['Very Low birth weight', 'low birth weight', 'Normal birth weight'])}
          WHEN kind = 'method' THEN {_case('q % 4', ['IUD', 'Condom', 'Pill', 'Implant'])}
          WHEN kind = 'consent' THEN {_case('q % 2', ['Yes', 'No'])}
          WHEN kind = 'answer' THEN CASE WHEN k % 3 = 0 THEN concat(CAST(q % 28 AS STRING), ' pts')
            ELSE CAST(q % 28 AS STRING) END
          ELSE '1' END AS data_value
        FROM (
          {_slots(_VITALS, 'l_linenumber - 1')}
          UNION ALL
          {_slots(_VITALS, '(l_linenumber + 2) % 7')}
          UNION ALL
          {_slots(_FIELDS_A, 'l_partkey % 25')}
          UNION ALL
          {_slots(_FIELDS_B, '(l_partkey + l_suppkey) % 25')}
        ) AS observed""",
    "template": f"""
        SELECT CAST({_case('n_nationkey', list(range(23)) + [2500, 2710])} AS INT) AS template_id,
          {_case('n', [
              'Progress Note', 'Adult Physical Exam', 'Pediatric Well Child', 'Follow Up Visit',
              'Initial ACOG Clinical Note', 'Nurse Visit', 'LABS Only', 'Title X Visit', 'PHQ Screening',
              'Gynecology Exam', 'OB Visit', 'Optometry Exam', 'Podiatry Consult', 'Agency Note',
              'BH Intake', 'Chronic Disease Visit', 'SDoH Data Questions', 'Annual Wellness',
              'Sick Visit', 'Women Health Visit', 'initial acog clinical note', 'Title X Follow Up',
              'Diabetes Visit', 'Optometry Clinical Note', 'Dental Clinical Note'])} AS template_name,
          CASE n WHEN 18 THEN 69 WHEN 22 THEN 92 WHEN 3 THEN 76 ELSE n END
            AS template_type_id FROM {_NATIONS}""",
    "template_field": f"""
        SELECT 12160 + n_nationkey AS template_field_id,
          concat('Prenatal care began - ', {_case('n_nationkey % 3', ['1st Tri', '2nd Tri', '3rd Tri'])})
            AS field_name FROM {{nation}}""",
    "charge_history": f"""
        SELECT o_custkey AS patient_id, {_day('(l_orderkey * 37 + l_linenumber * 3) % 529')} AS post_fromdate,
          l_suppkey AS procedure_id, l_partkey AS diagnosis_id_1,
          CASE WHEN l_suppkey % 3 = 0 THEN NULL ELSE l_partkey + l_suppkey END AS diagnosis_id_2,
          CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE l_partkey + l_orderkey % 50 END AS diagnosis_id_3,
          CASE WHEN l_linenumber = 1 THEN l_partkey ELSE NULL END AS diagnosis_id_4,
          CAST(l_partkey % 40 AS INT) AS financial_class_id_1,
          CASE WHEN l_linenumber = 2 THEN CAST(l_suppkey % 6 AS INT) ELSE NULL END AS financial_class_id_2,
          CASE WHEN l_linenumber = 3 THEN CAST(l_partkey % 40 AS INT) ELSE NULL END AS financial_class_id_3,
          CASE WHEN l_suppkey % 29 = 0 THEN 8 ELSE 9 END AS company_id
        FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey""",
    "view_chargehistory": f"""
        SELECT o_custkey AS patient_id, {_day('(l_orderkey * 37 + l_linenumber * 3) % 529')} AS post_fromdate,
          l_suppkey AS procedure_id, CAST(l_partkey % 25 AS INT) AS physician_id,
          CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE CAST((l_partkey + l_suppkey) % 25 AS INT) END
            AS physician_id_2,
          CAST((l_orderkey + l_partkey) % 25 AS INT) AS department_id, CAST(l_linenumber % 3 AS INT) AS status
        FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey""",
    "diagnosis": f"""
        SELECT p_partkey AS diagnosis_id, coalesce(code, concat('M', CAST(p_partkey % 200 AS STRING))) AS icd9,
          CASE p_partkey % 200 WHEN 19 THEN 'N' ELSE 'Y' END AS icd10_yn,
          CASE WHEN p_partkey % 43 = 0 THEN 8 ELSE 9 END AS company_id,
          CASE WHEN p_partkey % 41 = 40 THEN 'N' ELSE 'Y' END AS active_yn
        FROM {{part}} LEFT JOIN (SELECT n_nationkey AS slot, {_case('n_nationkey', [
            'E11.9', 'E10.1', 'O24.4', 'I10', 'N18.3', 'F32.1', 'F39', 'Z34.00', 'Z37', 'Z37.0', 'Z30.2',
            'Z90.710', 'A54.01', 'Z30.011', 'O04.5', 'N95.1', 'N76.0', 'e09.9', 'Z72.51', 'V22', 'N76', 'A54.010',
            'n60.11', 'N93.8', 'N64.53'])} AS code
          FROM {{nation}}) AS codes ON p_partkey % 200 = slot""",
    "procedure": f"""
        SELECT s_suppkey AS procedure_id,
          {_case('n % 50', [
              'D0120', 'D0145', 'C9011', '58300', '99213', '87491', 'J1050', '59840', '99406', '99407',
              'd0150'], "concat('X', CAST(n % 50 AS STRING))")} AS procedure_code,
          CASE n % 50 WHEN 8 THEN 848 WHEN 9 THEN 849 ELSE CAST(n % 50 AS INT) END
            AS procedure_number,
          CASE WHEN n % 49 = 48 THEN 'N' ELSE 'Y' END AS active_yn FROM {_SUPPLIERS}""",
    "lab_req": f"""
        SELECT o_orderkey AS lab_result_req_id, CASE WHEN o_orderkey % 17 = 0 THEN 1 ELSE 0 END
          AS lab_hist_req_id, o_custkey AS patientprofileid,
          {_day('(o_orderkey * 53) % 1129 - 600')} + {_minutes('o_orderkey % 1440')} AS obr_obs_datetime
        FROM {{orders}}""",
    "lab_set": f"""
        SELECT DISTINCT l_orderkey * 10 + l_linenumber AS lab_result_set_id,
          CASE WHEN l_orderkey % 17 = 0 THEN 1 ELSE 0 END AS lab_hist_req_id, l_orderkey AS lab_result_req_id,
          {_case('l_linenumber', ['', 'A8011', '58315B', '90933', '18817X', 'L5', 'L6', 'L7'])}
            AS obr_order_code FROM {{lineitem}}""",
    "lab_item": f"""
        SELECT DISTINCT (l_orderkey * 10 + l_linenumber) * 8 + l_partkey % 8 AS lab_result_item_id,
          CASE WHEN l_orderkey % 17 = 0 THEN 1 ELSE 0 END AS lab_hist_req_id,
          l_orderkey * 10 + l_linenumber AS lab_result_set_id,
          {_case('l_partkey % 8', ['2040', '50026400', '75400597', 'RESULT_1', '90001256', 'xAPResult1',
                                    '7504', 'RESULTA1'])} AS result_code,
          {_case('l_partkey % 8', ['A1c', 'A1c', 'FIT', 'Occult Blood', 'Pap', 'Pap',
                                    'Chlamydia Trachomatis RNA, TMA', 'OCCULT BLOOD'])} AS result_desc
        FROM {{lineitem}}""",
    "lab_value": """
        SELECT DISTINCT (l_orderkey * 10 + l_linenumber) * 8 + l_partkey % 8 AS lab_result_item_id,
          CASE WHEN l_orderkey % 17 = 0 THEN 1 ELSE 0 END AS lab_hist_req_id,
          CASE WHEN l_suppkey % 13 = 0 THEN 'pending' ELSE
            concat(CAST(4 + CAST(l_quantity AS INT) % 9 AS STRING), '.', CAST(l_suppkey % 10 AS STRING))
          END AS result_value,
          CASE WHEN l_suppkey % 11 = 0 THEN NULL ELSE 'F' END AS result_status FROM {lineitem}""",
    "patientappt": f"""
        SELECT o_orderkey AS appointmentid, o_custkey AS patientprofileid,
          {_day('(o_orderkey * 37) % 529')} + {_minutes('o_orderkey % 3 * 240')} AS booking_date,
          {_day('(o_orderkey * 37) % 529 - o_orderkey % 40')} + {_minutes('o_orderkey % 1440')}
            AS booked_by_date,
          CAST(480 + (o_orderkey * 7) % 720 AS INT) AS start_minutes,
          CAST((o_orderkey * 3 + o_custkey * 5) % 25 AS INT) AS departmentid,
          CAST((o_orderkey * 7 + o_custkey) % 25 AS INT) AS doctorid,
          CAST({_case('(o_orderkey * 5 + o_custkey) % 12',
                      [0, 1, 2, 3, 4, 5, 58849498, 53915600, 8, 9, 10, 11])} AS INT) AS visit_type_id,
          CASE WHEN o_orderkey % 23 = 0 THEN 'Booked' WHEN o_orderkey % 29 = 0 THEN 'Walk Out'
            WHEN o_orderstatus = 'F' OR o_orderkey % 6 = 1 THEN 'Appt Kept' WHEN o_orderstatus = 'O' THEN 'No Show'
            ELSE 'Cancelled' END AS status,
          CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS canceled,
          CASE o_orderkey % 5 WHEN 0 THEN 37465493 WHEN 1 THEN NULL ELSE CAST(o_orderkey % 25 AS INT) END
            AS cancelled_by,
          {_case('o_orderkey % 3', ['', 'Patient request'])} AS cancel_comment,
          CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_orderkey % 4 AS INT) END AS disposition,
          CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE
            {_day('(o_orderkey * 37) % 529')} + {_minutes('480 + (o_orderkey * 7) % 720')} END AS pat_arrived,
          {_day('(o_orderkey * 37) % 529')} + {_minutes('490 + (o_orderkey * 7) % 720')} AS pat_registered,
          {_day('(o_orderkey * 37) % 529')} + {_minutes('500 + (o_orderkey * 7) % 720 + o_orderkey % 90')}
            AS pat_discharged FROM {{orders}}""",
    "patientapptresp": f"""
        SELECT o_orderkey AS appointmentid,
          {_case('o_orderkey % 4', ['NO SHOW -  REASON', 'NO SHOW - 1ST ATTEMPT', 'NO SHOW - 2ND ATTEMPT',
                                    'OTHER'])} AS question,
          {_case('o_orderkey % 5', ['-', 'Forgot', 'Work', ' - ', 'Transport'])} AS response_text FROM {{orders}}
        UNION ALL
        SELECT o_orderkey, {_case('(o_orderkey + 1) % 4', ['NO SHOW -  REASON', 'no show - 1st attempt',
                                  'NO SHOW - 2ND ATTEMPT', 'OTHER'])}, 'Left message' FROM {{orders}}""",
    "appt_tracking": """
        SELECT event_id AS appt_tracking_id, CAST((event_id - event_id % 4) * 3 / 2 AS BIGINT) AS bookings_id,
          CASE event_type WHEN 'signup' THEN 'Arrived' WHEN 'view' THEN 'Registered' WHEN 'click' THEN 'Admitted'
            WHEN 'purchase' THEN 'PROV IN' ELSE CASE WHEN event_id % 2 = 0 THEN 'XM COMP' ELSE 'Discharged' END
          END AS tracking_type,
          CASE WHEN event_id % 13 = 0 THEN 'N' ELSE 'Y' END AS active_yn, ts AS start_datetime FROM {events}""",
    "superbill": f"""
        SELECT o_orderkey AS appointmentid, o_custkey AS patientprofileid,
          CAST((o_orderkey * 3 + 1) % 25 AS INT) AS dept_id, CAST((o_orderkey * 7 + o_custkey) % 25 AS INT)
            AS doctorid,
          CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST((o_orderkey * 3 + o_custkey) % 25 AS INT) END
            AS doctor2id, CAST(o_orderkey % 5 - 1 AS INT) AS signedby,
          {_day('(o_orderkey * 37) % 529')} AS superbill_datetime,
          {_day('(o_orderkey * 37) % 529 + o_orderkey % 3')} AS created_date,
          CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE
            {_day('(o_orderkey * 37) % 529 + o_orderkey % 6')} END AS update_datetime FROM {{orders}}""",
    "document": f"""
        SELECT o_orderkey AS document_id, o_custkey AS patientprofileid,
          CAST((o_orderkey * 7 + o_custkey) % 25 AS INT) AS doctorid,
          CAST((o_orderkey * 3 + o_custkey * 5) % 25 AS INT) AS dept_id, CAST(o_orderkey % 12 AS INT) AS doc_type_id,
          CASE WHEN o_orderkey % 9 = 0 THEN 'scan_FOBT.pdf' ELSE 'scan.pdf' END AS file_name,
          {_day('(o_orderkey * 47) % 559')} + {_minutes('o_orderkey % 1440')} AS doc_date,
          {_day('(o_orderkey * 47) % 559 - o_orderkey % 9')} AS created_date,
          {_day('(o_orderkey * 47) % 559 + o_orderkey % 5')} AS update_datetime,
          CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_orderkey % 30 AS INT) END AS signedby FROM {{orders}}""",
    "lookups": f"""
        SELECT n_nationkey AS lookup_id, {_case('n', [
            'BCP', 'Consult Report', 'Health Assessment', 'Letter', 'History & Physical', 'hospital record',
            'Lab', 'Form', 'Old Clinical Notes', 'SOAP Note', 'X-Ray/Ultrasound', 'Insurance'], "'Other'")}
          AS lookup_item FROM {_NATIONS}""",
    "notification": f"""
        SELECT o_orderkey AS notification_id, CAST(o_orderkey % 7 AS INT) AS notification_rule_id,
          o_custkey AS patientprofileid, CAST((o_orderkey * 7 + o_custkey) % 25 AS INT) AS doctorid,
          CAST((o_orderkey * 3 + o_custkey * 5) % 25 AS INT) AS deptid,
          CASE WHEN o_orderkey % 11 = 0 THEN 8 ELSE 9 END AS company_id,
          {_case('o_orderkey % 3', [8961, 8962], '9000')} AS teamid,
          {_case('o_orderkey % 3', ['  Team A ', 'Team B'], "'Team C'")} AS team_name,
          {_day('(o_orderkey * 47) % 529')} + {_minutes('o_orderkey % 1440')} AS notif_date,
          concat('Hospital visit ', CAST(o_orderkey % 10 AS STRING)) AS item_description,
          CASE WHEN o_orderkey % 4 = 0 THEN 0 ELSE 1 END AS completed_flag,
          CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE {_day('(o_orderkey * 47) % 529 + o_orderkey % 20')} END
            AS completed_datetime FROM {{orders}}""",
    "notification_rule": f"""
        SELECT n_nationkey AS notification_rule_id, CASE WHEN n % 5 = 0 THEN 0 ELSE 1 END AS active_flag
        FROM {_NATIONS}""",
    "patient_drug": f"""
        SELECT o_custkey AS patientprofileid, {_case('o_orderkey % 12', [
            'Apri', 'apri extended', 'Plan B One Step', 'Amoxicillin', 'Ibuprofen', 'TRIAMCINOLONE', 'Mirena IUD',
            'Metformin', 'Lisinopril', 'Atorvastatin', 'Albuterol', 'Zinc'])} AS drug_name,
          {_day('(o_orderkey * 31) % 529')} AS start_date FROM {{orders}}""",
    "patient_shortcode": f"""
        SELECT c_custkey AS patient_id, {_case('c_custkey % 4', [
            'YES TRANSLATOR', 'NO TRANSLATION', 'MAYBE TRANSLATE', 'OTHER'])} AS code FROM {{customer}}""",
    "financial_class": f"""
        SELECT n_nationkey AS financial_class_id, concat('Plan ', CAST(n AS STRING)) AS description
        FROM {_NATIONS}""",
    "fee_matrix_detail": """
        SELECT 1 AS fee_matrix_id, 9 AS company_id, CAST(1 + (n_nationkey - n_nationkey % 4) / 4 AS INT) AS family_size,
          CAST(n_nationkey % 4 * 2000 AS DECIMAL(12,2)) AS income_from,
          CAST(n_nationkey % 4 * 2000 + 1999.99 AS DECIMAL(12,2)) AS income_to,
          concat('Level ', CAST(n_nationkey % 4 + 1 AS STRING)) AS poverty_status FROM {nation}
        UNION ALL
        SELECT 2, 8, CAST(1 + (n_nationkey - n_nationkey % 4) / 4 AS INT), CAST(n_nationkey % 4 * 1000 AS DECIMAL(12,2)),
          CAST(n_nationkey % 4 * 1000 + 999.99 AS DECIMAL(12,2)), 'Elsewhere' FROM {nation}""",
    "physician": f"""
        SELECT n_nationkey AS phys_id, {_FIRST} AS first_name, {_LAST} AS last_name, {_DEGREE} AS degree,
          CASE WHEN n = 17 THEN 'N' ELSE 'Y' END AS active_yn FROM {_NATIONS}""",
    "department": f"""
        SELECT n_nationkey AS departmentid,
          CASE WHEN n = 13 THEN NULL ELSE concat('Clinic ', CAST(n AS STRING)) END AS short_name,
          concat('C', CAST(n AS STRING)) AS short,
          CASE n % 4 WHEN 0 THEN 'Main Dental Clinic' WHEN 1 THEN 'zz Dental Old' ELSE 'Medical' END
            AS listname FROM {_NATIONS}""",
    "staff": f"""
        SELECT n_nationkey AS staffid, n_nationkey AS doctorid, concat('Staff ', CAST(n AS STRING))
          AS fullname FROM {_NATIONS}""",
    "value_set_code": "SELECT 'reproductive_health' AS set_name, code, code_to, kind FROM (VALUES " + ", ".join(
        [f"('{c}', CAST(NULL AS STRING), 'exact')" for c in _REPRODUCTIVE_HEALTH]
        + [f"('{c}', " + (f"'{to}'" if to else "CAST(NULL AS STRING)") + f", '{kind}')" for c, to, kind in _CODE_RULES])
        + ") AS listed(code, code_to, kind)",
    "lists": f"""
        SELECT n_nationkey AS medlistsid, concat('Item ', CAST(n AS STRING)) AS description FROM {_NATIONS}""",
    "visit_type": f"""
        SELECT CASE n_nationkey WHEN 6 THEN 58849498 WHEN 7 THEN 53915600 ELSE n_nationkey END AS visit_type_id,
          {_case('n', ['OV', 'OV', 'BH', 'OPT', 'NURSE', 'OV', 'ELIG', 'OB', 'BH', 'WALK', 'BH', 'OV'],
                 "'PTO'")} AS short_desc,
          {_case('n', ['Office Visit', 'Telehealth Visit', 'Behavioral Health Intake', 'Optometry Exam',
                                 'Nurse Visit', 'Phone Follow Up', 'Eligibility Check', 'OB Visit', 'BH Group',
                                 'Walk In Visit', 'Behavioral Counseling', 'Physical'], "'Calendar'")}
            AS description FROM {_NATIONS}""",
    "active_phys": f"""
        SELECT n_nationkey AS doctorid, concat({_LAST}, ', ', {_FIRST}) AS provider_name, {_FIRST} AS first_name,
          {_LAST} AS last_name, {_DEGREE} AS degree,
          CASE WHEN n % 11 = 10 THEN '' ELSE concat('10', CAST(n AS STRING)) END AS individual_npi,
          CASE WHEN n = 17 THEN 'N' ELSE 'Y' END AS active_yn, 1 AS rn FROM {_NATIONS}""",
    "ddb_pat": f"""
        SELECT c_custkey AS patid, concat('X', CAST(c_custkey AS STRING)) AS patextid,
          concat('A', CAST(c_custkey AS STRING)) AS pataccountnumber,
          CASE WHEN c_custkey % 53 = 0 THEN 'Test' ELSE 'Doe' END AS lastname,
          CASE WHEN c_custkey % 106 = 0 THEN 'TEST' ELSE 'Jo' END AS firstname, {_BIRTH} AS birthdate,
          {_day('c_custkey % 300')} AS ddb_last_mod, CASE WHEN c_custkey % 59 = 0 THEN 2 ELSE 1 END AS status
        FROM {{customer}}
        UNION ALL
        SELECT c_custkey, concat('OLDX', CAST(c_custkey AS STRING)), concat('OLDA', CAST(c_custkey AS STRING)),
          'Doe', 'Jo', DATE '1990-01-01', {_day('c_custkey % 300 - 10')}, 1 FROM {{customer}}""",
    "ddb_rsc": f"""
        SELECT n_nationkey AS urscid, CASE WHEN n % 9 = 8 THEN 2 ELSE 1 END AS rsctype,
          CASE WHEN n = 4 THEN 'Walk-In' WHEN n = 5 THEN NULL
            ELSE concat('Dent', CAST(n AS STRING)) END AS name_last,
          concat('First', CAST(n AS STRING)) AS name_first,
          CASE WHEN n = 6 THEN 0 ELSE 1 END AS activeflag, CASE WHEN n = 7 THEN 1 ELSE 0 END
            AS isnonperson FROM {_NATIONS}""",
    "ddb_clinic": f"""
        SELECT n_nationkey AS urscid, {_case('n % 8', [
            'No_Clinic', 'EAGLEROCK', 'SUNLAND', 'CENTRAL', 'INACTIVE', 'GLENDALE', 'NORTH'])} AS rscid
        FROM {_NATIONS}""",
    "ddb_proc_log": f"""
        SELECT o_custkey AS patid, {_day('(l_orderkey * 37 + l_linenumber * 5) % 529')} AS pldate,
          l_suppkey AS proc_codeid, CAST(l_partkey % 25 AS INT) AS provid,
          CAST((l_partkey + l_orderkey) % 25 AS INT) AS clinicappliedto,
          CASE WHEN l_linenumber = 3 THEN 101 ELSE 102 END AS chart_status,
          CASE WHEN l_partkey % 5 = 0 THEN 1 ELSE 0 END AS history
        FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey""",
    "ddb_proc_code": f"""
        SELECT s_suppkey AS proc_codeid, {_case('n % 20', [
            'D0120', 'D0145', 'D0150', 'D0601', 'D0602', 'D0603', 'D0210', 'D0220', 'D0274', 'D1206', 'D2140',
            'D2330', 'C2002', 'D2752', 'D2790', 'C9017', 'D1351', 'D0120 ', 'C9017', 'C9017'])} AS adacode
        FROM {_SUPPLIERS}""",
}


def source(spark: SparkSession, sf_dir: str, config: SiteConfig = CONFIG) -> Source:
    """The clinical tables over the given Parquet files in ``sf_dir``."""
    @cache
    def given(table: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{table}.parquet")

    def load(name: str) -> DataFrame:
        text = TABLES[name].replace("@BASE@", f"TIMESTAMP_NTZ'{FIRST_DAY}'")
        df = spark.sql(text, **{t: given(t) for t in set(re.findall(r"\{(\w+)\}", text))})
        return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema(name)])

    return Source(load, config)


def as_cte(name: str) -> str:
    """The same table as a common table expression for another SQL engine."""
    text = TABLES[name].replace("@BASE@", f"TIMESTAMP '{FIRST_DAY}'")
    return f"{name} AS ({re.sub(r'{(' + '|'.join(GIVEN) + r')}', chr(92) + '1', text)})"
