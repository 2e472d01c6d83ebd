"""SQL statements the measures are checked against (June 1998, run on 1998-07-15).

Written from the rules of each report with windows, correlated subqueries and OR joins, not
from the DataFrame code. Only the fixed code lists are shared.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from care_measures.functions import valuesets as vs
from care_measures.sources import driver_tables as dt

S, E = "DATE '1998-06-01'", "DATE '1998-06-30'"
YEAR_BEFORE_START, YEAR_BEFORE_END = "DATE '1997-06-01'", "DATE '1997-06-30'"
PRIOR_START, PRIOR_END, PRIOR_END_CLAMPED = "DATE '1998-05-01'", "DATE '1998-05-31'", "DATE '1998-05-30'"
AS_OF = "DATE '1998-07-15'"


def _list(codes: Iterable[str]) -> str:
    return ", ".join("'" + c.lower().replace("'", "''") + "'" for c in codes)


def _ilike(col: str, patterns: Iterable[str]) -> str:
    return "(" + " OR ".join(f"{col} ILIKE '{p}'" for p in patterns) + ")"


def _black(patterns, names, types) -> str:
    pats = " AND ".join(f"template_name NOT ILIKE '{p}'" for p in (*vs.TEMPLATE_PATTERNS, *patterns, "%agency%"))
    return (f"SELECT template_id, template_name FROM template WHERE {pats} AND lower(template_name) NOT IN "
            f"({_list((*vs.TEMPLATE_NAMES, *names))}) AND template_type_id NOT IN ({', '.join(map(str, types))})")


def age(birth: str) -> str:
    return f"CAST(floor(date_diff('day', {birth}, {AS_OF}) * 24 / 8766) AS INTEGER)"


def us(d: str) -> str:
    return f"strftime({d}, '%m/%d/%Y')"


def num(v: str) -> str:
    return f"CASE WHEN regexp_matches(trim({v}), '^[+-]?[0-9]+$') THEN TRY_CAST({v} AS INTEGER) END"


def workdays(a: str, b: str) -> str:
    """Weekdays counted one by one."""
    def count(lo, hi):
        return f"len([x for x in generate_series({lo} + 1, {hi}, INTERVAL 1 DAY) if dayofweek(x) NOT IN (0, 6)])"
    return f"CAST(CASE WHEN {a} <= {b} THEN {count(a, b)} WHEN {a} > {b} THEN -{count(b, a)} END AS INTEGER)"


def any_slot(alias: str, ref: str, n: int = 4, stem: str = "diagnosis_id") -> str:
    return "(" + " OR ".join(f"{ref} = {alias}.{stem}_{i}" for i in range(1, n + 1)) + ")"


def charged_with(dim: str, where: str = "TRUE") -> str:
    """Patients with a charge that names a row of ``dim`` in one of its four slots."""
    return " UNION ALL ".join(
        f"SELECT ch.patient_id FROM charge_history ch JOIN ({dim}) g{i} ON g{i}.diagnosis_id = ch.diagnosis_id_{i} "
        f"WHERE {where}" for i in range(1, 5))


def charged_on(start: str) -> str:
    return f"CAST(ch.post_fromdate AS DATE) BETWEEN {start} AND {E}"


# Helper relations; each is added in front of a statement that mentions it.
HELPERS: dict[str, str] = {
    "pts": f"""SELECT *, {age('birthdate')} AS age, CAST(date_sub('month', birthdate, {AS_OF}) AS INTEGER) AS agemonth
        FROM view_patient""",
    "phys": "SELECT * FROM active_phys WHERE active_yn = 'Y' AND rn = 1",
    "medphys": """SELECT * FROM phys WHERE degree NOT IN ('DDS', 'DPM', 'LCSW', '') AND individual_npi <> ''
        AND provider_name NOT IN ('Last9, First9', 'Last16, First16')""",
    "newest": """SELECT * FROM patient_note QUALIFY row_number() OVER (PARTITION BY patient_note_id
        ORDER BY update_datetime DESC NULLS LAST) = 1""",
    "mednotes": f"SELECT * FROM newest JOIN ({_black(vs.MEDICAL_PATTERNS, (), vs.MEDICAL_TYPES)}) USING (template_id)",
    "signnotes": f"SELECT * FROM newest JOIN ({_black(vs.SIGN_OFF_PATTERNS, vs.SIGN_OFF_NAMES, vs.SIGN_OFF_TYPES)}) "
                 "USING (template_id)",
    "tobnotes": f"SELECT * FROM newest JOIN ({_black(vs.TOBACCO_PATTERNS, (), vs.TOBACCO_TYPES)}) USING (template_id)",
    "obs": """SELECT n.patientprofileid AS pid, n.patient_note_id AS nid, n.note_datetime AS ts,
        CAST(n.note_datetime AS DATE) AS d, n.template_id, c.template_field_id AS f, c.data_value AS v
        FROM patient_note n JOIN patient_note_control c ON n.patient_note_id = c.patient_note_id""",
    "dx": "SELECT * FROM diagnosis WHERE active_yn = 'Y' AND company_id = 9",
    "px": "SELECT * FROM procedure WHERE active_yn = 'Y'",
    "pregnant": charged_with(f"SELECT diagnosis_id FROM dx WHERE lower(icd9) IN ({_list(vs.SUPERVISED_PREGNANCY)})",
                             charged_on(YEAR_BEFORE_END)),
    "regpts": f"""SELECT p.*, {age('birth_date')} AS age FROM patient p JOIN (SELECT patient_id, max(modified_date) AS latest
        FROM patient WHERE active_yn = 'Y' AND deleted_yn <> 'Y' AND company_id = 9 GROUP BY patient_id) m
        ON m.patient_id = p.patient_id AND m.latest = p.modified_date WHERE p.active_yn = 'Y'""",
    "dpat": f"""SELECT *, {age('birthdate')} AS age FROM ddb_pat WHERE status = 1
        AND NOT (lower(lastname) = 'test' AND lower(firstname) = 'test')
        QUALIFY row_number() OVER (PARTITION BY patid ORDER BY ddb_last_mod DESC) = 1""",
    "dprov": """SELECT urscid, concat(name_last, ', ', name_first) AS provider FROM ddb_rsc WHERE rsctype = 1
        AND activeflag = 1 AND isnonperson = 0 AND name_last IS NOT NULL AND name_first IS NOT NULL
        AND lower(name_last) NOT IN ('def_prov', 'walk-in', 'test', 'agency')
        AND lower(name_first) NOT IN ('test', 'agency')""",
    "dclin": """SELECT urscid, CASE WHEN rscid IS NULL OR rscid = 'No_Clinic' THEN '' WHEN rscid = 'EAGLEROCK' THEN 'ER'
        WHEN rscid = 'SUNLAND' THEN 'SL' WHEN rscid = 'CENTRAL' THEN 'CENT' WHEN rscid = 'GLENDALE' THEN 'GL'
        ELSE rscid END AS clinic FROM ddb_clinic""",
    "chart": """SELECT l.*, CAST(l.pldate AS DATE) AS d, c.adacode FROM ddb_proc_log l
        LEFT JOIN ddb_proc_code c USING (proc_codeid) WHERE chart_status = 102 AND history = 0""",
    "results": """SELECT r.patientprofileid AS pid, r.obr_obs_datetime AS ts, s.obr_order_code, i.result_code,
        i.result_desc, i.lab_result_item_id AS iid, v.result_value, v.result_status, s.lab_hist_req_id AS sh,
        r.lab_hist_req_id AS rh, i.lab_hist_req_id AS ih, v.lab_hist_req_id AS vh
        FROM lab_item i JOIN lab_set s ON i.lab_result_set_id = s.lab_result_set_id
        JOIN lab_req r ON s.lab_result_req_id = r.lab_result_req_id
        JOIN lab_value v ON i.lab_result_item_id = v.lab_result_item_id""",
    "fields": "SELECT DISTINCT pid, d, f FROM obs",
    "reproductive": """SELECT DISTINCT g.icd9 FROM diagnosis g JOIN value_set_code s ON s.set_name = 'reproductive_health'
        AND CASE s.kind WHEN 'range' THEN upper(rtrim(g.icd9)) BETWEEN upper(s.code) AND upper(s.code_to)
        WHEN 'pattern' THEN g.icd9 ILIKE s.code ELSE lower(rtrim(g.icd9)) = lower(s.code) END""",
}


def with_tables(sql: str) -> str:
    """Prefix a statement with the helper relations and clinical tables it mentions."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in {**HELPERS, **dt.TABLES}:
            if name not in needed and re.search(rf"\b{name}\b", text):
                if name in HELPERS:
                    visit(HELPERS[name])
                needed.append(name)

    visit(sql)
    # The lab join is evaluated by itself: its history ids are no useful join keys.
    ctes = [dt.as_cte(n) if n in dt.TABLES else
            f"{n} AS {'MATERIALIZED ' if n == 'results' else ''}({HELPERS[n]})" for n in needed]
    return f"WITH {', '.join(ctes)} {sql}" if ctes else sql


def at(field: int | str, pid: str, when: str, ok: str = "TRUE") -> str:
    """Newest value of a field under a condition on its day ``d``."""
    ids = field if isinstance(field, str) else str(field)
    return (f"(SELECT v FROM obs WHERE obs.pid = {pid} AND f IN ({ids}) AND {when} AND {ok} "
            "ORDER BY ts DESC, nid DESC, v DESC LIMIT 1)")


def on(field, pid, day, ok="TRUE"):
    return at(field, pid, f"d = {day}", ok)


def upto(field, pid, day, ok="TRUE"):
    return at(field, pid, f"d <= {day}", ok)


def consents(pid: str, day: str, first: str, second: str) -> str:
    return f'{upto(16001, pid, day)} AS "{first}", {upto(16002, pid, day)} AS "{second}"'


def last_note(notes: str, providers: str, dept: bool = True, extra: str = "", where: str = "TRUE") -> str:
    """Newest note of each patient in the month with an eligible provider and patient."""
    d = "JOIN department dep ON n.dept_id = dep.departmentid" if dept else ""
    short = "dep.short_name," if dept else ""
    tie = ", dep.short_name DESC NULLS LAST" if dept else ""  # versions of one note
    return f"""SELECT n.patientprofileid AS pid, n.note_datetime, CAST(n.note_datetime AS DATE) AS day, {short}
        ph.provider_name, ph.last_name, ph.first_name, p.patientid, p.birthdate, p.age, p.agemonth, p.sex
        FROM {notes} n JOIN {providers} ph ON n.doctorid = ph.doctorid {d}
        JOIN pts p ON n.patientprofileid = p.patientprofileid {extra}
        WHERE CAST(n.note_datetime AS DATE) BETWEEN {S} AND {E} AND {where}
        QUALIFY row_number() OVER (PARTITION BY n.patientprofileid
          ORDER BY n.note_datetime DESC, n.patient_note_id DESC, ph.provider_name DESC {tie}) = 1"""


NOT_LEFT_OUT = "ph.provider_name <> 'Last3, First3'"
TELE = ("Patient Consents to Telehealth Visit", "Patient Consents to Telephone Visit")
TELE_LOWER = ("Patient Consents to telehealth Visits", "Patient Consents to telephone Visits")
TELE_PHONE = ("Patient Consents to Telehealth Visit", "Patient Consents to TelePhone Visit")

SQL: dict[str, str] = {}

SQL["m01_adult_weight"] = f"""
SELECT provider_name AS "Provider", patientid AS "Patient ID", age AS "Age", coalesce(bmi, '') AS "Last BMI",
  CASE WHEN bmi IS NULL THEN 0 ELSE 1 END AS "BMI Recorded",
  CASE WHEN bmi IS NULL THEN 1 WHEN TRY_CAST(mbmi AS DECIMAL(10,2)) BETWEEN 18.5 AND 24.9 THEN 0 ELSE 1 END AS "Out Of Range",
  coalesce({num('plan')}, 0) AS "Wt Mgmt F/u Plan",
  CASE WHEN bmi IS NULL THEN 'N' WHEN TRY_CAST(mbmi AS DECIMAL(10,2)) BETWEEN 18.5 AND 24.9 THEN 'Y'
    WHEN coalesce({num('plan')}, 0) = 0 THEN 'N' ELSE 'Y' END AS "Documented",
  {consents('q.pid', 'q.day', *TELE_PHONE)}
FROM (SELECT v.*, {on(1719, 'v.pid', 'v.day')} AS bmi, {at(1719, 'v.pid', f'd BETWEEN {S} AND {E}')} AS mbmi,
    {on(14466, 'v.pid', 'v.day')} AS plan
  FROM ({last_note('mednotes', 'medphys', False, where=f"p.age >= 18 AND p.rn = 1 AND {NOT_LEFT_OUT}")}) v
  WHERE v.pid NOT IN (SELECT patient_id FROM pregnant)) q"""

_BOOKABLE = """vt.description NOT ILIKE '%nurse%' AND vt.description NOT ILIKE '%cpsp%' AND vt.description NOT ILIKE 'walk in%'
  AND vt.description NOT ILIKE 'walk-in%' AND upper(vt.short_desc) NOT IN ('HOLIDAY', 'MEETING', 'PTO', 'ADMIN', 'DO NOT USE')"""

SQL["m02_appointment_status"] = f"""
SELECT a.appointmentid AS "Appointment ID", dep.short_name AS "Dept", p.patientid AS "Patient ID",
  {us('a.booking_date')} AS "DOS",
  CASE WHEN a.status = 'Cancelled' AND (a.cancelled_by = 37465493 OR a.disposition = 2) THEN 'Cancelled by Patient'
    WHEN a.status = 'Cancelled' AND (a.cancelled_by <> 37465493 OR a.disposition = 3) THEN 'Cancelled by Doctor'
    ELSE a.status END AS "Appt Status", a.canceled AS "Cancelled",
  CASE WHEN a.status IN ('No Show', 'Cancelled') THEN coalesce({us('''(SELECT min(f.booking_date) FROM patientappt f
      JOIN visit_type ft ON f.visit_type_id = ft.visit_type_id JOIN department fd ON f.departmentid = fd.departmentid
      WHERE f.patientprofileid = a.patientprofileid AND ft.short_desc = vt.short_desc AND '''
      + _BOOKABLE.replace('vt.', 'ft.') + f''' AND CAST(f.booked_by_date AS DATE) BETWEEN {S} AND {E}
      AND (CAST(f.booking_date AS DATE) > CAST(a.booking_date AS DATE)
        OR (CAST(f.booking_date AS DATE) = CAST(a.booking_date AS DATE) AND f.start_minutes > a.start_minutes)))''')}, '')
    ELSE '' END AS "Future Appt",
  CASE WHEN a.status = 'Appt Kept' THEN ''
    WHEN a.status = 'Cancelled' AND coalesce(a.cancel_comment, '') = '' AND a.cancelled_by = 37465493
      THEN 'Cancelled on Patient Portal' ELSE coalesce(a.cancel_comment, '') END AS "Cancellation Reason",
  CASE WHEN a.status = 'No Show' AND trim(r0.t) <> '-' THEN r0.t ELSE '' END AS "No Show Reason",
  CASE WHEN a.status = 'No Show' THEN coalesce(r1.t, '') ELSE '' END AS "No Show 1st Comment",
  CASE WHEN a.status = 'No Show' THEN coalesce(r2.t, '') ELSE '' END AS "No Show 2nd Comment",
  CASE WHEN a.status IN ('No Show', 'Cancelled', 'Appt Kept', 'Booked') THEN 0 ELSE 1 END AS "Unknown",
  dep.short AS "short"
FROM patientappt a JOIN pts p ON a.patientprofileid = p.patientprofileid
JOIN visit_type vt ON a.visit_type_id = vt.visit_type_id JOIN department dep ON a.departmentid = dep.departmentid
JOIN phys ph ON a.doctorid = ph.doctorid
LEFT JOIN (SELECT appointmentid, max(response_text) AS t FROM patientapptresp
  WHERE upper(question) = 'NO SHOW -  REASON' GROUP BY 1) r0 ON r0.appointmentid = a.appointmentid
LEFT JOIN (SELECT appointmentid, max(response_text) AS t FROM patientapptresp
  WHERE upper(question) = 'NO SHOW - 1ST ATTEMPT' GROUP BY 1) r1 ON r1.appointmentid = a.appointmentid
LEFT JOIN (SELECT appointmentid, max(response_text) AS t FROM patientapptresp
  WHERE upper(question) = 'NO SHOW - 2ND ATTEMPT' GROUP BY 1) r2 ON r2.appointmentid = a.appointmentid
WHERE CAST(a.booking_date AS DATE) BETWEEN {S} AND {E} AND lower(a.status) NOT IN ('booked', 'registered', 'confirmed')
  AND {_BOOKABLE}"""

SQL["m03_cervical_cancer"] = f"""
SELECT concat(v.last_name, ', ', v.first_name) AS "Provider", coalesce(v.short_name, '') AS "Clinic",
  v.patientid AS "Patient ID", {us('v.birthdate')} AS "DOB", v.age AS "Age", {us('v.note_datetime')} AS "DOS",
  coalesce({us('pap.ts')}, '') AS "Last Pap Date",
  {consents('v.pid', 'v.day', *TELE_LOWER)}
FROM ({last_note('mednotes', 'medphys', where=f'''p.age BETWEEN 21 AND 64 AND p.sex = 'F' AND p.rn = 1
  AND EXISTS (SELECT 1 FROM patientappt a WHERE a.patientprofileid = n.patientprofileid AND a.visit_type_id <> 58849498
    AND CAST(a.booking_date AS DATE) = CAST(n.note_datetime AS DATE))''')}) v
LEFT JOIN (SELECT pid, max(ts) AS ts FROM results WHERE CAST(ts AS DATE) BETWEEN DATE '1995-06-01' AND {E}
  AND {_ilike('result_code', vs.PAP_RESULT_PATTERNS)} AND {_ilike('obr_order_code', vs.PAP_ORDER_PATTERNS)}
  GROUP BY pid) pap ON pap.pid = v.pid
WHERE v.pid IN ({charged_with("SELECT diagnosis_id FROM diagnosis WHERE icd9 <> 'Z90.710'", charged_on("DATE '1995-06-01'"))})"""

_ICD10 = "(" + _ilike("icd9", vs.SEXUALLY_ACTIVE_ICD10_PATTERNS) + " OR " + " OR ".join(
    f"upper(icd9) BETWEEN '{a}' AND '{b}'" for a, b in vs.SEXUALLY_ACTIVE_ICD10_RANGES) + ")"

SQL["m04_chlamydia"] = f"""
SELECT v.provider_name AS "Provider", v.short_name AS "Clinic", v.patientid AS "Patient ID",
  {us('v.birthdate')} AS "Date Of Birth", v.age AS "Age", {us('v.note_datetime')} AS "Last Visit Date",
  coalesce({us('lab.ts')}, '') AS "Test Date In Last 12 mo", CASE WHEN lab.ts IS NULL THEN 'N' ELSE 'Y' END AS "Met",
  {consents('v.pid', 'v.day', *TELE)}
FROM ({last_note('mednotes', 'medphys', where="p.age BETWEEN 13 AND 24 AND p.sex = 'F' AND p.rn = 1")}) v
LEFT JOIN (SELECT pid, max(ts) AS ts FROM results WHERE abs(sh - rh) + abs(sh - ih) + abs(sh - vh) = 0 AND result_status IS NOT NULL
  AND lower(result_desc) IN ({_list(vs.CHLAMYDIA_RESULTS)})
  AND CAST(ts AS DATE) BETWEEN {YEAR_BEFORE_START} AND {E} GROUP BY pid) lab ON lab.pid = v.pid
WHERE v.pid IN ({charged_with(f'''SELECT diagnosis_id FROM dx WHERE (icd10_yn = 'N'
    AND lower(icd9) IN ({_list(vs.SEXUALLY_ACTIVE_ICD9)})) OR (icd10_yn = 'Y' AND {_ICD10})''')})
  OR v.pid IN (SELECT ch.patient_id FROM charge_history ch
    LEFT JOIN (SELECT procedure_id FROM px WHERE lower(procedure_code) IN ({_list(vs.SEXUALLY_ACTIVE_PROCEDURES)})) c
      ON ch.procedure_id = c.procedure_id
    LEFT JOIN (SELECT DISTINCT patientprofileid AS dp FROM patient_drug WHERE CAST(start_date AS DATE)
      BETWEEN {YEAR_BEFORE_START} AND {E} AND {_ilike('drug_name', vs.CONTRACEPTIVE_DRUGS)}) g ON g.dp = ch.patient_id
    WHERE CAST(ch.post_fromdate AS DATE) BETWEEN {YEAR_BEFORE_START} AND {E}
      AND (c.procedure_id IS NOT NULL OR g.dp IS NOT NULL))"""

_WINDOW = f"d BETWEEN {YEAR_BEFORE_START} AND {E}"
_LEAD = f"CASE WHEN ({num('substr(v, 1, 2)')}) IS NOT NULL THEN substr(v, 1, 2) ELSE substr(v, 1, 1) END"

SQL["m05_depression"] = f"""
WITH_SCORES
SELECT provider_name AS "Provider", short_name AS "Clinic", patientid AS "Patient ID", age AS "Age",
  {us('note_datetime')} AS "DOS", coalesce(score, '') AS "Last PHQ Score", coalesce({us('scr')}, '') AS "Last PHQ Date",
  CASE WHEN scr IS NULL THEN 0 ELSE 1 END AS "Screened", pos AS "Positive Result", fu AS "Follow-Up Plan",
  CASE WHEN scr IS NOT NULL AND pos = fu THEN 'Y' ELSE 'N' END AS "Met", {consents('z.pid', 'z.day', *TELE)}
FROM (SELECT y.*, CASE WHEN ({num('score')}) > 9 THEN 1 ELSE 0 END AS pos FROM (
  SELECT x.*, CASE WHEN age < 18 THEN v9 WHEN v2 IS NULL OR rtrim(v2) = '0' THEN coalesce(v9, v2)
      WHEN d2 <= d9 THEN v9 ELSE v2 END AS score,
    CASE WHEN s1 BETWEEN {YEAR_BEFORE_START} AND {E} THEN s1 WHEN s2 BETWEEN {YEAR_BEFORE_START} AND {E} THEN s2 END AS scr
  FROM (
    SELECT v.*, q9.v AS v9, q9.d AS d9, q2.v AS v2, q2.d AS d2,
      TRY_CAST({upto(15593, 'v.pid', E)} AS DATE) AS s1, TRY_CAST({upto(14765, 'v.pid', E)} AS DATE) AS s2,
      CASE WHEN (SELECT o.v FROM obs o JOIN mednotes m ON m.patient_note_id = o.nid WHERE o.pid = v.pid AND o.f = 15143
        AND o.{_WINDOW} AND ({num('o.v')}) IS NOT NULL ORDER BY o.ts DESC, o.nid DESC, o.v DESC LIMIT 1) = '1'
        THEN 1 ELSE 0 END AS fu
    FROM ({last_note('mednotes', 'medphys', where=f"p.age >= 12 AND p.rn = 1 AND {NOT_LEFT_OUT}")}) v
    LEFT JOIN (SELECT pid, d, v FROM obs WHERE f IN (15095, 15096, 15097, 3696, 15958) AND {_WINDOW}
      AND ({num('v')}) IS NOT NULL QUALIFY row_number() OVER (PARTITION BY pid
        ORDER BY ts DESC, TRY_CAST(v AS INTEGER) DESC, nid DESC, v DESC) = 1) q9 ON q9.pid = v.pid
    LEFT JOIN (SELECT pid, d, {_LEAD} AS v FROM obs WHERE f IN (15423, 15957, 15815, 15816) AND {_WINDOW} AND trim(v) <> ''
      QUALIFY row_number() OVER (PARTITION BY pid ORDER BY ts DESC, nid DESC, obs.v DESC) = 1) q2 ON q2.pid = v.pid
    WHERE v.pid IN (SELECT pid FROM fields WHERE f IN (3696, 15095, 15096, 15097, 15423) AND d BETWEEN {S} AND {E})
      AND v.pid NOT IN ({charged_with("SELECT diagnosis_id FROM dx WHERE upper(icd9) BETWEEN 'F30' AND 'F39'",
                                      charged_on(YEAR_BEFORE_START))})
  ) x) y) z""".replace("WITH_SCORES\n", "")

SQL["m06_notes_signed_off"] = f"""
SELECT provider AS "Provider",
  CASE WHEN {workdays('CAST(note_datetime AS DATE)', 'CAST(update_datetime AS DATE)')} <= 1 THEN 'Y' ELSE 'N' END AS "Met Goal",
  CASE WHEN signedby <= 0 THEN 0 ELSE 1 END AS "Signed", short_name AS "Clinic", p.patientid AS "Patient ID",
  patient_note_id AS "Note ID", {us('note_datetime')} AS "Start Date",
  CASE WHEN signedby <= 0 OR update_datetime IS NULL OR update_datetime < CAST(note_datetime AS DATE) THEN ''
    ELSE {us('update_datetime')} END AS "SignOff Date", template_name
FROM (SELECT n.patient_note_id, n.patientprofileid, n.note_datetime, n.update_datetime, n.signedby, dep.short_name,
    n.template_name, ph.last_name || ', ' || ph.first_name || ', ' || ph.degree AS provider
  FROM signnotes n JOIN department dep ON n.dept_id = dep.departmentid JOIN phys ph ON n.doctorid = ph.doctorid
  WHERE {NOT_LEFT_OUT} AND CAST(n.note_datetime AS DATE) BETWEEN {S} AND {E}
  UNION
  SELECT n.patient_note_id, n.patientprofileid, n.note_datetime, n.update_datetime, n.signedby, dep.short_name,
    t.template_name, ph.provider_name || CASE WHEN ph.degree IS NULL THEN '' ELSE ', ' || ph.degree END
  FROM patient_note n JOIN template t ON n.template_id = t.template_id AND t.template_id IN (2500, 2710)
  JOIN department dep ON n.dept_id = dep.departmentid JOIN phys ph ON n.doctorid = ph.doctorid
  WHERE CAST(n.note_datetime AS DATE) BETWEEN {S} AND {E}) u
JOIN view_patient p ON p.patientprofileid = u.patientprofileid AND p.rn = 1"""

SQL["m07_superbill_signed_off"] = f"""
SELECT signed, short_name AS "Clinic", provider_name AS "Provider", patientid AS "Patient ID",
  {us('created_date')} AS "Start Date", {us('update_datetime')} AS "Signedoff Date", description,
  CASE WHEN {workdays('CAST(created_date AS DATE)', 'CAST(update_datetime AS DATE)')} <= 1 THEN 'Y' ELSE 'N' END AS "METGOAL"
FROM (SELECT DISTINCT b.superbill_datetime, p.patientid, CASE WHEN b.signedby <= 0 THEN 0 ELSE 1 END AS signed,
    dep.short_name, ph.provider_name, b.created_date, b.update_datetime, vt.description
  FROM superbill b JOIN view_patient p ON p.patientprofileid = b.patientprofileid
  JOIN patientappt a ON a.appointmentid = b.appointmentid JOIN visit_type vt ON vt.visit_type_id = a.visit_type_id
  JOIN department dep ON dep.departmentid = b.dept_id
  JOIN phys ph ON b.doctorid = ph.doctorid OR b.doctor2id = ph.doctorid AND ph.provider_name NOT ILIKE '%cpsp%'
  WHERE CAST(b.created_date AS DATE) BETWEEN {S} AND {E} AND a.status = 'Appt Kept'
    AND vt.visit_type_id IN (0, 1, 2, 3, 5, 8, 11, 53915600, 53915594, 58788109, 58788107)
    AND vt.description NOT ILIKE '%cpsp%' AND vt.description NOT ILIKE 'ob%' AND vt.description NOT ILIKE 'nurse%'
    AND vt.description NOT ILIKE 'cm%' AND vt.description NOT ILIKE 'dental%' AND vt.description NOT ILIKE 'mat%') q"""

_FIT_WINDOW = f"CAST(ts AS DATE) BETWEEN DATE '1996-06-01' AND {E} AND abs(sh - rh) + abs(sh - ih) + abs(sh - vh) = 0"

SQL["m08_colorectal_cancer"] = f"""
SELECT provider_name AS "Provider", short_name AS "Clinic", patientid AS "Patient ID", sex AS "Gender",
  {us('birthdate')} AS "DOB", age AS "Age", {us('note_datetime')} AS "DOS",
  coalesce({us('fit')}, '') AS "Last FIT Date", coalesce({us('office')}, '') AS "In Office FOBT",
  coalesce({us('scan')}, '') AS "Last FOBT Scanned", {consents('v.pid', 'v.day', *TELE)}
FROM ({last_note('mednotes', 'medphys', where=f"p.age BETWEEN 45 AND 75 AND {NOT_LEFT_OUT}")}) v
LEFT JOIN (SELECT pid, max(ts) AS fit FROM results WHERE {_FIT_WINDOW} AND result_code IN ({_list(vs.FIT_RESULTS)})
  GROUP BY pid) a ON a.pid = v.pid
LEFT JOIN (SELECT pid, max(ts) AS office FROM results WHERE {_FIT_WINDOW} AND result_code ILIKE 'RESULT_1'
  AND result_desc ILIKE 'Occult%' GROUP BY pid) b ON b.pid = v.pid
LEFT JOIN (SELECT patientprofileid AS pid, max(doc_date) AS scan FROM document WHERE file_name ILIKE '%FOBT%'
  GROUP BY 1) c ON c.pid = v.pid"""

_BP_OK = f"({num('v')}) IS NOT NULL"

SQL["m09_blood_pressure"] = f"""
SELECT provider_name AS "Provider", short_name AS "Clinic", patientid AS "Patient ID", age AS "Age",
  CAST(well AS VARCHAR) AS "No DM or CKD", {us('note_datetime')} AS "Last DOS", {us('birthdate')} AS "DOB",
  coalesce(s1, '') AS "1st Systolic BP", coalesce(d1, '') AS "1st Diastolic BP", CAST(ok1 AS VARCHAR) AS "1st BP Controlled",
  coalesce(s2, '') AS "2nd Systolic BP", coalesce(d2, '') AS "2nd Diastolic BP",
  CASE WHEN ok1 = 0 AND (coalesce(TRY_CAST(s2 AS INTEGER), 0) = 0 OR coalesce(TRY_CAST(d2 AS INTEGER), 0) = 0) THEN 'N'
    WHEN ok1 = 1 AND coalesce(TRY_CAST(s2 AS INTEGER), 0) = 0 AND coalesce(TRY_CAST(d2 AS INTEGER), 0) = 0 THEN 'Y'
    WHEN TRY_CAST(s2 AS INTEGER) <> 0 AND TRY_CAST(d2 AS INTEGER) <> 0 AND TRY_CAST(s2 AS INTEGER) < lim
      AND TRY_CAST(d2 AS INTEGER) < 90 THEN 'Y' ELSE 'N' END AS "Final BP Controlled",
  {consents('z.pid', 'z.day', *TELE_LOWER)}
FROM (SELECT y.*, CASE WHEN TRY_CAST(s1 AS INTEGER) < lim AND TRY_CAST(d1 AS INTEGER) < 90 THEN 1 ELSE 0 END AS ok1 FROM (
  SELECT x.*, CASE WHEN age >= 60 AND well = 1 THEN 150 ELSE 140 END AS lim,
    {on(12848, 'x.pid', 'x.day', _BP_OK)} AS s1, {on(12849, 'x.pid', 'x.day', _BP_OK)} AS d1,
    {on(13259, 'x.pid', 'x.day', _BP_OK)} AS s2, {on(13260, 'x.pid', 'x.day', _BP_OK)} AS d2
  FROM (SELECT v.*, CASE WHEN v.pid IN ({charged_with(
        f"SELECT diagnosis_id FROM diagnosis WHERE company_id = 9 AND {_ilike('icd9', vs.DIABETES_OR_CKD_PATTERNS)}",
        "ch.company_id = 9 AND " + charged_on("DATE '1998-02-01'"))}) THEN 0 ELSE 1 END AS well
    FROM ({last_note('mednotes', 'phys', where="p.age BETWEEN 18 AND 85 AND p.rn = 1")}) v
    WHERE v.pid IN (SELECT pid FROM fields WHERE f IN (12848, 12849, 13259, 13260) AND d BETWEEN {S} AND {E})) x) y) z"""


def _mark(kind: str) -> str:
    return f"""(SELECT arg_max(start_datetime, appt_tracking_id) FROM appt_tracking k
      WHERE k.bookings_id = a.appointmentid AND tracking_type = '{kind}' AND active_yn = 'Y')"""


def _gap(a: str, b: str) -> str:
    return f"CAST(coalesce(abs(date_diff('minute', {a}, {b})), -1) AS INTEGER)"


def _line(kind: str, test: str) -> str:
    return f"""SELECT short_name AS "Clinic", provider_name AS "Provider", patientid AS "Patient ID", {us('booking_date')} AS "DOS",
  description AS "Visit Type", {_gap('arr', 'reg')} AS "Arrived To Registered", {_gap('reg', 'adm')} AS "Registered To Admitted",
  {_gap('adm', 'pin')} AS "Admitted To Provider In", {_gap('pin', 'xm')} AS "Provider In To Exam Complete",
  {_gap('xm', 'dis')} AS "Exam Complete To Discharge",
  CAST(date_diff('minute', pat_arrived, pat_discharged) AS INTEGER) AS "Total Cycle Time",
  CAST(date_diff('minute', pat_registered, pat_discharged) AS INTEGER) AS "Total Telehealth Cycle Time",
  appointmentid AS "Appt Id", '{kind}' AS "Type",
  CASE WHEN description ILIKE '%telehealth%' OR description ILIKE 'phone%' THEN 1 ELSE 0 END AS "Telehealth"
FROM marked WHERE {test}"""


SQL["m10_cycle_time"] = f"""
SELECT * FROM (WITH marked AS (SELECT a.*, dep.short_name, ph.provider_name, p.patientid, vt.description,
    {_mark('Arrived')} AS arr, {_mark('Registered')} AS reg, {_mark('Admitted')} AS adm, {_mark('PROV IN')} AS pin,
    {_mark('XM COMP')} AS xm, {_mark('Discharged')} AS dis
  FROM patientappt a JOIN view_patient p ON a.patientprofileid = p.patientprofileid
  JOIN phys ph ON a.doctorid = ph.doctorid JOIN department dep ON a.departmentid = dep.departmentid
  JOIN visit_type vt ON a.visit_type_id = vt.visit_type_id
  WHERE CAST(a.booking_date AS DATE) BETWEEN {S} AND {E} AND a.status = 'Appt Kept')
{_line('med', "description NOT ILIKE 'behavioral health%' AND description NOT ILIKE 'bh%' AND description NOT ILIKE 'opt%'")}
UNION {_line('bh', "description ILIKE 'bh%' OR description ILIKE 'behavioral%'")}
UNION {_line('opt', "description ILIKE 'opt%'")})"""


def _dental(exam: str, ages: str, evidence: str, columns: str) -> str:
    return f"""
SELECT provider AS "Provider", clinic AS "Clinic", {columns}
FROM (SELECT c.patid, c.pldate, c.adacode, pr.provider, dc.clinic, dp.age, dp.patextid, dp.pataccountnumber
  FROM chart c JOIN dpat dp ON c.patid = dp.patid JOIN dclin dc ON dc.urscid = c.clinicappliedto
  JOIN dprov pr ON pr.urscid = c.provid WHERE c.d BETWEEN {S} AND {E} AND {exam} AND {ages}
  QUALIFY row_number() OVER (PARTITION BY c.patid ORDER BY c.pldate DESC, TIE pr.provider DESC, dc.clinic DESC) = 1) e
LEFT JOIN (SELECT patid, adacode AS found FROM chart WHERE d BETWEEN {S} AND {E} AND {evidence}
  QUALIFY row_number() OVER (PARTITION BY patid ORDER BY pldate DESC, adacode DESC) = 1) n ON n.patid = e.patid"""


_FOUND = "CASE WHEN found IS NULL THEN 'N' ELSE 'Y' END"
SQL["m11_caries_risk"] = _dental(
    "trim(c.adacode) IN ('D0120', 'D0145', 'D0150')", "dp.age BETWEEN 10 AND 20", "adacode IN ('D0601', 'D0602', 'D0603')",
    f'patextid AS "Patient ID", age AS "Age", adacode AS "Procedure Code", {us("pldate")} AS "DOS", '
    f'{_FOUND} AS "Caries Risk Assesed"').replace("TIE", "c.adacode DESC,")

SQL["m12_crown_delivery"] = f"""
SELECT DISTINCT provider AS "Provider", clinic AS "Clinic", pataccountnumber AS "Patient ID", {us('i.d')} AS "Impression Taken",
  coalesce({us('c.d')}, '') AS "Crown Delivered", CASE WHEN date_diff('day', i.d, c.d) <= 28 THEN 'Y' ELSE 'N' END AS "Within 28 Days"
FROM chart i JOIN dpat p ON p.patid = i.patid JOIN dclin ON dclin.urscid = i.clinicappliedto JOIN dprov ON dprov.urscid = i.provid
LEFT JOIN (SELECT * FROM chart WHERE adacode IN ('D2752', 'D2790', 'D2791', 'D2799') AND d BETWEEN {PRIOR_START} AND {E}) c
  ON c.patid = i.patid
WHERE i.adacode = 'C2002' AND i.d BETWEEN {PRIOR_START} AND {PRIOR_END}"""

SQL["m13_diagnostic_treatment"] = _dental(
    "trim(c.adacode) = 'D0120'", "dp.age BETWEEN 4 AND 20",
    "adacode IN ('D0210', 'D0220', 'D0230', 'D0270', 'D0272', 'D0274')",
    f'pataccountnumber AS "Patient ID", age AS "Age", {us("pldate")} AS "DOS", coalesce(found, \'\') AS "X-ray Code", '
    f'{_FOUND} AS "X-ray Completed"').replace("TIE", "c.adacode DESC,")

SQL["m14_fluoride"] = _dental(
    "trim(c.adacode) IN ('D0602', 'D0603')", "dp.age BETWEEN 0 AND 5", "adacode = 'D1206'",
    f'pataccountnumber AS "Patient ID", age AS "Age", adacode AS "Risk Coded", {us("pldate")} AS "DOS", '
    f'{_FOUND} AS "Fluoride Treatment"').replace("TIE", "c.adacode DESC,")

_BAND = """CASE WHEN age BETWEEN 0 AND 5 THEN 'A. 0 to 5' WHEN age BETWEEN 6 AND 13 THEN 'B. 6 to 13'
  WHEN age BETWEEN 14 AND 21 THEN 'C. 14 to 21' WHEN age >= 22 THEN 'D. 22 and Up' ELSE {} END"""

SQL["m15_phase_one_exam"] = f"""
SELECT provider_name AS "Exam Provider", patientid AS "Patient ID", {_BAND.format('NULL')} AS "Age Range", short_name AS "Clinic",
  {us('post_fromdate')} AS "Exam Date", procedure_code AS "Procedure Code",
  CASE WHEN pid IN (SELECT c.patient_id FROM view_chargehistory c JOIN px ON px.procedure_id = c.procedure_id
    JOIN phys ON (phys.doctorid = c.physician_id OR phys.doctorid = c.physician_id_2) AND phys.degree IN ('DMD', 'DDS')
    JOIN department d ON d.departmentid = c.department_id WHERE upper(px.procedure_code) = 'C9011'
    AND d.listname ILIKE '%dental%' AND d.listname NOT ILIKE 'zz%'
    AND CAST(c.post_fromdate AS DATE) BETWEEN {YEAR_BEFORE_START} AND {E}) THEN 1 ELSE 0 END AS "Met"
FROM (SELECT c.patient_id AS pid, p.patientid, p.age, d.short_name, c.post_fromdate, px.procedure_code,
    concat(f.last_name, ', ', f.first_name) AS provider_name
  FROM view_chargehistory c JOIN pts p ON p.patientprofileid = c.patient_id JOIN px ON px.procedure_id = c.procedure_id
  JOIN physician f ON (f.phys_id = c.physician_id OR f.phys_id = c.physician_id_2) AND f.degree IN ('DMD', 'DDS')
    AND f.active_yn = 'Y'
  JOIN department d ON d.departmentid = c.department_id
  WHERE upper(px.procedure_code) IN ('D0120', 'D0145', 'D0150') AND d.listname ILIKE '%dental%' AND d.listname NOT ILIKE 'zz%'
    AND c.status IN (0, 1) AND CAST(c.post_fromdate AS DATE) BETWEEN {YEAR_BEFORE_START} AND {E}
  QUALIFY row_number() OVER (PARTITION BY c.patient_id ORDER BY CAST(c.post_fromdate AS DATE) DESC, c.post_fromdate DESC,
    provider_name DESC, px.procedure_code DESC, d.short_name DESC NULLS LAST) = 1) q"""

SQL["m16_restorative"] = _dental(
    "TRUE", "TRUE", "(adacode LIKE 'D21%' OR adacode LIKE 'D23%')",
    "pataccountnumber AS \"Patient ID\", " + _BAND.format("'NA'") + f' AS "Age Range", {us("pldate")} AS "DOS", '
    f'{_FOUND} AS "Restorative Treatment"').replace("TIE", "")

SQL["m17_sealant"] = f"""
SELECT "Provider", clinic AS "Clinic", pataccountnumber AS "Patient ID", age AS "Age", {us('rd')} AS "Mod to High Risk Assessed",
  coalesce({us('sd')}, '') AS "Sealant Date", CASE WHEN sd IS NULL THEN 'N' ELSE 'Y' END AS "Sealant Placed"
FROM (SELECT DISTINCT r.patid, CASE WHEN s.patid IS NULL THEN dprov.provider ELSE s.provider END AS "Provider", clinic,
    p.pataccountnumber, p.patextid, p.age, r.d AS rd, s.d AS sd
  FROM chart r JOIN dpat p ON p.patid = r.patid JOIN dclin ON dclin.urscid = r.clinicappliedto
  JOIN dprov ON dprov.urscid = r.provid
  LEFT JOIN (SELECT DISTINCT c.patid, c.d, x.provider FROM chart c JOIN dprov x ON x.urscid = c.provid
    WHERE c.adacode = 'D1351' AND c.d BETWEEN {PRIOR_START} AND {E}) s ON s.patid = r.patid
  WHERE r.adacode IN ('D0601', 'D0602', 'D0603') AND r.d BETWEEN {PRIOR_START} AND {PRIOR_END_CLAMPED}
    AND p.age BETWEEN 6 AND 9 AND r.patid IN (SELECT patid FROM chart WHERE adacode = 'C9017'
      AND d BETWEEN {PRIOR_START} AND {E})) q"""

SQL["m18_diabetic_a1c"] = f"""
SELECT provider_name AS "Provider", coalesce(short_name, '') AS "Clinic", patientid AS "Patient ID", {us('birthdate')} AS "DOB",
  age AS "Age", {us('note_datetime')} AS "Last DOS", coalesce(res, '') AS "Last hgb A1c Result",
  coalesce({us('res_day')}, '') AS "Result Date",
  CASE WHEN TRY_CAST(res AS DECIMAL(10,2)) < 9 THEN 'Y' ELSE 'N' END AS "Met", {consents('q.pid', 'q.day', *TELE_LOWER)}
FROM (SELECT v.*, CASE WHEN nv.v IS NOT NULL AND (lab.v IS NULL OR nv.d >= lab.d) THEN nv.v ELSE lab.v END AS res,
    CASE WHEN nv.v IS NOT NULL AND (lab.v IS NULL OR nv.d >= lab.d) THEN nv.d ELSE lab.d END AS res_day
  FROM ({last_note('mednotes', 'medphys', where=NOT_LEFT_OUT)}) v
  LEFT JOIN (SELECT pid, d, v FROM obs WHERE f = 3680 AND {_WINDOW} AND TRY_CAST(v AS DECIMAL(10,2)) IS NOT NULL AND v <> ''
    QUALIFY row_number() OVER (PARTITION BY pid ORDER BY ts DESC, nid DESC, v DESC) = 1) nv ON nv.pid = v.pid
  LEFT JOIN (SELECT pid, CAST(ts AS DATE) AS d, result_value AS v FROM results WHERE sh = 0 AND rh = 0 AND vh = 0
    AND result_code IN ('2040', '50026400') AND CAST(ts AS DATE) BETWEEN {YEAR_BEFORE_START} AND {E}
    AND TRY_CAST(result_value AS DECIMAL(10,2)) IS NOT NULL AND result_value <> ''
    QUALIFY row_number() OVER (PARTITION BY pid ORDER BY ts DESC, iid DESC, result_value DESC) = 1) lab ON lab.pid = v.pid
  WHERE v.age >= 18 AND v.pid IN ({charged_with(f"SELECT diagnosis_id FROM diagnosis WHERE {_ilike('icd9', vs.DIABETES_PATTERNS)}",
                                               charged_on(YEAR_BEFORE_START))})) q"""

SQL["m19_document_sign_off"] = f"""
SELECT ph.provider_name AS "Provider",
  CASE WHEN s.fullname IS NOT NULL AND {workdays('CAST(o.created_date AS DATE)', 'CAST(o.doc_date AS DATE)')} <= 3
    THEN 'Y' ELSE 'N' END AS "Signed within 3 days",
  CASE WHEN s.fullname IS NOT NULL AND {workdays('CAST(o.created_date AS DATE)', 'CAST(o.doc_date AS DATE)')} <= 5
    THEN 'Y' ELSE 'N' END AS "Signed within 5 days",
  CASE WHEN s.fullname IS NULL THEN 'N' ELSE 'Y' END AS "Signed", dep.short_name AS "Clinic", p.patientid AS "Patient ID",
  {us('o.doc_date')} AS "Doc Date", o.document_id AS "Document ID", {us('o.created_date')} AS "Import Date",
  CASE WHEN s.fullname IS NULL THEN '' ELSE {us('o.update_datetime')} END AS "SignOff Date",
  coalesce(s.fullname, '') AS "Signed By", o.file_name AS "File Name"
FROM document o JOIN view_patient p ON p.patientprofileid = o.patientprofileid JOIN phys ph ON ph.doctorid = o.doctorid
JOIN department dep ON dep.departmentid = o.dept_id LEFT JOIN staff s ON s.staffid = o.signedby
WHERE CAST(o.doc_date AS DATE) BETWEEN {S} AND {E} AND o.doc_type_id IN (SELECT lookup_id FROM lookups WHERE lower(lookup_item) IN
  ('bcp', 'consult report', 'health assessment', 'history & physical', 'hospital record', 'lab', 'old clinical notes', 'soap note',
   'x-ray/ultrasound'))"""

_DONE_DAYS = workdays("CAST(notif_date AS DATE)", "CAST(completed_datetime AS DATE)")
SQL["m20_hospital_tracking"] = f"""
SELECT p.patientid AS "Patient ID", notification_id AS "Notification ID", {us('notif_date')} AS "Notification Date",
  item_description AS "Template Name", ph.provider_name AS "Provider", dep.short AS "Department",
  CASE WHEN completed_flag = 1 THEN 'Y' ELSE 'N' END AS "Notification Completed",
  coalesce({us('completed_datetime')}, '') AS "Completed Date", coalesce({_DONE_DAYS}, 0) AS "Days to Complete",
  CASE WHEN {_DONE_DAYS} <= 10 THEN 'Y' ELSE 'N' END AS "Met", CASE WHEN {_DONE_DAYS} <= 2 THEN 'Y' ELSE 'N' END AS "Met2",
  dep.short_name, trim(team_name) AS team_name, teamid
FROM notification o JOIN notification_rule r ON r.notification_rule_id = o.notification_rule_id AND r.active_flag = 1
JOIN view_patient p ON p.patientprofileid = o.patientprofileid JOIN phys ph ON ph.doctorid = o.doctorid
JOIN department dep ON dep.departmentid = o.deptid
WHERE o.company_id = 9 AND teamid IN (8961, 8962) AND CAST(notif_date AS DATE) BETWEEN {S} AND {E}"""

SQL["m21_last_dental_exam"] = f"""
SELECT provider_name AS "Provider", short_name AS "Clinic", patientid AS "Patient ID", age AS "Age", agemonth AS "Age In Month",
  {us('note_datetime')} AS "Last Visit Date", coalesce(e.v, '') AS "Last Dental Exam",
  CASE WHEN e.v IS NULL THEN 'N' ELSE 'Y' END AS "Exam in Last 12 Months"
FROM ({last_note('mednotes', 'phys', where="p.agemonth >= 12 AND p.age <= 5")}) n2
LEFT JOIN (SELECT pid, v FROM obs WHERE f = 9273 AND TRY_CAST(v AS DATE) BETWEEN {YEAR_BEFORE_END} AND {E}
  QUALIFY row_number() OVER (PARTITION BY pid ORDER BY TRY_CAST(v AS DATE) DESC, v DESC) = 1) e ON e.pid = n2.pid"""

_T = ("obs.template_id IN (SELECT template_id FROM template WHERE template_name ILIKE '%initial acog%') "
      f"AND trim(v) NOT IN ('', '.', '..', '...') AND ({num('v')}) IS NOT NULL")
SQL["m22_maternal_depression"] = f"""
SELECT provider_name AS "Provider", short_name AS "Clinic", patientid AS "Patient ID", {us('note_datetime')} AS "Initial OB Date",
  CASE WHEN t1 IS NULL AND t2 IS NULL AND t3 IS NULL THEN 0 ELSE 1 END AS "PHQ9 Documented",
  coalesce(t3, t2, t1, '') AS "PHQ9 Score"
FROM (SELECT v.*, {on(15095, 'v.pid', 'v.day', _T)} AS t1, {on(15096, 'v.pid', 'v.day', _T)} AS t2,
    {on(15097, 'v.pid', 'v.day', _T)} AS t3
  FROM ({last_note('patient_note', 'phys', extra="JOIN template t ON n.template_id = t.template_id",
                   where="p.rn = 1 AND t.template_name ILIKE '%initial acog%'")}) v) q"""

SQL["m23_no_show_rescheduled"] = f"""
SELECT ph.provider_name AS "Provider", dep.short_name AS "Clinic", p.patientid AS "Patient ID", {us('p.birthdate')} AS "DOB",
  {us('a.booking_date')} AS "No Show Date", vt.short_desc AS "Visit Type", coalesce({us('f.booking_date')}, '') AS "Rescheduled Date",
  coalesce(f.short_desc, '') AS "Rescheduled Type", coalesce(f.provider_name, '') AS "Rescheduled Provider"
FROM patientappt a JOIN view_patient p ON p.patientprofileid = a.patientprofileid JOIN phys ph ON ph.doctorid = a.doctorid
JOIN department dep ON dep.departmentid = a.departmentid JOIN visit_type vt ON vt.visit_type_id = a.visit_type_id
LEFT JOIN (SELECT b.*, t.short_desc, x.provider_name FROM patientappt b JOIN phys x ON x.doctorid = b.doctorid
    JOIN visit_type t ON t.visit_type_id = b.visit_type_id
    WHERE CAST(b.booked_by_date AS DATE) BETWEEN {S} AND {E} AND b.status <> 'Cancelled') f
  ON f.patientprofileid = a.patientprofileid AND CAST(f.booked_by_date AS DATE) >= CAST(a.booking_date AS DATE)
  AND (CAST(f.booking_date AS DATE) > CAST(a.booking_date AS DATE) OR (CAST(f.booking_date AS DATE) = CAST(a.booking_date AS DATE)
    AND f.start_minutes > a.start_minutes))
WHERE a.status = 'No Show' AND a.booking_date BETWEEN {S} AND {E}
QUALIFY row_number() OVER (PARTITION BY a.appointmentid ORDER BY f.booked_by_date, f.start_minutes, f.appointmentid) = 1"""

_VITAL = {"Height": 1716, "Weight": 1717, "BP": 12848, "Temperature": 1347, "Pulse": 11253, "Respiratory": 11254}
SQL["m24_patient_vitals"] = f"""
SELECT short_name AS "Clinic", provider_name AS "Provider", patientid AS "Patient ID", age AS "Age", {us('note_datetime')} AS "DOS",
  CASE WHEN h + w + b + t + pu + r = 6 THEN 'Y' ELSE 'N' END AS "MET", h AS "Height", w AS "Weight", b AS "BP",
  t AS "Temperature", pu AS "Pulse", r AS "Respiratory", {consents('q.pid', 'q.day', *TELE_PHONE)}
FROM (SELECT v.*, {", ".join(f"CASE WHEN EXISTS (SELECT 1 FROM obs WHERE obs.pid = v.pid AND obs.d = v.day AND f = {f}) THEN 1 ELSE 0 END AS {a}"
                             for f, a in zip(_VITAL.values(), ("h", "w", "b", "t", "pu", "r")))}
  FROM (SELECT n.patientprofileid AS pid, n.note_datetime, CAST(n.note_datetime AS DATE) AS day, dep.short_name, ph.provider_name,
      p.patientid, p.age
    FROM (SELECT patientprofileid, dept_id, doctorid, note_datetime FROM mednotes
      UNION SELECT patientprofileid, dept_id, doctorid, note_datetime FROM patient_note JOIN template USING (template_id)
      WHERE template_name ILIKE 'gyn%' OR template_name ILIKE 'ob%' OR template_name ILIKE 'opto%' OR template_name ILIKE 'podia%') n
    JOIN pts p ON p.patientprofileid = n.patientprofileid AND p.rn = 1 AND p.age >= 3
    JOIN department dep ON dep.departmentid = n.dept_id
    JOIN active_phys ph ON ph.doctorid = n.doctorid AND ph.provider_name NOT ILIKE '%cpsp%'
    WHERE CAST(n.note_datetime AS DATE) BETWEEN {S} AND {E}
    QUALIFY row_number() OVER (PARTITION BY n.patientprofileid ORDER BY n.note_datetime DESC, n.doctorid DESC, n.dept_id DESC) = 1) v) q"""

_MONTH = f"d BETWEEN {S} AND {E}"
SQL["m25_pediatric_weight"] = f"""
SELECT provider_name AS "Provider", patientid AS "Patient ID", age AS "Age", {us('note_datetime')} AS "DOS",
  nu AS "Nutrition Counseling Doc'd", ac AS "Activity Counseling Doc'd",
  CASE WHEN nu = 1 AND ac = 1 AND vit = day THEN 'Y' ELSE 'N' END AS "Met", {consents('q.pid', 'q.day', *TELE_LOWER)}
FROM (SELECT v.*, coalesce({num(at(14359, 'v.pid', _MONTH))}, 0) AS nu, coalesce({num(at(14358, 'v.pid', _MONTH))}, 0) AS ac,
    (SELECT max(d) FROM obs WHERE obs.pid = v.pid AND f = 14646 AND {_MONTH}) AS vit
  FROM ({last_note('mednotes', 'phys', False, where='''p.age BETWEEN 3 AND 17 AND p.rn = 1 AND EXISTS (SELECT 1
    FROM patient_note_control c WHERE c.patient_note_id = n.patient_note_id AND c.template_field_id IN (14358, 14646, 14359))''')}) v
  WHERE v.pid NOT IN (SELECT patient_id FROM pregnant)) q"""

SQL["m26_perinatal_health"] = f"""
SELECT short_name AS "Clinic", provider_name AS "Provider", patientid AS "Patient ID", dos AS "DOS", upper(w) AS "Description",
  CASE WHEN w ILIKE 'very low%' THEN 1 WHEN w IS NOT NULL THEN 0 END AS "<1500g",
  CASE WHEN w ILIKE 'low%' THEN 1 WHEN w IS NOT NULL THEN 0 END AS "1501g TO 2500g",
  CASE WHEN w ILIKE 'normal%' THEN 1 WHEN w IS NOT NULL THEN 0 END AS ">2500g"
FROM (SELECT v.*, o.dos, coalesce(o.w1, o.w2, o.w3) AS w
  FROM ({last_note('patient_note', 'phys', where='''EXISTS (SELECT 1 FROM patient_note_control c
    WHERE c.patient_note_id = n.patient_note_id AND c.template_field_id IN (15127, 15141, 15142)
    AND trim(c.data_value) NOT IN ('.', '..', '...', ''))''')}) v
  LEFT JOIN (SELECT pid, d, {', '.join(f"arg_max(v, (ts, nid, v)) FILTER (WHERE f = {f}) AS {n}" for n, f in
      dict(dos=15085, w1=15127, w2=15141, w3=15142).items())} FROM obs WHERE f IN (15085, 15127, 15141, 15142) GROUP BY pid, d) o
    ON o.pid = v.pid AND o.d = v.day
  WHERE v.pid NOT IN (SELECT pid FROM obs WHERE f = 15476 AND {_MONTH} AND trim(v) IN ('AB/TAB/EAB', 'Decline to state',
      'Fetal Demise / Neo. Death', 'Letter sent / Lost to F/U', 'SAB / Miscarriage'))
    AND v.pid IN (SELECT pid FROM obs WHERE f = 15085 AND TRY_CAST(v AS DATE) BETWEEN {S} AND {E})) q"""

SQL["m27_prenatal_trimester"] = f"""
SELECT s.fullname AS "Provider", p.patientid AS "Patient ID", {us('n.note_datetime')} AS "DOS",
  CASE WHEN a.field_name IS NOT NULL THEN right(a.field_name, 7) WHEN b.field_name IS NOT NULL THEN right(b.field_name, 6)
    ELSE '' END AS "Description", CASE WHEN a.field_name IS NULL THEN 0 ELSE 1 END AS "Begin With First Trimester"
FROM patient_note n JOIN view_patient p ON p.patientprofileid = n.patientprofileid
JOIN template t ON t.template_id = n.template_id AND t.template_name ILIKE '%initial acog clinical note%'
JOIN staff s ON s.doctorid = n.doctorid
LEFT JOIN (SELECT pid, field_name FROM obs JOIN template_field ON template_field_id = f WHERE f IN (12164, 12166, 12168)
  AND v = '1' AND {_MONTH} QUALIFY row_number() OVER (PARTITION BY pid ORDER BY ts, nid, field_name) = 1) a
  ON a.pid = n.patientprofileid
LEFT JOIN (SELECT pid, field_name FROM obs JOIN template_field ON template_field_id = f WHERE f IN (12165, 12167, 12169)
  AND v = '1' AND {_MONTH} QUALIFY row_number() OVER (PARTITION BY pid ORDER BY ts DESC, nid DESC, field_name DESC) = 1) b
  ON b.pid = n.patientprofileid
WHERE CAST(n.note_datetime AS DATE) BETWEEN {S} AND {E}"""


def _charged(procedures: str, codes: str, diagnoses: str, dx_test: str) -> str:
    """Charges with a known procedure and diagnosis, one of the two in its list."""
    known = f"SELECT procedure_id FROM {procedures}"
    listed = f"{known} WHERE lower(procedure_code) IN ({_list(codes)})"
    when = charged_on(YEAR_BEFORE_START)
    return (charged_with(f"SELECT diagnosis_id FROM {diagnoses}", f"{when} AND ch.procedure_id IN ({listed})") + " UNION ALL "
            + charged_with(f"SELECT diagnosis_id FROM {diagnoses} g WHERE {dx_test}", f"{when} AND ch.procedure_id IN ({known})"))


_KEPT = f"""SELECT a.patientprofileid AS pid, CAST(a.booking_date AS DATE) AS dos, dep.short_name, ph.degree, ph.provider_name,
    vt.short_desc FROM patientappt a JOIN visit_type vt ON vt.visit_type_id = a.visit_type_id
    AND vt.visit_type_id IN (0, 1, 2, 3, 5, 8, 10, 11)
  JOIN department dep ON dep.departmentid = a.departmentid
  JOIN phys ph ON ph.doctorid = a.doctorid AND ph.degree IN ('MD', 'PA', 'MS PA-C', 'NP', 'DO')
  WHERE a.status = 'Appt Kept' AND CAST(a.booking_date AS DATE) BETWEEN {S} AND {E}"""

SQL["m28_family_planning"] = f"""
SELECT DISTINCT 'AGENCY' AS "Agency", coalesce(k.short_name, '') AS "Site", p.patient_number AS "Patient ID",
  {us('p.birth_date')} AS "DOB", p.sex AS "Sex", p.age AS "Age", r.description AS "Race", t.description AS "Ethnicity",
  coalesce(p.family_size, 1) AS "Family Size", CAST(coalesce(p.income, 0) AS DOUBLE) AS "Weekly Income", {us('k.dos')} AS "Visit Date",
  coalesce(k.degree, '') AS "Provider Type",
  coalesce((SELECT fc.description FROM charge_history c JOIN financial_class fc
    ON {any_slot('c', 'fc.financial_class_id', 3, 'financial_class_id')} WHERE c.patient_id = p.patient_id
    AND CAST(c.post_fromdate AS DATE) BETWEEN {YEAR_BEFORE_START} AND {E}
    ORDER BY c.post_fromdate DESC, fc.description DESC LIMIT 1), '') AS "Principle Health Coverage", p.zip AS "Zip Code",
  coalesce((SELECT max(CASE WHEN code LIKE 'YES TRANSLAT%' THEN 'TRANSLATION NEEDED - YES' WHEN code LIKE 'NO TRANSLAT%'
    THEN 'TRANSLATION NOT NEEDED - NO' END) FROM patient_shortcode sc WHERE sc.patient_id = p.patient_id), '')
    AS "Limited English Proficiency", coalesce(e.description, '') AS "Homeless",
  coalesce({upto(7220, 'p.patient_id', 'k.dos', "trim(v) <> '' AND year(ts) = 1998 AND template_id IN (SELECT template_id FROM template)")}, '')
    AS "Birth Control Method",
  (SELECT m.poverty_status FROM patient o, fee_matrix_detail m WHERE o.patient_id = p.patient_id AND o.company_id = 9
    AND o.active_yn = 'Y' AND m.company_id = o.company_id
    AND m.family_size = least(coalesce(o.family_size, 1),
      (SELECT max(family_size) FROM fee_matrix_detail m2 WHERE m2.fee_matrix_id = m.fee_matrix_id))
    AND m.income_from <= coalesce(o.income, 0)
    AND m.income_to >= least(coalesce(o.income, 0), (SELECT max(income_to) FROM fee_matrix_detail m3
      WHERE m3.fee_matrix_id = m.fee_matrix_id AND m3.family_size = m.family_size))
    ORDER BY o.modified_date DESC, m.poverty_status DESC LIMIT 1) AS "Poverty Level"
FROM ({_KEPT}) k JOIN regpts p ON p.patient_id = k.pid
LEFT JOIN lists e ON e.medlistsid = p.employment_status_id LEFT JOIN lists r ON r.medlistsid = p.race_id
LEFT JOIN lists t ON t.medlistsid = p.ethnicity_id
WHERE ((p.sex = 'M' AND p.age BETWEEN 12 AND 60) OR (p.sex = 'F' AND p.age BETWEEN 12 AND 55))
  AND p.patient_id NOT IN ({_charged('px', vs.TERMINATION_PROCEDURES, 'dx', f"lower(g.icd9) IN ({_list(vs.TERMINATION_DIAGNOSES)})")})
  AND p.patient_id IN ({_charged('procedure', vs.CONTRACEPTION_PROCEDURES, 'diagnosis', f"lower(g.icd9) IN ({_list(vs.CONTRACEPTION_DIAGNOSES)})")})
  AND p.patient_id IN ({_charged('procedure', vs.REPRODUCTIVE_HEALTH_PROCEDURES, 'diagnosis',
                                 "g.icd9 IN (SELECT icd9 FROM reproductive)")})"""

_FILLED = "coalesce(trim(v), '') NOT IN ('', '..', '...', '.')"
SQL["m29_missed_opportunity"] = f"""
SELECT p.patient_number AS "Patient ID", {us('p.birth_date')} AS "Date of Birth", p.sex AS "Gender", p.age AS "Age", {us('k.dos')} AS "DOS",
  k.short_name AS "Clinic", k.provider_name AS "Provider", done AS "Completed", 1 - done AS "Missed",
  CASE WHEN done = 1 THEN 'Y' ELSE 'N' END AS "Met Goal", k.short_desc AS "Visit Type",
  coalesce({upto(7220, 'k.pid', 'k.dos', f"{_FILLED} AND d BETWEEN {YEAR_BEFORE_START} AND {E} AND obs.template_id IN (SELECT template_id FROM template WHERE template_name ILIKE '%title%')")}, '') AS "Title X BC",
  coalesce({on('7220, 9340', 'k.pid', 'k.dos', f"{_FILLED} AND obs.template_id IN (SELECT template_id FROM template WHERE template_name NOT ILIKE '%title%')")}, '') AS "Visit BC"
FROM (SELECT *, CASE WHEN pid IN (SELECT n.patientprofileid FROM patient_note n JOIN template t ON t.template_id = n.template_id
      WHERE t.template_name ILIKE '%title%' AND CAST(n.note_datetime AS DATE) BETWEEN DATE '1998-01-01' AND {E}) THEN 1 ELSE 0 END AS done
    FROM ({_KEPT}) QUALIFY row_number() OVER (PARTITION BY pid ORDER BY dos DESC, short_name DESC NULLS LAST,
      provider_name DESC, short_desc DESC) = 1) k
JOIN regpts p ON p.patient_id = k.pid
WHERE p.age BETWEEN 12 AND 50
  AND p.patient_id IN ({_charged('px', vs.FAMILY_PLANNING_VISIT_PROCEDURES, 'dx', f"lower(g.icd9) IN ({_list(vs.CONTRACEPTION_DIAGNOSES)})")})
  AND p.patient_id NOT IN ({charged_with(f"SELECT diagnosis_id FROM dx WHERE lower(icd9) IN ({_list(vs.STERILISED_OR_MENOPAUSAL)})",
                                         charged_on(YEAR_BEFORE_START))})"""

_SIX = "d >= DATE '1997-12-01'"
SQL["m30_tobacco"] = f"""
SELECT provider_name AS "Provider", short_name AS "Clinic", patientid AS "Patient ID", {us('note_datetime')} AS "DOS",
  CASE WHEN uses = '1' OR nope = '1' THEN 1 ELSE 0 END AS "Use Doc''d", coalesce({num('nope')}, 0) AS "Not Tobacco User",
  coalesce({num('uses')}, 0) AS "Uses Tobacco", CASE WHEN nope = '1' OR uses = '0' THEN 0 ELSE got END AS "Cessation Received",
  CASE WHEN nope = '1' OR (uses = '1' AND got = 1) THEN 'Y' ELSE 'N' END AS "Met",
  {consents('q.pid', 'q.day', 'Patient Consent to Telehealth Visit', 'Patient Consent to Telephone Visit')}
FROM (SELECT v.*, {upto(14449, 'v.pid', 'v.day')} AS uses, {upto(14450, 'v.pid', 'v.day')} AS nope,
    CASE WHEN v.pid IN (SELECT ch.patient_id FROM charge_history ch JOIN px ON px.procedure_id = ch.procedure_id
        WHERE px.procedure_number IN (848, 849) AND CAST(ch.post_fromdate AS DATE) BETWEEN DATE '1997-12-01' AND {E})
      OR coalesce({upto(14451, 'v.pid', 'v.day', _SIX)}, '0') = '1' OR coalesce({upto(14375, 'v.pid', 'v.day', _SIX)}, '0') = '1'
      THEN 1 ELSE 0 END AS got
  FROM ({last_note('tobnotes', 'active_phys', where="p.age >= 18 AND p.rn = 1")}) v
  WHERE v.pid IN (SELECT pid FROM fields WHERE f IN (14375, 14451, 14452, 14450, 14449)
    AND d BETWEEN DATE '1996-06-01' AND {E})) q"""


def statements() -> dict[str, str]:
    return {name: with_tables(sql) for name, sql in SQL.items()}
