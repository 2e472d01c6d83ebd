"""SQL for the operator queries."""

from __future__ import annotations

from .measures import num, us, with_tables, workdays

_AS_OF = "DATE '1998-07-15'"


def _newest(fields: str, day: str, ok: str = "TRUE") -> str:
    return (f"(SELECT v FROM obs WHERE obs.pid = q.pid AND f IN ({fields}) AND {day} AND {ok} "
            "ORDER BY ts DESC, nid DESC, v DESC LIMIT 1)")


_VISITS = "(SELECT DISTINCT pid, d AS vd FROM (SELECT patientprofileid AS pid, CAST(note_datetime AS DATE) AS d FROM patient_note)) q"
_VISIT_COLS = 'q.pid AS patientprofileid, q.vd AS "day"'


def _daily(fields: str, ok: str, name: str) -> str:
    return f"arg_max(v, (ts, nid, v)) FILTER (WHERE f IN ({fields}) AND {ok}) AS {name}"


_INT = f"({num('trim(v)')}) IS NOT NULL"
_OFF = "('1997-01-01', '1997-07-04', '1997-12-25')"
_GAPS = "(SELECT DISTINCT CAST(o_orderdate AS DATE) AS d1, CAST(l_shipdate AS DATE) AS d2 FROM lineitem JOIN orders ON l_orderkey = o_orderkey) g"


def _lab(test: str) -> str:
    return f"""SELECT pid AS patientprofileid, result_code, count(*) AS n, max(ts) AS last_at FROM results
      WHERE (result_code ILIKE '2040' OR result_code ILIKE 'result_1' OR result_code ILIKE '%apres%') AND {test} GROUP BY 1, 2"""


_KINDS = {"arrived": "Arrived", "registered": "Registered", "admitted": "Admitted", "discharged": "Discharged",
          "provider_in": "PROV IN", "exam_complete": "XM COMP"}
_MARKS = "SELECT bookings_id, " + ", ".join(
    f"arg_max(start_datetime, appt_tracking_id) FILTER (WHERE tracking_type = '{k}') AS {n}" for n, k in _KINDS.items()
) + " FROM appt_tracking WHERE active_yn = 'Y' GROUP BY 1"


def _gap(a: str, b: str) -> str:
    return f"CAST(coalesce(abs(date_diff('minute', {a}, {b})), -1) AS INTEGER)"


_BP = {"s1": 12848, "d1": 12849, "s2": 13259, "d2": 13260}

SQL: dict[str, str] = {
    "latest_order_per_customer": """SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS o_day FROM orders
      QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
    "earliest_order_per_customer": """SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS o_day FROM orders
      QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1""",
    "latest_by_composite_key": """SELECT o_custkey, o_orderstatus, o_orderkey FROM orders QUALIFY row_number() OVER
      (PARTITION BY o_custkey, o_orderstatus ORDER BY date_trunc('month', o_orderdate) DESC, o_totalprice DESC, o_orderkey DESC) = 1""",
    "current_patient_version": """SELECT p.patient_id, p.patient_number, p.birth_date, p.zip FROM patient p JOIN
      (SELECT patient_id, max(modified_date) AS m FROM patient WHERE active_yn = 'Y' GROUP BY 1) l
      ON l.patient_id = p.patient_id AND l.m = p.modified_date WHERE p.active_yn = 'Y'""",
    "newest_note_of_month": """SELECT patient_note_id, patientprofileid, template_id, note_datetime FROM newest
      WHERE CAST(note_datetime AS DATE) BETWEEN DATE '1998-06-01' AND DATE '1998-06-30'""",
    "value_set_rules_from_table": """SELECT diagnosis_id, icd9, icd9 IN (SELECT icd9 FROM reproductive) AS listed FROM diagnosis""",
    "evidence_masks": """SELECT patient_id, bit_or((CASE WHEN icd9 ILIKE 'n%' THEN 1 ELSE 0 END) + (CASE WHEN icd9 ILIKE 'm1%' THEN 2 ELSE 0 END)
        + (CASE WHEN procedure_code ILIKE 'x1%' THEN 4 ELSE 0 END)) AS mask
      FROM (SELECT patient_id, procedure_id, unnest([diagnosis_id_1, diagnosis_id_2, diagnosis_id_3, diagnosis_id_4]) AS slot FROM charge_history)
      LEFT JOIN diagnosis ON slot = diagnosis_id LEFT JOIN procedure USING (procedure_id) GROUP BY 1""",
    "consent_state": """SELECT pid AS patientprofileid, f AS template_field_id, arg_max(v, (ts, nid, v)) AS consent FROM obs
      WHERE f IN (16001, 16002) AND d <= DATE '1998-06-30' GROUP BY 1, 2""",
    "slot_join_codes": """SELECT p_partkey, p_type, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem
      JOIN part ON p_partkey = l_partkey OR p_partkey = l_suppkey OR p_partkey = l_linenumber GROUP BY 1, 2""",
    "slot_any_match_codes": """SELECT l_returnflag, l_linestatus, l_linenumber, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem
      WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size <= 5)
        OR l_suppkey IN (SELECT p_partkey FROM part WHERE p_size <= 5)
        OR l_linenumber IN (SELECT p_partkey FROM part WHERE p_size <= 5) GROUP BY 1, 2, 3""",
    "value_set_filter": """SELECT * FROM (SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_type ELSE p_brand END AS code FROM part)
      WHERE lower(code) IN ('economy', 'brand#7') OR code ILIKE '%2_' OR code ILIKE 'prom%'
        OR upper(code) BETWEEN 'BRAND#10' AND 'BRAND#15'""",
    "value_set_from_table": """SELECT p_partkey, lower(p_name) = 'red widget' OR lower(p_name) IN
      (SELECT lower(p_name) FROM part WHERE p_size > 47) AS in_set FROM part""",
    "exclude_by_name_parts": """SELECT p_partkey, p_name, p_size FROM part WHERE p_name NOT ILIKE 'small%'
      AND p_name NOT ILIKE '%wid%' AND lower(p_name) <> 'red ring' AND p_size NOT IN (1, 2, 3)""",
    "observation_exact": f"SELECT {_VISIT_COLS}, {_newest('1719', 'd = q.vd')} AS bmi FROM {_VISITS}",
    "observation_asof": f"""SELECT {_VISIT_COLS}, {_newest('7220, 9340', 'd <= q.vd')} AS "method",
      {_newest('3680', 'd <= q.vd', "v <> ''")} AS a1c FROM {_VISITS}""",
    "observation_window": f"""SELECT k.pid AS patientprofileid, a.v AS phq, a.d AS phq_day, b.v AS bmi, b.d AS bmi_day
      FROM (SELECT DISTINCT pid FROM obs WHERE f IN (15095, 15096, 1719) AND d BETWEEN DATE '1997-06-01' AND DATE '1998-05-31') k
      LEFT JOIN (SELECT pid, v, d FROM obs WHERE f IN (15095, 15096) AND d BETWEEN DATE '1997-06-01' AND DATE '1998-05-31'
        AND ({num('v')}) IS NOT NULL QUALIFY row_number() OVER (PARTITION BY pid
        ORDER BY ts DESC, CAST(v AS INTEGER) DESC, nid DESC) = 1) a ON a.pid = k.pid
      LEFT JOIN (SELECT pid, v, d FROM obs WHERE f = 1719 AND d BETWEEN DATE '1997-06-01' AND DATE '1998-05-31'
        QUALIFY row_number() OVER (PARTITION BY pid ORDER BY ts DESC, nid DESC, v DESC) = 1) b ON b.pid = k.pid""",
    "observations_wide": f"""SELECT pid AS patientprofileid, d AS "day", {_daily('1716', _INT, 'height')},
      {_daily('1717', _INT, 'weight')}, {_daily('12848', _INT, 'systolic')}, {_daily('11253', _INT, 'pulse')}
      FROM obs WHERE f IN (1716, 1717, 12848, 11253) GROUP BY 1, 2""",
    "consent_in_force": f"""SELECT {_VISIT_COLS}, {_newest('16001', 'd <= q.vd')} AS telehealth_consent,
      {_newest('16002', 'd <= q.vd')} AS telephone_consent FROM {_VISITS}""",
    "clean_values": f"""SELECT data_value, count(*) AS n,
      CASE WHEN trim(data_value) NOT IN ('', '.', '..', '...') THEN trim(data_value) END AS cleaned,
      {num('data_value')} AS whole, TRY_CAST(data_value AS DATE) AS as_day,
      CASE WHEN ({num('substr(data_value, 1, 2)')}) IS NOT NULL THEN substr(data_value, 1, 2) ELSE substr(data_value, 1, 1) END AS lead
      FROM patient_note_control GROUP BY data_value""",
    "business_days": f"SELECT d1, d2, {workdays('d1', 'd2')} AS days FROM {_GAPS}",
    "business_days_with_holidays": f"""SELECT d1, d2, CAST({workdays('d1', 'd2')} - CASE WHEN d1 <= d2 THEN 1 ELSE -1 END *
      len([h for h in {_OFF.replace('(', '[').replace(')', ']')} if CAST(h AS DATE) > least(d1, d2) AND CAST(h AS DATE) <= greatest(d1, d2)])
      AS INTEGER) AS days FROM {_GAPS}""",
    "after_hours_any": """SELECT patient_note_id, update_datetime, ph.provider_name FROM patient_note n JOIN phys ph ON ph.doctorid = n.doctorid
      WHERE NOT (ph.provider_name = 'Last1, First1' AND dayofweek(note_datetime) IN (2, 4) AND hour(note_datetime) > 17
          AND minute(note_datetime) >= 30)
        AND NOT (ph.provider_name = 'Last2, First2' AND dayofweek(note_datetime) BETWEEN 1 AND 5 AND hour(note_datetime) > 18)""",
    "cohort_in_not_in": """SELECT c_custkey, c_mktsegment FROM customer
      WHERE (c_custkey IN (SELECT o_custkey FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1998-01-01' AND DATE '1998-06-30')
        OR c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000))
      AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1998 AND o_orderpriority = '1-URGENT')""",
    "membership_flag": """SELECT c_custkey, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')
      THEN 1 ELSE 0 END AS has_pending FROM customer""",
    "lab_results_match": _lab("abs(sh - rh) + abs(sh - ih) + abs(sh - vh) = 0"),
    "lab_results_zero": _lab("sh + rh + vh = 0"),
    "lab_results_ignore": _lab("TRUE"),
    "booking_milestones": _MARKS,
    "booking_stage_durations": f"""SELECT bookings_id, {_gap('arrived', 'registered')} AS "Arrived To Registered",
      {_gap('registered', 'admitted')} AS "Registered To Admitted", {_gap('admitted', 'provider_in')} AS "Admitted To Provider In",
      {_gap('provider_in', 'exam_complete')} AS "Provider In To Exam Complete",
      {_gap('exam_complete', 'discharged')} AS "Exam Complete To Discharge" FROM ({_MARKS})""",
    "next_booking_per_appointment": """SELECT a.appointmentid, b.appointmentid AS next_found FROM patientappt a
      LEFT JOIN patientappt b ON b.patientprofileid = a.patientprofileid AND b.status <> 'Cancelled'
        AND CAST(b.booked_by_date AS DATE) >= CAST(a.booking_date AS DATE)
        AND (CAST(b.booking_date AS DATE) > CAST(a.booking_date AS DATE)
          OR (CAST(b.booking_date AS DATE) = CAST(a.booking_date AS DATE) AND b.start_minutes > a.start_minutes))
      QUALIFY row_number() OVER (PARTITION BY a.appointmentid ORDER BY b.booked_by_date, b.appointmentid) = 1""",
    "next_order_of_customer": """SELECT a.o_orderkey, CAST(min(b.o_orderdate) AS DATE) AS next_found_day FROM orders a
      LEFT JOIN orders b ON b.o_custkey = a.o_custkey AND (CAST(b.o_orderdate AS DATE) > CAST(a.o_orderdate AS DATE)
        OR (CAST(b.o_orderdate AS DATE) = CAST(a.o_orderdate AS DATE) AND b.o_orderkey % 1440 > a.o_orderkey % 1440))
      GROUP BY a.o_orderkey""",
    "asof_previous_order": """SELECT a.o_orderkey, b.o_orderkey AS "key", b.o_totalprice AS price FROM orders a
      LEFT JOIN orders b ON b.o_custkey = a.o_custkey AND b.o_orderstatus = 'F' AND b.o_orderdate < a.o_orderdate
      QUALIFY row_number() OVER (PARTITION BY a.o_orderkey ORDER BY b.o_orderdate DESC NULLS LAST, b.o_orderkey DESC) = 1""",
    "no_show_answers": """SELECT appointmentid, max(response_text) FILTER (WHERE upper(question) = 'NO SHOW -  REASON') AS reason,
      max(response_text) FILTER (WHERE upper(question) = 'NO SHOW - 1ST ATTEMPT') AS first_attempt,
      max(response_text) FILTER (WHERE upper(question) = 'NO SHOW - 2ND ATTEMPT') AS second_attempt
      FROM patientapptresp WHERE question <> 'OTHER' GROUP BY 1""",
    "appointment_labels": """SELECT appointmentid, CASE WHEN status = 'Cancelled' AND (cancelled_by = 37465493 OR disposition = 2)
      THEN 'Cancelled by Patient' WHEN status = 'Cancelled' AND (cancelled_by <> 37465493 OR disposition = 3)
      THEN 'Cancelled by Doctor' ELSE status END AS label FROM patientappt""",
    "poverty_brackets": """SELECT p.patient_id, p.patient_number, m.poverty_status FROM patient p JOIN fee_matrix_detail m
      ON m.company_id = p.company_id
      JOIN (SELECT fee_matrix_id, max(family_size) AS s FROM fee_matrix_detail GROUP BY 1) a ON a.fee_matrix_id = m.fee_matrix_id
      JOIN (SELECT fee_matrix_id, family_size, max(income_to) AS t FROM fee_matrix_detail GROUP BY 1, 2) b
        ON b.fee_matrix_id = m.fee_matrix_id AND b.family_size = m.family_size
      WHERE m.family_size = CASE WHEN a.s < coalesce(p.family_size, 1) THEN a.s ELSE coalesce(p.family_size, 1) END
        AND m.income_from <= coalesce(p.income, 0)
        AND m.income_to >= CASE WHEN b.t < coalesce(p.income, 0) THEN b.t ELSE coalesce(p.income, 0) END""",
    "newer_lab_or_note": """SELECT o_custkey, CASE WHEN fk IS NOT NULL AND (ok IS NULL OR fd >= od) THEN fk ELSE ok END AS o_orderkey
      FROM (SELECT o_custkey, max(CAST(o_orderdate AS DATE)) FILTER (WHERE o_orderstatus = 'F') AS fd,
        max(CAST(o_orderdate AS DATE)) FILTER (WHERE o_orderstatus = 'O') AS od,
        arg_max(o_orderkey, (o_orderdate, o_orderkey)) FILTER (WHERE o_orderstatus = 'F') AS fk,
        arg_max(o_orderkey, (o_orderdate, o_orderkey)) FILTER (WHERE o_orderstatus = 'O') AS ok FROM orders GROUP BY 1)""",
    "patient_ages": """SELECT patientprofileid, age, agemonth AS months, CASE WHEN age < 0 THEN 'NA' WHEN age <= 5 THEN 'A. 0 to 5'
      WHEN age <= 13 THEN 'B. 6 to 13' WHEN age <= 21 THEN 'C. 14 to 21' ELSE 'D. 22 and Up' END AS band FROM pts""",
    "bp_control_per_day": f"""SELECT pid AS patientprofileid, d AS "day", ok1 AS first_ok,
      CASE WHEN coalesce(y2, 0) = 0 AND coalesce(z2, 0) = 0 THEN ok1 WHEN coalesce(y2, 0) = 0 OR coalesce(z2, 0) = 0 THEN FALSE
        ELSE age >= 18 AND y2 < lim AND z2 < 90 END AS final_ok
      FROM (SELECT *, coalesce(age >= 18 AND y1 < lim AND z1 < 90, FALSE) AS ok1 FROM (SELECT pid, d, p.age,
        CASE WHEN p.age >= 60 AND pid % 3 = 0 THEN 150 ELSE 140 END AS lim, {num('s1')} AS y1, {num('d1')} AS z1,
        {num('s2')} AS y2, {num('d2')} AS z2 FROM (SELECT pid, d,
          {', '.join(_daily(str(f), 'TRUE', n) for n, f in _BP.items())} FROM obs WHERE f IN (12848, 12849, 13259, 13260) GROUP BY 1, 2) o
        JOIN pts p ON p.patientprofileid = o.pid))""",
    "first_present_weight": f"""SELECT pid AS patientprofileid, d AS "day", upper(coalesce(w1, w2, w3)) AS weight,
      CASE WHEN coalesce(w1, w2, w3) IS NULL THEN NULL WHEN coalesce(w1, w2, w3) ILIKE 'low%' THEN 1 ELSE 0 END AS is_low
      FROM (SELECT pid, d, {_daily('15127', "v <> ''", 'w1')}, {_daily('15141', "v <> ''", 'w2')}, {_daily('15142', "v <> ''", 'w3')}
        FROM obs WHERE f IN (15127, 15141, 15142) GROUP BY 1, 2)""",
    "shipped_within_28_days": """SELECT o_orderkey AS "key", CAST(o_orderdate AS DATE) AS placed, s.shipped,
      CASE WHEN date_diff('day', CAST(o_orderdate AS DATE), s.shipped) <= 28 THEN 'Y' ELSE 'N' END AS "within"
      FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey, CAST(l_shipdate AS DATE) AS shipped FROM lineitem) s ON l_orderkey = o_orderkey""",
    "clinic_labels": """SELECT clinic, count(*) AS n FROM ddb_proc_log l JOIN dclin c ON c.urscid = l.clinicappliedto GROUP BY 1""",
    "report_layout": f"""SELECT o_orderkey AS "Order ID", {us('o_orderdate')} AS "Placed",
      CASE WHEN o_orderkey % 3 = 0 THEN {us('o_orderdate')} ELSE '' END AS "Late",
      CASE WHEN o_totalprice > 250000 THEN 'Y' ELSE 'N' END AS "Dear", CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS "Open?"
      FROM orders""",
    "union_distinct": """SELECT o_custkey, o_orderpriority FROM orders WHERE o_orderstatus = 'F' UNION
      SELECT o_custkey, o_orderpriority FROM orders WHERE o_orderstatus = 'O' UNION
      SELECT o_custkey, o_orderpriority FROM orders WHERE o_orderstatus = 'P'""",
    "multi_role_dimension": """SELECT p.patient_id, r.description AS race, e.description AS ethnicity, m.description AS employment
      FROM regpts p LEFT JOIN lists r ON r.medlistsid = p.race_id LEFT JOIN lists e ON e.medlistsid = p.ethnicity_id
      LEFT JOIN lists m ON m.medlistsid = p.employment_status_id""",
    "date_and_text_functions": f"""SELECT o_orderkey, CAST(date_trunc('month', o_orderdate - INTERVAL 1 MONTH) AS DATE) AS month_start,
      last_day(o_orderdate - INTERVAL 1 MONTH) AS month_end, CAST(date_trunc('year', o_orderdate) AS DATE) AS year_start,
      CAST(o_orderdate - INTERVAL 4 MONTH AS DATE) AS back_four, CAST(o_orderdate + INTERVAL 28 DAY AS DATE) AS plus_days,
      CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS weekday, CAST(year(o_orderdate) AS INTEGER) AS "year",
      {us('o_orderdate')} AS shown, concat('P', o_orderpriority) AS joined, left(o_orderpriority, 1) AS lead,
      right(o_orderpriority, 3) AS tail, upper(trim(o_orderpriority)) AS upper_text,
      strftime(TIMESTAMP '1970-01-01' + INTERVAL 1 MINUTE * CAST(o_orderkey % 1440 AS INTEGER), '%H:%M') AS clock FROM orders""",
    "minutes_between_events": """SELECT event_id, CAST(date_diff('minute', first_ts, ts) AS INTEGER) AS minutes FROM events
      JOIN (SELECT user_id, min(ts) AS first_ts FROM events GROUP BY 1) f USING (user_id)""",
}


def statements() -> dict[str, str]:
    return {name: with_tables(sql) for name, sql in SQL.items()}
