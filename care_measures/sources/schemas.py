"""Declared schema of every clinical table (nothing is inferred when reading)."""

from pyspark.sql import types as T

_TS = "TIMESTAMP_NTZ"

TABLES: dict[str, str] = {
    "view_patient": "patientprofileid BIGINT, patientid STRING, birthdate DATE, sex STRING, "
                    "first STRING, last STRING, rn INT",
    "patient": f"patient_id BIGINT, patient_number STRING, birth_date DATE, modified_date {_TS}, "
               "active_yn STRING, deleted_yn STRING, company_id INT, sex STRING, zip STRING, "
               "family_size INT, income DECIMAL(12,2), race_id INT, ethnicity_id INT, "
               "employment_status_id INT",
    "patient_note": "patient_note_id BIGINT, patientprofileid BIGINT, doctorid INT, dept_id INT, "
                    f"template_id INT, note_datetime {_TS}, update_datetime {_TS}, signedby INT",
    "patient_note_control": "patient_note_id BIGINT, template_field_id INT, data_value STRING",
    "template": "template_id INT, template_name STRING, template_type_id INT",
    "template_field": "template_field_id INT, field_name STRING",
    "charge_history": f"patient_id BIGINT, post_fromdate {_TS}, procedure_id BIGINT, "
                      "diagnosis_id_1 BIGINT, diagnosis_id_2 BIGINT, diagnosis_id_3 BIGINT, "
                      "diagnosis_id_4 BIGINT, financial_class_id_1 INT, financial_class_id_2 INT, "
                      "financial_class_id_3 INT, company_id INT",
    "view_chargehistory": f"patient_id BIGINT, post_fromdate {_TS}, procedure_id BIGINT, "
                          "physician_id INT, physician_id_2 INT, department_id INT, status INT",
    "diagnosis": "diagnosis_id BIGINT, icd9 STRING, icd10_yn STRING, company_id INT, active_yn STRING",
    "procedure": "procedure_id BIGINT, procedure_code STRING, procedure_number INT, active_yn STRING",
    "lab_req": f"lab_result_req_id BIGINT, lab_hist_req_id INT, patientprofileid BIGINT, "
               f"obr_obs_datetime {_TS}",
    "lab_set": "lab_result_set_id BIGINT, lab_hist_req_id INT, lab_result_req_id BIGINT, "
               "obr_order_code STRING",
    "lab_item": "lab_result_item_id BIGINT, lab_hist_req_id INT, lab_result_set_id BIGINT, "
                "result_code STRING, result_desc STRING",
    "lab_value": "lab_result_item_id BIGINT, lab_hist_req_id INT, result_value STRING, "
                 "result_status STRING",
    "patientappt": f"appointmentid BIGINT, patientprofileid BIGINT, booking_date {_TS}, "
                   f"booked_by_date {_TS}, start_minutes INT, departmentid INT, doctorid INT, "
                   "visit_type_id INT, status STRING, canceled INT, cancelled_by INT, "
                   f"cancel_comment STRING, disposition INT, pat_arrived {_TS}, "
                   f"pat_registered {_TS}, pat_discharged {_TS}",
    "patientapptresp": "appointmentid BIGINT, question STRING, response_text STRING",
    "appt_tracking": "appt_tracking_id BIGINT, bookings_id BIGINT, tracking_type STRING, "
                     f"active_yn STRING, start_datetime {_TS}",
    "superbill": "appointmentid BIGINT, patientprofileid BIGINT, dept_id INT, doctorid INT, "
                 f"doctor2id INT, signedby INT, superbill_datetime {_TS}, created_date {_TS}, "
                 f"update_datetime {_TS}",
    "document": "document_id BIGINT, patientprofileid BIGINT, doctorid INT, dept_id INT, "
                f"doc_type_id INT, file_name STRING, doc_date {_TS}, created_date {_TS}, "
                f"update_datetime {_TS}, signedby INT",
    "lookups": "lookup_id INT, lookup_item STRING",
    "notification": "notification_id BIGINT, notification_rule_id INT, patientprofileid BIGINT, "
                    "doctorid INT, deptid INT, company_id INT, teamid INT, team_name STRING, "
                    f"notif_date {_TS}, item_description STRING, completed_flag INT, "
                    f"completed_datetime {_TS}",
    "notification_rule": "notification_rule_id INT, active_flag INT",
    "patient_drug": f"patientprofileid BIGINT, drug_name STRING, start_date {_TS}",
    "patient_shortcode": "patient_id BIGINT, code STRING",
    "financial_class": "financial_class_id INT, description STRING",
    "fee_matrix_detail": "fee_matrix_id INT, company_id INT, family_size INT, "
                         "income_from DECIMAL(12,2), income_to DECIMAL(12,2), poverty_status STRING",
    "physician": "phys_id INT, first_name STRING, last_name STRING, degree STRING, active_yn STRING",
    "department": "departmentid INT, short_name STRING, short STRING, listname STRING",
    "staff": "staffid INT, doctorid INT, fullname STRING",
    "lists": "medlistsid INT, description STRING",
    "visit_type": "visit_type_id INT, short_desc STRING, description STRING",
    "active_phys": "doctorid INT, provider_name STRING, first_name STRING, last_name STRING, "
                   "degree STRING, individual_npi STRING, active_yn STRING, rn INT",
    "ddb_pat": "patid BIGINT, patextid STRING, pataccountnumber STRING, lastname STRING, "
               f"firstname STRING, birthdate DATE, ddb_last_mod {_TS}, status INT",
    "ddb_rsc": "urscid INT, rsctype INT, name_last STRING, name_first STRING, activeflag INT, "
               "isnonperson INT",
    "ddb_clinic": "urscid INT, rscid STRING",
    "ddb_proc_log": f"patid BIGINT, pldate {_TS}, proc_codeid BIGINT, provid INT, "
                    "clinicappliedto INT, chart_status INT, history INT",
    "ddb_proc_code": "proc_codeid BIGINT, adacode STRING",
    # Long code lists kept as data: set name and code.
    "value_set_code": "set_name STRING, code STRING, code_to STRING, kind STRING",
}


def schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(TABLES[table])
