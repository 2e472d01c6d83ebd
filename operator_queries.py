"""One registered query per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, functions as F

from care_measures.functions import expressions as x
from care_measures.functions.valuesets import CLINIC_LABELS, ValueSet
from care_measures.operators import (
    asof_value, bracket_lookup, code_mask, cohort, consent_flags, current_version, daily_observations, earliest_per_key, evidence,
    extend_state,
    exclude_after_hours, exclude_by_name, follow_up_within, ids_of, lab_results, latest_observations, latest_per_key,
    milestones, next_booking, observations_asof, observations_exact, report, responses_wide, slot_any_match,
    slot_join, stage_durations)
from care_measures.plans.common import DX_SLOTS
from care_measures.plans.scheduling import MILESTONES, NO_SHOW_QUESTIONS, PORTAL_USER, STAGES
from care_measures.sources import views
from care_measures.sources.tables import Source

Query = Callable[[Source, Callable[[str], DataFrame]], DataFrame]
QUERIES: dict[str, Query] = {}


def _query(fn: Query) -> Query:
    QUERIES[fn.__name__.lstrip("_")] = fn
    return fn


def _visits(src: Source) -> DataFrame:
    return src.table("patient_note").select(
        "patientprofileid", x.day("note_datetime").alias("day")).distinct()


@_query
def latest_order_per_customer(src, given):
    return latest_per_key(given("orders"), ["o_custkey"], ["o_orderdate"], ["o_orderkey"]).select(
        "o_custkey", "o_orderkey", x.day("o_orderdate").alias("o_day"))


@_query
def earliest_order_per_customer(src, given):
    return earliest_per_key(given("orders"), ["o_custkey"], ["o_orderdate"], ["o_orderkey"]).select(
        "o_custkey", "o_orderkey", x.day("o_orderdate").alias("o_day"))


@_query
def latest_by_composite_key(src, given):
    """Composite key, order by an expression, then by a value, then by the id."""
    return latest_per_key(given("orders"), ["o_custkey", "o_orderstatus"],
                          [F.trunc("o_orderdate", "MM"), F.col("o_totalprice")], ["o_orderkey"]).select(
        "o_custkey", "o_orderstatus", "o_orderkey")


@_query
def current_patient_version(src, given):
    return current_version(src.table("patient"), "patient_id", "modified_date", x.ci("active_yn") == "y",
                           ["patient_number"]).select("patient_id", "patient_number", "birth_date", "zip")


@_query
def newest_note_of_month(src, given):
    """Notes whose newest version lies in June; those moved out of it by a later version are not there."""
    return views.latest_notes(src, date(1998, 6, 1), date(1998, 6, 30)).select(
        "patient_note_id", "patientprofileid", "template_id", "note_datetime")


@_query
def value_set_rules_from_table(src, given):
    """A stored code list of exact codes, ranges and patterns, marked on the diagnosis codes."""
    return ValueSet(table=src.table("value_set_code")).mark(src.table("diagnosis"), "icd9", "listed").select(
        "diagnosis_id", "icd9", "listed")


@_query
def evidence_masks(src, given):
    """Three code lists over all charges of each patient in one pass."""
    dx = code_mask(src.table("diagnosis"), "diagnosis_id", [x.like("icd9", "N%"), x.like("icd9", "M1%")], "_d")
    px = code_mask(src.table("procedure"), "procedure_id", [F.lit(False), F.lit(False), x.like("procedure_code", "X1%")], "_p")
    return evidence(src.table("charge_history"), "patient_id", DX_SLOTS, dx, "diagnosis_id",
                    F.coalesce("_d", F.lit(0)).bitwiseOR(F.coalesce("_p", F.lit(0))), procedures=px, procedure="procedure_id",
                    every_fact=True)


@_query
def consent_state(src, given):
    """The newest consents up to May, and extended by June."""
    fields = (src.config.telehealth_consent_field, src.config.telephone_consent_field)
    notes, controls = src.table("patient_note"), src.table("patient_note_control")
    may = extend_state(None, notes, controls, fields, None, date(1998, 5, 31))
    june = extend_state(may, notes, controls, fields, date(1998, 6, 1), date(1998, 6, 30))
    return june.select("patientprofileid", "template_field_id", F.col("newest.value").alias("consent"))


@_query
def slot_join_codes(src, given):
    parts = given("part").select("p_partkey", "p_type")
    hits = slot_join(given("lineitem"), ("l_partkey", "l_suppkey", "l_linenumber"), parts, "p_partkey")
    return hits.groupBy("p_partkey", "p_type").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"))


@_query
def slot_any_match_codes(src, given):
    small = given("part").where("p_size <= 5").select("p_partkey")
    hits = slot_any_match(given("lineitem"), ("l_partkey", "l_suppkey", "l_linenumber"), small, "p_partkey")
    return hits.groupBy("l_returnflag", "l_linestatus", "l_linenumber").agg(
        F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"))


@_query
def value_set_filter(src, given):
    codes = ValueSet(exact=("economy", "BRAND#7 "), patterns=("%2_", "prom%"), ranges=(("BRAND#10", "BRAND#15"),))
    return codes.filter(given("part").withColumn("code", F.when(F.col("p_size") % 2 == 0, F.col("p_type"))
                                                 .otherwise(F.col("p_brand"))), "code").select("p_partkey", "code")


@_query
def value_set_from_table(src, given):
    listed = given("part").where("p_size > 47").select(F.lower("p_name").alias("code"))
    return ValueSet(exact=("red widget",), table=listed).mark(given("part"), "p_name", "in_set").select(
        "p_partkey", "in_set")


@_query
def exclude_by_name_parts(src, given):
    return exclude_by_name(given("part"), "p_name", ("SMALL%", "%wid%"), ("Red Ring",), "p_size", (1, 2, 3)).select(
        "p_partkey", "p_name", "p_size")


@_query
def observation_exact(src, given):
    daily = daily_observations(src.table("patient_note"), src.table("patient_note_control"), {"bmi": (1719,)})
    return observations_exact(_visits(src), daily)


@_query
def observation_asof(src, given):
    daily = daily_observations(src.table("patient_note"), src.table("patient_note_control"),
                               {"method": (7220, 9340), "a1c": (3680,)}, keep={"a1c": lambda v: v != ""})
    return observations_asof(_visits(src), daily)


@_query
def observation_window(src, given):
    return latest_observations(src.table("patient_note"), src.table("patient_note_control"),
                               {"phq": (15095, 15096), "bmi": (1719,)}, date(1997, 6, 1), date(1998, 5, 31),
                               keep={"phq": lambda v: x.try_int(v).isNotNull()}, prefer={"phq": x.try_int})


@_query
def observations_wide(src, given):
    return daily_observations(src.table("patient_note"), src.table("patient_note_control"),
                              {"height": (1716,), "weight": (1717,), "systolic": (12848,), "pulse": (11253,)},
                              keep=lambda v: x.clean_value(v, "int").isNotNull())


@_query
def consent_in_force(src, given):
    return consent_flags(_visits(src), src.table("patient_note"), src.table("patient_note_control"), 16001, 16002,
                         date(1998, 7, 15))


@_query
def clean_values(src, given):
    v = src.table("patient_note_control").groupBy("data_value").agg(F.count("*").alias("n"))
    return v.select("data_value", "n", x.clean_value("data_value").alias("cleaned"),
                    x.clean_value("data_value", "int").alias("whole"), x.try_date("data_value").alias("as_day"),
                    x.leading_score("data_value").alias("lead"))


def _ship_gaps(given) -> DataFrame:
    joined = given("lineitem").join(given("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(x.day("o_orderdate").alias("d1"), x.day("l_shipdate").alias("d2")).distinct()


@_query
def business_days(src, given):
    return _ship_gaps(given).withColumn("days", x.business_day_diff("d1", "d2"))


@_query
def business_days_with_holidays(src, given):
    off = (date(1997, 1, 1), date(1997, 7, 4), date(1997, 12, 25), date(1998, 7, 4))
    return _ship_gaps(given).withColumn("days", x.business_day_diff("d1", "d2", off))


@_query
def after_hours_any(src, given):
    n = src.table("patient_note").join(views.providers(src).select("doctorid", "provider_name"), "doctorid")
    return exclude_after_hours(n, src.config.provider_rules, "any", provider="provider_name", ts="note_datetime").select(
        "patient_note_id", "update_datetime", "provider_name")


@_query
def cohort_in_not_in(src, given):
    """Semi join against a union of two cohorts, and NOT IN a third."""
    o = given("orders")
    placed = ids_of(o.where(x.within("o_orderdate", date(1998, 1, 1), date(1998, 6, 30))), "o_custkey")
    dear = ids_of(o.where("o_totalprice > 450000"), "o_custkey")
    urgent = ids_of(o.where(x.within("o_orderdate", date(1998, 1, 1), date(1998, 12, 31))
                            & (F.col("o_orderpriority") == "1-URGENT")), "o_custkey")
    return cohort(given("customer"), "c_custkey", include=[placed.union(dear)], exclude=[urgent]).select(
        "c_custkey", "c_mktsegment")


@_query
def membership_flag(src, given):
    ids = ids_of(given("orders").where("o_orderstatus = 'P'"), "o_custkey")
    c = given("customer").join(ids, F.col("c_custkey") == F.col("id"), "left")
    return c.select("c_custkey", x.flag(F.col("id").isNotNull()).alias("has_pending"))


def _labs(hist: str) -> Query:
    def fn(src, given):
        out = lab_results(src.table("lab_req"), src.table("lab_set"), src.table("lab_item"), src.table("lab_value"),
                          hist=hist, where=x.like_any("result_code", ("2040", "RESULT_1", "%apres%")))
        return out.groupBy("patientprofileid", "result_code").agg(
            F.count("*").alias("n"), F.max("obr_obs_datetime").alias("last_at"))
    return fn


for _hist in ("match", "zero", "ignore"):
    QUERIES[f"lab_results_{_hist}"] = _labs(_hist)


def _marks(src: Source) -> DataFrame:
    return milestones(src.table("appt_tracking"), "bookings_id", "tracking_type", "start_datetime", "appt_tracking_id",
                      MILESTONES, x.ci("active_yn") == "y")


@_query
def booking_milestones(src, given):
    return _marks(src)


@_query
def booking_stage_durations(src, given):
    return stage_durations(_marks(src), STAGES).select("bookings_id", *STAGES)


@_query
def next_booking_per_appointment(src, given):
    a = src.table("patientappt").select("appointmentid", "patientprofileid", "start_minutes", "status",
                                        x.day("booking_date").alias("slot_day"), "booked_by_date",
                                        x.day("booked_by_date").alias("booked_day"))
    right = a.where(x.ci("status") != "cancelled").withColumnRenamed("appointmentid", "found")
    return next_booking(a, right, ("patientprofileid",), day="slot_day", minute="start_minutes",
                        order=("booked_by_date",), payload=("found",), booked_day="booked_day").select(
        "appointmentid", "next_found")


@_query
def next_order_of_customer(src, given):
    o = given("orders").select("o_orderkey", "o_custkey", x.day("o_orderdate").alias("d"),
                               (F.col("o_orderkey") % 1440).cast("int").alias("m"))
    return next_booking(o, o.withColumn("found_day", F.col("d")), ("o_custkey",), day="d", minute="m", order=("d",),
                        payload=("found_day",)).select("o_orderkey", "next_found_day")


@_query
def asof_previous_order(src, given):
    o = given("orders")
    filled = o.where("o_orderstatus = 'F'").select("o_custkey", "o_orderdate", F.col("o_orderkey").alias("key"),
                                                   F.col("o_totalprice").alias("price"))
    left = o.select("o_orderkey", "o_custkey", "o_orderdate")
    return asof_value(left, filled, ["o_custkey"], "o_orderdate", "o_orderdate", ["key", "price"], ["key"],
                      allow_equal=False).select("o_orderkey", "key", "price")


@_query
def no_show_answers(src, given):
    return responses_wide(src.table("patientapptresp"), "appointmentid", "question", "response_text", NO_SHOW_QUESTIONS)


@_query
def appointment_labels(src, given):
    return src.table("patientappt").select(
        "appointmentid", x.classify_status("status", "cancelled_by", "disposition", PORTAL_USER).alias("label"))


@_query
def poverty_brackets(src, given):
    return bracket_lookup(src.table("patient").select("patient_id", "patient_number", "company_id", "family_size",
                                                      "income"), src.table("fee_matrix_detail")).select(
        "patient_id", "patient_number", "poverty_status")


@_query
def newer_lab_or_note(src, given):
    """Later of a customer's last filled and last open order, the filled one on a tie."""
    o = given("orders").withColumn("d", x.day("o_orderdate")).groupBy("o_custkey").agg(
        *[F.max(F.when(F.col("o_orderstatus") == s, F.struct("d", "o_orderkey"))).alias(s) for s in ("F", "O")])
    return o.select("o_custkey", x.newer_of(F.col("F.d"), F.col("F.o_orderkey"), F.col("O.d"),
                                            F.col("O.o_orderkey")).alias("o_orderkey"))


@_query
def patient_ages(src, given):
    p = src.table("view_patient")
    age = x.age_years("birthdate", date(1998, 7, 15))
    return p.select("patientprofileid", age.alias("age"), x.age_months("birthdate", date(1998, 7, 15)).alias("months"),
                    x.age_band(age, "NA").alias("band"))


@_query
def bp_control_per_day(src, given):
    daily = daily_observations(src.table("patient_note"), src.table("patient_note_control"),
                               {"s1": (12848,), "d1": (12849,), "s2": (13259,), "d2": (13260,)})
    p = views.patients(src, date(1998, 7, 15), unique=False).select("patientprofileid", "age")
    d = daily.join(p, "patientprofileid").withColumn("well", F.col("patientprofileid") % 3 == 0)
    d = d.withColumn("first_ok", x.bp_first_controlled(F.col("age"), F.col("well"), F.col("s1"), F.col("d1")))
    return d.select("patientprofileid", "day", "first_ok", x.bp_final_controlled(
        F.col("age"), F.col("well"), F.col("first_ok"), F.col("s2"), F.col("d2")).alias("final_ok"))


@_query
def first_present_weight(src, given):
    daily = daily_observations(src.table("patient_note"), src.table("patient_note_control"),
                               {"w1": (15127,), "w2": (15141,), "w3": (15142,)}, keep=lambda v: v != "")
    return daily.select("patientprofileid", "day", x.first_present(("w1", "w2", "w3"), F.upper).alias("weight"),
                        x.first_present(("w1", "w2", "w3"), lambda w: x.flag(x.like(w, "low%"))).alias("is_low"))


@_query
def shipped_within_28_days(src, given):
    placed = given("orders").select(F.col("o_orderkey").alias("key"), x.day("o_orderdate").alias("placed"))
    shipped = given("lineitem").select(F.col("l_orderkey").alias("key"), x.day("l_shipdate").alias("shipped")).distinct()
    return follow_up_within(placed, shipped, "key", "placed", "shipped", 28, "within")


@_query
def clinic_labels(src, given):
    return src.table("ddb_proc_log").join(src.table("ddb_clinic"), F.col("clinicappliedto") == F.col("urscid")).groupBy(
        x.label_map("rscid", CLINIC_LABELS).alias("clinic")).agg(F.count("*").alias("n"))


@_query
def report_layout(src, given):
    o = given("orders").withColumn("late", F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderdate")))
    return report(o, {"Order ID": "o_orderkey", "Placed": x.us_date("o_orderdate"), "Late": x.or_blank(x.us_date("late")),
                      "Dear": x.yes_no(F.col("o_totalprice") > 250000), "Open?": x.flag(F.col("o_orderstatus") == "O")},
                  ["Placed", "Order ID"])


@_query
def union_distinct(src, given):
    o = given("orders").select("o_custkey", "o_orderpriority", "o_orderstatus")
    parts = [o.where(F.col("o_orderstatus") == s).select("o_custkey", "o_orderpriority") for s in ("F", "O", "P")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).distinct()


@_query
def multi_role_dimension(src, given):
    """One lookup joined in three roles."""
    lists = src.table("lists")
    out = views.registered_patients(src, date(1998, 7, 15))
    for key, name in (("race_id", "race"), ("ethnicity_id", "ethnicity"), ("employment_status_id", "employment")):
        out = out.join(lists.select(F.col("medlistsid").alias(key), F.col("description").alias(name)), key, "left")
    return out.select("patient_id", "race", "ethnicity", "employment")


@_query
def date_and_text_functions(src, given):
    o, d = given("orders"), F.col("o_orderdate")
    return o.select(
        "o_orderkey", F.trunc(F.add_months(d, -1), "MM").alias("month_start"), F.last_day(F.add_months(d, -1)).alias("month_end"),
        F.trunc(d, "YEAR").alias("year_start"), F.add_months(d, -4).alias("back_four"), F.date_add(d, 28).alias("plus_days"),
        F.dayofweek(d).alias("weekday"), F.year(d).alias("year"), x.us_date(d).alias("shown"),
        F.concat_ws("", F.lit("P"), F.col("o_orderpriority")).alias("joined"), F.left("o_orderpriority", F.lit(1)).alias("lead"),
        F.right("o_orderpriority", F.lit(3)).alias("tail"), F.upper(F.trim("o_orderpriority")).alias("upper_text"),
        F.date_format(F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(mins=(F.col("o_orderkey") % 1440).cast("int")),
                      "HH:mm").alias("clock"))


@_query
def minutes_between_events(src, given):
    e = given("events")
    first = earliest_per_key(e, ["user_id"], ["ts"], ["event_id"]).select("user_id", F.col("ts").alias("first_ts"))
    return e.join(first, "user_id").select("event_id", x.minute_diff("first_ts", "ts").alias("minutes"))
