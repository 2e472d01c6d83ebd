from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from care_measures import operators as ops
from care_measures.config import ProviderRule
from care_measures.functions import expressions as x


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)


def test_latest_and_earliest_per_key(spark):
    df = spark.createDataFrame(
        [(1, datetime(2024, 1, 1), 1), (1, datetime(2024, 1, 1), 2), (1, None, 9), (2, None, 5), (3, datetime(2024, 2, 1), 7)],
        "k INT, ts TIMESTAMP_NTZ, id INT")
    assert rows(ops.latest_per_key(df, ["k"], ["ts"], ["id"]), "k", "id") == [(1, 2), (2, 5), (3, 7)]
    assert rows(ops.earliest_per_key(df, ["k"], ["ts"], ["id"]), "k", "id") == [(1, 1), (2, 5), (3, 7)]


def test_current_version_takes_the_newest_active_row(spark):
    df = spark.createDataFrame([(1, 3, "N"), (1, 2, "y"), (1, 1, "Y")], "k INT, m INT, active STRING")
    assert rows(ops.current_version(df, "k", "m", x.ci("active") == "y"), "m") == [(2,)]


def test_slot_join_equals_the_or_join(spark):
    facts = spark.createDataFrame([(1, 10, 10, None), (2, 10, 20, 30), (3, None, None, None), (4, 99, None, 20)],
                                  "f INT, a INT, b INT, c INT")
    dim = spark.createDataFrame([(10, "x"), (20, "y"), (20, "y2"), (None, "n")], "id INT, name STRING")
    want = facts.join(dim, (facts.a == dim.id) | (facts.b == dim.id) | (facts.c == dim.id))
    got = ops.slot_join(facts, ("a", "b", "c"), dim, "id")
    assert rows(got, "f", "name") == rows(want, "f", "name") == [(1, "x"), (2, "x"), (2, "y"), (2, "y2"), (4, "y"), (4, "y2")]
    assert rows(ops.slot_any_match(facts, ("a", "b", "c"), dim, "id"), "f") == [(1,), (2,), (4,)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_cohort_follows_not_in(spark):
    base = spark.createDataFrame([(1,), (2,), (3,), (None,)], "k INT")
    ids = lambda *v: spark.createDataFrame([(i,) for i in v], "id INT")
    for exclude in (ids(2, 2), ids(2, None), ids()):
        base.createOrReplaceTempView("base")
        exclude.createOrReplaceTempView("gone")
        want = spark.sql("SELECT k FROM base WHERE k NOT IN (SELECT id FROM gone)")
        assert rows(ops.cohort(base, "k", exclude=[exclude], key_nullable=True)) == rows(want)
    assert rows(ops.cohort(base, "k", include=[ids(1, 1, 3), ids(3, None)])) == [(3,)]


def test_exclude_by_name(spark):
    df = spark.createDataFrame([("Nurse Visit", 1), ("progress", 2), ("PROGRESS", 69), (None, 1), ("SDoH ", 1)], "n STRING, t INT")
    kept = ops.exclude_by_name(df, "n", ("%nurse%", "zz%"), ("sdoh",), "t", (69,))
    assert rows(kept) == [("progress", 2)]


def test_after_hours_modes(spark):
    rules = (ProviderRule("A, B", (3,), 18), ProviderRule("C, D", (2, 3), 17, 30))
    ts = [("a, b", datetime(2024, 5, 7, 19, 0)), ("A, B", datetime(2024, 5, 8, 19, 0)), ("C, D", datetime(2024, 5, 7, 18, 10)),
          ("C, D", datetime(2024, 5, 7, 18, 40)), (None, datetime(2024, 5, 7, 20, 0))]
    df = spark.createDataFrame(ts, "p STRING, ts TIMESTAMP_NTZ")
    assert ops.exclude_after_hours(df, rules, "as_written", provider="p", ts="ts").count() == 5
    kept = ops.exclude_after_hours(df, rules, "any", provider="p", ts="ts")
    assert kept.count() == 3 and kept.where("minute(ts) = 10").count() == 1
    with pytest.raises(ValueError):
        ops.exclude_after_hours(df, rules, "none", provider="p", ts="ts")


def notes_and_controls(spark):
    notes = spark.createDataFrame([
        (1, 7, datetime(2024, 6, 1, 9, 0)), (2, 7, datetime(2024, 6, 1, 15, 0)), (3, 7, datetime(2024, 6, 30, 23, 0)),
        (4, 8, datetime(2024, 5, 31, 10, 0)), (5, 8, datetime(2024, 7, 1, 0, 0))],
        "patient_note_id INT, patientprofileid INT, note_datetime TIMESTAMP_NTZ")
    controls = spark.createDataFrame([
        (1, 10, "1"), (2, 10, " 5 "), (2, 11, ""), (2, 10, "..."), (3, 10, "9"), (3, 11, None), (4, 10, "4"), (5, 10, "3.5"), (5, 99, "8")],
        "patient_note_id INT, template_field_id INT, data_value STRING")
    return notes, controls


def test_daily_observations_and_lookups(spark):
    notes, controls = notes_and_controls(spark)
    number = lambda v: x.try_int(v).isNotNull()
    daily = ops.daily_observations(notes, controls, {"a": (10,), "b": (11,)}, keep={"a": number})
    assert rows(daily, "patientprofileid", "day", "a", "b") == sorted([
        (7, date(2024, 6, 1), " 5 ", ""), (7, date(2024, 6, 30), "9", None), (8, date(2024, 5, 31), "4", None),
        (8, date(2024, 7, 1), None, None)], key=repr)
    june = ops.daily_observations(notes, controls, {"a": (10,)}, date(2024, 6, 1), date(2024, 6, 30), keep=number)
    assert rows(june, "day") == [(date(2024, 6, 1),), (date(2024, 6, 30),)]
    visits = spark.createDataFrame([(7, date(2024, 6, 15)), (7, date(2024, 6, 30)), (8, date(2024, 5, 1)), (9, date(2024, 6, 1))],
                                   "patientprofileid INT, day DATE")
    assert rows(ops.observations_asof(visits, daily.select("patientprofileid", "day", "a")), "patientprofileid", "day", "a") == sorted([
        (7, date(2024, 6, 15), " 5 "), (7, date(2024, 6, 30), "9"), (8, date(2024, 5, 1), None), (9, date(2024, 6, 1), None)], key=repr)
    exact = ops.observations_exact(visits, daily.select("patientprofileid", "day", "a"))
    assert rows(exact, "a") == rows(spark.createDataFrame([("9",), (None,), (None,), (None,)], "a STRING"))


def test_observe_answers_all_lookups_of_a_visit(spark):
    notes, controls = notes_and_controls(spark)
    visits = spark.createDataFrame([(7, date(2024, 6, 1)), (8, date(2024, 7, 1)), (9, date(2024, 6, 1))], "patientprofileid INT, day DATE")
    number = lambda v: x.try_int(v).isNotNull()
    got = ops.observe(visits, notes, controls, {
        "today": ops.on_day(10, keep=number), "so_far": ops.up_to_day(10), "month": ops.in_window(10, start=date(2024, 6, 2)),
        "since": ops.up_to_day(10, since=date(2024, 6, 1))}, date(2024, 7, 15))
    assert rows(got, "patientprofileid", "today", "so_far", "month", "since", "month_day") == [
        (7, " 5 ", "...", "9", "...", date(2024, 6, 30)), (8, None, "3.5", "3.5", "3.5", date(2024, 7, 1)), (9, None, None, None, None, None)]


def test_latest_observations_prefers_the_greater_number(spark):
    notes, controls = notes_and_controls(spark)
    extra = spark.createDataFrame([(3, 10, "10")], controls.schema)
    got = ops.latest_observations(notes, controls.union(extra), {"a": (10,)}, date(2024, 6, 1), date(2024, 6, 30), prefer={"a": x.try_int})
    assert rows(got) == [(7, "10", date(2024, 6, 30))]


def test_milestones_and_durations(spark):
    t = lambda h, m, s=0: datetime(2024, 1, 1, h, m, s)
    events = spark.createDataFrame([
        (1, 5, "Arrived", "Y", t(9, 0)), (2, 5, "ARRIVED", "Y", t(10, 0, 59)), (3, 5, "Registered", "Y", t(10, 1)),
        (4, 5, "Admitted", "N", t(11, 0)), (5, 6, "Registered", "Y", t(9, 30)), (6, 6, "Arrived", "Y", t(9, 45))],
        "id INT, b INT, kind STRING, active STRING, ts TIMESTAMP_NTZ")
    marks = ops.milestones(events, "b", "kind", "ts", "id", {"arr": "Arrived", "reg": "Registered", "adm": "Admitted"}, x.ci("active") == "y")
    got = ops.stage_durations(marks, {"wait": ("arr", "reg"), "room": ("reg", "adm")})
    assert rows(got, "b", "wait", "room") == [(5, 1, -1), (6, 15, -1)]


def brute_next(left, right):
    out = []
    for (i, k, d, m) in left:
        later = [(b, d2, m2, j) for (j, k2, d2, m2, b) in right if k2 == k and b >= d and (d2 > d or (d2 == d and m2 > m))]
        out.append((i, min(later)[3] if later else None))
    return sorted(out, key=repr)


def test_next_booking(spark):
    d = lambda n: date(2024, 6, n)
    left = [(1, 7, d(5), 600), (2, 7, d(5), 900), (3, 7, d(9), 600), (4, 8, d(5), 600), (5, 9, d(5), 600)]
    right = [(11, 7, d(5), 700, d(5)), (12, 7, d(5), 500, d(5)), (13, 7, d(6), 600, d(4)), (14, 7, d(8), 600, d(6)),
             (15, 7, d(20), 600, d(5)), (16, 8, d(5), 600, d(5)), (17, 8, d(4), 900, d(6))]
    lf = spark.createDataFrame(left, "id INT, k INT, d DATE, m INT")
    rf = spark.createDataFrame(right, "found INT, k INT, d DATE, m INT, made DATE").withColumn("day2", F.col("d"))
    got = ops.next_booking(lf, rf, ["k"], day="d", minute="m", order=("made", "day2", "m"), payload=("found",), booked_day="made")
    assert rows(got, "id", "next_found") == brute_next(left, right)


def test_asof_value(spark):
    ts = lambda n, h=0: datetime(2024, 1, n, h)
    left = spark.createDataFrame([(1, ts(5)), (1, ts(10)), (1, ts(1)), (2, ts(5))], "k INT, at TIMESTAMP_NTZ")
    right = spark.createDataFrame([(1, ts(5, 9), "a"), (1, ts(5, 10), "b"), (1, ts(5, 10), "c"), (1, ts(7), "d"), (2, ts(6), "e")],
                                  "k INT, seen TIMESTAMP_NTZ, v STRING")
    got = ops.asof_value(left, right, ["k"], "at", "seen", ["v"], ["v"])
    assert rows(got, "k", "at", "v") == sorted([(1, ts(5), "c"), (1, ts(10), "d"), (1, ts(1), None), (2, ts(5), None)], key=repr)
    strict = ops.asof_value(left, right, ["k"], "at", "seen", ["v"], ["v"], allow_equal=False)
    assert rows(strict.where("v IS NOT NULL"), "at", "v") == [(ts(10), "d")]


def test_bracket_lookup_clamps(spark):
    matrix = spark.createDataFrame([(1, 9, s, float(lo), float(lo + 99), f"L{s}-{lo}") for s in (1, 2) for lo in (0, 100)]
                                   + [(2, 8, 1, 0.0, 99.0, "other")],
                                   "fee_matrix_id INT, company_id INT, family_size INT, income_from DOUBLE, income_to DOUBLE, poverty_status STRING")
    people = spark.createDataFrame([(1, 9, 5, 50.0), (2, 9, None, None), (3, 9, 1, 9999.0), (4, 9, 2, 100.0), (5, 9, 2, 99.0),
                                    (6, 8, 3, 10.0), (7, 7, 1, 1.0)], "patient_id INT, company_id INT, family_size INT, income DOUBLE")
    assert rows(ops.bracket_lookup(people, matrix), "patient_id", "poverty_status") == [
        (1, "L2-0"), (2, "L1-0"), (3, "L1-100"), (4, "L2-100"), (5, "L2-0"), (6, "other")]


def test_follow_up_keeps_all_pairs_and_counts_negative_gaps(spark):
    left = spark.createDataFrame([(1, date(2024, 1, 10)), (2, date(2024, 1, 10))], "k INT, a DATE")
    right = spark.createDataFrame([(1, date(2024, 1, 5)), (1, date(2024, 2, 7)), (1, date(2024, 2, 8))], "k INT, b DATE")
    got = ops.follow_up_within(left, right, "k", "a", "b", 28, "ok")
    assert rows(got, "k", "b", "ok") == sorted([(1, date(2024, 1, 5), "Y"), (1, date(2024, 2, 7), "Y"), (1, date(2024, 2, 8), "N"),
                                                (2, None, "N")], key=repr)


def test_lab_join_flavours(spark):
    req = spark.createDataFrame([(1, 0, 7), (1, 5, 7)], "lab_result_req_id INT, lab_hist_req_id INT, patientprofileid INT")
    sets = spark.createDataFrame([(2, 0, 1), (2, 5, 1)], "lab_result_set_id INT, lab_hist_req_id INT, lab_result_req_id INT")
    items = spark.createDataFrame([(3, 0, 2), (3, 5, 2)], "lab_result_item_id INT, lab_hist_req_id INT, lab_result_set_id INT")
    values = spark.createDataFrame([(3, 0, "a"), (3, 5, "b")], "lab_result_item_id INT, lab_hist_req_id INT, result_value STRING")
    count = lambda hist: ops.lab_results(req, sets, items, values, hist=hist).count()
    assert (count("match"), count("zero"), count("ignore")) == (2, 2, 16)
    with pytest.raises(ValueError):
        count("other")


def test_responses_and_report(spark):
    resp = spark.createDataFrame([(1, "Q A", "x"), (1, "q a", "y"), (1, "Q B", "z"), (2, "Q C", "w")], "id INT, q STRING, t STRING")
    got = ops.responses_wide(resp, "id", "q", "t", {"a": "Q A", "b": "Q B"})
    assert rows(got) == [(1, "y", "z")]
    shown = ops.report(got, {"The <b>": "b", "A's": F.upper("a")}, ["A's"])
    assert shown.columns == ["The <b>", "A's"] and rows(shown) == [("z", "Y")]
