from datetime import date, datetime, timedelta

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from care_measures.functions import expressions as x
from care_measures.functions.valuesets import ValueSet


def column(spark, values, type_, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, v {type_}")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def weekdays(a, b):
    """Weekdays in (a, b], counted one by one, negative when b is earlier."""
    if a is None or b is None:
        return None
    lo, hi, sign = (a, b, 1) if a <= b else (b, a, -1)
    return sign * sum((lo + timedelta(n + 1)).weekday() < 5 for n in range((hi - lo).days))


def test_business_days_edges(spark):
    pairs = [(date(2024, 5, 3), date(2024, 5, 3)), (date(2024, 5, 3), date(2024, 5, 6)), (date(2024, 5, 4), date(2024, 5, 5)),
             (date(2024, 5, 8), date(2024, 5, 1)), (date(2024, 5, 1), None), (date(1969, 12, 30), date(1970, 1, 5))]
    df = spark.createDataFrame(pairs, "a DATE, b DATE")
    assert [r[0] for r in df.select(x.business_day_diff("a", "b")).collect()] == [weekdays(a, b) for a, b in pairs]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.dates(date(1950, 1, 1), date(2050, 1, 1)), st.integers(-40, 400)), min_size=20, max_size=40))
def test_business_days_equal_counting(spark, rows):
    pairs = [(a, a + timedelta(n)) for a, n in rows]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i INT, a DATE, b DATE").orderBy("i")
    assert [r[0] for r in df.select(x.business_day_diff("a", "b")).collect()] == [weekdays(a, b) for a, b in pairs]


def test_business_days_holidays(spark):
    df = spark.createDataFrame([(date(2024, 12, 23), date(2024, 12, 27)), (date(2024, 12, 27), date(2024, 12, 23))], "a DATE, b DATE")
    days = [r[0] for r in df.select(x.business_day_diff("a", "b", [date(2024, 12, 25), date(2024, 12, 28)])).collect()]
    assert days == [3, -3]


def test_minute_diff_counts_boundaries(spark):
    rows = [(datetime(2024, 1, 1, 10, 0, 59), datetime(2024, 1, 1, 10, 1, 0)),
            (datetime(2024, 1, 1, 10, 0, 0), datetime(2024, 1, 1, 10, 0, 59)),
            (datetime(2024, 1, 1, 23, 59, 0), datetime(2024, 1, 2, 0, 1, 0)), (datetime(2024, 1, 1), None)]
    df = spark.createDataFrame(rows, "a TIMESTAMP_NTZ, b TIMESTAMP_NTZ")
    assert [r[0] for r in df.select(x.minute_diff("a", "b")).collect()] == [1, 0, 2, None]


def test_numbers_and_placeholders(spark):
    values = ["", ".", "..", "...", " 5 ", "3.5", "5%", None, "12", "-4"]
    assert column(spark, values, "STRING", x.try_int("v")) == [None, None, None, None, 5, None, None, None, 12, -4]
    assert column(spark, values, "STRING", x.clean_value("v")) == [None, None, None, None, "5", "3.5", "5%", None, "12", "-4"]
    assert column(spark, values, "STRING", x.clean_value("v", "int")) == [None] * 4 + [5, None, None, None, 12, -4]
    assert column(spark, ["12 points", "7%", "x", "3.5"], "STRING", x.leading_score("v")) == ["12", "7", "x", "3"]


def test_like_is_case_insensitive_with_wildcards(spark):
    values = ["Nurse Visit", "RESULT_1", "RESULTA1", "result1", None, "a.b"]
    assert column(spark, values, "STRING", x.like("v", "%nurse%"))[:2] == [True, False]
    assert column(spark, values, "STRING", x.like("v", "RESULT_1")) == [False, True, True, False, None, False]
    assert column(spark, values, "STRING", x.like_any("v", ("RESULT_1", "nur%", "A.B"))) == [True, True, True, False, None, True]
    assert column(spark, ["axb", "a.b"], "STRING", x.like_any("v", ("a.%", "zz%"))) == [False, True]
    kept = column(spark, values, "STRING", F.coalesce(x.not_like_all("v", ("%nurse%", "a%")), F.lit(False)))
    assert kept == [False, True, True, True, False, False]


def test_value_set(spark):
    codes = ["Z37", "Z37.0", "e11.9", "D0120 ", "d0120", "E1", None]
    vset = ValueSet(exact=("D0120",), patterns=("E11%",), ranges=(("Z30", "Z37"),))
    assert column(spark, codes, "STRING", vset.matches("v")) == [True, False, True, True, True, False, None]
    df = spark.createDataFrame([(c,) for c in codes], "v STRING")
    table = spark.createDataFrame([("z37.0",), ("z37.0",), ("E1 ",)], "code STRING")
    marked = ValueSet(exact=("D0120",), table=table).mark(df, "v", "hit")
    assert {(r.v, r.hit) for r in marked.collect()} == {("Z37", False), ("Z37.0", True), ("e11.9", False), ("D0120 ", True),
                                                        ("d0120", True), ("E1", True), (None, False)}
    assert marked.count() == len(codes)


def test_ages_and_bands(spark):
    as_of = date(2024, 3, 1)
    births = [date(2024, 3, 1), date(2019, 3, 1), date(2006, 3, 2), None]
    assert column(spark, births, "DATE", x.age_years("v", as_of)) == [0, 5, 17, None]
    assert column(spark, [0, 5, 6, 13, 14, 21, 22, -1, None], "INT", x.age_band("v", "NA")) == [
        "A. 0 to 5", "A. 0 to 5", "B. 6 to 13", "B. 6 to 13", "C. 14 to 21", "C. 14 to 21", "D. 22 and Up", "NA", "NA"]


def test_age_before_birth_is_cut_toward_zero(spark):
    assert column(spark, [date(2024, 7, 20), date(2025, 7, 10), date(2026, 9, 1)], "DATE", x.age_years("v", date(2024, 7, 15))) == [0, 0, -2]


def test_blood_pressure_rules(spark):
    rows = [(50, True, "139", "89", None, None, True, True), (50, True, "140", "80", None, None, False, False),
            (65, True, "149", "89", "", "", True, True), (65, False, "149", "89", None, None, False, False),
            (65, False, "149", "89", "139", "85", False, True), (50, True, "120", "80", "150", "95", True, False),
            (50, True, "120", "80", "130", None, True, False), (50, True, None, None, "0", "0", False, False)]
    df = spark.createDataFrame(rows, "age INT, well BOOLEAN, s1 STRING, d1 STRING, s2 STRING, d2 STRING, one BOOLEAN, two BOOLEAN")
    c = F.col
    df = df.withColumn("first_ok", x.bp_first_controlled(c("age"), c("well"), c("s1"), c("d1")))
    df = df.withColumn("final_ok", x.bp_final_controlled(c("age"), c("well"), c("first_ok"), c("s2"), c("d2")))
    assert all(r.first_ok == r.one and r.final_ok == r.two for r in df.collect())


def test_newer_of_and_labels(spark):
    rows = [(date(2024, 1, 2), "a", date(2024, 1, 2), "b"), (date(2024, 1, 1), "a", date(2024, 1, 2), "b"),
            (None, None, date(2024, 1, 2), "b"), (date(2024, 1, 1), "a", None, None), (None, None, None, None)]
    df = spark.createDataFrame(rows, "ad DATE, a STRING, bd DATE, b STRING")
    got = [r[0] for r in df.select(x.newer_of(F.col("ad"), F.col("a"), F.col("bd"), F.col("b"))).collect()]
    assert got == ["a", "b", "b", "a", None]
    assert column(spark, ["central", "NORTH", None], "STRING", x.label_map("v", {"CENTRAL": "CENT"})) == ["CENT", "NORTH", ""]


def test_status_labels(spark):
    rows = [("CANCELLED", 7, None), ("cancelled", 5, 2), ("cancelled", 5, None), ("cancelled", None, 3),
            ("cancelled", None, None), ("Appt Kept", None, None), ("left", None, None)]
    df = spark.createDataFrame(rows, "s STRING, b INT, d INT")
    assert [r[0] for r in df.select(x.classify_status("s", "b", "d", 7)).collect()] == [
        "Cancelled by Patient", "Cancelled by Patient", "Cancelled by Doctor", "Cancelled by Doctor", "cancelled", "Appt Kept", "left"]


def test_within_includes_the_last_days_hours(spark):
    ts = [datetime(2024, 6, 30, 23, 59), datetime(2024, 7, 1), datetime(2024, 6, 1), datetime(2024, 5, 31, 23, 59), None]
    assert column(spark, ts, "TIMESTAMP_NTZ", x.within("v", date(2024, 6, 1), date(2024, 6, 30))) == [True, False, True, False, None]
