"""Hot keys and plans: one key holds a third of the rows and no operator may funnel it."""

import re
from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from care_measures import Source, measures, operators as ops
from care_measures.sources import driver_tables, views

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def hot(spark):
    """30,000 rows of which key 0 holds a third, spread over 60 days and 1440 minutes."""
    n = F.col("id")
    return spark.range(0, 30000, numPartitions=8).select(
        n, F.when(n % 3 == 0, 0).otherwise(n % 500).cast("int").alias("k"),
        F.date_add(F.lit(date(2024, 1, 1)), (n * 7 % 60).cast("int")).alias("d"), (n * 11 % 1440).cast("int").alias("m"))


def test_latest_per_key_limits_before_the_shuffle(hot):
    out = ops.latest_per_key(hot, ["k"], ["d"], ["id"])
    text = plan(out)
    before = text[text.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in before and ", Partial" in before
    assert out.count() == hot.select("k").distinct().count()


def test_next_booking_hot_key_matches_brute_force(hot, spark):
    left, right = hot.where("id % 10 = 1 OR k = 0"), hot.withColumn("made", F.date_sub("d", (F.col("id") % 9).cast("int")))
    got = ops.next_booking(left, right.withColumnRenamed("id", "found"), ["k"], day="d", minute="m", order=("made",),
                           payload=("found",), booked_day="made")
    a, b = left.where("id < 3000").alias("a"), right.alias("b")
    want = a.join(b, (F.col("a.k") == F.col("b.k")) & (F.col("b.made") >= F.col("a.d")) & (
        (F.col("b.d") > F.col("a.d")) | ((F.col("b.d") == F.col("a.d")) & (F.col("b.m") > F.col("a.m")))), "left").groupBy(
        F.col("a.id").alias("id")).agg(F.min(F.struct("b.made", F.col("b.id").alias("found")))["found"].alias("want"))
    both = got.join(want, "id")
    assert both.count() == want.count()
    assert both.where(~F.col("next_found").eqNullSafe(F.col("want"))).count() == 0


def test_temporal_windows_see_days_not_rows(hot):
    """The window under an as-of lookup gets at most one row per key and day from each side."""
    daily = hot.groupBy("k", "d").agg(F.max("id").alias("v"))
    out = ops.asof_value(hot, hot.withColumnRenamed("id", "v"), ["k"], "d", "d", ["v"], ["v"])
    assert out.count() == hot.count()
    assert out.join(daily.withColumnRenamed("v", "w"), ["k", "d"]).where("v <> w").count() == 0
    text = plan(out)
    window = text[text.index("Window ["):]
    assert "Aggregate" in window and "Union" in window


@pytest.fixture(scope="module")
def plans(spark):
    src = driver_tables.source(spark, SF)
    return {name: plan(fn(src, driver_tables.AS_OF)) for name, fn in measures().items()}


def test_no_measure_uses_nested_loops_or_python(plans):
    for name, text in plans.items():
        assert not re.search(r"NestedLoopJoin|CartesianProduct|Python|ArrowEval", text), name


def test_date_range_and_columns_reach_the_scan(spark, tmp_path):
    """On stored clinical tables the period filters the scan and only needed columns are read."""
    src = driver_tables.source(spark, SF)
    src.table("patient_note").write.parquet(f"{tmp_path}/patient_note")
    stored = Source.parquet(spark, str(tmp_path), driver_tables.CONFIG)
    text = plan(views.notes_between(stored, date(1998, 6, 1), date(1998, 6, 30)).select("patientprofileid"))
    pushed = text[text.index("PushedFilters"):]
    assert "GreaterThanOrEqual(note_datetime,1998-06-01T00:00)" in pushed and "LessThan(note_date" in pushed
    assert "ReadSchema: struct<patientprofileid:bigint,note_datetime:timestamp_ntz>" in text


def test_after_hours_any_drops_the_matching_notes(spark):
    src = driver_tables.source(spark, SF, replace(driver_tables.CONFIG, after_hours="any"))
    n = src.table("patient_note")
    names = views.providers(src).select("doctorid", "provider_name")
    late = n.join(names, "doctorid").where("""
        (provider_name = 'Last1, First1' AND dayofweek(note_datetime) IN (3, 5) AND hour(note_datetime) > 17 AND minute(note_datetime) >= 30)
        OR (provider_name = 'Last2, First2' AND dayofweek(note_datetime) BETWEEN 2 AND 6 AND hour(note_datetime) > 18)""")
    assert late.count() > 0
    assert views.in_hours(src, n, "note_datetime").count() == n.count() - late.count()
    assert views.in_hours(driver_tables.source(spark, SF), n, "note_datetime").count() == n.count()


def test_measures_read_stored_tables(spark, tmp_path):
    """A measure on one Parquet folder per table equals the same measure on the projection."""
    src = driver_tables.source(spark, SF)
    for name in ("patientappt", "view_patient", "active_phys", "department", "visit_type", "appt_tracking"):
        src.table(name).write.parquet(f"{tmp_path}/{name}")
    stored = Source.parquet(spark, str(tmp_path), driver_tables.CONFIG)
    fn = measures()["m10_cycle_time"]
    want, got = (sorted(map(repr, fn(s, driver_tables.AS_OF).collect())) for s in (src, stored))
    assert want == got and len(want) > 0
