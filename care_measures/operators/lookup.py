"""Temporal, range and follow-up lookups between two tables of the same key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.expressions import day
from ..functions.search import count_up_to


def running_last(left: DataFrame, daily: DataFrame, keys: Sequence[str], left_day: str,
                 right_day: str, names: Sequence[str]) -> DataFrame:
    """``left`` with the newest non-NULL ``names`` of ``daily`` on or before its day.

    ``daily`` holds one row per key and day. The left side is reduced to its distinct
    (key, day) pairs, both are stacked and a running last value is taken, so the window of
    a key is bounded by the calendar however many rows the key has, and no pairs of rows
    are formed.
    """
    facts = daily.select(*keys, F.col(right_day).alias("_day"), F.lit(False).alias("_probe"), *names)
    probes = left.select(*keys, F.col(left_day).alias("_day")).distinct().select(
        *keys, "_day", F.lit(True).alias("_probe"),
        *[F.lit(None).cast(daily.schema[n].dataType).alias(n) for n in names])
    w = Window.partitionBy(*keys).orderBy("_day").rangeBetween(Window.unboundedPreceding, 0)
    found = (facts.unionByName(probes)
             .select(*keys, "_day", "_probe", *[F.last(n, True).over(w).alias(n) for n in names])
             .where("_probe").drop("_probe")
             .withColumnsRenamed({k: f"_{k}" for k in keys}))
    on = [F.col(k) == F.col(f"_{k}") for k in keys] + [F.col(left_day) == F.col("_day")]
    return left.join(found, on, "left").drop("_day", *[f"_{k}" for k in keys])


def asof_value(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str,
               values: Sequence[str], tiebreak: Sequence[str] = (),
               allow_equal: bool = True) -> DataFrame:
    """``left`` with ``values`` of the newest right row whose day is at or before its own.

    Days are compared; within a day the newest timestamp wins, then ``tiebreak``. With
    ``allow_equal=False`` the right row must lie on an earlier day.
    """
    best = F.max(F.struct(F.col(right_ts), *tiebreak, F.struct(*values).alias("_v")))
    at = day(right_ts) if allow_equal else F.date_add(day(right_ts), 1)
    daily = right.groupBy(*keys, at.alias("_at")).agg(best["_v"].alias("_v"))
    out = running_last(left.withColumn("_left_day", day(left_ts)), daily, keys, "_left_day", "_at",
                       ["_v"])
    return out.select(*left.columns, *[F.col("_v")[v].alias(v) for v in values])


def bracket_lookup(patients: DataFrame, matrix: DataFrame) -> DataFrame:
    """``patients`` with the poverty status for their family size and income.

    ``patients`` has company_id, family_size and income. ``matrix``: fee_matrix_id,
    company_id, family_size, income_from, income_to, poverty_status. Sizes above a matrix's
    largest use the largest; incomes above the top bracket of a size use the top bracket;
    missing size counts as 1 and missing income as 0. Patients without a bracket drop out;
    a company with several matrices gives a row for each. Of brackets that share the income the greatest status counts.

    A matrix's brackets of a size are one row with a sorted array. A patient meets the
    matrices of the company, is clamped to each one's own largest size, takes that size's
    brackets by equality and finds the income by binary search: the brackets that start at or
    below it, less those that end before it. A size of a million or thousands of brackets
    cost no more than others, and no row is made that is not in the result.
    """
    sizes = matrix.groupBy("fee_matrix_id", "company_id", "family_size").agg(
        F.sort_array(F.collect_list(F.struct("income_from", "income_to", "poverty_status"))).alias("_brackets"),
        F.max("income_to").alias("_top"))
    matrices = sizes.groupBy(F.col("company_id").alias("_company"), F.col("fee_matrix_id").alias("_matrix")).agg(
        F.max("family_size").alias("_largest"))
    p = patients.join(matrices, F.col("company_id") == F.col("_company"))
    p = p.withColumns({"_size": F.least(F.coalesce("family_size", F.lit(1)), "_largest"), "_income": F.coalesce("income", F.lit(0))})
    sizes = sizes.select(F.col("company_id").alias("_of"), F.col("fee_matrix_id").alias("_id"), F.col("family_size").alias("_for"), "_brackets",
                         F.col("_brackets.income_from").alias("_starts"), "_top")
    p = p.join(sizes, (F.col("_company") == F.col("_of")) & (F.col("_matrix") == F.col("_id")) & (F.col("_size") == F.col("_for")))
    begun = F.slice("_brackets", F.lit(1), F.greatest(F.lit(0), count_up_to(F.col("_starts"), F.col("_income"))))
    reached = F.least("_top", "_income")
    met = F.filter(begun, lambda b: b["income_to"] >= reached)
    status = F.array_max(F.transform(met, lambda b: b["poverty_status"]))
    return p.select(*[F.col(c) for c in patients.columns], status.alias("poverty_status"), F.size(met).alias("_n")).where("_n > 0").drop("_n")


def follow_up_within(left: DataFrame, right: DataFrame, key: str, left_day: str, right_day: str,
                     days: int, flag: str) -> DataFrame:
    """Left join on ``key`` keeping every pair, with a Y/N flag for a gap of at most ``days``.

    Both sides should be distinct by key and day, which bounds the pairs of a key by the
    calendar. A follow-up before the left day has a negative gap and counts as within.
    """
    r = right.select(F.col(key).alias("_key"), right_day)
    out = left.join(r, F.col(key) == F.col("_key"), "left").drop("_key")
    return out.withColumn(flag, F.when(F.datediff(right_day, left_day) <= days, "Y").otherwise("N"))
