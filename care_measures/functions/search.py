"""Binary search in sorted arrays, as a column expression."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def count_up_to(values: Column, x: Column) -> Column:
    """How many elements of a sorted array without NULLs are at most ``x``; NULL where either is NULL.

    The array is halved as often as its length allows: for a million elements twenty comparisons a row. ``values`` should
    be a column or a literal, as it is looked at in every step.
    """
    n = F.size(values)
    steps = F.sequence(F.lit(1), F.greatest(F.lit(1), F.ceil(F.log2(n + F.lit(1))).cast("int")))

    def step(range_: Column, _: Column) -> Column:
        low, high = range_["low"], range_["high"]
        middle = ((low + high) / F.lit(2)).cast("int")
        here = F.when(low < high, F.get(values, middle) <= x)
        return F.struct(F.when(here, middle + F.lit(1)).otherwise(low).alias("low"),
                        F.when(low < high, F.when(here, high).otherwise(middle)).otherwise(high).alias("high"))

    found = F.aggregate(steps, F.struct(F.lit(0).alias("low"), n.alias("high")), step, lambda r: r["low"])
    return F.when(values.isNotNull() & x.isNotNull(), found)
