"""Final projection of a measure."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def report(df: DataFrame, columns: Mapping[str, Column | str], sort: Sequence[str] = ()) -> DataFrame:
    """Display columns by label, in order, sorted by label.

    Where a patient can have many rows, end ``sort`` with a column that tells them apart:
    the range partitioning behind the sort cannot split rows that compare equal.
    """
    out = df.select(*[(F.col(c) if isinstance(c, str) else c).alias(label)
                      for label, c in columns.items()])
    return out.orderBy(*[F.col(f"`{s}`") for s in sort]) if sort else out
