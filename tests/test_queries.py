"""Every registered query against its SQL counterpart on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry_points

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
ORACLES = entry_points.oracle_sql()


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(r[i] for i in order)) for r in rows)


#: Queries of the library itself; those of an optional part are tested with that part.
NAMES = {*entry_points.measures(), *entry_points.QUERIES}


@pytest.mark.parametrize("name", sorted(NAMES))
def test_query_matches_sql(spark, name):
    df = entry_points.queries()[name](spark, SF)
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cursor = con.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert canonical(df.columns, df.collect()) == canonical(columns, cursor.fetchall())


def test_every_query_has_sql():
    assert NAMES <= set(ORACLES) <= set(entry_points.queries())


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns[0] == "Provider" and df.count() >= 0
