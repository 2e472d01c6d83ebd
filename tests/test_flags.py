"""Both settings of the switches that change what a report says, each against its own SQL."""
from dataclasses import replace

import duckdb
import pytest

from care_measures import measures
from care_measures.sources import driver_tables
from oracles import measures as measure_sql
from tests.test_queries import TABLES, canonical

SF = "/root/testdata/sf0.01"
CERVICAL, SIGN_OFF = "m03_cervical_cancer", "m19_document_sign_off"


def expected(statement):
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cursor = con.execute(statement)
    return canonical([c[0] for c in cursor.description], cursor.fetchall())


def without_hysterectomy(statement):
    """The charges that let a patient in, read for the code itself, keep her out."""
    rule = statement[statement.rindex("WHERE v.pid IN ("):]
    return statement + rule.replace("WHERE v.pid IN (", "\nAND v.pid NOT IN (", 1).replace("<> 'Z90.710'", "= 'Z90.710'")


def to_the_signature(statement):
    head, tail = statement.rsplit("FROM document o JOIN", 1)
    return head.replace("CAST(o.doc_date AS DATE)", "CAST(o.update_datetime AS DATE)") + "FROM document o JOIN" + tail


@pytest.mark.parametrize("exclude", [False, True])
def test_hysterectomy_switch(spark, exclude):
    src = driver_tables.source(spark, SF, replace(driver_tables.CONFIG, exclude_hysterectomy=exclude))
    df = measures()[CERVICAL](src, driver_tables.AS_OF)
    statement = measure_sql.statements()[CERVICAL]
    wanted = expected(without_hysterectomy(statement) if exclude else statement)
    assert canonical(df.columns, df.collect()) == wanted and wanted


@pytest.mark.parametrize("against", ["doc_date", "update_datetime"])
def test_sign_off_days_run_to_either_date(spark, against):
    df = measures()[SIGN_OFF](driver_tables.source(spark, SF), driver_tables.AS_OF, against=against)
    statement = measure_sql.statements()[SIGN_OFF]
    wanted = expected(to_the_signature(statement) if against == "update_datetime" else statement)
    assert canonical(df.columns, df.collect()) == wanted and wanted


def test_the_switches_change_rows():
    for name, other in ((CERVICAL, without_hysterectomy), (SIGN_OFF, to_the_signature)):
        statement = measure_sql.statements()[name]
        assert expected(statement) != expected(other(statement)), name
