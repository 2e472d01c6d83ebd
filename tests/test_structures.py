"""Search structures, evidence masks, note versions, consent states and ordered reports."""
from __future__ import annotations

import bisect
import random
import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from care_measures import Source, measures, operators as ops
from care_measures.functions import expressions as x
from care_measures.functions.search import count_up_to
from care_measures.functions.valuesets import ValueSet
from care_measures.sources import driver_tables, sink, views

SF = "/root/testdata/sf0.001"
JUNE = (date(1998, 6, 1), date(1998, 6, 30))


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The clinical tables as files, as a site would have them."""
    root = str(tmp_path_factory.mktemp("clinical"))
    src = driver_tables.source(spark, SF)
    for name in driver_tables.TABLES:
        src.table(name).write.parquet(f"{root}/{name}")
    return Source.parquet(spark, root, driver_tables.CONFIG)


def charge_scans(df):
    """How often charges are read with their diagnoses or classes: in the tree that ran, subqueries included and reused
    exchanges left out."""
    assert df.collect()
    node = df._jdf.queryExecution().executedPlan()
    node = node.executedPlan() if "Adaptive" in node.getClass().getSimpleName() else node
    seen, found = set(), 0

    def walk(n):
        nonlocal found
        kind = n.getClass().getSimpleName()
        if kind in ("ReusedExchangeExec", "ReusedSubqueryExec") or n.id() in seen:
            return
        seen.add(n.id())
        if kind == "FileSourceScanExec" and re.search("diagnosis_id_1|financial_class_id_1", n.output().mkString(",")):
            found += 1
        for inner in ("plan", "executedPlan"):
            if (inner == "plan" and kind.endswith("QueryStageExec")) or (inner == "executedPlan" and "AdaptiveSparkPlan" in kind):
                walk(getattr(n, inner)())
        for part in (n.children(), n.subqueries()):
            for i in range(part.size()):
                walk(part.apply(i))

    walk(node)
    return found


def test_count_up_to_is_bisect(spark):
    rng = random.Random(4)
    lists = [sorted(rng.randrange(60) for _ in range(n)) for n in (0, 1, 2, 3, 4, 7, 8, 9, 33, 64)]
    data = [(i, v, p) for i, v in enumerate(lists) for p in range(-1, 62, 3)]
    df = spark.createDataFrame(data + [(99, None, 1), (98, [1], None)], "i INT, v ARRAY<INT>, p INT")
    got = rows(df.select("i", "p", count_up_to(F.col("v"), F.col("p")).alias("n")))
    assert got == sorted([(i, p, bisect.bisect_right(v, p)) for i, v, p in data] + [(99, 1, None), (98, None, None)], key=repr)


def test_ten_thousand_holidays(spark):
    days = [date.fromordinal(700000 + 3 * i) for i in range(10_000)]
    pairs = [(date.fromordinal(a), date.fromordinal(b)) for a, b in ((699_990, 730_010), (710_000, 709_000), (720_001, 720_001), (725_000, 725_009))]
    df = spark.createDataFrame(pairs + [(None, pairs[0][0])], "a DATE, b DATE")
    got = [r[0] for r in df.select(x.business_day_diff("a", "b", days)).collect()]
    off = set(days)

    def count(a, b):
        span = [date.fromordinal(n) for n in range(min(a, b).toordinal() + 1, max(a, b).toordinal() + 1)]
        n = sum(d.weekday() < 5 and d not in off for d in span)
        return n if a <= b else -n

    assert got == [count(a, b) for a, b in pairs] + [None]


def test_a_stored_code_list_equals_the_list_written_down(spark):
    codes = [("A50",), ("a50.1 ",), ("A5",), ("B",), ("N93",), ("N93.0",), ("N93.4",), ("n93.9",), ("N93.91",), ("N64.52",), ("N64.5",), ("N64.521",),
             ("Z37",), ("Z37.0",), (None,), ("",), ("O1",), ("O16",), ("XLIKEX",), ("\U0001F600",)]
    df = spark.createDataFrame(codes, "code STRING")
    rules = [("s", "Z37", None, None), ("s", "a50 ", None, "exact"), ("s", "N93.0", "N93.9", "range"), ("s", "N93.4", "N93.8", "range"),
             ("s", "O00", "O16", "range"), ("s", "B%", None, "pattern"), ("s", "n64.5_", None, "pattern"), ("s", "%like%", None, "pattern"), ("s", None, None, "range")]
    table = spark.createDataFrame(rules, "set_name STRING, code STRING, code_to STRING, kind STRING")
    written = ValueSet(exact=("Z37", "A50"), ranges=(("N93.0", "N93.9"), ("O00", "O16")), patterns=("B%", "N64.5_", "%LIKE%"))
    want = rows(written.mark(df, "code", "hit"))
    assert rows(ValueSet(table=table).mark(df, "code", "hit")) == want and sum(r[1] for r in want) == 10
    assert rows(ValueSet(table=table).filter(df, "code")) == sorted([r[:1] for r in want if r[1]], key=repr)
    assert not any(r[1] for r in rows(ValueSet(table=table.where("set_name = 'none'")).mark(df, "code", "hit")))


def test_the_planning_report_with_a_stored_and_a_written_list(spark):
    src = driver_tables.source(spark, SF)
    listed = ValueSet(exact=driver_tables._REPRODUCTIVE_HEALTH, ranges=(("N93.0", "N93.9"),), patterns=("N60.%", "N64.5_"))
    from care_measures.plans.family_planning import family_planning
    assert rows(family_planning(src, driver_tables.AS_OF)) == rows(family_planning(src, driver_tables.AS_OF, listed))


def test_slots_of_mostly_empty_rows_are_joined_once(spark):
    rng = random.Random(2)
    data = [(i, *[rng.choice([None] * 9 + [rng.randrange(40)]) for _ in range(4)]) for i in range(3000)] + [(7, 1, 1, 1, 1)] * 2
    facts = spark.createDataFrame(data, "f INT, a INT, b INT, c INT, d INT")
    codes = spark.createDataFrame([(i,) for i in range(0, 40, 3)] + [(None,), (3,)], "id INT")
    got = ops.slot_any_match(facts, ("a", "b", "c", "d"), codes, "id")
    assert rows(got) == sorted((r for r in data if any(s is not None and s % 3 == 0 for s in r[1:])), key=repr)
    assert len(re.findall(r"(?:Hash|Merge)Join", plan(got).split("== Initial Plan ==")[-1])) == 1


def test_bracket_of_a_family_of_a_million(spark):
    sizes = [(1, 9, 1_000_000, 0.0, 99.0, "huge"), (1, 9, 1, 0.0, 99.0, "one"), (2, 9, 2, 0.0, 49.0, "low"), (2, 9, 2, 50.0, 99.0, "high"), (2, 9, 2, 40.0, 60.0, "mid")]
    matrix = spark.createDataFrame(sizes, "fee_matrix_id INT, company_id INT, family_size INT, income_from DOUBLE, income_to DOUBLE, poverty_status STRING")
    people = spark.createDataFrame([(1, 9, 1, 45.0), (2, 9, 2_000_000, 45.0), (3, 9, 5, 70.0), (4, 9, 2, -1.0), (5, 9, 2, 500.0)], "patient_id INT, company_id INT, family_size INT, income DOUBLE")
    got = ops.bracket_lookup(people, matrix)
    assert rows(got, "patient_id", "poverty_status") == [(1, "one"), (2, "huge"), (2, "mid"), (3, "high"), (5, "high")]
    assert "Generate" not in plan(got) and "NestedLoop" not in plan(got)


def test_next_booking_sweeps_once(spark):
    day = lambda n: date(2024, 6, n)
    left = spark.createDataFrame([(1, 7, day(5), 600), (2, 7, None, 600), (3, 7, day(5), None)], "id INT, k INT, d DATE, m INT")
    right = spark.createDataFrame([(1, 7, day(6), 1, None), (2, 7, None, 1, day(6)), (3, 7, day(9), 1, day(4)), (4, 7, day(8), 1, day(5))],
                                  "found INT, k INT, d DATE, m INT, made DATE")
    got = ops.next_booking(left, right, ["k"], day="d", minute="m", order=("made",), payload=("found",), booked_day="made")
    assert rows(got, "id", "next_found") == [(1, 4), (2, None), (3, None)]
    text = plan(got)
    assert len(re.findall(r"[- ]Window \[", text)) == 1


def test_evidence_by_brute_force(spark):
    rng = random.Random(9)
    charges = [(rng.choice([None, 1, 2, 3, 4, 5]), rng.choice([None, 10, 11, 12]), *[rng.choice([None, 1, 2, 3, 4]) for _ in range(2)]) for _ in range(80)]
    facts = spark.createDataFrame(charges, "p INT, proc INT, s1 INT, s2 INT")
    dx = ops.code_mask(spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id INT, c STRING"), "id", [F.col("c") == "a", F.col("c") == "b"], "_d")
    px = ops.code_mask(spark.createDataFrame([(10, "x"), (11, "y")], "id INT, c STRING"), "id", [F.lit(False), F.lit(False), F.col("c") == "x"], "_p")
    both = F.coalesce("_d", F.lit(0)).bitwiseOR(F.coalesce("_p", F.lit(0)))
    members = spark.createDataFrame([(1,), (2,), (2,), (9,)], "m INT")

    def want(every, only, null):
        out = {}
        for p, proc, *slots in charges:
            if only and p not in (1, 2) and not (null and p is None):
                continue
            known = {s for s in slots if s in (1, 2, 3)}
            if known or every:
                out[p] = out.get(p, 0) | (1 in known) | 2 * (2 in known) | 4 * (proc == 10)
        return sorted(out.items(), key=repr)

    for every in (True, False):
        kw = dict(procedures=px, procedure="proc", every_fact=every)
        assert rows(ops.evidence(facts, "p", ("s1", "s2"), dx, "id", both, **kw)) == want(every, False, False)
        for null in (True, False):
            got = ops.evidence(facts, "p", ("s1", "s2"), dx, "id", both, members=members, member="m", keep_null=null, **kw)
            assert rows(got) == want(every, True, null)


def test_charges_are_read_once_for_all_evidence(spark, tmp_path):
    src = driver_tables.source(spark, "/root/testdata/sf0.01")
    src.table("charge_history").write.parquet(f"{tmp_path}/charge_history")
    charges = spark.read.parquet(f"{tmp_path}/charge_history")
    stored = Source(lambda name: charges if name == "charge_history" else src.table(name), src.config)
    for name, most in (("m04_chlamydia", 1), ("m28_family_planning", 2), ("m29_missed_opportunity", 1)):
        n = charge_scans(measures()[name](stored, driver_tables.AS_OF))
        assert 1 <= n <= most, (name, n)


def test_a_note_moved_to_another_month_leaves_the_first(spark):
    at = lambda m, d: datetime(2024, m, d, 9)
    notes = [(1, 5, at(6, 3), at(6, 3)), (1, 5, at(7, 3), at(6, 9)), (2, 5, at(6, 4), at(6, 4)), (2, 5, at(5, 4), at(6, 1)), (3, 5, at(6, 5), None), (3, 5, at(5, 5), at(5, 6)),
             (4, 5, at(6, 6), None), (4, 5, None, None), (5, 6, at(6, 7), at(6, 7)), (5, 5, at(6, 8), at(6, 6)), (6, 5, at(6, 1), at(6, 1)), (6, 5, None, at(6, 2))]
    df = spark.createDataFrame(notes, "id INT, patient INT, ts TIMESTAMP_NTZ, modified TIMESTAMP_NTZ")
    got = ops.latest_if_within(df, "id", "modified", "ts", date(2024, 6, 1), date(2024, 6, 30), ["patient"])
    assert rows(got, "id", "patient", "ts") == [(2, 5, at(6, 4)), (4, 5, at(6, 6)), (5, 6, at(6, 7))]
    five = spark.createDataFrame([(5,)], "m INT")
    got = ops.latest_if_within(df, "id", "modified", "ts", date(2024, 6, 1), date(2024, 6, 30), ["patient"], five.withColumnRenamed("m", "patient"), "patient")
    assert rows(got, "id") == [(2,), (4,)]


def test_the_history_of_notes_is_read_by_its_keys(stored):
    text = plan(views.latest_notes(stored, *JUNE))
    read = re.findall(r"ReadSchema: struct<([^>\n]*)>", text)
    history = [r for r in read if "template_id" not in r]
    keys = {"patient_note_id:bigint", "note_datetime:timestamp_ntz", "update_datetime:timestamp_ntz"}
    assert history and all(set(r.split(",")) <= keys for r in history)
    assert views.latest_notes(stored, *JUNE).count() < views.notes_between(stored, *JUNE).select("patient_note_id").distinct().count()


def test_lab_requests_are_cut_down_to_the_patients_seen(stored):
    for name in ("m03_cervical_cancer", "m04_chlamydia", "m08_colorectal_cancer", "m18_diabetic_a1c"):
        names = [n for n in measures() if n.startswith(name[:4])]
        text = plan(measures()[names[0]](stored, driver_tables.AS_OF))
        at = [m.start() for m in re.finditer(r"lab_req\]", text)]
        before = [text[:a].rfind("LeftSemi") for a in at]
        sets = text.find("lab_set]")
        assert at and all(0 <= b < a for a, b in zip(at, before)) and sets > 0, name


@pytest.fixture(scope="module")
def consents(stored):
    fields = (stored.config.telehealth_consent_field, stored.config.telephone_consent_field)
    notes, controls = stored.table("patient_note"), stored.table("patient_note_control")
    state = ops.extend_state(None, notes, controls, fields, None, date(1998, 3, 31))
    for start, end in ((date(1998, 4, 1), date(1998, 4, 30)), (date(1998, 5, 1), date(1998, 5, 31))):
        state = ops.extend_state(state, notes, controls, fields, start, end)
    return state


@pytest.mark.parametrize("name", ["m09_blood_pressure", "m08_colorectal_cancer", "m30_tobacco"])
def test_measures_with_a_consent_state(stored, consents, name):
    with_state = measures()[[n for n in measures() if n[:3] == name[:3]][0]]
    plain, told = with_state(stored, driver_tables.AS_OF), with_state(stored.with_consents(consents, date(1998, 5, 31)), driver_tables.AS_OF)
    assert rows(plain) == rows(told)
    assert any("Yes" in map(str, r) or "No" in map(str, r) for r in rows(plain))


def test_a_consent_state_bounds_the_notes_read(spark, stored, tmp_path, consents):
    consents.write.parquet(f"{tmp_path}/state")
    src = stored.with_consents(spark.read.parquet(f"{tmp_path}/state"), date(1998, 5, 31))
    name = [n for n in measures() if n.startswith("m08")][0]
    def unbounded(source):
        text = plan(measures()[name](source, driver_tables.AS_OF))
        return [p for p in re.findall(r"patient_note\][^\n]*PushedFilters: \[([^\]]*)\]", text) if "IsNotNull(patientprofileid)" in p and "GreaterThanOrEqual(note_datetime" not in p]
    assert unbounded(stored) and not unbounded(src)


def test_a_state_needs_a_day_to_go_on_from(stored, consents):
    notes, controls = stored.table("patient_note"), stored.table("patient_note_control")
    with pytest.raises(ValueError):
        ops.extend_state(consents, notes, controls, (1,), None, date(1998, 6, 30))


SORTED = {n: f for n, f in measures().items()}


def order_of(df):
    top = df._jdf.queryExecution().analyzed()
    if top.getClass().getSimpleName() != "Sort":
        return []
    return [top.order().apply(i).child().name() for i in range(top.order().size())]


def test_reports_come_in_order(spark):
    src, found = driver_tables.source(spark, SF), 0
    for name, measure in SORTED.items():
        df = measure(src, driver_tables.AS_OF)
        keys = order_of(df)
        if keys:
            found += 1
            got = [tuple(r[k] for k in keys) for r in df.collect()]
            assert got == sorted(got, key=lambda t: tuple((v is not None, v) for v in t)), name
    assert found >= 24


def test_a_month_is_written_in_order_and_replaced_alone(spark, tmp_path):
    root, keys = str(tmp_path / "report"), ["Provider", "Patient ID"]
    data = spark.range(0, 5000, 1, 6).select(F.concat(F.lit("P"), (F.col("id") * 7919 % 13).cast("string")).alias("Provider"),
                                             F.when(F.col("id") % 50 != 0, F.col("id") * 31 % 5000).alias("Patient ID"), "id")
    sink.write_month(data, root, date(2024, 5, 1), keys, files=4)
    sink.write_month(data.limit(10), root, date(2024, 6, 1), keys, files=4)
    sink.write_month(data.where("id < 2000"), root, date(2024, 6, 1), keys, files=3)
    for month, n, files in ((date(2024, 5, 1), 5000, 4), (date(2024, 6, 1), 2000, 3)):
        got = sink.read_month(spark, root, month)
        assert got.count() == n and got.select("file").distinct().count() == files
        assert sink.misplaced(spark, root, month, keys).isEmpty()
        ordered = [(r[0], r[1]) for r in got.orderBy("file", "place").select(*keys).collect()]
        assert ordered == sorted(ordered, key=lambda t: tuple((v is not None, v) for v in t))
    sink.write_month(data.where("false"), root, date(2024, 6, 1), keys)
    assert sink.read_month(spark, root, date(2024, 6, 1)).count() == 0 and sink.read_month(spark, root, date(2024, 5, 1)).count() == 5000
    data.orderBy(F.desc("id")).coalesce(2).write.parquet(f"{root}/month=2024-07")
    assert not sink.misplaced(spark, root, date(2024, 7, 1), keys).isEmpty()
