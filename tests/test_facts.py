"""Edge cases of the per-contract facts (FIXTURES.md part C)."""

import datetime as dt
from decimal import Decimal as D

from ledgerline.operators.keys import DuplicateKeyError, assert_unique, first_last_per_key, nth_per_key
from ledgerline.params import RunParams, add_months
from ledgerline.plans import digests, facts
from ledgerline.plans.snapshot import program_class, status_waterfall

TS = dt.datetime(2020, 5, 1, 12)
APP = "application_id long, ca_id long"
DEC = "applicationid long, subdate timestamp_ntz, decisiondate timestamp_ntz, decisiondescription string, analyst string, cdecision string, vin string"


def test_null_analyst_with_cpp_dropped_other_kept(spark):
    app = spark.createDataFrame([(1, 10)], APP)
    dec = spark.createDataFrame(
        [(1, TS, TS, "App", None, "CPP", "v"), (1, TS, TS + dt.timedelta(1), "D", None, "STD", "v"),
         (1, TS, TS + dt.timedelta(2), "App", "acp", "CPP", "v")], DEC)
    sub = spark.createDataFrame([(10,)], "id long")
    r = facts.first_last_decision(dec, app, sub).collect()[0]
    assert (r.first_decision_s, r.last_decision_s, r.first_de_user) == ("D", "D", "Unknown")


def test_two_non_primary_applicants_count_as_co_applicant(spark):
    f = spark.createDataFrame([(5, "Co", 0, None), (5, "Co", 1, None), (6, "Prim", 1, None)],
                              "application_no long, applicant_type string, is_comm int, tds_v decimal(18,2)")
    assert [r.application_no for r in facts.co_applicant_flag(f).collect()] == [5]
    got = {r.id: r.have_a_co_app for r in digests.funding_digest(f, ["is_comm"]).collect()}
    assert got == {5: 1, 6: 0}


def test_income_frequency_and_lowest_row(spark):
    app = spark.createDataFrame([(i, i) for i in range(1, 7)], APP)
    rows = [(1, 1, None, D(100)), (2, 1, "W", D(100)), (3, 1, "M", D(100)), (4, 1, "A", D(100)), (5, 1, "Q", D(100))]
    rows += [(6, 1, "W", D(100)), (6, 1, "W", None)]
    c = spark.createDataFrame(
        [(a, r, fr, inc, D(7), 0, 0) for a, r, fr, inc in rows],
        "applicationid long, relationtype int, ginomefre string, ginome decimal(18,2), antotal decimal(18,2), isdeleted int, returningcflag int",
    )
    got = {r.id: (r.sub_a_inome, r.ginome) for r in facts.annual_income_by_relation(app, c).collect()}
    assert {k: int(v[0]) for k, v in got.items() if k < 6} == {1: 1200, 2: 5200, 3: 1200, 4: 100, 5: 1200}
    assert got[6] == (None, None)  # the NULL income row is the lowest


def test_overdue_counts_midnights(spark):
    s = spark.createDataFrame([(1, None, 0)], "id long, d_60_day_payments int, d_over_60_day_payments int")
    as_of = dt.date(1998, 6, 1)
    d = spark.createDataFrame(
        [(1, as_of - dt.timedelta(30), None), (1, as_of - dt.timedelta(31), None)],
        "contract_number long, i_due_date date, i_paid_off date",
    )
    assert facts.overdue_30(s, d, as_of).collect()[0].overdue_instalments == 1


def test_program_label_case_insensitive_and_waterfall(spark):
    ca = spark.createDataFrame(
        [(1, 1, 1, 100, 5, 4), (2, 0, 2, 4, 5, 4), (3, 0, 3, 6, 0, None)],
        "id long, funing_port_key int, mk_program_detail_id int, ca_st_key int, sub_date_key int, last_decisioned_ca_st_key int",
    )
    prog = spark.createDataFrame([(1, " Alt "), (2, "ALT"), (3, "std")], "mk_program_detail_id int, mk_program_name string")
    got = {r.id: (r.fca_or_mas, r.std_or_alt) for r in program_class(ca, prog).collect()}
    assert got == {1: ("FCA", "Alt"), 2: ("Mas", "Alt"), 3: ("Mas", "Std")}
    wf = {r.id: r.ca_status for r in status_waterfall(ca).collect()}
    assert wf == {1: "Boo", 2: "App", 3: "Qu"}


def test_keys_helpers(spark):
    df = spark.createDataFrame([(1, 3, "x"), (1, 1, "y"), (2, 5, "z"), (1, 2, "w")], "k int, t int, p string")
    assert {r.k: r.p for r in nth_per_key(df, ["k"], ["t"], 2).collect()} == {1: "w"}
    fl = {r.k: (r.first_p, r.last_p) for r in first_last_per_key(df, ["k"], ["t"], ["p"]).collect()}
    assert fl == {1: ("y", "x"), 2: ("z", "z")}
    try:
        assert_unique(df, ["k"], "demo")
        raise AssertionError("expected DuplicateKeyError")
    except DuplicateKeyError as e:
        assert "demo" in str(e)


def test_trailing_months_clamps_month_end():
    assert add_months(dt.date(2024, 5, 31), -3) == dt.date(2024, 2, 29)
    p = RunParams.trailing_months(dt.date(2024, 5, 31))
    assert (p.start, p.end) == (dt.date(2024, 2, 29), dt.date(2024, 5, 31))


def test_sequence_per_key_equals_plain_row_number(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from ledgerline.operators.keys import sequence_per_key

    rows = [(k, TS + dt.timedelta(hours=h), b) for k in (1, 2) for h in (0, 5, 5, 30, 49, 49, 200) for b in ("x", None)]
    rows.append((3, None, "z"))
    df = spark.createDataFrame(rows, "k long, t timestamp_ntz, b string")
    plain = df.withColumn("s", F.row_number().over(Window.partitionBy("k").orderBy("t", "b")).cast("bigint"))
    got = sequence_per_key(df, ["k"], "t", ["b"], "s", bucket_seconds=3600 * 7)
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.select(*got.columns).collect()))
