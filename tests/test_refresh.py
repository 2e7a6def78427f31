"""End-to-end refresh jobs: published tables equal the individual queries."""

from compare import compare

from ledgerline.plans import refresh
from ledgerline.registry import TEST_HOURS, TEST_PARAMS, Ctx
from ledgerline.schemas import DETAILS_TARGET, SUMMARY_TARGETS
from ledgerline.sources.sinks import read_published

SF = "/root/testdata/sf0.001"


def test_refresh_turnaround_publishes_four_tables(spark, tmp_path):
    import __spark_entry__ as entry

    c = Ctx(spark, SF)
    src = {n: c.src[n] for n in ("ca", "date_dim", "dealer", "app", "wf_history", "ca_status")}
    out = refresh.refresh_turnaround(spark, src, TEST_PARAMS, TEST_HOURS, str(tmp_path))
    assert set(out) == {"details", "analyst", "month", "analyst_month"}
    q = entry.queries()
    pairs = {
        "details": "sending_details",
        "analyst": "stats_per_analyst",
        "month": "stats_per_month",
        "analyst_month": "stats_per_analyst_month",
    }
    for table, key in pairs.items():
        got = read_published(spark, f"{tmp_path}/{refresh.TURNAROUND_TABLES[table]}")
        ok, msg = compare(got.toPandas(), q[key](spark, SF).toPandas())
        assert ok, (table, msg)
    for table, target in {"details": DETAILS_TARGET, **SUMMARY_TARGETS}.items():
        got = read_published(spark, f"{tmp_path}/{refresh.TURNAROUND_TABLES[table]}")
        assert [(f.name, f.dataType) for f in got.schema] == list(target), table


def test_month_totals_equal_analyst_month_totals(spark):
    import __spark_entry__ as entry

    q = entry.queries()
    m = q["stats_per_month"](spark, SF).groupBy("seq").sum("count_of_ac").collect()
    am = q["stats_per_analyst_month"](spark, SF).groupBy("seq").sum("count_of_ac").collect()
    assert sorted(map(tuple, m)) == sorted(map(tuple, am))


def test_snapshot_row_count_equals_scoped_contracts(spark):
    import __spark_entry__ as entry

    from pyspark.sql import functions as F

    snap = entry.queries()["wide_contract_snapshot"](spark, SF)
    assert len(snap.columns) == 102
    c = Ctx(spark, SF)
    scoped = c.src["ca"].filter(F.col("sub_date_key") > 0)
    # all scoped contracts have a status, dates and a dealer in the fixture
    assert snap.count() == scoped.count()


def test_cli_turnaround_over_table_sources(spark, tmp_path):
    import json

    from ledgerline import cli

    c = Ctx(spark, SF)
    mapping = {}
    for name in ("ca", "date_dim", "dealer", "app", "wf_history", "ca_status"):
        path = str(tmp_path / "src" / name)
        c.src[name].write.parquet(path)
        mapping[name] = f"parquet:{path}"
    (tmp_path / "map.json").write_text(json.dumps(mapping))
    out = str(tmp_path / "out")
    cli.main(["turnaround", "--sources", str(tmp_path / "map.json"), "--out", out, "--as-of", "2001-08-01",
              "--months", "24", "--calendar-from", "1995-01-01", "--calendar-to", "2002-12-31"])
    details = read_published(spark, f"{out}/{refresh.TURNAROUND_TABLES['details']}")
    assert details.count() > 0
    assert details.filter("type_1_time < timestamp_ntz'1999-08-01 00:00:00'").count() == 0


def test_repeated_scope_key_raises(spark, tmp_path):
    import pytest

    from ledgerline.operators.keys import DuplicateKeyError

    c = Ctx(spark, SF)
    src = {n: c.src[n] for n in ("ca", "date_dim", "dealer", "app", "wf_history", "ca_status")}
    src["ca"] = src["ca"].unionByName(src["ca"].limit(1))
    with pytest.raises(DuplicateKeyError):
        refresh.refresh_turnaround(spark, src, TEST_PARAMS, TEST_HOURS, str(tmp_path))


def test_blank_date_parity_option(spark):
    import datetime as dt

    from pyspark.sql import functions as F

    from ledgerline.plans.snapshot import contract_flags

    c = Ctx(spark, SF)
    flags = contract_flags(c.snapshot_sources(), TEST_PARAMS.as_of, blank_date=dt.date(1900, 1, 1))
    ca = c.src["ca"].select("id", "last_decisioned_ca_st_key")
    j = flags.join(ca, "id")
    not_app = j.filter(~F.coalesce(F.col("last_decisioned_ca_st_key").isin(4, 5), F.lit(False)))
    assert not_app.count() > 0
    assert not_app.filter(F.col("app_date") != F.lit(dt.date(1900, 1, 1))).count() == 0
    default = contract_flags(c.snapshot_sources(), TEST_PARAMS.as_of).join(ca, "id")
    assert default.filter(~F.coalesce(F.col("last_decisioned_ca_st_key").isin(4, 5), F.lit(False))
                          & F.col("app_date").isNotNull()).count() == 0


def test_turnaround_by_a_table_of_opening_intervals(spark, tmp_path):
    """Always open by the table: durations are wall-clock seconds, not those of the opening hours."""
    import datetime as dt

    from ledgerline.functions.caltime import calendar_from_intervals

    c = Ctx(spark, SF)
    src = {n: c.src[n] for n in ("ca", "date_dim", "dealer", "app", "wf_history", "ca_status")}
    table = spark.createDataFrame([(dt.datetime(1990, 1, 1), dt.datetime(2010, 1, 1))], "a timestamp_ntz, z timestamp_ntz")
    cal = calendar_from_intervals(table, "a", "z", TEST_HOURS)
    refresh.refresh_turnaround(spark, src, TEST_PARAMS, TEST_HOURS, str(tmp_path), calendar=cal)
    rows = read_published(spark, f"{tmp_path}/{refresh.TURNAROUND_TABLES['details']}").where("type_2_time is not null").collect()
    assert rows
    assert all(r["type_1_to_type_2_duration_in_seconds"] == int((r["type_2_time"] - r["type_1_time"]).total_seconds()) for r in rows)
