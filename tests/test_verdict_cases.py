"""Cases that the supplied tables do not hold: repeated keys, large sums, uncovered days, odd names."""

import dataclasses
import datetime as dt

import pytest

from ledgerline.functions.caltime import CalendarRangeError, assert_calendar_covers, int_div
from ledgerline.operators.keys import DuplicateKeyError
from ledgerline.params import BusinessHours
from ledgerline.plans import refresh
from ledgerline.plans import snapshot as snap
from ledgerline.registry import TEST_HOURS, TEST_PARAMS, Ctx
from ledgerline.schemas import SNAPSHOT_TARGET
from ledgerline.session import NoCheckpointDir, checkpoint_dir
from ledgerline.sources.ingest import ingested
from ledgerline.sources.sinks import read_published
from ledgerline.sources.tables import TableSources

SF = "/root/testdata/sf0.001"


def test_repeated_summary_rows_do_not_multiply_contracts(spark):
    s = Ctx(spark, SF).snapshot_sources()
    twice = dataclasses.replace(s, delinq_summary=s.delinq_summary.unionByName(s.delinq_summary))
    for table in (snap.contract_flags, snap.wide_contract_snapshot):
        assert table(twice, TEST_PARAMS.as_of).count() == table(s, TEST_PARAMS.as_of).count()
    one = {r["id"]: r["d_flag"] for r in snap.contract_flags(s, TEST_PARAMS.as_of).collect()}
    assert {r["id"]: r["d_flag"] for r in snap.contract_flags(twice, TEST_PARAMS.as_of).collect()} == one


@pytest.mark.parametrize("field", ["ca", "ca_status", "date_dim", "dealer", "ams", "mk_program", "app"])
def test_every_joined_key_must_be_unique(spark, tmp_path, field):
    s = Ctx(spark, SF).snapshot_sources()
    df = getattr(s, field)
    with pytest.raises(DuplicateKeyError):
        refresh.refresh_snapshot(spark, dataclasses.replace(s, **{field: df.unionByName(df)}), TEST_PARAMS, str(tmp_path))


def test_unread_sources_must_have_unique_keys(spark, tmp_path):
    s = Ctx(spark, SF).snapshot_sources()
    with pytest.raises(DuplicateKeyError):
        refresh.refresh_snapshot(spark, s, TEST_PARAMS, str(tmp_path), unread={"applicant": (s.ca.unionByName(s.ca), "id")})


def test_published_snapshot_has_the_target_types_and_blank_dates(spark, tmp_path):
    s = Ctx(spark, SF).snapshot_sources()
    path = refresh.refresh_snapshot(spark, s, TEST_PARAMS, str(tmp_path), blank_date=dt.date(1900, 1, 1))
    got = read_published(spark, path.rpartition("/v=")[0])
    assert [(f.name, f.dataType) for f in got.schema] == list(SNAPSHOT_TARGET)
    assert got.where("is_fun = 0 and fun_date <> date'1900-01-01'").count() == 0 < got.where("is_fun = 0").count()


@pytest.mark.parametrize(("num", "den"), [(123456789012345678, 1000), (9007199254740993, 1), (-7, 2), (7, -2), (5, 0), (None, 3)])
def test_integer_division_is_exact(spark, num, den):
    df = spark.createDataFrame([(num, den)], "n bigint, d bigint")
    want = None if num is None or not den else abs(num) // abs(den) * (1 if (num < 0) == (den < 0) else -1)
    assert df.select(int_div(df.n, df.d)).first()[0] == want


def test_events_outside_the_calendar_raise(spark, tmp_path):
    hours = BusinessHours(first_day=dt.date(2024, 1, 1), last_day=dt.date(2024, 12, 31))
    df = spark.createDataFrame([(dt.datetime(2024, 12, 30, 10), dt.datetime(2025, 1, 2, 10))], "a timestamp_ntz, b timestamp_ntz")
    assert_calendar_covers(df, ["a"], hours)
    assert_calendar_covers(df.limit(0), ["a", "b"], hours)
    with pytest.raises(CalendarRangeError):
        assert_calendar_covers(df, ["a", "b"], hours)
    c = Ctx(spark, SF)
    src = {n: c.src[n] for n in ("ca", "date_dim", "dealer", "app", "wf_history", "ca_status")}
    short = dataclasses.replace(TEST_HOURS, last_day=dt.date(1997, 1, 1))
    with pytest.raises(CalendarRangeError):
        refresh.refresh_turnaround(spark, src, TEST_PARAMS, short, str(tmp_path))


class _Session:
    """Stands for a session: what it was asked to set."""

    def __init__(self, conf, current):
        self.conf, self.sparkContext, self.current, self.set = conf, self, current, None

    def getCheckpointDir(self):  # noqa: N802
        return self.current

    def setCheckpointDir(self, path):  # noqa: N802
        self.set = path


def test_checkpoint_folder_is_the_sessions_own():
    mine = _Session({}, "hdfs://x/mine")
    assert checkpoint_dir(mine) == "hdfs://x/mine" and mine.set is None
    named = _Session({"spark.checkpoint.dir": "hdfs://x/named"}, None)
    assert checkpoint_dir(named) == "hdfs://x/named" == named.set
    with pytest.raises(NoCheckpointDir):
        checkpoint_dir(_Session({}, None))


def test_codes_are_normalised_and_odd_columns_renamed(spark, tmp_path):
    df = spark.createDataFrame([("prim ", "a"), ("PRIM", "b"), ("Co", "c"), (None, "d")], "applicant_type string, x string")
    assert [r[0] for r in ingested(df, "funding_data").collect()] == ["Prim", "Prim", "Co", None]
    dec = spark.createDataFrame([("ACP ", "cpp", "con app")], "analyst string, cdecision string, decisiondescription string")
    assert ingested(dec, "ino_decisions").collect()[0] == ("acp", "CPP", "Con App")
    odd = spark.createDataFrame([(1, "P", dt.date(2000, 1, 1))], "id bigint, `re program` string, `re program start date` date")
    assert ingested(odd, "res_adj").columns == ["id", "re_program", "re_program_start_date"]


def test_three_part_names_are_read(spark):
    spark.createDataFrame([(1, "prim")], "application_no bigint, applicant_type string").createOrReplaceTempView("three_part_rows")
    spark.sql("CREATE DATABASE IF NOT EXISTS ops")
    spark.sql("DROP TABLE IF EXISTS ops.three_part")
    spark.sql("CREATE TABLE ops.three_part USING parquet AS SELECT * FROM three_part_rows")
    src = TableSources(spark, {"funding_data": "spark_catalog.ops.three_part"})
    assert [tuple(r) for r in src["funding_data"].collect()] == [(1, "Prim")]
    spark.sql("DROP TABLE ops.three_part")
