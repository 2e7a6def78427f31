"""Named queries over the fixture views: one per operator of the inventory.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the whole
supplied tables. The parameters are the fixed test parameters of FIXTURES.md.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.caltime import business_calendar, calendar_from_intervals, epoch_seconds, format_hms, with_business_seconds
from ledgerline.params import BusinessHours, RunParams
from ledgerline.plans import facts
from ledgerline.plans import snapshot as snap
from ledgerline.plans import workflow as wf
from ledgerline.operators.summary import segment_summary
from ledgerline.sources.fixtures import FixtureSources

TEST_PARAMS = RunParams(as_of=dt.date(1998, 6, 1), start=dt.date(1996, 1, 1), end=dt.date(2001, 12, 31))
TEST_HOURS = BusinessHours(
    first_day=dt.date(1995, 1, 1),
    last_day=dt.date(2002, 12, 31),
    open_seconds=9 * 3600,
    close_seconds=17 * 3600,
    open_weekdays=(0, 1, 2, 3, 4),
    yearly_holidays=((1, 1),),
)

_HOUR = 3600
SPLIT_HOURS = BusinessHours(
    first_day=TEST_HOURS.first_day,
    last_day=TEST_HOURS.last_day,
    weekly=(
        *((d, 9 * _HOUR, 12 * _HOUR + 1800) for d in range(4)),
        *((d, 13 * _HOUR + 900, 17 * _HOUR) for d in range(4)),
        (4, 9 * _HOUR, 13 * _HOUR),
        (5, 10 * _HOUR, 12 * _HOUR),
    ),
    yearly_holidays=((1, 1),),
    special=((dt.date(1997, 12, 24), 9 * _HOUR, 11 * _HOUR),),
)


_SOURCES: dict[tuple[str, int, str], FixtureSources] = {}


def fixture_sources(spark: SparkSession, sf_dir: str) -> FixtureSources:
    """Fixture views per (application, session, folder): the lazy view DataFrames
    are built once and reused by every query of that session; each execution still
    reads the files in full."""
    key = (spark.sparkContext.applicationId, id(spark), sf_dir.rstrip("/"))
    if key not in _SOURCES:
        _SOURCES[key] = FixtureSources(spark, sf_dir)
    return _SOURCES[key]


class Ctx:
    """Fixture sources plus derived intermediates shared inside one query."""

    def __init__(self, spark: SparkSession, sf_dir: str, params: RunParams = TEST_PARAMS, hours: BusinessHours = TEST_HOURS):
        self.spark = spark
        self.src = fixture_sources(spark, sf_dir)
        self.params = params
        self.hours = hours
        self._memo: dict[str, DataFrame] = {}

    def memo(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._memo:
            self._memo[name] = build()
        return self._memo[name]

    # --- pipeline E intermediates -------------------------------------------------
    def sendings(self) -> DataFrame:
        s = self.src
        return self.memo("sendings", lambda: wf.sendings_in_window(s["ca"], s["date_dim"], s["dealer"], self.params))

    def events(self) -> DataFrame:
        s = self.src
        return self.memo("events", lambda: wf.wf_events(s["wf_history"], s["app"], self.sendings(), self.params))

    def pairs(self) -> DataFrame:
        return self.memo("pairs", lambda: wf.turnaround_pairs(self.spark, self.events(), self.hours))

    # --- pipeline T sources -------------------------------------------------------
    def snapshot_sources(self) -> snap.SnapshotSources:
        s = self.src
        return snap.SnapshotSources(
            ca=s["ca"], ca_status=s["ca_status"], date_dim=s["date_dim"], dealer=s["dealer"], ams=s["ams"],
            mk_program=s["mk_program"], funding=s["funding_data"], trans_return=s["trans_return"],
            delinq_summary=s["delinq_summary"], delinq_detail=s["delinq_detail"], status_log=s["s_c_log"],
            decisions=s["ino_decisions"], app=s["app"].select(
                "application_id", "ca_id"), history_t=s["wf_history_t"], ino_c=s["ino_c"], l_def=s["l_def"],
            major_dgg=s["major_dgg"], bureau=s["bureau"], res_adj=s["res_adj"], exposure=s["exposure"],
            dis_report=s["dis_report"],
        )


def engine_neutral(df: DataFrame) -> DataFrame:
    """Driver-facing output types: DECIMAL as DOUBLE and DATE as TIMESTAMP_NTZ.

    The library computes money in DECIMAL and keeps dates as DATE; only the
    results handed to the cross-engine comparison are widened, so that Spark and
    DuckDB rows convert to the same Python values (DuckDB's pandas export turns
    DECIMAL into float and DATE into Timestamp).
    """
    cols = []
    for f in df.schema:
        kind = f.dataType.typeName()
        if kind == "decimal":
            cols.append(F.col(f.name).cast("double").alias(f.name))
        elif kind == "date":
            cols.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def _q(build: Callable[[Ctx], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return engine_neutral(build(Ctx(spark, sf_dir)))

    run.__name__ = build.__name__
    return run


# --- pipeline E ------------------------------------------------------------------

def sendings_in_window(c: Ctx) -> DataFrame:
    return c.sendings()


def wf_events_by_state(c: Ctx) -> DataFrame:
    return wf.wf_events_by_state(c.events())


def ready_to_next_outcome(c: Ctx) -> DataFrame:
    return wf.track_details(c.pairs(), "ready")


def defnew_to_next_outcome(c: Ctx) -> DataFrame:
    return wf.track_details(c.pairs(), "def_new_doc")


def business_seconds(c: Ctx) -> DataFrame:
    """Business time from submission to each decision, for every decision row."""
    d = c.src["ino_decisions"].select("applicationid", "subdate", "decisiondate")
    cal = business_calendar(c.spark, c.hours)
    return with_business_seconds(d, "subdate", "decisiondate", "business_seconds", cal)


def business_seconds_by_weekday(c: Ctx) -> DataFrame:
    """The same with a midday break, short Fridays, Saturday mornings and one short day."""
    d = c.src["ino_decisions"].select("applicationid", "subdate", "decisiondate")
    return with_business_seconds(d, "subdate", "decisiondate", "business_seconds", business_calendar(c.spark, SPLIT_HOURS))


def business_seconds_from_table(c: Ctx) -> DataFrame:
    """The same with opening intervals from a table: two overlapping shifts a weekday, and Friday nights."""
    day = c.src["date_dim"].select("full_date", F.expr("cast(full_date as timestamp_ntz)").alias("t"))
    weekdays, fridays = day.where("weekday(full_date) < 5"), day.where("weekday(full_date) = 4")
    early = weekdays.selectExpr("t + make_dt_interval(0, 8 + day(full_date) % 3) AS starts", "t + interval '12' hour AS ends")
    late = weekdays.selectExpr("t + make_dt_interval(0, 11, 30) AS starts", "t + make_dt_interval(0, 15, day(full_date)) AS ends")
    night = fridays.selectExpr("t + interval '22' hour AS starts", "t + interval '26' hour AS ends")
    cal = calendar_from_intervals(early.unionAll(late).unionAll(night), "starts", "ends", c.hours)
    d = c.src["ino_decisions"].select("applicationid", "subdate", "decisiondate")
    return with_business_seconds(d, "subdate", "decisiondate", "business_seconds", cal)


def format_hms_q(c: Ctx) -> DataFrame:
    """Wall-clock seconds from submission to decision, formatted ``HH:MM:SS``."""
    d = c.src["ino_decisions"].select("applicationid", "subdate", "decisiondate")
    d = d.withColumn("seconds", (epoch_seconds(d, "decisiondate") - epoch_seconds(d, "subdate")).cast("bigint"))
    return d.withColumn("hms", format_hms(F.col("seconds")))


def sending_details(c: Ctx) -> DataFrame:
    return wf.sending_details(c.pairs(), c.src["ca"], c.src["ca_status"], c.sendings())


def stats_per_analyst(c: Ctx) -> DataFrame:
    return segment_summary(c.pairs(), "analyst")


def stats_per_month(c: Ctx) -> DataFrame:
    return segment_summary(c.pairs(), "month")


def stats_per_analyst_month(c: Ctx) -> DataFrame:
    return segment_summary(c.pairs(), "analyst_month")


def current_wf_state(c: Ctx) -> DataFrame:
    s = c.src
    return wf.current_wf_state(s["wf_history"], s["app"], s["ca"], s["ca_sending_data_ino"], c.params)


# --- pipeline T ------------------------------------------------------------------

def max_current_score(c: Ctx) -> DataFrame:
    return facts.max_current_score(c.src["trans_return"])


def overdue_30(c: Ctx) -> DataFrame:
    return facts.overdue_30(c.src["delinq_summary"], c.src["delinq_detail"], c.params.as_of)


def paid_over_30(c: Ctx) -> DataFrame:
    return facts.paid_over_30(c.src["delinq_summary"], c.src["delinq_detail"])


def delinquency_flag(c: Ctx) -> DataFrame:
    return facts.delinquency_flag(c.src["delinq_summary"], c.src["delinq_detail"], c.params.as_of)


def first_due_flagged(c: Ctx) -> DataFrame:
    s = c.src
    flagged = facts.delinquency_flag(s["delinq_summary"], s["delinq_detail"], c.params.as_of)
    return facts.first_due_flagged(s["delinq_summary"], s["delinq_detail"], flagged)


def submit_counts(c: Ctx) -> DataFrame:
    return facts.submit_counts(c.src["ca"], c.src["s_c_log"])


def first_last_decision(c: Ctx) -> DataFrame:
    s = c.src
    return facts.first_last_decision(s["ino_decisions"], s["app"], facts.submit_counts(s["ca"], s["s_c_log"]))


def last_approval(c: Ctx) -> DataFrame:
    return facts.last_approval(c.src["ino_decisions"], c.src["app"])


def last_funding(c: Ctx) -> DataFrame:
    return facts.last_funding(c.src["s_c_log"])


def co_applicant_flag(c: Ctx) -> DataFrame:
    return facts.co_applicant_flag(c.src["funding_data"])


def latest_wf_per_contract(c: Ctx) -> DataFrame:
    return facts.latest_wf_per_contract(c.src["wf_history_t"], c.src["app"])


def dealers_per_manager(c: Ctx) -> DataFrame:
    return facts.dealers_per_manager(c.src["dealer"], c.src["ams"], c.src["ca"])


def returning_customer(c: Ctx) -> DataFrame:
    return facts.returning_customer(c.src["app"], c.src["ino_c"])


def original_package_received(c: Ctx) -> DataFrame:
    return facts.original_package_received(c.src["ca"], c.src["dealer"], c.src["s_c_log"])


def major_derogatory(c: Ctx) -> DataFrame:
    return facts.major_derogatory(c.src["major_dgg"])


def prior_bankruptcy(c: Ctx) -> DataFrame:
    return facts.prior_bankruptcy(c.src["bureau"])


def annual_income_by_relation(c: Ctx) -> DataFrame:
    return facts.annual_income_by_relation(c.src["app"], c.src["ino_c"])


def funder_and_booker(c: Ctx) -> DataFrame:
    return facts.funder_and_booker(c.src["wf_history_t"], c.src["app"], c.src["ca"])


def status_waterfall(c: Ctx) -> DataFrame:
    return snap.status_waterfall(c.src["ca"])


def contract_flags(c: Ctx) -> DataFrame:
    return snap.contract_flags(c.snapshot_sources(), c.params.as_of)


def program_class(c: Ctx) -> DataFrame:
    return snap.program_class(c.src["ca"], c.src["mk_program"])


def wide_contract_snapshot(c: Ctx) -> DataFrame:
    return snap.wide_contract_snapshot(c.snapshot_sources(), c.params.as_of)


def snapshot_roundtrip(c: Ctx) -> DataFrame:
    """Publish the snapshot by atomic overwrite into the warehouse, read it back."""
    import hashlib

    from ledgerline.plans.refresh import SNAPSHOT_TABLE, refresh_snapshot
    from ledgerline.sources.sinks import read_published, warehouse_dir

    tag = hashlib.sha1(c.src.sf_dir.encode()).hexdigest()[:10]
    base = warehouse_dir(c.spark, "ledgerline_published", tag)
    refresh_snapshot(c.spark, c.snapshot_sources(), c.params, base, validate=True)
    return read_published(c.spark, f"{base}/{SNAPSHOT_TABLE}")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "sendings_in_window": _q(sendings_in_window),
    "wf_events_by_state": _q(wf_events_by_state),
    "ready_to_next_outcome": _q(ready_to_next_outcome),
    "defnew_to_next_outcome": _q(defnew_to_next_outcome),
    "business_seconds": _q(business_seconds),
    "business_seconds_by_weekday": _q(business_seconds_by_weekday),
    "business_seconds_from_table": _q(business_seconds_from_table),
    "format_hms": _q(format_hms_q),
    "sending_details": _q(sending_details),
    "stats_per_analyst": _q(stats_per_analyst),
    "stats_per_month": _q(stats_per_month),
    "stats_per_analyst_month": _q(stats_per_analyst_month),
    "current_wf_state": _q(current_wf_state),
    "max_current_score": _q(max_current_score),
    "overdue_30": _q(overdue_30),
    "paid_over_30": _q(paid_over_30),
    "delinquency_flag": _q(delinquency_flag),
    "first_due_flagged": _q(first_due_flagged),
    "submit_counts": _q(submit_counts),
    "first_last_decision": _q(first_last_decision),
    "last_approval": _q(last_approval),
    "last_funding": _q(last_funding),
    "co_applicant_flag": _q(co_applicant_flag),
    "latest_wf_per_contract": _q(latest_wf_per_contract),
    "dealers_per_manager": _q(dealers_per_manager),
    "returning_customer": _q(returning_customer),
    "original_package_received": _q(original_package_received),
    "major_derogatory": _q(major_derogatory),
    "prior_bankruptcy": _q(prior_bankruptcy),
    "annual_income_by_relation": _q(annual_income_by_relation),
    "funder_and_booker": _q(funder_and_booker),
    "status_waterfall": _q(status_waterfall),
    "contract_flags": _q(contract_flags),
    "program_class": _q(program_class),
    "wide_contract_snapshot": _q(wide_contract_snapshot),
    "snapshot_roundtrip": _q(snapshot_roundtrip),
}
