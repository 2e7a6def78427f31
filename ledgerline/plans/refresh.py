"""End-to-end refresh jobs: the reference's two batch scripts as Spark jobs.

``refresh_turnaround`` publishes the detail table and the three summaries;
``refresh_snapshot`` publishes the wide snapshot. Intermediates used by more than
one output are cut from their lineage with a reliable ``checkpoint()`` into the
cluster's shared ``spark.checkpoint.dir``, so a lost executor costs a re-read of
the checkpoint, not a recomputation of the pairing.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ledgerline.functions.caltime import assert_calendar_covers
from ledgerline.operators.audit import KeyAudit, watched
from ledgerline.operators.keys import BUCKET_SECONDS, assert_unique
from ledgerline.operators.summary import segment_summaries, summary_cells
from ledgerline.params import BusinessHours, RunParams
from ledgerline.plans import snapshot as snap
from ledgerline.plans import workflow as wf
from ledgerline.schemas import DETAILS_TARGET, SNAPSHOT_TARGET, SUMMARY_TARGETS
from ledgerline.session import checkpoint_dir
from ledgerline.sources.sinks import publish, publish_together

TURNAROUND_TABLES = {
    "details": "extract_data_sending_stats_details",
    "analyst": "extract_data_sending_stats_per_a",
    "month": "extract_data_sending_stats_per_m",
    "analyst_month": "extract_data_sending_stats_per_a_per_m",
}
SNAPSHOT_TABLE = "contract_snapshot_detail"


def _check_unread(unread: Mapping[str, tuple[DataFrame, str]] | None) -> None:
    """Left-joined sources of which no column is used are not joined at all, which is only right while
    their key is unique. Nothing else reads them, so each is counted on its own."""
    for name, (df, key) in (unread or {}).items():
        assert_unique(df, [key], name)


def refresh_turnaround(
    spark: SparkSession,
    src: Mapping[str, DataFrame],
    params: RunParams,
    hours: BusinessHours,
    out_base: str,
    bucket_seconds: int = BUCKET_SECONDS,
    validate: bool = True,
    tables: dict[str, str] | None = None,
    unread: Mapping[str, tuple[DataFrame, str]] | None = None,
    calendar: DataFrame | None = None,
) -> dict[str, str]:
    """Sources: ``ca, date_dim, dealer, app, wf_history, ca_status``. Returns the published path per
    table; the four tables become current with one commit. ``validate`` counts the copies of every
    joined key (contracts, dates, dealers, statuses, the application bridge) inside the joins
    themselves and raises before anything is committed if one repeats. ``unread`` names left-joined
    sources of which no column is used, with their key. ``tables`` overrides the published table names
    (keys as in ``TURNAROUND_TABLES``). ``calendar`` (see ``calendar_from_intervals``) stands in for the opening
    hours of ``hours``, whose days it covers."""
    names = {**TURNAROUND_TABLES, **(tables or {})}
    checkpoint_dir(spark)
    audit = KeyAudit() if validate else None
    if validate:
        _check_unread(unread)
    app = watched(audit, src["app"].select("application_id", "ca_id"), ["application_id"], "application bridge")
    dates = watched(audit, src["date_dim"].select("date_key", "full_date"), ["date_key"], "date dimension")
    dealers = watched(audit, src["dealer"].select("d_key"), ["d_key"], "dealers")
    sendings = wf.sendings_in_window(src["ca"], dates, dealers, params)
    events = wf.wf_events(src["wf_history"], app, sendings, params)
    pairs = wf.turnaround_pairs(spark, events, hours, bucket_seconds, calendar=calendar).checkpoint()
    if audit:
        audit.check()
    assert_calendar_covers(pairs, ["type_1_time", "type_2_time"], hours)
    contracts = watched(audit, src["ca"].select("id", "ca_st_key"), ["id"], "contracts")
    statuses = watched(audit, src["ca_status"].select("ca_st_key", "ca_s_name"), ["ca_st_key"], "contract statuses")
    plain = wf.sendings_in_window(src["ca"], src["date_dim"], src["dealer"], params)
    frames = {"details": (wf.sending_details(pairs, contracts, statuses, plain), DETAILS_TARGET)}
    for grain, df in segment_summaries(summary_cells(pairs).checkpoint()).items():
        frames[grain] = (df, SUMMARY_TARGETS[grain])
    paths = publish_together({names[k]: f for k, f in frames.items()}, out_base, check=audit.check if audit else None)
    return {k: paths[names[k]] for k in frames}


def refresh_snapshot(
    spark: SparkSession,
    sources: snap.SnapshotSources,
    params: RunParams,
    out_base: str,
    validate: bool = True,
    table: str = SNAPSHOT_TABLE,
    blank_date: dt.date | None = None,
    unread: Mapping[str, tuple[DataFrame, str]] | None = None,
    scope_logs: bool = False,
) -> str:
    """Publish the 102-column snapshot; ``validate`` counts the copies of every joined key inside the
    joins and raises before the commit if one repeats. ``blank_date`` stands for an absent approval or
    funding date (NULL). ``unread`` names left-joined sources of which no column is used, with their
    key: leaving the join out is only right while the key is unique, so that is checked as well. ``scope_logs``
    as in ``wide_contract_snapshot``."""
    checkpoint_dir(spark)
    audit = KeyAudit() if validate else None
    if validate:
        _check_unread(unread)
    df = snap.wide_contract_snapshot(sources, params.as_of, blank_date=blank_date, audit=audit, scope_logs=scope_logs)
    return publish(df, f"{out_base}/{table}", SNAPSHOT_TARGET, check=audit.check if audit else None)
