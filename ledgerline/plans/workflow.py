"""Pipeline E: workflow turnaround details and summaries.

Dataflow: scope (sendings in window) -> one classified scan of the workflow
history -> forward pairing of ready / deferred-new-document starts with their
first outcome (both tracks in one shuffle) -> business-time duration ->
detail table and segment summaries.

Inputs are DataFrames with the source schemas of ``FIXTURES.md`` part A
(``ca`` = contract fact, ``date_dim``, ``dealer``, ``app``, ``wf_history``,
``ca_status``, ``ca_sending_data_ino``). Codes (state type, state ids by class, tracks, applicant type) are
arguments whose defaults are the source system's values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.caltime import business_calendar, format_hms, with_business_seconds
from ledgerline.operators.keys import BUCKET_SECONDS, sequence_per_key
from ledgerline.operators.pairing import pair_next_event
from ledgerline.operators.scope import reduced, scope_bits
from ledgerline.params import (
    BOOKED_STATUS_KEY,
    SENDING_PRIMARY_TYPE,
    SENDING_STATE_TYPE,
    STATE_CLASSES,
    BusinessHours,
    RunParams,
)

# pairing tracks: start class -> outcome classes
TRACKS = {
    "ready": ("ready", ("awaiting", "def_pen", "funded")),
    "def_new_doc": ("def_new_doc", ("def_pen", "funded")),
}


def sendings_in_window(ca: DataFrame, date_dim: DataFrame, dealer: DataFrame, params: RunParams) -> DataFrame:
    """Booked contracts whose sending date is in ``[start, end]`` and that have a
    last-submission date and a dealer. Columns: ``ca_id, full_date``.

    The last-submission date and the dealer are existence checks against keys
    that are unique in their dimension, so they are semi-joins (no fan-out).
    """
    dates = date_dim.select("date_key", "full_date")
    dealers = dealer.select("d_key")
    scoped = ca.filter(F.col("ca_st_key") == BOOKED_STATUS_KEY).select(
        F.col("id").alias("ca_id"), "sending_date_key", "sub_date_key", "d_key"
    )
    sent = scoped.join(dates, scoped.sending_date_key == dates.date_key, "inner").filter(
        F.col("full_date").between(F.lit(params.start), F.lit(params.end))
    )
    sent = sent.join(dates.select(F.col("date_key").alias("_sub_key")), F.col("sub_date_key") == F.col("_sub_key"), "left_semi")
    sent = sent.join(dealers, "d_key", "left_semi")
    return sent.select("ca_id", "full_date")


def _state_class(classes: Mapping[str, Sequence[int]]) -> F.Column:
    expr = None
    for cls, ids in classes.items():
        cond = F.col("wf_state_id").isin(list(ids))
        expr = F.when(cond, F.lit(cls)) if expr is None else expr.when(cond, F.lit(cls))
    return expr


def wf_events(
    history: DataFrame,
    app: DataFrame,
    sendings: DataFrame,
    params: RunParams,
    state_type: str = SENDING_STATE_TYPE,
    classes: Mapping[str, Sequence[int]] = STATE_CLASSES,
    scope_logs: bool = True,
) -> DataFrame:
    """One scan of the history: events of the workflow ``state_type`` of in-scope contracts since
    ``start``, each with its state class (``classes``: class to state ids; events of no class go).
    ``scope_logs`` drops events of other applications at the scan, before the shuffle.
    Columns: ``ca_id, state_class, wf_state_name, u_date_time, u_by``."""
    ev = history.filter(
        (F.col("wf_state_type_name") == state_type)
        & (F.col("u_date_time") >= F.lit(params.start).cast("timestamp_ntz"))
    ).withColumn("state_class", _state_class(classes)).filter(F.col("state_class").isNotNull())
    # few contracts are sent in a window: their applications are settled first, so that events of all others go at the scan
    scoped = app.select("application_id", "ca_id").join(sendings.select("ca_id"), "ca_id", "left_semi")
    if scope_logs:
        ev = reduced(ev, "application_id", scope_bits(scoped, "application_id"))
    ev = ev.join(scoped, "application_id", "inner")
    return ev.select("ca_id", "state_class", "wf_state_name", "u_date_time", "u_by")


def wf_events_by_state(events: DataFrame, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """All events per class with their sequence number per contract (ascending
    time; ties by actor then state name, NULLs first). Numbered per time bucket
    plus a running offset, so a very active contract is spread over many tasks."""
    return sequence_per_key(
        events, ["ca_id", "state_class"], "u_date_time", ["u_by", "wf_state_name"], "seq_no", bucket_seconds
    ).select("ca_id", "state_class", "wf_state_name", "u_date_time", "u_by", "seq_no")


def pairing_input(events: DataFrame, tracks: Mapping[str, tuple[str, Sequence[str]]] = TRACKS) -> DataFrame:
    """Events placed on each track they take part in, with role start/outcome.
    A deferred-pending or funded event is an outcome on both tracks."""
    entries = []
    for track, (start_cls, outcome_cls) in tracks.items():
        entries.append((start_cls, track, "start"))
        for cls in outcome_cls:
            entries.append((cls, track, "outcome"))
    by_class: dict[str, list] = {}
    for cls, track, role in entries:
        by_class.setdefault(cls, []).append(F.struct(F.lit(track).alias("track"), F.lit(role).alias("role")))
    placement = None
    for cls, structs in by_class.items():
        cond = F.col("state_class") == F.lit(cls)
        arr = F.array(*structs)
        placement = F.when(cond, arr) if placement is None else placement.when(cond, arr)
    exploded = events.withColumn("_p", F.explode(placement))
    return exploded.select("ca_id", "wf_state_name", "u_date_time", "u_by", F.col("_p.track").alias("track"), F.col("_p.role").alias("role"))


def turnaround_pairs(
    spark: SparkSession,
    events: DataFrame,
    hours: BusinessHours,
    bucket_seconds: int = BUCKET_SECONDS,
    tracks: Mapping[str, tuple[str, Sequence[str]]] = TRACKS,
    calendar: DataFrame | None = None,
) -> DataFrame:
    """The pairings of all tracks; by default both (``track`` = ready / def_new_doc) with business-time duration
    by ``hours``, or by ``calendar`` if one is given.

    Columns: ``track, ca_id, type_1, type_1_time, type_1_by, type_2, type_2_time,
    type_2_by, type_1_to_type_2_duration``.
    """
    pairs = pair_next_event(pairing_input(events, tracks), track="track", bucket_seconds=bucket_seconds)
    cal = business_calendar(spark, hours) if calendar is None else calendar
    return with_business_seconds(pairs, "type_1_time", "type_2_time", "type_1_to_type_2_duration", cal)


DETAIL_COLUMNS = (
    "ca_id", "type_1", "type_1_time", "type_1_by", "type_2", "type_2_time", "type_2_by",
    "type_1_to_type_2_duration",
)


def track_details(pairs: DataFrame, track: str) -> DataFrame:
    return pairs.filter(F.col("track") == track).select(*DETAIL_COLUMNS)


def sending_details(pairs: DataFrame, ca: DataFrame, ca_status: DataFrame, sendings: DataFrame) -> DataFrame:
    """Published detail table (11 columns): both tracks, current status name,
    sending date; distinct rows."""
    # a pair is unique on its track; only the narrow rows of both tracks are made distinct, then
    # enriched on the contract, and the few status names come last
    narrow = pairs.select(*DETAIL_COLUMNS).distinct()
    scope = ca.select(F.col("id").alias("ca_id"), "ca_st_key").join(sendings.select("ca_id", F.col("full_date").alias("fd_date")), "ca_id", "left")
    out = narrow.join(scope, "ca_id", "left").join(ca_status.select("ca_st_key", "ca_s_name"), "ca_st_key", "left")
    return out.select(
        "ca_id",
        F.col("ca_s_name").alias("c_s"),
        "type_1", "type_1_time", "type_1_by", "type_2", "type_2_time", "type_2_by",
        F.col("type_1_to_type_2_duration").alias("type_1_to_type_2_duration_in_seconds"),
        format_hms(F.col("type_1_to_type_2_duration")).alias("type_1_to_type_2_duration_hms"),
        "fd_date",
    )


def current_wf_state(
    history: DataFrame,
    app: DataFrame,
    ca: DataFrame,
    sending_data: DataFrame,
    params: RunParams,
    state_type: str = SENDING_STATE_TYPE,
    applicant_type: str = SENDING_PRIMARY_TYPE,
) -> DataFrame:
    """Latest state in the workflow ``state_type`` per contract that has a sending row of the
    ``applicant_type``. Columns: ``ca_id, wf_state_name, u_date_time``."""
    ev = history.filter(
        (F.col("wf_state_type_name") == state_type)
        & (F.col("u_date_time") >= F.lit(params.start).cast("timestamp_ntz"))
    )
    last = F.max(F.struct("u_date_time", "wf_state_name"))
    per_app = ev.groupBy("application_id").agg(last.alias("last")).join(app.select("application_id", "ca_id"), "application_id", "inner")
    per_ca = per_app.groupBy("ca_id").agg(F.max("last").alias("last"))
    per_ca = per_ca.join(ca.select(F.col("id").alias("ca_id")), "ca_id", "left_semi")
    prim = sending_data.filter(F.col("applicant_type") == applicant_type).select(F.col("application_no").alias("ca_id"))
    return per_ca.join(prim, "ca_id", "left_semi").select("ca_id", F.col("last.wf_state_name").alias("wf_state_name"), F.col("last.u_date_time").alias("u_date_time"))


__all__ = [
    "sendings_in_window", "wf_events", "wf_events_by_state", "pairing_input", "turnaround_pairs",
    "track_details", "sending_details", "current_wf_state",
]
