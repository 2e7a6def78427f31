"""Per-log digests: one scan and one pre-aggregated shuffle per event log.

The snapshot needs several facts from each log (the status log gives submit
counts, the last funding row and the first package-received row; the decisions
give first/last final decision and last approval; ...). Instead of one scan per
fact, each log is classified once and folded into one row per contract with
conditional aggregates. First/last/lowest rows are ``min``/``max`` over a
struct whose field order is the sort order, which equals ``ROW_NUMBER() = 1``
under the same order (NULLs first ascending, last descending) and, unlike a
window, aggregates map-side: a contract holding a third of a log never funnels
its raw rows into one task.

Logs keyed by application fold twice: per application (map-side partial
aggregation over the raw log), then per contract after joining the bridge.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.params import (
    APPROVAL_DECISIONS,
    AUTO_ANALYST,
    AUTO_DECISION,
    BOOKER_STATE,
    FINAL_DECISIONS,
    FUNDER_STATE,
    FUNDING_STATUS_ID,
    OVERDUE_DAYS,
    PACKAGE_RECEIVED_STATUS_ID,
    PRIMARY_APPLICANT_TYPE,
    RELATION_TYPES,
    SUBMIT_STATUS_IDS,
    UNKNOWN_LABEL,
)


def _bridge(app: DataFrame) -> DataFrame:
    return app.select("application_id", F.col("ca_id").alias("id"))


def status_log_digest(status_log: DataFrame) -> DataFrame:
    """Per contract: ``cou_of_submits`` (NULL without submit rows), ``fun_date_time``
    (latest funding row), ``first_package_time`` (earliest package-received row)."""
    submit = F.col("s_id").isin(list(SUBMIT_STATUS_IDS))
    g = status_log.groupBy("id").agg(
        F.count(F.when(submit, F.lit(1))).alias("_n_submit"),
        F.count(F.when(submit, F.col("s_c_log_id"))).alias("_submits"),
        F.max(F.when(F.col("s_id") == FUNDING_STATUS_ID, F.col("created_date_time"))).alias("fun_date_time"),
        F.min(F.when(F.col("s_id") == PACKAGE_RECEIVED_STATUS_ID, F.col("created_date_time"))).alias("first_package_time"),
    )
    return g.select(
        "id",
        F.when(F.col("_n_submit") > 0, F.col("_submits")).alias("cou_of_submits"),
        "fun_date_time",
        "first_package_time",
    )


def decision_digest(decisions: DataFrame, app: DataFrame) -> DataFrame:
    """Per contract: first and last final decision (automatic ``acp``/``CPP``
    excluded) and the last approval-type decision with its ``vin``.

    Columns: ``id, first_dec, last_dec, last_app`` (structs).
    """
    final = ~((F.col("analyst") == AUTO_ANALYST) & (F.col("cdecision") == AUTO_DECISION)) & F.col(
        "decisiondescription"
    ).isin(list(FINAL_DECISIONS))
    dec = F.struct(
        "decisiondate", "decisiondescription",
        F.coalesce(F.col("analyst"), F.lit(UNKNOWN_LABEL)).alias("canalyst"), "subdate",
    )
    appr = F.struct("decisiondate", "vin", "decisiondescription")
    is_appr = F.col("decisiondescription").isin(list(APPROVAL_DECISIONS))
    per_app = decisions.groupBy(F.col("applicationid").alias("application_id")).agg(
        F.min(F.when(final, dec)).alias("first_dec"),
        F.max(F.when(final, dec)).alias("last_dec"),
        F.max(F.when(is_appr, appr)).alias("last_app"),
    )
    per_ca = per_app.join(_bridge(app), "application_id", "inner")
    return per_ca.groupBy("id").agg(
        F.min("first_dec").alias("first_dec"), F.max("last_dec").alias("last_dec"), F.max("last_app").alias("last_app")
    )


def workflow_digest(history_t: DataFrame, app: DataFrame) -> DataFrame:
    """Per contract (every contract of the bridge): latest workflow row
    (``last_wf``), latest funder row (``fun``) and latest booker row (``boo``)."""
    fun = (F.col("wf_s_id") == FUNDER_STATE[0]) & (F.col("wf_state_name") == FUNDER_STATE[1])
    boo = (F.col("wf_s_id") == BOOKER_STATE[0]) & (F.col("wf_state_name") == BOOKER_STATE[1])
    actor = F.struct("up_date_time", "up_by")
    per_app = history_t.groupBy("application_id").agg(
        F.max(F.struct("up_date_time", "wf_state_name", "up_by")).alias("last_wf"),
        F.max(F.when(fun, actor)).alias("fun"),
        F.max(F.when(boo, actor)).alias("boo"),
    )
    per_ca = _bridge(app).join(per_app, "application_id", "left")
    return per_ca.groupBy("id").agg(
        F.max("last_wf").alias("last_wf"), F.max("fun").alias("fun"), F.max("boo").alias("boo")
    )


def customer_row_digest(ino_c: DataFrame, app: DataFrame) -> DataFrame:
    """Per contract: ``returningcflag`` (1 or NULL) and, per relation, the
    lowest-income live row as struct ``(ginome, antotal, ginomefre)`` named
    ``low_<relation>``."""
    live = F.col("isdeleted") == 0
    row = F.struct("ginome", "antotal", "ginomefre")
    aggs = [F.max(F.when(F.col("returningcflag") == 1, F.lit(1))).alias("returningcflag")]
    for rel, prefix in RELATION_TYPES.items():
        aggs.append(F.min(F.when(live & (F.col("relationtype") == rel), row)).alias(f"low_{prefix}"))
    per_app = ino_c.groupBy(F.col("applicationid").alias("application_id")).agg(*aggs)
    per_ca = per_app.join(_bridge(app), "application_id", "inner")
    return per_ca.groupBy("id").agg(
        F.max("returningcflag").alias("returningcflag"),
        *[F.min(f"low_{p}").alias(f"low_{p}") for p in RELATION_TYPES.values()],
    )


def delinquency_digest(summary: DataFrame, detail: DataFrame, as_of: dt.date) -> DataFrame:
    """Per contract of the delinquency summary: ``d_flag`` (1/NULL) and
    ``first_i_due_date`` (earliest due date, flagged contracts only).

    The detail log is folded per contract *before* the join, so only one row per
    contract crosses the shuffle.
    """
    overdue = F.col("i_paid_off").isNull() & (F.datediff(F.lit(as_of), F.col("i_due_date")) > OVERDUE_DAYS)
    per_contract = detail.groupBy(F.col("contract_number").alias("id")).agg(
        F.count(F.when(overdue, F.lit(1))).alias("_n_overdue"),
        F.min("i_due_date").alias("_first_due"),
    )
    late = (F.col("d_60_day_payments") >= 1) | (F.col("d_over_60_day_payments") >= 1)
    # one row per contract on both sides: a repeated summary row changes nothing
    summaries = summary.groupBy("id").agg(F.max(F.coalesce(late, F.lit(False))).alias("_late"))
    j = summaries.join(per_contract, "id", "inner")
    flagged = (F.col("_n_overdue") > 0) | F.col("_late")
    return j.select(
        "id",
        F.when(flagged, F.lit(1)).alias("d_flag"),
        F.when(flagged, F.col("_first_due")).alias("first_i_due_date"),
    ).filter(F.col("d_flag").isNotNull())


def funding_digest(funding: DataFrame, pass_through) -> DataFrame:
    """Per application: ``have_a_co_app`` (a second applicant row exists) and the
    primary row's attributes as ``prim`` (struct of ``pass_through``), with the number
    of primary rows ``n_prim``."""
    prim = F.when(F.col("applicant_type") == PRIMARY_APPLICANT_TYPE, F.struct(*pass_through))
    g = funding.groupBy(F.col("application_no").alias("id")).agg(
        F.count(F.lit(1)).alias("_rows"), F.count(prim).alias("n_prim"), F.max(prim).alias("prim")
    )
    return g.select("id", F.when(F.col("_rows") >= 2, F.lit(1)).otherwise(F.lit(0)).alias("have_a_co_app"), "prim", "n_prim")
