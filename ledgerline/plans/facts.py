"""Pipeline T: per-contract facts (delinquency, decisions, incomes, workflow, flags).

Every function returns one row per contract key (``id`` BIGINT, except where
noted), so the wide snapshot can join them without fan-out. Each fact is an
aggregate or a top-1-per-key selection, both of which Spark pre-aggregates or
pre-limits before the shuffle; the output of each is hash-partitioned by its
key, which the snapshot's joins reuse.

Tie rules (NULLs first ascending, last descending, as in Spark and T-SQL):
``first`` = smallest (order, payload); ``last`` = greatest (order, payload).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.income import annualised
from ledgerline.operators.keys import latest_per_key, nth_per_key
from ledgerline.plans.digests import delinquency_digest
from ledgerline.params import (
    APPROVAL_DECISIONS,
    AUTO_ANALYST,
    AUTO_DECISION,
    BOOKED_STATUS_KEY,
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


def max_current_score(trans_return: DataFrame) -> DataFrame:
    """Highest bureau score (text order) over current return rows: ``id, highest_fco``."""
    return trans_return.filter(F.col("is_current") == 1).groupBy("id").agg(F.max("go170").alias("highest_fco"))


def overdue_30(summary: DataFrame, detail: DataFrame, as_of: dt.date) -> DataFrame:
    """Unpaid instalments more than 30 days past due at ``as_of`` (days counted as
    midnights crossed): ``id, overdue_instalments``."""
    late = F.col("i_paid_off").isNull() & (F.datediff(F.lit(as_of), F.col("i_due_date")) > OVERDUE_DAYS)
    per_contract = detail.filter(late).groupBy(F.col("contract_number").alias("id")).agg(F.count(F.lit(1)).alias("overdue_instalments"))
    return per_contract.join(summary.select("id"), "id", "left_semi")


def paid_over_30(summary: DataFrame, detail: DataFrame) -> DataFrame:
    """Contracts with a 60-day or over-60-day late payment and detail rows:
    ``id, detail_rows``."""
    late = summary.filter((F.col("d_60_day_payments") >= 1) | (F.col("d_over_60_day_payments") >= 1)).select("id")
    per_contract = detail.groupBy(F.col("contract_number").alias("id")).agg(F.count(F.lit(1)).alias("detail_rows"))
    return per_contract.join(late, "id", "left_semi")


def delinquency_flag(summary: DataFrame, detail: DataFrame, as_of: dt.date) -> DataFrame:
    """Union of overdue and paid-late contracts: ``id``."""
    return delinquency_digest(summary, detail, as_of).select("id")


def first_due_flagged(summary: DataFrame, detail: DataFrame, flagged: DataFrame) -> DataFrame:
    """Earliest due date over all instalments of flagged contracts: ``id, first_i_due_date``."""
    first = detail.groupBy(F.col("contract_number").alias("id")).agg(F.min("i_due_date").alias("first_i_due_date"))
    return first.join(summary.select("id"), "id", "left_semi").join(flagged.select("id"), "id", "left_semi")


def submit_counts(ca: DataFrame, status_log: DataFrame) -> DataFrame:
    """Submit log rows per contract: ``id, cou_of_submits``."""
    log = status_log.filter(F.col("s_id").isin(list(SUBMIT_STATUS_IDS))).select("id", "s_c_log_id")
    return log.groupBy("id").agg(F.count("s_c_log_id").alias("cou_of_submits")).join(ca.select("id"), "id", "left_semi")


def _decisions_by_contract(decisions: DataFrame, app: DataFrame) -> DataFrame:
    return decisions.join(
        app.select(F.col("application_id").alias("applicationid"), F.col("ca_id").alias("id")), "applicationid", "inner"
    )


def first_last_decision(decisions: DataFrame, app: DataFrame, submitted: DataFrame) -> DataFrame:
    """First and last final decision of submitted contracts, automatic
    ``acp``/``CPP`` decisions excluded (3-valued: a NULL analyst with ``CPP`` is
    dropped). One aggregate for both ends.

    Columns: ``id, sub_date_time, first_decision_date_time, first_decision_s,
    first_de_user, last_decision_date_time, last_decision_s, last_de_user``.
    """
    keep = ~((F.col("analyst") == AUTO_ANALYST) & (F.col("cdecision") == AUTO_DECISION))
    d = decisions.filter(keep & F.col("decisiondescription").isin(list(FINAL_DECISIONS))).select(
        "applicationid", "decisiondate", "decisiondescription",
        F.coalesce(F.col("analyst"), F.lit(UNKNOWN_LABEL)).alias("canalyst"), "subdate",
    )
    # fold per application, then per contract: raw decisions never meet on a contract
    packed = F.struct("decisiondate", "decisiondescription", "canalyst", "subdate")
    per_app = d.groupBy("applicationid").agg(F.min(packed).alias("first"), F.max(packed).alias("last"))
    fl = _decisions_by_contract(per_app, app).groupBy("id").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return fl.join(submitted.select("id"), "id", "left_semi").select(
        "id",
        F.col("first.subdate").alias("sub_date_time"),
        F.col("first.decisiondate").alias("first_decision_date_time"),
        F.col("first.decisiondescription").alias("first_decision_s"),
        F.col("first.canalyst").alias("first_de_user"),
        F.col("last.decisiondate").alias("last_decision_date_time"),
        F.col("last.decisiondescription").alias("last_decision_s"),
        F.col("last.canalyst").alias("last_de_user"),
    )


def last_approval(decisions: DataFrame, app: DataFrame) -> DataFrame:
    """Latest approval-type decision per contract: ``id, last_app_date_time, vin``."""
    d = decisions.filter(F.col("decisiondescription").isin(list(APPROVAL_DECISIONS)))
    # folded per application, then per contract: raw decisions never meet on a contract
    per_app = d.groupBy("applicationid").agg(F.max(F.struct("decisiondate", "vin", "decisiondescription")).alias("last"))
    last = _decisions_by_contract(per_app, app).groupBy("id").agg(F.max("last").alias("last"))
    return last.select("id", F.col("last.decisiondate").alias("last_app_date_time"), F.col("last.vin").alias("vin"))


def last_funding(status_log: DataFrame) -> DataFrame:
    """Latest funding log row per contract: ``id, fun_date_time``."""
    log = status_log.filter(F.col("s_id") == FUNDING_STATUS_ID).select("id", "created_date_time", "s_c_log_id")
    last = latest_per_key(log, ["id"], "created_date_time", ["s_c_log_id"])
    return last.select("id", F.col("created_date_time").alias("fun_date_time"))


def co_applicant_flag(funding: DataFrame) -> DataFrame:
    """Second applicant row per application (primary ranked first; among the rest
    lowest ``is_comm`` then ``tds_v``): ``application_no, is_comm``. Present means
    the contract has a co-applicant; two non-primary rows also count."""
    prio = F.when(F.col("applicant_type") == PRIMARY_APPLICANT_TYPE, F.lit(1)).otherwise(F.lit(2))
    second = nth_per_key(funding, ["application_no"], [prio, F.col("is_comm"), F.col("tds_v")], 2)
    return second.select("application_no", "is_comm")


def latest_wf_per_contract(history_t: DataFrame, app: DataFrame) -> DataFrame:
    """Latest workflow row per application, then the latest of those per contract;
    contracts whose applications have no history keep a row of NULLs.

    Both levels are aggregates over a (time, state, actor) struct: the first
    level pre-aggregates map-side, the second runs on one row per application.
    Columns: ``id, wf_state_name, up_date_time, up_by``.
    """
    packed = F.struct("up_date_time", "wf_state_name", "up_by")
    per_app = history_t.groupBy("application_id").agg(F.max(packed).alias("_last"))
    per_ca = app.select("application_id", F.col("ca_id").alias("id")).join(per_app, "application_id", "left")
    per_ca = per_ca.groupBy("id").agg(F.max("_last").alias("_last"))
    return per_ca.select(
        "id",
        F.col("_last.wf_state_name").alias("wf_state_name"),
        F.col("_last.up_date_time").alias("up_date_time"),
        F.col("_last.up_by").alias("up_by"),
    )


def dealers_per_manager(dealer: DataFrame, ams: DataFrame, ca: DataFrame) -> DataFrame:
    """Live, non-test dealers having at least one contract, per manager (NULL
    manager key counts as 0): ``ams_key, ams, total_d_under_ams``."""
    live = dealer.filter(
        (F.coalesce(F.col("is_test_d"), F.lit(0)) == 0) & (F.coalesce(F.col("is_old_s"), F.lit(0)) == 0)
    ).select("d_key", F.coalesce(F.col("ams_key"), F.lit(0)).alias("ams_key"))
    used = ca.select("d_key").distinct()
    live = live.join(used, "d_key", "left_semi")
    managers = ams.select("ams_key", "ams_name")
    j = live.join(managers, "ams_key", "inner")
    return j.groupBy("ams_key", F.coalesce(F.col("ams_name"), F.lit(UNKNOWN_LABEL)).alias("ams")).agg(
        F.count_distinct("d_key").alias("total_d_under_ams")
    )


def returning_customer(app: DataFrame, ino_c: DataFrame) -> DataFrame:
    """Contracts with any customer row flagged returning: ``id, returningcflag``."""
    flagged = ino_c.filter(F.col("returningcflag") == 1).select(F.col("applicationid").alias("application_id")).distinct()
    ids = app.join(flagged, "application_id", "left_semi").select(F.col("ca_id").alias("id")).distinct()
    return ids.withColumn("returningcflag", F.lit(1))


def original_package_received(ca: DataFrame, dealer: DataFrame, status_log: DataFrame) -> DataFrame:
    """First package-received log time of booked contracts with a dealer; NULL
    when there is none: ``id, original_fun_pac_date_re``."""
    booked = ca.filter(F.col("ca_st_key") == BOOKED_STATUS_KEY).select("id", "d_key")
    booked = booked.join(dealer.select("d_key"), "d_key", "inner").select("id")
    first = status_log.filter(F.col("s_id") == PACKAGE_RECEIVED_STATUS_ID).groupBy("id").agg(
        F.min("created_date_time").alias("original_fun_pac_date_re")
    )
    return booked.join(first, "id", "left")


def major_derogatory(major_dgg: DataFrame) -> DataFrame:
    """Contracts with a derogatory row of type other than ``O`` (NULL type counts): ``id``."""
    return major_dgg.filter(F.coalesce(F.col("ptype"), F.lit("")) != "O").select("id").distinct()


def prior_bankruptcy(bureau: DataFrame) -> DataFrame:
    """Contracts with a non-zero prior-bankruptcy indicator (NULL excluded): ``id``."""
    return bureau.filter(F.col("prebankre") != 0).select("id").distinct()


INCOME_ORDER = ("ginome", "antotal", "ginomefre")


def annual_income_by_relation(app: DataFrame, ino_c: DataFrame, order: Sequence[str] = INCOME_ORDER, lowest: bool = True) -> DataFrame:
    """Per contract and relation (1 primary, 2 co-applicant, 3 co-signer) one income row: the first
    one by ``order``, from below (NULL first) or, if not ``lowest``, from above. By default the row
    with the lowest income; ties by lower total, then frequency.

    Columns: ``id, relationtype, ginomefre, ginome, sub_a_inome, antotal``.
    """
    pick = F.min if lowest else F.max
    rows = ino_c.filter((F.col("isdeleted") == 0) & F.col("relationtype").isin(list(RELATION_TYPES)))
    row = F.struct(*order, *[c for c in INCOME_ORDER if c not in order])
    # folded per application, then per contract: raw rows never meet on a contract
    per_app = rows.groupBy(F.col("applicationid").alias("application_id"), "relationtype").agg(pick(row).alias("row"))
    per_app = per_app.join(app.select("application_id", F.col("ca_id").alias("id")), "application_id", "inner")
    low = per_app.groupBy("id", "relationtype").agg(pick("row").alias("row")).select("id", "relationtype", "row.*")
    return low.select(
        "id", "relationtype", "ginomefre", "ginome", annualised(F.col("ginomefre"), F.col("ginome")).alias("sub_a_inome"), "antotal"
    )


def funder_and_booker(history_t: DataFrame, app: DataFrame, ca: DataFrame) -> DataFrame:
    """Latest actor at the funding state and at the booking state, booked contracts
    only, from one scan of the history: ``id, wf_state_name, up_by, up_date_time``."""
    states = [FUNDER_STATE, BOOKER_STATE]
    cond = None
    for sid, name in states:
        c = (F.col("wf_s_id") == sid) & (F.col("wf_state_name") == name)
        cond = c if cond is None else cond | c
    h = history_t.filter(cond).select("application_id", "wf_state_name", "up_by", "up_date_time")
    per_app = h.groupBy("application_id", "wf_state_name").agg(F.max(F.struct("up_date_time", "up_by")).alias("last"))
    per_app = per_app.join(app.select("application_id", F.col("ca_id").alias("id")), "application_id", "inner")
    last = per_app.groupBy("id", "wf_state_name").agg(F.max("last").alias("last"))
    last = last.join(ca.filter(F.col("ca_st_key") == BOOKED_STATUS_KEY).select("id"), "id", "left_semi")
    return last.select("id", "wf_state_name", F.col("last.up_by").alias("up_by"), F.col("last.up_date_time").alias("up_date_time"))
