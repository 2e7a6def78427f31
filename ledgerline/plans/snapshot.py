"""Pipeline T: status waterfall, contract flags, program labels and the wide
102-column contract snapshot.

Plan shape of the snapshot: each event log is folded once into a per-contract
digest (``plans.digests``: one scan, map-side partial aggregation, one shuffle),
so every digest arrives hash-partitioned on ``id``. The scoped contract fact is
shuffled on ``id`` once and then joined to all digests as a chain of
co-partitioned sort-merge joins -- no further shuffle of the fact. Dimension
joins (status, dates in three roles, dealer, manager, program) are left to the
planner: broadcast when Spark's size estimate is under
``spark.sql.autoBroadcastJoinThreshold`` or when AQE measures the side small at
runtime, a shuffle join otherwise. Nothing here forces a broadcast.

Left-joined sources that are not aggregates (funding row of the primary
applicant, default periods, adjustments, exposure, disposition) must be unique
on their key; a ``KeyAudit`` counts their copies inside the joins (N10).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.audit import KeyAudit, watched
from ledgerline.operators.scope import reduced, scope_bits
from ledgerline.params import (
    APPROVAL_DATE_STATUS_KEYS,
    APPROVED_STATUS_KEYS,
    BOOKED_STATUS_KEY,
    CANCELLED_STATUS_KEYS,
    DECLINED_STATUS_KEYS,
    FCA_PORT_KEY,
    FUNDED_STATUS_KEY,
    NOT_APPLICABLE,
    PRIMARY_APPLICANT_TYPE,
    RELATION_TYPES,
)
from ledgerline.functions.income import annualised
from ledgerline.plans import digests, facts

# ---------------------------------------------------------------------------
# CASE expressions
# ---------------------------------------------------------------------------


def status_label(st: str = "ca_st_key", sub: str = "sub_date_key", last: str = "last_decisioned_ca_st_key") -> Column:
    """Contract status waterfall, first match wins: Boo, Qu, Can, App, D, Sub, else Pen."""
    s, d, l_ = F.col(st), F.col(sub), F.col(last)
    live = (s != BOOKED_STATUS_KEY) & (d > 0)
    return (
        F.when(s == BOOKED_STATUS_KEY, F.lit("Boo"))
        .when((s != BOOKED_STATUS_KEY) & (d == 0), F.lit("Qu"))
        .when(live & s.isin(list(CANCELLED_STATUS_KEYS)), F.lit("Can"))
        .when(live & l_.isin(list(APPROVAL_DATE_STATUS_KEYS)) & (l_ == s), F.lit("App"))
        .when(live & l_.isin(list(DECLINED_STATUS_KEYS)) & (l_ == s), F.lit("D"))
        .when(live & (l_ == 0), F.lit("Sub"))
        .otherwise(F.lit("Pen"))
    )


def fca_or_mas(port: str = "funing_port_key") -> Column:
    return F.when(F.col(port) == FCA_PORT_KEY, F.lit("FCA")).otherwise(F.lit("Mas"))


def std_or_alt(program_name: str = "mk_program_name") -> Column:
    """``Alt`` when the program name contains ``alt`` in any letter case (the
    reference's LIKE runs under a case-insensitive collation), else ``Std``."""
    return F.when(F.lower(F.col(program_name)).contains("alt"), F.lit("Alt")).otherwise(F.lit("Std"))


def _flag(key: str) -> Column:
    return F.when(F.col(key).isNull(), F.lit(0)).otherwise(F.lit(1))


def _blank_date(blank_date: dt.date | None) -> Column:
    return F.lit(blank_date) if blank_date is not None else F.lit(None).cast("date")


def status_waterfall(ca: DataFrame) -> DataFrame:
    """``id, ca_status`` for every contract."""
    return ca.select("id", status_label().alias("ca_status"))


def program_class(ca: DataFrame, mk_program: DataFrame) -> DataFrame:
    """``id, fca_or_mas, std_or_alt`` for every contract."""
    prog = mk_program.select("mk_program_detail_id", "mk_program_name")
    j = ca.select("id", "funing_port_key", "mk_program_detail_id").join(prog, "mk_program_detail_id", "left")
    return j.select("id", fca_or_mas().alias("fca_or_mas"), std_or_alt().alias("std_or_alt"))


# ---------------------------------------------------------------------------
# Inputs
# ---------------------------------------------------------------------------


@dataclass
class SnapshotSources:
    """Source tables of the snapshot (schemas: FIXTURES.md part A)."""

    ca: DataFrame
    ca_status: DataFrame
    date_dim: DataFrame
    dealer: DataFrame
    ams: DataFrame
    mk_program: DataFrame
    funding: DataFrame
    trans_return: DataFrame
    delinq_summary: DataFrame
    delinq_detail: DataFrame
    status_log: DataFrame
    decisions: DataFrame
    app: DataFrame
    history_t: DataFrame
    ino_c: DataFrame
    l_def: DataFrame
    major_dgg: DataFrame
    bureau: DataFrame
    res_adj: DataFrame
    exposure: DataFrame
    dis_report: DataFrame


def _prefixed(df: DataFrame, key: str, prefix: str, cols) -> DataFrame:
    return df.select(F.col(key).alias("id"), *[F.col(c).alias(prefix + c) for c in cols])


# ---------------------------------------------------------------------------
# Contract flags (shared by the snapshot and the standalone query)
# ---------------------------------------------------------------------------

def flag_columns(blank_date: dt.date | None = None) -> list[Column]:
    """Flag/date columns over a frame carrying the joined flag sources."""
    return [
        F.when(F.col("last_decisioned_ca_st_key").isin(list(APPROVED_STATUS_KEYS)), 1).otherwise(0).alias("is_app"),
        F.when(F.col("last_decisioned_ca_st_key").isin(list(APPROVAL_DATE_STATUS_KEYS)), F.col("da_full_date"))
        .otherwise(_blank_date(blank_date)).alias("app_date"),
        F.when(F.col("ca_st_key") == FUNDED_STATUS_KEY, 1).otherwise(0).alias("is_fun"),
        F.when(F.col("ca_st_key") == FUNDED_STATUS_KEY, F.col("df_full_date"))
        .otherwise(_blank_date(blank_date)).alias("fun_date"),
        F.coalesce(F.col("fd_have_a_co_app"), F.lit(0)).alias("have_a_co_app"),
        F.coalesce(F.col("dq_d_flag"), F.lit(0)).alias("d_flag"),
        _flag("def_id").alias("def_flag"),
        F.col("def_def_from_date").alias("def_from_date"),
        F.col("def_def_until_date").alias("def_until_date"),
        _flag("md_id").alias("major_dgg"),
        _flag("pb_id").alias("prev_bkr"),
        _flag("ee_most_recent_app").alias("exposure_exce"),
    ]


FLAG_NAMES = (
    "is_app", "app_date", "is_fun", "fun_date", "have_a_co_app", "d_flag", "def_flag", "def_from_date",
    "def_until_date", "major_dgg", "prev_bkr", "exposure_exce",
)


def _date_role(date_dim: DataFrame, prefix: str) -> DataFrame:
    return date_dim.select(F.col("date_key").alias(f"{prefix}_date_key"), F.col("full_date").alias(f"{prefix}_full_date"))


def _flag_sources(base: DataFrame, s: SnapshotSources, as_of: dt.date, funding: DataFrame, audit: KeyAudit | None) -> DataFrame:
    """Left joins feeding ``flag_columns`` (``base`` carries ``id``; ``funding`` is
    the funding digest prefixed ``fd_``)."""
    ldef = watched(audit, _prefixed(s.l_def, "id", "def_", ["id", "def_from_date", "def_until_date"]), ["id"], "ca_l_def")
    exp = watched(audit, _prefixed(s.exposure, "most_recent_app", "ee_", ["most_recent_app"]), ["id"], "exposure")
    dq = digests.delinquency_digest(s.delinq_summary, s.delinq_detail, as_of)
    j = base.join(funding, "id", "left")
    j = j.join(_prefixed(dq, "id", "dq_", ["d_flag", "first_i_due_date"]), "id", "left")
    j = j.join(ldef, "id", "left")
    j = j.join(facts.major_derogatory(s.major_dgg).select("id", F.col("id").alias("md_id")), "id", "left")
    j = j.join(facts.prior_bankruptcy(s.bureau).select("id", F.col("id").alias("pb_id")), "id", "left")
    j = j.join(exp, "id", "left")
    return j


def _funding(s: SnapshotSources, audit: KeyAudit | None) -> DataFrame:
    fd = digests.funding_digest(s.funding, list(FUNDING_PASS_THROUGH))
    if audit:
        fd = audit.watch_count(fd, "n_prim", ["id"], "primary funding row")
    return fd.select("id", F.col("have_a_co_app").alias("fd_have_a_co_app"),
                     *[F.col(f"prim.{c}").alias(f"ino_{c}") for c in FUNDING_PASS_THROUGH])


def contract_flags(s: SnapshotSources, as_of: dt.date, blank_date: dt.date | None = None, audit: KeyAudit | None = None) -> DataFrame:
    """``id`` + the twelve flag/date columns, for every contract (date roles joined
    left so no contract is dropped)."""
    base = s.ca.select("id", "ca_st_key", "last_decisioned_ca_st_key", "last_decisioned_date_key", "funing_date_key")
    base = base.join(_date_role(s.date_dim, "da"), F.col("last_decisioned_date_key") == F.col("da_date_key"), "left")
    base = base.join(_date_role(s.date_dim, "df"), F.col("funing_date_key") == F.col("df_date_key"), "left")
    fd = _funding(s, audit).select("id", "fd_have_a_co_app")
    j = _flag_sources(base, s, as_of, fd, audit)
    return j.select("id", *flag_columns(blank_date))


# ---------------------------------------------------------------------------
# Wide snapshot
# ---------------------------------------------------------------------------

# fixed values: output column -> source column, in target order (102 columns). Sources are
# prefixed by the join that supplies them: ca_ contract, ino_ primary funding
# row, x_ derived in this module.
SNAPSHOT_COLUMNS: tuple[tuple[str, str], ...] = (
    ("id", "id"), ("current_s_name", "s_ca_s_name"), ("sub_date", "ds_full_date"), ("is_app", "x_is_app"),
    ("app_date", "x_app_date"), ("is_fun", "x_is_fun"), ("fun_date", "x_fun_date"),
    ("prim_app_p", "ino_applicant_p"), ("prim_app_age", "ino_c_age"), ("have_a_co_app", "x_have_a_co_app"),
    ("is_comm", "ino_is_comm"), ("make", "ca_vehicle_make"), ("model", "ca_vehicle_model"),
    ("trim", "ca_vehicle_trim"), ("body_style", "ca_vehicle_body_style"), ("l_start_date", "ca_l_start_date"),
    ("l_end_date_original", "ca_l_end_date_original"), ("term", "ca_term"), ("gkrp", "ca_gkrp"),
    ("s_price", "ca_b_s_price"), ("boo_r", "ca_r_value_original"), ("l_rate", "ca_l_rate"),
    ("d_payment", "ca_d_payment"), ("net_t_in", "ca_net_t_in"), ("extended_war", "ca_extended_war"),
    ("payment_f", "ca_payment_f"), ("ins_before_tax", "ca_ins_before_tax"), ("ltv_r", "ino_ltv_r"),
    ("ltv_r_at_decision", "ino_ltv_r_at_decision"), ("tds_r", "ino_tds_r"), ("tds_v", "ino_tds_v"),
    ("pti", "ino_pti"), ("fco_score", "ino_fco_score"), ("fco_score_refresh", "x_fco_score_refresh"),
    ("r_c_rating", "ca_c_rating"), ("r_app_score", "ino_r_app_score"), ("bk_score", "ino_bk_score"),
    ("gross_in", "ino_gross_in"), ("gross_in_combined", "ino_gross_in_combined"), ("d_flag", "x_d_flag"),
    ("first_i_due_date", "fi_first_i_due_date"), ("def_flag", "x_def_flag"), ("def_from_date", "x_def_from_date"),
    ("def_until_date", "x_def_until_date"), ("first_de_user", "dc_first_de_user"),
    ("last_de_user", "dc_last_de_user"), ("poi_waived_flag", "ca_is_in_veri_waived"),
    ("ca_status", "x_ca_status"), ("fca_or_mas", "x_fca_or_mas"), ("sub_date_time", "dc_sub_date_time"),
    ("last_app_date_time", "la_last_app_date_time"), ("fun_date_time", "lf_fun_date_time"),
    ("first_decision_date_time", "dc_first_decision_date_time"), ("first_decision_s", "dc_first_decision_s"),
    ("last_decision_date_time", "dc_last_decision_date_time"), ("last_decision_s", "dc_last_decision_s"),
    ("cou_of_submits", "sc_cou_of_submits"), ("tr_year", "ca_tr_year"),
    ("amount_to_be_am_cap", "ca_amount_to_be_am_cap"), ("b_rate", "ca_b_rate"), ("le_fee_rate", "ca_le_fee_rate"),
    ("lo_re_value", "ca_lo_re_value"), ("cpp_re_value", "ca_cpp_re_value"),
    ("oem_sub_amount_before_tax", "ca_oem_sub_amount_before_tax"), ("oem_sub_amount", "ca_oem_sub_amount"),
    ("fun_sub_amount", "ca_fun_sub_amount"), ("wf_state_name", "wf_wf_state_name"),
    ("up_date_time", "wf_up_date_time"), ("vin", "la_vin"), ("vehicle_year", "ca_vehicle_year"),
    ("msrp", "ino_gkrp_msrp"), ("ds_name", "ca_ds_name"), ("d_pro", "ca_d_pro"), ("ams_name", "am_ams_name"),
    ("c_care_flag", "ca_is_ewt_currently_sub"), ("region", "dl_pro"), ("total_d_under_ams", "u_total_d_under_ams"),
    ("mo_ins_before_tax", "ca_mo_ins_before_tax"), ("std_or_alt", "x_std_or_alt"),
    ("accident_health_insurance", "ca_accident_health_insurance"),
    ("critical_illness_insurance", "ca_critical_illness_insurance"), ("returningcflag", "rc_returningcflag"),
    ("re_program", "ra_re_program"), ("re_program_start_date", "ra_re_program_start_date"),
    ("original_fun_pac_date_re", "op_original_fun_pac_date_re"), ("tdsr_last_decision", "ino_tds_r_at_decision"),
    ("total_an_km", "ca_total_an_km"), ("sec_deposit", "ca_sec_deposit"), ("up_by", "wf_up_by"),
    ("r_value_original", "ca_r_value_original"), ("l_end_date", "ca_l_end_date"), ("d_key", "ca_d_key"),
    ("ve_delivery_date", "ca_ve_delivery_date"), ("major_dgg", "x_major_dgg"), ("prev_bkr", "x_prev_bkr"),
    ("prim_an_income", "x_prim_an_income"), ("co_app_an_income", "x_co_app_an_income"),
    ("co_si_an_income", "x_co_si_an_income"), ("funer", "fb_funer"), ("exposure_exce", "x_exposure_exce"),
    ("boo_by", "fb_boo_by"), ("current_disp_status", "dr_current_status"),
)

CONTRACT_PASS_THROUGH = tuple(sorted({src[3:] for _, src in SNAPSHOT_COLUMNS if src.startswith("ca_")}))
FUNDING_PASS_THROUGH = tuple(sorted({src[4:] for _, src in SNAPSHOT_COLUMNS if src.startswith("ino_")}))


def _scoped(s: SnapshotSources, ids: DataFrame) -> SnapshotSources:
    """The sources with every log reduced to rows of contracts in ``ids`` or of their applications."""
    words = scope_bits(ids, "id")
    app = reduced(s.app.select("application_id", "ca_id"), "ca_id", words)
    app_words = scope_bits(app, "application_id")
    return replace(
        s, app=app,
        status_log=reduced(s.status_log, "id", words), delinq_detail=reduced(s.delinq_detail, "contract_number", words),
        funding=reduced(s.funding, "application_no", words), trans_return=reduced(s.trans_return, "id", words),
        decisions=reduced(s.decisions, "applicationid", app_words), ino_c=reduced(s.ino_c, "applicationid", app_words),
        history_t=reduced(s.history_t, "application_id", app_words),
    )


def wide_contract_snapshot(
    s: SnapshotSources, as_of: dt.date, blank_date: dt.date | None = None, audit: KeyAudit | None = None,
    scope_logs: bool = False,
) -> DataFrame:
    """The 102-column contract snapshot for contracts with a submission date key > 0.

    Shuffles: one per log digest (pre-aggregated), one for the scoped contract
    fact; the fact-to-digest joins are co-partitioned on ``id``. Dimension joins
    are left to the planner (broadcast when its size estimate is under
    ``spark.sql.autoBroadcastJoinThreshold``, or when AQE measures it small).

    ``scope_logs`` drops the log rows of contracts out of scope at each log's scan, before it is folded
    (``operators.scope``). It costs a scan of the contract keys and of the bridge, so it pays where many
    contracts of the logs are out of scope.

    ``audit`` watches every key that must be unique inside these same joins; ask its
    ``check()`` once the snapshot is written.
    """
    keys = ["ca_st_key", "last_decisioned_ca_st_key", "sub_date_key", "last_decisioned_date_key",
            "funing_date_key", "d_key", "mk_program_detail_id", "funing_port_key"]
    fact = s.ca.filter(F.col("sub_date_key") > 0).select(
        "id", *keys, *[F.col(c).alias(f"ca_{c}") for c in CONTRACT_PASS_THROUGH]
    )

    if scope_logs:
        s = _scoped(s, fact.select("id"))

    # inner joins to dimensions first (they can only drop rows)
    status = s.ca_status.select("ca_st_key", F.col("ca_s_name").alias("s_ca_s_name"))
    j = fact.join(watched(audit, status, ["ca_st_key"], "contract statuses"), "ca_st_key", "inner")
    dates = watched(audit, s.date_dim.select("date_key", "full_date"), ["date_key"], "date dimension")
    for role, key in (("ds", "sub_date_key"), ("da", "last_decisioned_date_key"), ("df", "funing_date_key")):
        j = j.join(_date_role(dates, role), F.col(key) == F.col(f"{role}_date_key"), "inner")
    dealer = s.dealer.select("d_key", F.coalesce(F.col("ams_key"), F.lit(0)).alias("_ams_key"), F.col("pro").alias("dl_pro"))
    per_mgr = facts.dealers_per_manager(s.dealer, s.ams, s.ca).select(
        F.col("ams_key").alias("_ams_key"), F.col("total_d_under_ams").alias("u_total_d_under_ams")
    )
    # dealer, manager and dealer count become one table, so the fact meets one join for all three
    managers = s.ams.select(F.col("ams_key").alias("_ams_key"), F.col("ams_name").alias("am_ams_name"))
    dealer = dealer.join(watched(audit, managers, ["_ams_key"], "managers"), "_ams_key", "left")
    dealer = dealer.join(per_mgr, "_ams_key", "left")
    j = j.join(watched(audit, dealer, ["d_key"], "dealers"), "d_key", "inner")
    programs = s.mk_program.select("mk_program_detail_id", "mk_program_name")
    j = j.join(watched(audit, programs, ["mk_program_detail_id"], "programs"), "mk_program_detail_id", "left")
    # the joins below shuffle the fact on id anyway; a contract that repeats there repeats in its source
    j = watched(audit, j, ["id"], "contracts", joined_to=False)

    # per-contract digests, all keyed by id
    j = _flag_sources(j, s, as_of, _funding(s, audit), audit)
    j = j.join(_prefixed(facts.max_current_score(s.trans_return), "id", "catr_", ["highest_fco"]), "id", "left")
    sl = digests.status_log_digest(s.status_log)
    app = watched(audit, s.app.select("application_id", "ca_id"), ["application_id"], "application bridge")
    j = j.join(_prefixed(sl, "id", "sl_", ["cou_of_submits", "fun_date_time", "first_package_time"]), "id", "left")
    j = j.join(_prefixed(digests.decision_digest(s.decisions, app), "id", "dd_", ["first_dec", "last_dec", "last_app"]), "id", "left")
    j = j.join(_prefixed(digests.workflow_digest(s.history_t, app), "id", "wd_", ["last_wf", "fun", "boo"]), "id", "left")
    lows = [f"low_{p}" for p in RELATION_TYPES.values()]
    j = j.join(_prefixed(digests.customer_row_digest(s.ino_c, app), "id", "cr_", ["returningcflag", *lows]), "id", "left")
    ra = watched(audit, _prefixed(s.res_adj, "id", "ra_", ["re_program", "re_program_start_date"]), ["id"], "res_adj")
    j = j.join(ra, "id", "left")
    dr = watched(audit, _prefixed(s.dis_report, "contract_id", "dr_", ["current_status"]), ["id"], "dis_report")
    j = j.join(dr, "id", "left")

    booked = F.col("ca_st_key") == BOOKED_STATUS_KEY
    submitted = F.col("sl_cou_of_submits").isNotNull()
    derived = [c.alias("x_" + n) for c, n in zip(flag_columns(blank_date), FLAG_NAMES)]
    derived += [
        F.col("dq_first_i_due_date").alias("fi_first_i_due_date"),
        F.coalesce(F.col("catr_highest_fco").cast("string"), F.lit(NOT_APPLICABLE)).alias("x_fco_score_refresh"),
        status_label().alias("x_ca_status"),
        fca_or_mas().alias("x_fca_or_mas"),
        std_or_alt().alias("x_std_or_alt"),
        F.col("sl_cou_of_submits").alias("sc_cou_of_submits"),
        F.col("sl_fun_date_time").alias("lf_fun_date_time"),
        F.when(booked, F.col("sl_first_package_time")).alias("op_original_fun_pac_date_re"),
        F.col("dd_last_app.decisiondate").alias("la_last_app_date_time"),
        F.col("dd_last_app.vin").alias("la_vin"),
        F.col("wd_last_wf.wf_state_name").alias("wf_wf_state_name"),
        F.col("wd_last_wf.up_date_time").alias("wf_up_date_time"),
        F.col("wd_last_wf.up_by").alias("wf_up_by"),
        F.when(booked, F.col("wd_fun.up_by")).alias("fb_funer"),
        F.when(booked, F.col("wd_boo.up_by")).alias("fb_boo_by"),
        F.col("cr_returningcflag").alias("rc_returningcflag"),
    ]
    # first/last final decision only for contracts with submit rows
    for side, src in (("first", "dd_first_dec"), ("last", "dd_last_dec")):
        derived += [
            F.when(submitted, F.col(f"{src}.decisiondate")).alias(f"dc_{side}_decision_date_time"),
            F.when(submitted, F.col(f"{src}.decisiondescription")).alias(f"dc_{side}_decision_s"),
            F.when(submitted, F.col(f"{src}.canalyst")).alias(f"dc_{side}_de_user"),
        ]
    derived.append(F.when(submitted, F.col("dd_first_dec.subdate")).alias("dc_sub_date_time"))
    for prefix in RELATION_TYPES.values():
        low = F.col(f"cr_low_{prefix}")
        derived.append(
            F.when(F.col("ino_tds_v").isNull(), annualised(low["ginomefre"], low["ginome"]))
            .otherwise(low["antotal"]).alias(f"x_{prefix}_an_income")
        )
    j = j.select("*", *derived)
    return j.select(*[F.col(src).alias(out) for out, src in SNAPSHOT_COLUMNS])
