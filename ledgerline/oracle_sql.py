"""DuckDB SQL oracles, derived from the rules of FIXTURES.md part B in another way than the plans.

Where a plan folds structs or numbers rows, an oracle sorts a list and takes an element, joins the
nearest later row (ASOF) or filters an aggregate; codes, labels, segments and the snapshot's columns
stand here as their own small tables and do not come from the library. The fixture views are the
only thing both sides share.
"""

from __future__ import annotations

from ledgerline.sources.fixtures import duckdb_with

# the test parameters and fixed codes
FIRST, LAST, AS_OF = "DATE '1996-01-01'", "DATE '2001-12-31'", "DATE '1998-06-01'"
CLASSES = "(VALUES (1, 'ready'), (0, 'awaiting'), (3, 'def_pen'), (4, 'def_new_doc'), (9, 'funded'), (10, 'funded')) c(wf_state_id, state_class)"
ROLES = """(VALUES ('ready', 'ready', true), ('ready', 'awaiting', false), ('ready', 'def_pen', false), ('ready', 'funded', false),
    ('def_new_doc', 'def_new_doc', true), ('def_new_doc', 'def_pen', false), ('def_new_doc', 'funded', false)) r(track, state_class, opens)"""
SEGMENT_TABLE = """(VALUES (1, 'From Ready for Re to Fun', 'ready', ['Secu', 'Fun']), (2, 'From Ready for Re to Awaiting Ap', 'ready', ['AwaitingAp']),
    (3, 'From Ready for Re to Def Pen', 'ready', ['DefPen']), (4, 'From Def New D to Def Pen', 'def_new_doc', ['DefPen']),
    (5, 'From Def New D to Fun', 'def_new_doc', ['Secu', 'Fun'])) s(seq, group_name, track, ends)"""
MULTIPLES = "(VALUES ('W', 52), ('M', 12), ('A', 1)) m(ginomefre, times)"


def _hms(x: str) -> str:
    return f"format('{{:02d}}:{{:02d}}:{{:02d}}', ({x}) // 3600, ({x}) // 60 % 60, ({x}) % 60)"


def _open_seconds(a: str, b: str) -> str:
    """Seconds from 9 to 17 o'clock on weekdays but New Year between two times, day by day in the row itself."""
    return f"""CAST(coalesce(list_sum([greatest(0, epoch(least({b}, d + INTERVAL 17 HOUR)) - epoch(greatest({a}, d + INTERVAL 9 HOUR)))
    FOR d IN generate_series(date_trunc('day', {a}), {b}, INTERVAL 1 DAY) IF isodow(d) < 6 AND strftime(d, '%m-%d') <> '01-01']), 0) AS BIGINT)"""


def _open_by_weekday(a: str, b: str) -> str:
    """The same day by day with the intervals of each day."""
    return f"""CAST(coalesce(list_sum(flatten([[greatest(0, epoch(least({b}, d + to_seconds(x[2]))) - epoch(greatest({a}, d + to_seconds(x[1]))))
      FOR x IN CASE WHEN d = TIMESTAMP '1997-12-24' THEN [[32400, 39600]] WHEN strftime(d, '%m-%d') = '01-01' THEN []
        WHEN isodow(d) < 5 THEN [[32400, 45000], [47700, 61200]] WHEN isodow(d) = 5 THEN [[32400, 46800]] WHEN isodow(d) = 6 THEN [[36000, 43200]] ELSE [] END]
    FOR d IN generate_series(date_trunc('day', {a}), {b}, INTERVAL 1 DAY)])), 0) AS BIGINT)"""


# opening intervals over the whole time, overlapping ones merged
OPENINGS = (
    "openings",
    """SELECT min(a) AS a, max(z) AS z FROM (SELECT *, sum(fresh) OVER (ORDER BY a, z ROWS UNBOUNDED PRECEDING) AS g
    FROM (SELECT *, CASE WHEN a > max(z) OVER (ORDER BY a, z ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS fresh
      FROM (SELECT t + to_hours(8 + day(t) % 3) AS a, t + INTERVAL 12 HOUR AS z FROM (SELECT full_date::TIMESTAMP AS t FROM date_dim) WHERE isodow(t) < 6
        UNION ALL SELECT t + INTERVAL 690 MINUTE, t + INTERVAL 15 HOUR + to_minutes(day(t)) FROM (SELECT full_date::TIMESTAMP AS t FROM date_dim) WHERE isodow(t) < 6
        UNION ALL SELECT t + INTERVAL 22 HOUR, t + INTERVAL 26 HOUR FROM (SELECT full_date::TIMESTAMP AS t FROM date_dim) WHERE isodow(t) = 5))) GROUP BY g""",
)

E_VIEWS = ["ca", "date_dim", "dealer", "wf_history", "app", "ca_status"]
SCOPE = (
    "scope",
    f"""SELECT id AS ca_id, full_date FROM date_dim JOIN (
    SELECT id, sending_date_key AS date_key FROM ca WHERE ca_st_key = 100
      AND sub_date_key IN (SELECT date_key FROM date_dim) AND d_key IN (SELECT d_key FROM dealer)) USING (date_key)
  WHERE full_date >= {FIRST} AND full_date <= {LAST}""",
)
EVENTS = (
    "ev",
    f"""SELECT ca_id, state_class, wf_state_name AS st, u_date_time AS t, u_by AS who
  FROM wf_history JOIN {CLASSES} USING (wf_state_id) JOIN app USING (application_id)
  WHERE wf_state_type_name = 'AudSendingWFState' AND CAST(u_date_time AS DATE) >= {FIRST} AND ca_id IN (SELECT ca_id FROM scope)""",
)
PAIRED = [
    SCOPE,
    EVENTS,
    ("placed", f"SELECT track, opens, ev.* FROM ev JOIN {ROLES} USING (state_class)"),
    # a time at which several starts meet has no outcome, and shows the least of them
    (
        "opening",
        """SELECT track, ca_id, t, count(*) AS together, list({'s': st, 'w': who} ORDER BY who NULLS FIRST, st)[1] AS x,
    lead(t) OVER (PARTITION BY track, ca_id ORDER BY t) AS until FROM placed WHERE opens GROUP BY track, ca_id, t""",
    ),
    ("closing", "SELECT track, ca_id, t AS t2, list({'s': st, 'w': who} ORDER BY st, who NULLS FIRST)[1] AS y FROM placed WHERE NOT opens GROUP BY track, ca_id, t"),
    (
        "nearest",
        """SELECT o.*, CASE WHEN together = 1 AND (until IS NULL OR t2 < until) THEN t2 END AS t2, y
  FROM opening o ASOF LEFT JOIN closing c ON o.track = c.track AND o.ca_id = c.ca_id AND o.t <= c.t2""",
    ),
    (
        "pair",
        f"""SELECT track, ca_id, x.s AS type_1, t AS type_1_time, x.w AS type_1_by,
    CASE WHEN t2 IS NOT NULL THEN y.s END AS type_2, t2 AS type_2_time, CASE WHEN t2 IS NOT NULL THEN y.w END AS type_2_by,
    CASE WHEN t2 IS NOT NULL THEN {_open_seconds('t', 't2')} END AS type_1_to_type_2_duration FROM nearest""",
    ),
]


def _e(sql: str, ctes=PAIRED) -> str:
    return duckdb_with(E_VIEWS, ctes) + sql


def _stats(grain: str) -> str:
    return _e(f"""SELECT *, {_hms('total // n')} AS avg_t_hms FROM (
  SELECT seq, group_name, {grain}, count(DISTINCT ca_id) AS unique_con, count(*) AS count_of_ac,
      CAST(sum(type_1_to_type_2_duration) AS BIGINT) AS total, count(type_1_to_type_2_duration) AS n
  FROM pair JOIN {SEGMENT_TABLE} ON s.track = pair.track AND list_contains(ends, type_2) GROUP BY ALL)""").replace(
        "SELECT *, format", "SELECT * EXCLUDE (total, n), format", 1
    )


ANALYST, MONTH = "type_2_by AS se_analyst", "CAST(strftime(type_2_time, '%Y%m') AS INTEGER) AS sending_mt"
DECIDED = ["ino_decisions"]

ORACLES: dict[str, str] = {
    "sendings_in_window": _e("SELECT ca_id, full_date FROM scope", [SCOPE]),
    "wf_events_by_state": _e("""SELECT ca_id, state_class, e.st AS wf_state_name, e.t AS u_date_time, e.who AS u_by, seq_no
  FROM (SELECT ca_id, state_class, unnest(l) AS e, CAST(generate_subscripts(l, 1) AS BIGINT) AS seq_no
    FROM (SELECT ca_id, state_class, list({'st': st, 't': t, 'who': who} ORDER BY t, who NULLS FIRST, st) AS l FROM ev GROUP BY ALL))""", [SCOPE, EVENTS]),
    "ready_to_next_outcome": _e("SELECT * EXCLUDE (track) FROM pair WHERE track = 'ready'"),
    "defnew_to_next_outcome": _e("SELECT * EXCLUDE (track) FROM pair WHERE track = 'def_new_doc'"),
    "business_seconds": duckdb_with(DECIDED) + f"SELECT applicationid, subdate, decisiondate, {_open_seconds('subdate', 'decisiondate')} AS business_seconds FROM ino_decisions",
    "business_seconds_by_weekday": duckdb_with(DECIDED) + f"SELECT applicationid, subdate, decisiondate, {_open_by_weekday('subdate', 'decisiondate')} AS business_seconds FROM ino_decisions",
    "business_seconds_from_table": duckdb_with([*DECIDED, "date_dim"], [OPENINGS]) + """SELECT applicationid, subdate, decisiondate, CAST(coalesce((
    SELECT sum(epoch(least(z, decisiondate)) - epoch(greatest(a, subdate))) FROM openings WHERE a < decisiondate AND z > subdate AND subdate < decisiondate), 0) AS BIGINT) AS business_seconds
  FROM ino_decisions""",
    "format_hms": duckdb_with(DECIDED) + f"""SELECT *, {_hms('seconds')} AS hms
  FROM (SELECT applicationid, subdate, decisiondate, CAST(epoch(decisiondate) - epoch(subdate) AS BIGINT) AS seconds FROM ino_decisions)""",
    "sending_details": _e(f"""SELECT ca_id, ca_s_name AS c_s, type_1, type_1_time, type_1_by, type_2, type_2_time, type_2_by,
    type_1_to_type_2_duration AS type_1_to_type_2_duration_in_seconds,
    CASE WHEN type_2_time IS NOT NULL THEN {_hms('type_1_to_type_2_duration')} END AS type_1_to_type_2_duration_hms, full_date AS fd_date
  FROM (SELECT DISTINCT * EXCLUDE (track) FROM pair) JOIN scope USING (ca_id), (SELECT ca_s_name FROM ca_status WHERE ca_st_key = 100)"""),
    "stats_per_analyst": _stats(ANALYST),
    "stats_per_month": _stats(MONTH),
    "stats_per_analyst_month": _stats(f"{ANALYST}, {MONTH}"),
    "current_wf_state": duckdb_with(["wf_history", "app", "ca", "ca_sending_data_ino"]) + f"""SELECT ca_id, x.s AS wf_state_name, x.t AS u_date_time FROM (
  SELECT ca_id, list({{'t': u_date_time, 's': wf_state_name}} ORDER BY u_date_time DESC, wf_state_name DESC)[1] AS x
  FROM app JOIN wf_history USING (application_id)
  WHERE wf_state_type_name = 'AudSendingWFState' AND CAST(u_date_time AS DATE) >= {FIRST} AND ca_id IN (SELECT id FROM ca)
    AND ca_id IN (SELECT application_no FROM ca_sending_data_ino WHERE applicant_type = 'Primary') GROUP BY ca_id)""",
}

# ---------------------------------------------------------------------------
# per-contract facts: one grouped pass for each log
# ---------------------------------------------------------------------------

FACTS: dict[str, str] = {
    "score": "SELECT id, max(go170) FILTER (WHERE is_current = 1) AS highest_fco FROM trans_return GROUP BY id HAVING count(*) FILTER (WHERE is_current = 1) > 0",
    "owed": f"""SELECT contract_number AS id, count(*) AS rows_, min(i_due_date) AS first_i_due_date,
    count(*) FILTER (WHERE i_paid_off IS NULL AND {AS_OF} - i_due_date > 30) AS over30 FROM delinq_detail GROUP BY ALL""",
    "owing": """SELECT id, rows_, over30, first_i_due_date, late FROM owed JOIN (
    SELECT id, bool_or(coalesce(d_60_day_payments, 0) > 0 OR coalesce(d_over_60_day_payments, 0) > 0) AS late FROM delinq_summary GROUP BY id) USING (id)""",
    "status": """SELECT id, count(s_c_log_id) FILTER (WHERE s_id BETWEEN 289 AND 290) AS cou_of_submits,
    bool_or(s_id BETWEEN 289 AND 290) AS has_submits, bool_or(s_id = 297) AS has_funds,
    max(created_date_time) FILTER (WHERE s_id = 297) AS fun_date_time, min(created_date_time) FILTER (WHERE s_id = 94) AS package FROM s_c_log GROUP BY id""",
    "final": """SELECT id, l[1] AS a, l[-1] AS z FROM (SELECT ca_id AS id,
    list({'d': decisiondate, 's': decisiondescription, 'u': coalesce(analyst, 'Unknown'), 'b': subdate}
      ORDER BY decisiondate NULLS FIRST, decisiondescription NULLS FIRST, coalesce(analyst, 'Unknown'), subdate NULLS FIRST) AS l
  FROM ino_decisions JOIN app ON applicationid = application_id
  WHERE list_contains(['App', 'Con App', 'D', 'C P'], decisiondescription) AND (analyst <> 'acp' OR cdecision <> 'CPP') GROUP BY ca_id)
  WHERE id IN (SELECT id FROM status WHERE has_submits) AND id IN (SELECT id FROM ca)""",
    "approval": """SELECT ca_id AS id, list({'d': decisiondate, 'v': vin} ORDER BY decisiondate DESC NULLS LAST, vin DESC NULLS LAST, decisiondescription DESC NULLS LAST)[1] AS x
  FROM ino_decisions JOIN app ON applicationid = application_id WHERE list_contains(['App', 'Con App', 'Doc Re', 'Boo'], decisiondescription) GROUP BY ca_id""",
    "second": """SELECT application_no, list(is_comm ORDER BY applicant_type <> 'Prim', is_comm NULLS FIRST, tds_v NULLS FIRST)[2] AS is_comm
  FROM funding_data GROUP BY application_no HAVING count(*) > 1""",
    "flow": """SELECT ca_id AS id, list({'s': wf_state_name, 't': up_date_time, 'w': up_by}
    ORDER BY up_date_time DESC NULLS LAST, wf_state_name DESC NULLS LAST, up_by DESC NULLS LAST)[1] AS x
  FROM app LEFT JOIN wf_history_t USING (application_id) GROUP BY ca_id""",
    "manager": """SELECT ams_key, coalesce(ams_name, 'Unknown') AS ams, count(DISTINCT d_key) AS total_d_under_ams
  FROM (SELECT d_key, coalesce(ams_key, 0) AS ams_key FROM dealer WHERE coalesce(is_test_d, 0) + coalesce(is_old_s, 0) = 0) l
    SEMI JOIN ca USING (d_key) JOIN ams USING (ams_key) GROUP BY ALL""",
    "again": "SELECT DISTINCT ca_id AS id, 1 AS returningcflag FROM app WHERE application_id IN (SELECT applicationid FROM ino_c WHERE returningcflag = 1)",
    "package": """SELECT id, package AS original_fun_pac_date_re FROM (SELECT id FROM ca WHERE ca_st_key = 100 AND d_key IN (SELECT d_key FROM dealer))
  LEFT JOIN status USING (id)""",
    "derogatory": "SELECT DISTINCT id FROM major_dgg WHERE ptype IS DISTINCT FROM 'O'",
    "bankrupt": "SELECT DISTINCT id FROM bureau WHERE abs(prebankre) > 0",
    "income": f"""SELECT id, relationtype, x.f AS ginomefre, x.g AS ginome, CAST(x.g * coalesce(times, 12) AS DECIMAL(18, 2)) AS sub_a_inome, x.a AS antotal
  FROM (SELECT ca_id AS id, relationtype, list({{'g': ginome, 'a': antotal, 'f': ginomefre}} ORDER BY ginome NULLS FIRST, antotal NULLS FIRST, ginomefre NULLS FIRST)[1] AS x
    FROM app JOIN ino_c ON application_id = applicationid WHERE isdeleted = 0 AND relationtype BETWEEN 1 AND 3 GROUP BY ALL) LEFT JOIN {MULTIPLES} ON x.f = m.ginomefre""",
    "actor": """SELECT ca_id AS id, wf_state_name, list({'t': up_date_time, 'w': up_by} ORDER BY up_date_time DESC NULLS LAST, up_by DESC NULLS LAST)[1] AS x
  FROM app JOIN wf_history_t USING (application_id) WHERE (wf_s_id, wf_state_name) IN ((62, 'Funing'), (4, 'Boo'))
    AND ca_id IN (SELECT id FROM ca WHERE ca_st_key = 100) GROUP BY ALL""",
    "label": """SELECT id, coalesce(CASE WHEN ca_st_key = 100 THEN 'Boo' WHEN sub_date_key = 0 THEN 'Qu'
      WHEN sub_date_key > 0 THEN coalesce(gone, CASE WHEN last_decisioned_ca_st_key = ca_st_key THEN told END, CASE last_decisioned_ca_st_key WHEN 0 THEN 'Sub' END) END, 'Pen') AS ca_status
  FROM ca LEFT JOIN (VALUES (11, 'Can'), (12, 'Can')) g(k, gone) ON ca_st_key = g.k
    LEFT JOIN (VALUES (4, 'App'), (5, 'App'), (6, 'D')) t(k, told) ON last_decisioned_ca_st_key = t.k""",
    "kind": """SELECT ca.id, list_extract(['Mas', 'FCA'], 1 + CAST(funing_port_key IS NOT DISTINCT FROM 1 AS INTEGER)) AS fca_or_mas,
    list_extract(['Std', 'Alt'], 1 + CAST(coalesce(regexp_matches(mk_program_name, '(?i)alt'), false) AS INTEGER)) AS std_or_alt
  FROM ca LEFT JOIN mk_program USING (mk_program_detail_id)""",
    "flags": """SELECT ca.id, CAST(coalesce(last_decisioned_ca_st_key BETWEEN 14 AND 15, false) AS INTEGER) AS is_app,
    (SELECT full_date FROM date_dim WHERE date_key = last_decisioned_date_key AND last_decisioned_ca_st_key BETWEEN 4 AND 5) AS app_date,
    CAST(ca_st_key = 10 AS INTEGER) AS is_fun, (SELECT full_date FROM date_dim WHERE date_key = funing_date_key AND ca_st_key = 10) AS fun_date,
    CAST(ca.id IN (SELECT application_no FROM second) AS INTEGER) AS have_a_co_app,
    CAST(ca.id IN (SELECT id FROM owing WHERE late OR over30 > 0) AS INTEGER) AS d_flag,
    CAST(l_def.id IS NOT NULL AS INTEGER) AS def_flag, def_from_date, def_until_date,
    CAST(ca.id IN (SELECT id FROM derogatory) AS INTEGER) AS major_dgg, CAST(ca.id IN (SELECT id FROM bankrupt) AS INTEGER) AS prev_bkr,
    CAST(ca.id IN (SELECT most_recent_app FROM exposure) AS INTEGER) AS exposure_exce FROM ca LEFT JOIN l_def ON l_def.id = ca.id""",
}
NEEDS = {"owing": ["owed"], "final": ["status"], "package": ["status"], "flags": ["second", "owing", "derogatory", "bankrupt"]}
T_VIEWS = [
    "ca", "ca_status", "date_dim", "dealer", "ams", "mk_program", "funding_data", "trans_return", "delinq_summary",
    "delinq_detail", "s_c_log", "ino_decisions", "app", "wf_history_t", "ino_c", "l_def", "major_dgg", "bureau",
    "res_adj", "exposure", "dis_report",
]


def _t(sql: str, *names: str) -> str:
    order: list[str] = []

    def add(name: str) -> None:
        for other in NEEDS.get(name, []):
            add(other)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    return duckdb_with(T_VIEWS, [(n, FACTS[n]) for n in order]) + sql


# target column = where its value comes from; a bare name is the contract's or funding row's own
SNAPSHOT = """
id=ca.id; current_s_name=ca_s_name; sub_date=(SELECT full_date FROM date_dim WHERE date_key = ca.sub_date_key); is_app=flags.is_app
app_date=flags.app_date; is_fun=flags.is_fun; fun_date=flags.fun_date; prim_app_p=p.applicant_p; prim_app_age=p.c_age; have_a_co_app=flags.have_a_co_app
is_comm=p.is_comm; make=ca.vehicle_make; model=ca.vehicle_model; trim=ca.vehicle_trim; body_style=ca.vehicle_body_style; l_start_date=ca.l_start_date
l_end_date_original=ca.l_end_date_original; term=ca.term; gkrp=ca.gkrp; s_price=ca.b_s_price; boo_r=ca.r_value_original; l_rate=ca.l_rate
d_payment=ca.d_payment; net_t_in=ca.net_t_in; extended_war=ca.extended_war; payment_f=ca.payment_f; ins_before_tax=ca.ins_before_tax; ltv_r=p.ltv_r
ltv_r_at_decision=p.ltv_r_at_decision; tds_r=p.tds_r; tds_v=p.tds_v; pti=p.pti; fco_score=p.fco_score; fco_score_refresh=coalesce(score.highest_fco, 'N/A')
r_c_rating=ca.c_rating; r_app_score=p.r_app_score; bk_score=p.bk_score; gross_in=p.gross_in; gross_in_combined=p.gross_in_combined; d_flag=flags.d_flag
first_i_due_date=CASE WHEN flags.d_flag = 1 THEN owing.first_i_due_date END; def_flag=flags.def_flag; def_from_date=flags.def_from_date
def_until_date=flags.def_until_date; first_de_user=final.a.u; last_de_user=final.z.u; poi_waived_flag=ca.is_in_veri_waived; ca_status=label.ca_status
fca_or_mas=kind.fca_or_mas; sub_date_time=final.a.b; last_app_date_time=approval.x.d; fun_date_time=status.fun_date_time
first_decision_date_time=final.a.d; first_decision_s=final.a.s; last_decision_date_time=final.z.d; last_decision_s=final.z.s
cou_of_submits=CASE WHEN status.has_submits THEN status.cou_of_submits END; tr_year=ca.tr_year; amount_to_be_am_cap=ca.amount_to_be_am_cap
b_rate=ca.b_rate; le_fee_rate=ca.le_fee_rate; lo_re_value=ca.lo_re_value; cpp_re_value=ca.cpp_re_value; oem_sub_amount_before_tax=ca.oem_sub_amount_before_tax
oem_sub_amount=ca.oem_sub_amount; fun_sub_amount=ca.fun_sub_amount; wf_state_name=flow.x.s; up_date_time=flow.x.t; vin=approval.x.v
vehicle_year=ca.vehicle_year; msrp=p.gkrp_msrp; ds_name=ca.ds_name; d_pro=ca.d_pro; ams_name=ams.ams_name; c_care_flag=ca.is_ewt_currently_sub
region=dealer.pro; total_d_under_ams=manager.total_d_under_ams; mo_ins_before_tax=ca.mo_ins_before_tax; std_or_alt=kind.std_or_alt
accident_health_insurance=ca.accident_health_insurance; critical_illness_insurance=ca.critical_illness_insurance; returningcflag=again.returningcflag
re_program=res_adj.re_program; re_program_start_date=res_adj.re_program_start_date; original_fun_pac_date_re=package.original_fun_pac_date_re
tdsr_last_decision=p.tds_r_at_decision; total_an_km=ca.total_an_km; sec_deposit=ca.sec_deposit; up_by=flow.x.w; r_value_original=ca.r_value_original
l_end_date=ca.l_end_date; d_key=ca.d_key; ve_delivery_date=ca.ve_delivery_date; major_dgg=flags.major_dgg; prev_bkr=flags.prev_bkr
prim_an_income=CASE WHEN p.tds_v IS NULL THEN pay.p1 ELSE pay.t1 END; co_app_an_income=CASE WHEN p.tds_v IS NULL THEN pay.p2 ELSE pay.t2 END
co_si_an_income=CASE WHEN p.tds_v IS NULL THEN pay.p3 ELSE pay.t3 END; funer=act.f; exposure_exce=flags.exposure_exce; boo_by=act.b
current_disp_status=dis_report.current_status
"""


def _snapshot() -> str:
    columns = [c.strip().split("=", 1) for line in SNAPSHOT.strip().split("\n") for c in line.split("; ")]
    select = ",\n    ".join(f"{source} AS {name}" for name, source in columns)
    by_id = " ".join(f"LEFT JOIN {t} ON {t}.id = ca.id" for t in ("flags", "owing", "score", "final", "approval", "status", "flow", "again", "res_adj", "package", "label", "kind"))
    pays = ", ".join(f"any_value(sub_a_inome) FILTER (WHERE relationtype = {k}) AS p{k}, any_value(antotal) FILTER (WHERE relationtype = {k}) AS t{k}" for k in (1, 2, 3))
    return _t(
        f"""SELECT {select}
FROM (SELECT * FROM ca WHERE sub_date_key > 0 AND sub_date_key IN (SELECT date_key FROM date_dim)
    AND last_decisioned_date_key IN (SELECT date_key FROM date_dim) AND funing_date_key IN (SELECT date_key FROM date_dim)) ca
  JOIN ca_status USING (ca_st_key) JOIN dealer USING (d_key)
  LEFT JOIN ams ON ams.ams_key = coalesce(dealer.ams_key, 0) LEFT JOIN manager ON manager.ams_key = coalesce(dealer.ams_key, 0)
  LEFT JOIN (SELECT * FROM funding_data WHERE applicant_type = 'Prim') p ON p.application_no = ca.id
  {by_id}
  LEFT JOIN (SELECT id, {pays} FROM income GROUP BY id) pay ON pay.id = ca.id
  LEFT JOIN (SELECT id, any_value(x.w) FILTER (WHERE wf_state_name = 'Funing') AS f, any_value(x.w) FILTER (WHERE wf_state_name = 'Boo') AS b FROM actor GROUP BY id) act ON act.id = ca.id
  LEFT JOIN dis_report ON dis_report.contract_id = ca.id""",
        "second", "owing", "derogatory", "bankrupt", "flags", "score", "status", "final", "approval", "flow", "again", "package", "label", "kind", "income", "actor", "manager",
    )


ORACLES |= {
    "max_current_score": _t("FROM score", "score"),
    "overdue_30": _t("SELECT id, over30 AS overdue_instalments FROM owing WHERE over30 > 0", "owing"),
    "paid_over_30": _t("SELECT id, rows_ AS detail_rows FROM owing WHERE late", "owing"),
    "delinquency_flag": _t("SELECT id FROM owing WHERE late OR over30 > 0", "owing"),
    "first_due_flagged": _t("SELECT id, first_i_due_date FROM owing WHERE late OR over30 > 0", "owing"),
    "submit_counts": _t("SELECT id, cou_of_submits FROM status SEMI JOIN ca USING (id) WHERE has_submits", "status"),
    "first_last_decision": _t("""SELECT id, a.b AS sub_date_time, a.d AS first_decision_date_time, a.s AS first_decision_s, a.u AS first_de_user,
    z.d AS last_decision_date_time, z.s AS last_decision_s, z.u AS last_de_user FROM final""", "final"),
    "last_approval": _t("SELECT id, x.d AS last_app_date_time, x.v AS vin FROM approval", "approval"),
    "last_funding": _t("SELECT id, fun_date_time FROM status WHERE has_funds", "status"),
    "co_applicant_flag": _t("FROM second", "second"),
    "latest_wf_per_contract": _t("SELECT id, x.s AS wf_state_name, x.t AS up_date_time, x.w AS up_by FROM flow", "flow"),
    "dealers_per_manager": _t("FROM manager", "manager"),
    "returning_customer": _t("FROM again", "again"),
    "original_package_received": _t("FROM package", "package"),
    "major_derogatory": _t("FROM derogatory", "derogatory"),
    "prior_bankruptcy": _t("FROM bankrupt", "bankrupt"),
    "annual_income_by_relation": _t("FROM income", "income"),
    "funder_and_booker": _t("SELECT id, wf_state_name, x.w AS up_by, x.t AS up_date_time FROM actor", "actor"),
    "status_waterfall": _t("FROM label", "label"),
    "contract_flags": _t("FROM flags", "flags"),
    "program_class": _t("FROM kind", "kind"),
    "wide_contract_snapshot": _snapshot(),
}
ORACLES["snapshot_roundtrip"] = ORACLES["wide_contract_snapshot"]


# Output columns widened for the cross-engine comparison (see registry.engine_neutral):
# DECIMAL -> DOUBLE and DATE -> TIMESTAMP, the same on both sides.
_SNAPSHOT_DECIMALS = [
    "gkrp", "s_price", "boo_r", "l_rate", "d_payment", "net_t_in", "extended_war", "ins_before_tax", "ltv_r",
    "ltv_r_at_decision", "tds_r", "tds_v", "pti", "gross_in", "gross_in_combined", "amount_to_be_am_cap", "b_rate",
    "le_fee_rate", "lo_re_value", "cpp_re_value", "oem_sub_amount_before_tax", "oem_sub_amount", "fun_sub_amount",
    "msrp", "mo_ins_before_tax", "accident_health_insurance", "critical_illness_insurance", "tdsr_last_decision",
    "sec_deposit", "r_value_original", "prim_an_income", "co_app_an_income", "co_si_an_income",
]
_SNAPSHOT_DATES = [
    "sub_date", "app_date", "fun_date", "l_start_date", "l_end_date_original", "first_i_due_date", "def_from_date",
    "def_until_date", "re_program_start_date", "l_end_date", "ve_delivery_date",
]
NEUTRAL_CASTS: dict[str, tuple[list[str], list[str]]] = {
    "sendings_in_window": ([], ["full_date"]),
    "sending_details": ([], ["fd_date"]),
    "first_due_flagged": ([], ["first_i_due_date"]),
    "annual_income_by_relation": (["ginome", "sub_a_inome", "antotal"], []),
    "contract_flags": ([], ["app_date", "fun_date", "def_from_date", "def_until_date"]),
    "wide_contract_snapshot": (_SNAPSHOT_DECIMALS, _SNAPSHOT_DATES),
    "snapshot_roundtrip": (_SNAPSHOT_DECIMALS, _SNAPSHOT_DATES),
}


def _neutral(name: str, sql: str) -> str:
    decimals, dates = NEUTRAL_CASTS[name]
    casts = [f"CAST({c} AS DOUBLE) AS {c}" for c in decimals] + [f"CAST({c} AS TIMESTAMP) AS {c}" for c in dates]
    return f"SELECT * REPLACE ({', '.join(casts)}) FROM (\n{sql}\n) neutral_q"


for _name in NEUTRAL_CASTS:
    ORACLES[_name] = _neutral(_name, ORACLES[_name])
