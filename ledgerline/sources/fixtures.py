"""Fixture views: the reference's source tables mapped onto the supplied test tables.

Contract = customer, application = order, workflow log row = lineitem,
status log = events. Each view is one SQL text that runs unchanged in Spark
(``spark.sql(text, **dataframes)``) and in DuckDB (as a CTE), so the library's
Spark plans and the SQL oracles read exactly the same rows. Only the two
dialect-specific helpers (seconds arithmetic, date keys) differ.

Pass-through attributes the supplied tables do not carry (vehicle, rate and
insurance columns of the contract; ratio and score columns of the funding row)
are generated by a rule from the customer row, so the wide snapshot has real
values to carry through its joins.
"""

from __future__ import annotations

from functools import lru_cache

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# Declared schemas of the supplied tables: reading with a schema skips the
# footer-sampling inference job per table.
BASE_SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
        "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
        "l_shipdate TIMESTAMP_NTZ"
    ),
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


def _secs(dialect: str, ts: str, n: str) -> str:
    if dialect == "spark":
        return f"({ts} + make_dt_interval(0, 0, 0, cast({n} as int)))"
    return f"({ts} + to_seconds(cast({n} as bigint)))"


def _key(ts: str) -> str:
    return f"cast(year({ts}) * 10000 + month({ts}) * 100 + day({ts}) as int)"


# contract pass-through attributes: (column, kind). Values come from a rule.
CONTRACT_ATTRIBUTES = (
    ("vehicle_make", "str"), ("vehicle_model", "str"), ("vehicle_trim", "str"),
    ("vehicle_body_style", "str"), ("l_start_date", "date0"), ("l_end_date_original", "date1"),
    ("term", "int"), ("gkrp", "dec"), ("b_s_price", "dec"), ("r_value_original", "dec"),
    ("l_rate", "dec"), ("d_payment", "dec"), ("net_t_in", "dec"), ("extended_war", "dec"),
    ("payment_f", "str"), ("ins_before_tax", "dec"), ("c_rating", "str"),
    ("is_in_veri_waived", "int"), ("tr_year", "int"), ("amount_to_be_am_cap", "dec"),
    ("b_rate", "dec"), ("le_fee_rate", "dec"), ("lo_re_value", "dec"), ("cpp_re_value", "dec"),
    ("oem_sub_amount_before_tax", "dec"), ("oem_sub_amount", "dec"), ("fun_sub_amount", "dec"),
    ("vehicle_year", "int"), ("ds_name", "str"), ("d_pro", "str"), ("is_ewt_currently_sub", "int"),
    ("mo_ins_before_tax", "dec"), ("accident_health_insurance", "dec"),
    ("critical_illness_insurance", "dec"), ("total_an_km", "int"), ("sec_deposit", "dec"),
    ("l_end_date", "date1"), ("ve_delivery_date", "date0"),
)

# funding-row pass-through attributes (applicant level)
FUNDING_ATTRIBUTES = (
    ("applicant_p", "str"), ("c_age", "int"), ("ltv_r", "dec"), ("ltv_r_at_decision", "dec"),
    ("tds_r", "dec"), ("pti", "dec"), ("fco_score", "int"), ("r_app_score", "int"),
    ("bk_score", "int"), ("gross_in", "dec"), ("gross_in_combined", "dec"),
    ("gkrp_msrp", "dec"), ("tds_r_at_decision", "dec"),
)


def _attribute_expr(position: int, name: str, kind: str, key: str, amount: str, d0: str, d1: str) -> str:
    """Deterministic value for a generated attribute; ``position`` varies the rule."""
    mod = 3 + position % 17
    if kind == "str":
        return f"concat('{name}_', cast({key} % {mod} as string)) as {name}"
    if kind == "int":
        return f"cast({key} % {mod * 7} as int) as {name}"
    if kind == "dec":
        return f"cast(cast({amount} as decimal(18,2)) * {position + 1} as decimal(18,2)) as {name}"
    # another day for each column, so that swapped columns show
    return f"cast({d0 if kind == 'date0' else d1} + interval '{position}' day as date) as {name}"


def _view_sql(dialect: str) -> dict[str, str]:
    secs = lambda ts, n: _secs(dialect, ts, n)
    shipped = secs("l_shipdate", "(l_partkey * 7919 + l_suppkey * 104729) % 86400")
    contract_attrs = ",\n  ".join(
        _attribute_expr(i, n, k, "c_custkey", "c_acctbal", "first_ts", "last_ts")
        for i, (n, k) in enumerate(CONTRACT_ATTRIBUTES)
    )
    funding_attrs = ",\n  ".join(
        _attribute_expr(i, n, k, "(c_custkey + k)", "c_acctbal", "", "")
        for i, (n, k) in enumerate(FUNDING_ATTRIBUTES)
    )
    return {
        "app": "SELECT o_orderkey AS application_id, o_custkey AS ca_id FROM {orders}",
        "cust_dates": (
            "SELECT o_custkey AS ca_id, min(o_orderdate) AS first_ts, max(o_orderdate) AS last_ts "
            "FROM {orders} GROUP BY o_custkey"
        ),
        "date_dim": (
            f"SELECT {_key('ts')} AS date_key, cast(ts as date) AS full_date FROM "
            "(SELECT o_orderdate AS ts FROM {orders} UNION SELECT l_shipdate FROM {lineitem}) q"
        ),
        "ca": f"""SELECT c_custkey AS id,
  CASE c_mktsegment WHEN 'BUILDING' THEN 100 WHEN 'AUTOMOBILE' THEN 10 WHEN 'MACHINERY' THEN 4
       WHEN 'HOUSEHOLD' THEN 6 ELSE 11 END AS ca_st_key,
  CASE c_custkey % 7 WHEN 0 THEN 0 WHEN 1 THEN 4 WHEN 2 THEN 5 WHEN 3 THEN 6 WHEN 4 THEN 14
       WHEN 5 THEN 15 END AS last_decisioned_ca_st_key,
  CASE WHEN c_custkey % 10 = 0 THEN 0 ELSE {_key('first_ts')} END AS sub_date_key,
  {_key('last_ts')} AS sending_date_key,
  {_key('first_ts')} AS last_decisioned_date_key,
  {_key('last_ts')} AS funing_date_key,
  c_nationkey AS d_key,
  CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 13 = 0 THEN -1 ELSE cast(c_custkey as int) END AS mk_program_detail_id,
  cast(c_custkey % 2 as int) AS funing_port_key,
  {contract_attrs}
FROM {{customer}} JOIN {{cust_dates}} ON c_custkey = ca_id""",
        "ca_status": (
            "SELECT ca_st_key, concat('S', cast(ca_st_key as string)) AS ca_s_name "
            "FROM (SELECT DISTINCT ca_st_key FROM {ca}) q"
        ),
        "wf_history": f"""SELECT l_orderkey AS application_id,
  {shipped} AS u_date_time,
  CASE l_linenumber WHEN 1 THEN 1 WHEN 2 THEN 0 WHEN 3 THEN 3 WHEN 4 THEN 4 WHEN 5 THEN 9
       WHEN 6 THEN 10 ELSE 62 END AS wf_state_id,
  CASE l_linenumber WHEN 1 THEN 'ReadyForRe' WHEN 2 THEN 'AwaitingAp' WHEN 3 THEN 'DefPen'
       WHEN 4 THEN 'DefNewD' WHEN 5 THEN 'Secu' WHEN 6 THEN 'Fun' ELSE 'Funing' END AS wf_state_name,
  CASE WHEN l_linenumber = 7 THEN 'OtherWFState' ELSE 'AudSendingWFState' END AS wf_state_type_name,
  CASE WHEN l_suppkey % 11 = 0 THEN NULL ELSE concat('A', cast(l_suppkey % 8 as string)) END AS u_by
FROM {{lineitem}}""",
        "wf_history_t": """SELECT application_id,
  CASE WHEN wf_state_name = 'DefNewD' THEN 4 ELSE wf_state_id END AS wf_s_id,
  CASE WHEN wf_state_name = 'DefNewD' THEN 'Boo' ELSE wf_state_name END AS wf_state_name,
  u_date_time AS up_date_time, u_by AS up_by
FROM {wf_history}""",
        "s_c_log": """SELECT event_id AS s_c_log_id, user_id AS id,
  CASE event_type WHEN 'signup' THEN 289 WHEN 'click' THEN 290 WHEN 'purchase' THEN 297
       WHEN 'view' THEN 94 ELSE 1 END AS s_id,
  ts AS created_date_time
FROM {events}""",
        "ino_decisions": f"""SELECT l_orderkey AS applicationid, o_orderdate AS subdate,
  {shipped} AS decisiondate,
  CASE l_linenumber WHEN 1 THEN 'App' WHEN 2 THEN 'Con App' WHEN 3 THEN 'D' WHEN 4 THEN 'C P'
       WHEN 5 THEN 'Doc Re' WHEN 6 THEN 'Boo' ELSE 'Other' END AS decisiondescription,
  CASE WHEN l_suppkey % 11 = 0 THEN NULL WHEN l_suppkey % 7 = 0 THEN 'acp'
       ELSE concat('A', cast(l_suppkey % 8 as string)) END AS analyst,
  CASE WHEN l_partkey % 5 = 0 THEN NULL WHEN l_returnflag = 'R' THEN 'CPP' ELSE 'STD' END AS cdecision,
  concat('VIN', cast(l_partkey as string)) AS vin
FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey""",
        "delinq_detail": """SELECT o_custkey AS contract_number, cast(l_shipdate as date) AS i_due_date,
  CASE WHEN l_linestatus = 'F' OR l_linenumber > 1 THEN cast(l_shipdate as date) END AS i_paid_off
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
        "delinq_summary": """SELECT c_custkey AS id,
  CASE WHEN c_custkey % 9 = 0 THEN 1 WHEN c_custkey % 9 = 1 THEN 0 END AS d_60_day_payments,
  CASE WHEN c_custkey % 14 = 0 THEN 2 ELSE 0 END AS d_over_60_day_payments
FROM {customer}""",
        "trans_return": """SELECT o_custkey AS id, cast(o_orderkey % 900 as string) AS go170,
  CASE WHEN o_orderstatus = 'F' AND o_custkey % 5 > 0 THEN 1 ELSE 0 END AS is_current
FROM {orders}""",
        "ino_c": """SELECT l_orderkey AS applicationid, l_linenumber % 3 + 1 AS relationtype,
  CASE l_returnflag WHEN 'A' THEN 'A' WHEN 'R' THEN 'M'
       ELSE CASE WHEN l_partkey % 4 = 0 THEN NULL ELSE 'W' END END AS ginomefre,
  CASE WHEN l_partkey % 13 = 0 THEN NULL ELSE cast(l_extendedprice as decimal(18,2)) END AS ginome,
  cast(l_quantity as decimal(18,2)) AS antotal,
  CASE WHEN l_suppkey % 10 = 0 THEN 1 ELSE 0 END AS isdeleted,
  CASE WHEN l_suppkey % 97 = 0 THEN 1 ELSE 0 END AS returningcflag,
  l_partkey, l_suppkey
FROM {lineitem}""",
        "funding_data": f"""SELECT c_custkey AS application_no,
  CASE WHEN k = 1 THEN 'Prim' ELSE 'Co' END AS applicant_type,
  k % 2 AS is_comm,
  CASE WHEN c_acctbal < 0 THEN NULL ELSE cast(c_acctbal as decimal(18,2)) END AS tds_v,
  {funding_attrs}
FROM (SELECT c_custkey, c_acctbal, 1 AS k FROM {{customer}} WHERE c_custkey % 20 > 0
      UNION ALL SELECT c_custkey, c_acctbal, 2 FROM {{customer}} WHERE c_custkey % 3 = 0
      UNION ALL SELECT c_custkey, c_acctbal, 3 FROM {{customer}} WHERE c_custkey % 20 = 0) q""",
        "ca_sending_data_ino": """SELECT application_no, CASE WHEN applicant_type = 'Prim' THEN 'Primary' ELSE 'Prim' END AS applicant_type
FROM {funding_data}""",
        "dealer": """SELECT n_nationkey AS d_key, n_name AS ds_name, nullif(n_regionkey, 4) AS ams_key,
  CASE WHEN n_nationkey % 9 = 0 THEN 1 WHEN n_nationkey % 9 = 1 THEN NULL ELSE 0 END AS is_test_d,
  CASE WHEN n_nationkey % 6 = 5 THEN 1 END AS is_old_s,
  concat('P', cast(n_regionkey as string)) AS pro
FROM {nation}""",
        "ams": "SELECT r_regionkey AS ams_key, CASE WHEN r_regionkey = 3 THEN NULL ELSE r_name END AS ams_name FROM {region}",
        "mk_program": """SELECT cast(p_partkey as int) AS mk_program_detail_id,
  concat(p_type, CASE WHEN p_partkey % 3 = 0 THEN ' ALT' WHEN p_partkey % 3 = 1 THEN ' alt' ELSE ' std' END)
    AS mk_program_name
FROM {part}""",
        # sparse sides: there are fewer suppliers than contracts, and every supplier row counts
        "l_def": """SELECT s_suppkey * 11 AS id,
  make_date(1999, cast(1 + s_suppkey % 6 as int), cast(1 + s_suppkey % 28 as int)) AS def_from_date,
  make_date(1999, cast(7 + s_suppkey % 6 as int), cast(1 + s_suppkey % 27 as int)) AS def_until_date
FROM {supplier}""",
        "major_dgg": "\nUNION ALL ".join(
            f"""SELECT (s_suppkey * 3) % 97 * 5 + {k} AS id,
  CASE (s_suppkey + {k}) % 4 WHEN 1 THEN 'O' WHEN 2 THEN NULL ELSE 'X' END AS ptype
FROM {{supplier}}"""
            for k in (0, 2, 3)
        ),
        "bureau": """SELECT c_custkey AS id,
  CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE cast(c_custkey % 3 as int) END AS prebankre
FROM {customer}""",
        "res_adj": """SELECT s_suppkey * 7 AS id, concat('P', cast(s_suppkey as string)) AS re_program,
  make_date(2000, cast(1 + s_suppkey % 12 as int), cast(1 + s_suppkey % 28 as int)) AS re_program_start_date
FROM {supplier}""",
        "exposure": "SELECT s_suppkey * 5 AS most_recent_app FROM {supplier}",
        "dis_report": "SELECT s_suppkey * 9 AS contract_id, concat('Open', cast(s_nationkey as string)) AS current_status FROM {supplier}",
    }


VIEW_DEPS = {
    "app": ("orders",), "cust_dates": ("orders",), "date_dim": ("orders", "lineitem"),
    "ca": ("customer", "cust_dates"), "ca_status": ("ca",), "wf_history": ("lineitem",),
    "wf_history_t": ("wf_history",), "s_c_log": ("events",), "ino_decisions": ("lineitem", "orders"),
    "delinq_detail": ("lineitem", "orders"), "delinq_summary": ("customer",), "trans_return": ("orders",),
    "ino_c": ("lineitem",), "funding_data": ("customer",), "ca_sending_data_ino": ("funding_data",), "dealer": ("nation",), "ams": ("region",),
    "mk_program": ("part",), "l_def": ("supplier",), "major_dgg": ("supplier",), "bureau": ("customer",),
    "res_adj": ("supplier",), "exposure": ("supplier",), "dis_report": ("supplier",),
}
VIEWS = tuple(VIEW_DEPS)


@lru_cache(maxsize=2)
def view_sql(dialect: str) -> dict[str, str]:
    return _view_sql(dialect)


def _closure(names) -> list[str]:
    """Views needed for ``names`` (dependencies first)."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in BASE_TABLES or name in order:
            return
        for dep in VIEW_DEPS[name]:
            visit(dep)
        order.append(name)

    for n in names:
        visit(n)
    return order


def duckdb_with(views, ctes: list[tuple[str, str]] | None = None) -> str:
    """``WITH`` clause holding the fixture views (and extra query CTEs) for DuckDB."""
    sql = view_sql("duckdb")
    parts = []
    for name in _closure(views):
        body = sql[name].format(**{d: d for d in VIEW_DEPS[name]})
        parts.append(f"{name} AS (\n{body}\n)")
    for name, body in ctes or ():
        parts.append(f"{name} AS (\n{body}\n)")
    return "WITH " + ",\n".join(parts) + "\n"


class FixtureSources:
    """Lazily built fixture views over ``{sf_dir}/{table}.parquet``.

    ``sources.df("wf_history")`` returns a DataFrame; nothing runs until an action.
    """

    def __init__(self, spark, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._cache: dict[str, object] = {}

    def table(self, name: str):
        if name not in self._cache:
            self._cache[name] = self.spark.read.schema(BASE_SCHEMAS[name]).parquet(f"{self.sf_dir}/{name}.parquet")
        return self._cache[name]

    def df(self, name: str):
        if name in BASE_TABLES:
            return self.table(name)
        if name not in self._cache:
            deps = {d: self.df(d) for d in VIEW_DEPS[name]}
            self._cache[name] = self.spark.sql(view_sql("spark")[name], **deps)
        return self._cache[name]

    __getitem__ = df
