"""Plan shape: no Python in the hot path, no cartesian products, pre-shuffle limits."""

import pytest

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def queries():
    from ledgerline.registry import QUERIES

    return {k: v for k, v in QUERIES.items() if k != "snapshot_roundtrip"}


def test_no_python_udf_or_cartesian(spark, queries):
    for name, q in queries.items():
        p = plan(q(spark, SF))
        for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in p, (name, bad)


def test_top1_windows_are_limited_before_the_shuffle(spark, queries):
    for name in ("last_funding", "co_applicant_flag"):
        assert "WindowGroupLimit" in plan(queries[name](spark, SF)), name


def _shuffles(node, out):
    """Shuffle exchanges of a physical plan (a reused exchange is not descended into)."""
    if node.nodeName() == "Exchange" and "REPARTITION_BY_COL" in node.toString().split("\n")[0]:
        out.append(node)
    it = node.children().iterator()
    while it.hasNext():
        _shuffles(it.next(), out)
    return out


def test_pairing_shuffles_events_once(spark):
    from ledgerline.registry import Ctx

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = Ctx(spark, SF).pairs()._jdf.queryExecution().executedPlan()
        # one repartition on (track, ca_id, bucket) feeds both the windows and the
        # bucket summary; the second reference is a ReusedExchange
        assert len(_shuffles(p, [])) == 1
        assert "ReusedExchange" in p.toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_snapshot_has_one_scan_per_log(spark, queries):
    p = queries["wide_contract_snapshot"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    # the events table backs the status log: one scan for the submit, funding and
    # package-received facts together
    assert p.count("Relation [event_id") == 1


def test_pairing_partitions_by_time_bucket(spark):
    """A hot contract is split by time: the events' repartition keys include the bucket."""
    from ledgerline.registry import Ctx

    p = Ctx(spark, SF).pairs()._jdf.queryExecution().optimizedPlan().toString()
    lines = [line for line in p.split("\n") if "RepartitionByExpression" in line]
    assert lines and all("_bucket" in line and "ca_id" in line for line in lines)


def test_filters_and_columns_reach_the_parquet_scan(spark, tmp_path):
    """Over a real parquet table the state-type and time filters are pushed to the
    scan and only the needed columns are read."""
    from ledgerline.plans import workflow as wf
    from ledgerline.registry import TEST_PARAMS, Ctx
    from ledgerline.sources.tables import TableSources

    c = Ctx(spark, SF)
    path = str(tmp_path / "wf_history")
    c.src["wf_history"].write.parquet(path)
    src = TableSources(spark, {"wf_history": f"parquet:{path}"}, normalise=False)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        ev = wf.wf_events(src["wf_history"], c.src["app"], c.sendings(), TEST_PARAMS)
        p = ev._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = next(line for line in p.split("\n") if "FileScan" in line and "wf_history" in line)
    pushed = scan.split("PushedFilters:")[1].split("ReadSchema:")[0]
    assert "EqualTo(wf_state_type_name,AudSendingWFState)" in pushed
    assert "GreaterThanOrEqual(u_date_time," in pushed
    read_schema = scan.split("ReadSchema:")[1]
    assert read_schema.strip().startswith("struct<application_id:bigint,u_date_time:timestamp_ntz")


def test_pairing_reuses_the_events_shuffle_under_aqe(spark):
    from ledgerline.registry import Ctx

    df = Ctx(spark, SF).pairs()
    df.write.format("noop").mode("overwrite").save()
    final = df._jdf.queryExecution().executedPlan().finalPhysicalPlan().toString()
    lines = [line for line in final.split("\n") if "REPARTITION_BY_COL" in line]
    assert len(lines) == 2 and sum("ReusedExchange" in line for line in lines) == 1


def _ops(node, out):
    out.append(node)
    it = node.children().iterator()
    while it.hasNext():
        _ops(it.next(), out)
    return out


def test_logs_are_folded_before_they_are_joined(spark, queries):
    """Where a join shuffles, its log side is already a partial aggregate."""
    names = ("overdue_30", "paid_over_30", "delinquency_flag", "first_due_flagged", "submit_counts", "first_last_decision",
             "current_wf_state", "funder_and_booker", "last_approval", "annual_income_by_relation")
    logs = ("l_shipdate", "event_id")  # columns of the tables behind the logs
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in names:
            for join in [n for n in _ops(queries[name](spark, SF)._jdf.queryExecution().executedPlan(), []) if "Join" in n.nodeName()]:
                it = join.children().iterator()
                while it.hasNext():
                    below = _ops(it.next(), [])
                    scans = [n.toString() for n in below if "Scan" in n.nodeName()]
                    if any(c in s for s in scans for c in logs) and not any("Aggregate" in n.nodeName() for n in below):
                        # the fixture views themselves join lineitem to orders on the order key
                        assert "l_orderkey" in join.toString().split("\n")[0], (name, join.toString()[:300])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_sequencing_reads_the_history_once(spark, queries):
    df = queries["wf_events_by_state"](spark, SF)
    df.write.format("noop").mode("overwrite").save()
    final = df._jdf.queryExecution().executedPlan().finalPhysicalPlan().toString()
    lines = [line for line in final.split("\n") if "REPARTITION_BY_COL" in line]
    assert len(lines) == 2 and sum("ReusedExchange" in line for line in lines) == 1
    scans = [line for line in final.split("\n") if "FileScan" in line and "l_linenumber" in line]
    assert len(scans) == 1


def test_details_do_not_shuffle_on_the_status(spark, queries):
    p = plan(queries["sending_details"](spark, SF))
    # the one exchange on it belongs to the fixture's distinct list of statuses
    assert p.count("hashpartitioning(ca_st_key") <= 1
