"""Logs reduced to the keys in scope: nothing in scope is lost, and the filter stands below each log's fold."""

import dataclasses

from pyspark.sql import functions as F

from compare import compare
from ledgerline.operators.scope import reduced, scope_bits
from ledgerline.plans import snapshot as snap
from ledgerline.plans import workflow as wf
from ledgerline.registry import TEST_PARAMS, Ctx

SF = "/root/testdata/sf0.001"


def test_no_key_in_scope_is_lost_and_few_others_stay(spark):
    log = spark.range(-20_000, 20_000).selectExpr("if(id % 50 = 0, null, id) AS k", "id AS _word", "id AS _at")
    keys = spark.range(-20_000, 20_000, 10).selectExpr("if(id % 70 = 0, null, id) AS k")
    want = {r[0] for r in keys.collect() if r[0] is not None and r[0] % 50}
    for bits in (64, 1 << 12, 1 << 26):
        got = reduced(log.select("k", F.col("_word").alias("w")), "k", scope_bits(keys, "k", bits), bits)
        found = [r["k"] for r in got.collect()]
        assert got.columns == ["k", "w"] and want <= set(found) and len(found) == len(set(found)) and None not in found
    assert len(set(found) - want) < 20
    none = scope_bits(keys.limit(0), "k")
    assert none.count() == 0 and reduced(log.select("k"), "k", none).count() == 0
    assert scope_bits(spark.range(10**6), "id", 1 << 12).count() == 64  # the broadcast's bound


def _snapshot(spark, **more):
    s = Ctx(spark, SF).snapshot_sources()
    few = s.ca.withColumn("sub_date_key", F.when(F.col("id") % 3 == 0, F.col("sub_date_key")).otherwise(0))
    return snap.wide_contract_snapshot(dataclasses.replace(s, ca=few), TEST_PARAMS.as_of, **more)


def test_the_snapshot_of_reduced_logs_is_the_same(spark):
    ok, msg = compare(_snapshot(spark, scope_logs=True).toPandas(), _snapshot(spark).toPandas())
    assert ok, msg


def _below(node, out):
    out.append(node)
    it = node.children().iterator()
    while it.hasNext():
        _below(it.next(), out)
    return out


def test_the_filter_stands_below_every_fold_of_a_log(spark):
    p = _snapshot(spark, scope_logs=True)._jdf.queryExecution().optimizedPlan()
    folds = 0
    for node in _below(p, []):
        text = node.toString().split("\n")[0]
        if node.nodeName() == "Aggregate" and "bit_or" not in text:
            inside = [n.toString().split("\n")[0] for n in _below(node, [])]
            if any(n.startswith("Join") and "getbit" in n for n in inside):
                folds += 1
    logs = 7  # status, delinquency, funding, score, decision, workflow and customer rows
    assert folds >= logs


def test_events_of_other_applications_go_before_the_shuffle(spark):
    c = Ctx(spark, SF)
    sendings = c.sendings().where("ca_id % 5 = 0")
    args = (c.src["wf_history"], c.src["app"], sendings, TEST_PARAMS)
    a, b = wf.wf_events(*args), wf.wf_events(*args, scope_logs=False)
    key = lambda df: sorted(map(str, df.collect()))
    assert key(a) == key(b) and a.count() > 0
    join = next(n for n in _below(a._jdf.queryExecution().optimizedPlan(), []) if n.nodeName() == "Join")
    assert "getbit" in join.left().toString()
