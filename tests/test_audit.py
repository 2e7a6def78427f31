"""Key checks inside the joins: no further scan, and duplicates raise before anything is committed."""

import json

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.audit import KeyAudit
from ledgerline.operators.keys import DuplicateKeyError
from ledgerline.plans import refresh
from ledgerline.plans import snapshot as snap
from ledgerline.registry import TEST_HOURS, TEST_PARAMS, Ctx
from ledgerline.sources.sinks import publish, publish_together, read_published, remove_orphans

SF = "/root/testdata/sf0.001"
TURNAROUND = ("ca", "date_dim", "dealer", "app", "wf_history", "ca_status")


def _files(base):
    return sorted(p.name for p in base.iterdir()) if base.exists() else []


def test_counts_of_both_kinds_of_watch(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    for rows, bad in ((df, False), (df.unionByName(df.where("k = 2")), True)):
        audit = KeyAudit()
        left = spark.range(5).select(F.col("id").cast("int").alias("k"))
        assert left.join(audit.watch(rows, ["k"], "rows"), "k", "left").count() == 5 + bad
        folded = audit.watch_count(rows.groupBy("k").agg(F.count("*").alias("n")), "n", ["k"], "folded")
        if bad:
            with pytest.raises(DuplicateKeyError, match=r"rows: key \(2\) appears 2 times"):
                audit.check()
        else:
            folded.collect()
            audit.check()


def _exchanges(plan, out):
    if plan.nodeName() == "Exchange":
        out.append(plan.toString().split("\n")[0])
    it = plan.children().iterator()
    while it.hasNext():
        _exchanges(it.next(), out)
    return out


def test_a_watched_snapshot_has_no_further_scan_or_shuffle(spark):
    s = Ctx(spark, SF).snapshot_sources()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with sides too large to broadcast
    try:
        plain, seen = (snap.wide_contract_snapshot(s, TEST_PARAMS.as_of, audit=a)._jdf.queryExecution().executedPlan() for a in (None, KeyAudit()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "CollectMetrics" in seen.toString() and "CollectMetrics" not in plain.toString()
    assert seen.toString().count("FileScan") <= plain.toString().count("FileScan")
    assert len(_exchanges(seen, [])) <= len(_exchanges(plain, []))


@pytest.mark.parametrize("name", ["app", "ca", "date_dim", "ca_status", "dealer"])
def test_a_repeated_key_leaves_the_published_tables_as_they_were(spark, tmp_path, name):
    c = Ctx(spark, SF)
    src = {n: c.src[n] for n in TURNAROUND}
    src["wf_history"] = src["wf_history"].where("application_id % 20 = 0")
    refresh.refresh_turnaround(spark, src, TEST_PARAMS, TEST_HOURS, str(tmp_path))
    before = {t: _files(tmp_path / t) for t in refresh.TURNAROUND_TABLES.values()}
    with pytest.raises(DuplicateKeyError):
        refresh.refresh_turnaround(spark, src | {name: src[name].unionByName(src[name])}, TEST_PARAMS, TEST_HOURS, str(tmp_path))
    assert {t: _files(tmp_path / t) for t in before} == before and len(_files(tmp_path / "_commits")) >= 1


def test_unread_sources_of_the_turnaround(spark, tmp_path):
    c = Ctx(spark, SF)
    src = {n: c.src[n] for n in TURNAROUND}
    twice = src["dealer"].unionByName(src["dealer"])
    with pytest.raises(DuplicateKeyError, match="s_asm"):
        refresh.refresh_turnaround(spark, src, TEST_PARAMS, TEST_HOURS, str(tmp_path), unread={"s_asm": (twice, "d_key")})
    assert not (tmp_path / "_commits").exists()


def _one(spark, n):
    return spark.createDataFrame([(n,)], "x int")


def _all(spark, base, names):
    return [read_published(spark, f"{base}/{t}").collect()[0].x for t in names]


def test_several_tables_change_with_one_commit(spark, tmp_path):
    base, names = str(tmp_path), ["a", "b", "c", "d"]
    publish(_one(spark, 0), f"{base}/a")  # an older table of its own
    publish_together({t: (_one(spark, 1), None) for t in names}, base)
    assert _all(spark, base, names) == [1, 1, 1, 1]

    class Crash(Exception):
        pass

    class Failing:
        sparkSession = spark

        @property
        def write(self):
            raise Crash

    with pytest.raises(Crash):  # after two of four were written
        publish_together({"a": (_one(spark, 2), None), "b": (_one(spark, 2), None), "c": (Failing(), None), "d": (_one(spark, 2), None)}, base)
    assert _all(spark, base, names) == [1, 1, 1, 1]
    assert len([f for f in _files(tmp_path / "b") if f.startswith("v=")]) == 2  # the crashed run's folder
    publish_together({t: (_one(spark, 3), None) for t in names}, base)
    assert _all(spark, base, names) == [3, 3, 3, 3]
    assert len([f for f in _files(tmp_path / "b") if f.startswith("v=")]) == 2  # 1 and 3: the orphan is gone
    publish_together({t: (_one(spark, 4), None) for t in names}, base)
    assert _all(spark, base, names) == [4, 4, 4, 4] and len([f for f in _files(tmp_path / "b") if f.startswith("v=")]) == 2
    assert set(json.loads((tmp_path / "_commits" / _files(tmp_path / "_commits")[-1]).read_text())) == set(names)


def test_a_check_that_fails_removes_what_was_written(spark, tmp_path):
    base = str(tmp_path / "t")
    publish(_one(spark, 1), base, version="a")

    def bad():
        raise ValueError("no")

    with pytest.raises(ValueError):
        publish(_one(spark, 2), base, version="b", check=bad)
    assert _files(tmp_path / "t") == ["_commits", "v=a"] and read_published(spark, base).collect()[0].x == 1
    _one(spark, 9).write.parquet(f"{base}/v=left")
    assert remove_orphans(spark, base) == ["left"] and _files(tmp_path / "t") == ["_commits", "v=a"]
