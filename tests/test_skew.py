"""A contract holding a third of all workflow events: the bucketed pairing splits it
into many groups and returns exactly what a single unbucketed pass returns."""

from pyspark.sql import functions as F

from ledgerline.functions.caltime import epoch_seconds
from ledgerline.operators.keys import sequence_per_key
from ledgerline.operators.pairing import pair_next_event
from ledgerline.plans import workflow as wf
from ledgerline.registry import Ctx

SF = "/root/testdata/sf0.01"
HOT = 424242


def hot_events(spark):
    c = Ctx(spark, SF)
    ev = wf.pairing_input(wf.wf_events(c.src["wf_history"], c.src["app"], c.sendings(), c.params))
    # every third contract's events move onto one contract
    return ev.withColumn("ca_id", F.when(F.col("ca_id") % 3 == 0, F.lit(HOT)).otherwise(F.col("ca_id")))


def test_hot_contract_is_split_and_result_unchanged(spark):
    ev = hot_events(spark).cache()
    try:
        total = ev.count()
        hot = ev.filter(F.col("ca_id") == HOT)
        assert hot.count() * 4 > total  # the hot contract holds over a quarter of the events
        buckets = hot.select(F.floor(epoch_seconds(hot, "u_date_time") / 86_400).alias("b")).distinct().count()
        assert buckets > 100  # ... spread over many (track, key, bucket) groups
        daily = pair_next_event(ev, track="track", bucket_seconds=86_400)
        single = pair_next_event(ev, track="track", bucket_seconds=10**10)
        assert daily.exceptAll(single).count() == 0 and single.exceptAll(daily).count() == 0
        # the default cuts finer: same result
        split = pair_next_event(ev, track="track")
        assert split.exceptAll(single).count() == 0 and single.exceptAll(split).count() == 0
        seq_daily = sequence_per_key(ev, ["track", "ca_id"], "u_date_time", ["u_by", "wf_state_name", "role"], "s", 86_400)
        seq_single = sequence_per_key(ev, ["track", "ca_id"], "u_date_time", ["u_by", "wf_state_name", "role"], "s", 10**10)
        assert seq_daily.exceptAll(seq_single).count() == 0
    finally:
        ev.unpersist()
