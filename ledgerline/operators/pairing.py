"""Forward as-of pairing: each start event with the first outcome before the next start.

Semantics (per ``key``, optionally per ``track``):

* every start row ``s`` gets the earliest outcome ``o`` with
  ``s.ts <= o.ts < next_start.ts`` (no upper bound when there is no next start);
* starts sharing one timestamp form one output row; because the earlier of two
  tied starts sees the empty interval ``[t, t)``, such a row has **no** outcome
  and carries the smallest actor of the group;
* starts without an outcome are kept with NULL outcome columns;
* ties are broken by ``(ts, by, name)`` ascending, NULLs first, everywhere.

Plan (skew-safe, one shuffle of the events)
-------------------------------------------
Events are bucketed by time (``bucket_seconds``) and shuffled once on
``(track, key, bucket)``, so a single hot key is spread over as many tasks as it
has buckets. One window pass per bucket (a single sort) yields the earliest
outcome at or after each start, the next start, and the tie marker. What a
bucket cannot see -- the first start and the first outcome in any *later*
bucket -- comes from a per-bucket summary (one row per key and bucket, computed
from the same shuffled events) and a running minimum over the buckets in
descending order. The summary is joined back on ``(track, key, bucket)``; the
event side keeps its partitioning, so only the summary moves again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.operators.keys import BUCKET_SECONDS, with_time_bucket


def pair_next_event(
    events: DataFrame,
    key: str = "ca_id",
    ts: str = "u_date_time",
    name: str = "wf_state_name",
    by: str = "u_by",
    role: str = "role",
    track: str | None = None,
    bucket_seconds: int = BUCKET_SECONDS,
) -> DataFrame:
    """``events``: rows with ``role`` = ``'start'`` or ``'outcome'``.

    Returns one row per (track, key, start ts): ``[track,] key, type_1, type_1_time,
    type_1_by, type_2, type_2_time, type_2_by``.

    The bucket id is monotone in time, so its width changes the spread of the work
    and not the result. Rows sharing one instant cannot be split by time.
    """
    part = ([track] if track else []) + [key]
    ev = events.select(
        *[F.col(c) for c in part],
        F.col(ts).alias("_ts"),
        F.col(name).alias("_name"),
        F.col(by).alias("_by"),
        (F.col(role) == F.lit("start")).alias("_is_start"),
    )
    ev = with_time_bucket(ev, "_ts", "_bucket", bucket_seconds)
    outcome = F.when(~F.col("_is_start"), F.struct(F.col("_ts").alias("ts"), F.col("_name").alias("name"), F.col("_by").alias("by")))

    # one shuffle of the events on (track, key, bucket), reused by the bucket
    # summary and by the windows below
    grp = part + ["_bucket"]
    ev = ev.repartition(*grp)

    # per bucket: earliest start and earliest outcome; then the minimum over later buckets
    summary = ev.groupBy(*grp).agg(
        F.min(F.when(F.col("_is_start"), F.col("_ts"))).alias("_b_start"),
        F.min(outcome).alias("_b_out"),
    )
    later = Window.partitionBy(*part).orderBy(F.col("_bucket").desc()).rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(
        *grp,
        F.min("_b_start").over(later).alias("_after_start"),
        F.min("_b_out").over(later).alias("_after_out"),
    )

    # inside a bucket, one descending pass (growing frames, linear time):
    # outcomes sort before starts of the same instant, so a start's frame holds
    # every outcome at or after it; the rows before it hold every later start
    # (and tied starts that follow it in (ts, by, name) order). Tied starts are
    # adjacent in this order: all but the last (the smallest actor) are dropped,
    # and the last sees its tie as a next start at the same instant.
    desc = Window.partitionBy(*grp).orderBy(
        F.col("_ts").desc(), F.col("_is_start").asc(), F.col("_by").desc(), F.col("_name").desc()
    )
    upto = desc.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = desc.rowsBetween(Window.unboundedPreceding, -1)
    local = ev.select(
        "*",
        F.min(outcome).over(upto).alias("_out_local"),
        F.min(F.when(F.col("_is_start"), F.col("_ts"))).over(before).alias("_next_local"),
        F.lead("_ts").over(desc).alias("_lead_ts"),
        F.lead("_is_start").over(desc).alias("_lead_start"),
    )
    tie_follows = F.coalesce(F.col("_lead_start") & (F.col("_lead_ts") == F.col("_ts")), F.lit(False))
    local = local.filter(F.col("_is_start") & ~tie_follows)

    paired = local.join(carry, grp, "left")
    tied = F.coalesce(F.col("_next_local") == F.col("_ts"), F.lit(False))
    next_start = F.coalesce(F.col("_next_local"), F.col("_after_start"))
    cand = F.coalesce(F.col("_out_local"), F.col("_after_out"))
    hit = F.when(~tied & cand.isNotNull() & (next_start.isNull() | (cand["ts"] < next_start)), cand)
    paired = paired.withColumn("_hit", hit)
    return paired.select(
        *[F.col(c) for c in part],
        F.col("_name").alias("type_1"),
        F.col("_ts").alias("type_1_time"),
        F.col("_by").alias("type_1_by"),
        F.col("_hit.name").alias("type_2"),
        F.col("_hit.ts").alias("type_2_time"),
        F.col("_hit.by").alias("type_2_by"),
    )

