"""Segmented turnaround summaries at grain analyst, month, or analyst and month.

A detail row belongs to at most one segment (track + outcome state), so the
segment is a CASE expression, not a join.

One grain (``segment_summary``) is one ``groupBy`` with ``count_distinct``. All three
(``segment_summaries``) come from one shuffle of the detail rows: they are folded into cells, one for each
segment, analyst, month and bucket of 32,768 contract ids, that hold a row count, a sum and a bitmap of the
contracts. Bitmaps are exact sets that can be merged: the coarser grains OR the bitmaps of a bucket and count bits, so
no contract id is shuffled again. The fold is partial before the shuffle, and a hot analyst, month or contract
becomes a few cells of each map task. A bitmap takes 4 KB whatever it holds; contracts sent in one window are
neighbours in id, so a cell is well filled.

The average is ``sum div count`` (integer average of integer seconds).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.caltime import format_hms, int_div, yyyymm
from ledgerline.params import SEGMENTS

GRAIN_COLUMNS = {
    "analyst": ("se_analyst",),
    "month": ("sending_mt",),
    "analyst_month": ("se_analyst", "sending_mt"),
}


def _segment_case(segments: Sequence[tuple], track: str, outcome: str, field: int) -> Column:
    expr = None
    for seg in segments:
        cond = (F.col(track) == F.lit(seg[2])) & F.col(outcome).isin(list(seg[3]))
        value = F.lit(seg[field])
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    return expr


def tag_segments(details: DataFrame, track: str = "track", segments: Sequence[tuple] = SEGMENTS) -> DataFrame:
    """Detail rows that fall in one of the ``segments`` (number, name, track, outcome states), with ``seq``, ``group_name``, ``se_analyst``
    (the outcome's actor) and ``sending_mt`` (the outcome's year-month)."""
    return (
        details.select(
            _segment_case(segments, track, "type_2", 0).cast("int").alias("seq"),
            _segment_case(segments, track, "type_2", 1).alias("group_name"),
            F.col("type_2_by").alias("se_analyst"),
            yyyymm(F.col("type_2_time")).alias("sending_mt"),
            F.col("ca_id"),
            F.col("type_1_to_type_2_duration").alias("_dur"),
        ).filter(F.col("seq").isNotNull())
    )


def _measures() -> list[Column]:
    return [
        F.count_distinct("ca_id").alias("unique_con"),
        F.count("ca_id").alias("count_of_ac"),
        format_hms(int_div(F.sum("_dur"), F.count("_dur"))).alias("avg_t_hms"),
    ]


def segment_summary(details: DataFrame, grain: str, track: str = "track", segments: Sequence[tuple] = SEGMENTS) -> DataFrame:
    """One grain: ``seq, group_name, <grain columns>, unique_con, count_of_ac, avg_t_hms``."""
    keys = GRAIN_COLUMNS[grain]
    tagged = tag_segments(details, track, segments)
    return tagged.groupBy("seq", "group_name", *keys).agg(*_measures()).select(
        "seq", "group_name", *keys, "unique_con", "count_of_ac", "avg_t_hms"
    )


_CELL = ("seq", "group_name", "se_analyst", "sending_mt", "_bucket")


def summary_cells(details: DataFrame, track: str = "track", segments: Sequence[tuple] = SEGMENTS) -> DataFrame:
    """The cells that all grains are merged from: one shuffle of the detail rows. Checkpoint them if the
    grains are written one by one."""
    tagged = tag_segments(details, track, segments).withColumn("_bucket", F.bitmap_bucket_number("ca_id"))
    return tagged.groupBy(*_CELL).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("ca_id")).alias("_contracts"),
        F.count("ca_id").alias("_rows"), F.sum("_dur").alias("_sum"), F.count("_dur").alias("_n"),
    )


def merged(cells: DataFrame, grain: str) -> DataFrame:
    """One grain from the cells; same columns as ``segment_summary``."""
    keys = ["seq", "group_name", *GRAIN_COLUMNS[grain]]
    sums = [F.sum(c).alias(c) for c in ("_rows", "_sum", "_n")]
    parts = cells.groupBy(*keys, "_bucket").agg(F.bitmap_or_agg("_contracts").alias("_contracts"), *sums)
    whole = parts.withColumn("_contracts", F.when(F.col("_bucket").isNotNull(), F.bitmap_count("_contracts")).otherwise(0))
    whole = whole.groupBy(*keys).agg(F.sum("_contracts").alias("unique_con"), *sums)
    return whole.select(*keys, "unique_con", F.col("_rows").alias("count_of_ac"), format_hms(int_div(F.col("_sum"), F.col("_n"))).alias("avg_t_hms"))


def segment_summaries(cells: DataFrame) -> dict[str, DataFrame]:
    """The three grains of ``summary_cells``."""
    return {grain: merged(cells, grain) for grain in GRAIN_COLUMNS}
