"""Per-key row selection: first / last / n-th row per key, uniqueness checks.

All orderings are total: callers pass tiebreak columns after the main order so
the chosen row never depends on task scheduling.

Scale notes
-----------
* ``nth_per_key`` filters ``row_number() == n`` directly on the window, which
  Catalyst turns into a ``WindowGroupLimit`` that runs *before* the shuffle
  (partial) and after it (final). A hot key therefore sends at most ``n`` rows per
  map task through the exchange, not all of its rows.
* ``first_last_per_key`` uses ``min``/``max`` over a struct: an aggregate with
  map-side partial aggregation, so it is skew-safe as well and needs one pass
  for both ends.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def nth_per_key(df: DataFrame, keys: Sequence[str], order: Sequence, n: int = 1, rank_col: str = "_rn") -> DataFrame:
    """Row number ``n`` per ``keys`` under ``order`` (Spark's default NULL order:
    first ascending, last descending)."""
    w = Window.partitionBy(*keys).orderBy(*_cols(order))
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) == n).drop(rank_col)


def latest_per_key(df: DataFrame, keys: Sequence[str], ts: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """The row with the greatest ``ts`` per key (NULL ``ts`` last); ties go to the
    greatest ``tiebreak`` values."""
    return nth_per_key(df, keys, [F.col(ts).desc()] + [F.col(c).desc() for c in tiebreak], 1)


def earliest_per_key(df: DataFrame, keys: Sequence[str], ts: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """The row with the smallest ``ts`` per key (NULL ``ts`` first); ties go to the
    smallest ``tiebreak`` values."""
    return nth_per_key(df, keys, [F.col(ts).asc()] + [F.col(c).asc() for c in tiebreak], 1)


def first_last_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    payload: Sequence[str],
    first_prefix: str = "first_",
    last_prefix: str = "last_",
) -> DataFrame:
    """First and last row per key in one aggregate.

    ``order`` (then ``payload``) forms the struct that is compared, so ties on the
    order columns resolve to the smallest payload for ``first`` and the greatest
    payload for ``last``. Output: keys + ``first_<c>`` and ``last_<c>`` for every
    column of ``order`` + ``payload``.
    """
    fields = list(order) + [c for c in payload if c not in order]
    packed = F.struct(*[F.col(c) for c in fields])
    agg = df.groupBy(*keys).agg(F.min(packed).alias("_first"), F.max(packed).alias("_last"))
    out = [F.col(k) for k in keys]
    out += [F.col(f"_first.{c}").alias(first_prefix + c) for c in fields]
    out += [F.col(f"_last.{c}").alias(last_prefix + c) for c in fields]
    return agg.select(*out)


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct key set (partial aggregation before the shuffle)."""
    return df.select(*keys).distinct()


class DuplicateKeyError(ValueError):
    pass


def assert_unique(df: DataFrame, keys: Sequence[str], name: str = "input") -> DataFrame:
    """Raise if ``keys`` repeat in ``df``; return ``df`` unchanged otherwise.

    One aggregate job; only the first offending key reaches the driver.
    """
    dup = df.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).collect()
    if dup:
        raise DuplicateKeyError(f"{name}: key {tuple(dup[0][k] for k in keys)} appears {dup[0]['count']} times")
    return df


_NULL_BUCKET = -(2**62)


#: One hour: a key's rows meet in one task only if they fall in the same hour.
BUCKET_SECONDS = 3_600


def with_time_bucket(df: DataFrame, ts: str, out: str, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """Add ``out``: a time bucket that is monotone in ``ts`` (NULL time first)."""
    from ledgerline.functions.caltime import epoch_seconds

    return df.withColumn(out, F.coalesce(F.floor(epoch_seconds(df, ts) / F.lit(bucket_seconds)), F.lit(_NULL_BUCKET)))


def sequence_per_key(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    tiebreak: Sequence[str] = (),
    out: str = "seq_no",
    bucket_seconds: int = BUCKET_SECONDS,
) -> DataFrame:
    """``row_number()`` over ``keys`` ordered by ``ts``, ``tiebreak``, then the other columns
    (NULLs first), computed without putting a whole key into one task.

    Rows are numbered inside time buckets (``with_time_bucket``; one shuffle on
    ``keys + bucket``); each bucket's offset is a running sum over the per-bucket
    row counts (one small row per key and bucket). Equal to the plain window
    because buckets are monotone in ``ts``. Both branches number the same rows by all
    columns, so they share one shuffle and ``df`` is read once.
    """
    grp = list(keys) + ["_seq_bucket"]
    b = with_time_bucket(df, ts, "_seq_bucket", bucket_seconds).repartition(*grp)
    order = [ts, *tiebreak, *[c for c in df.columns if c not in {*keys, ts, *tiebreak}]]
    local = Window.partitionBy(*grp).orderBy(*[F.col(c).asc() for c in order])
    numbered = b.withColumn("_local", F.row_number().over(local)).withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*grp)))
    before = Window.partitionBy(*keys).orderBy("_seq_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = numbered.filter(F.col("_local") == 1).select(*grp, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return (
        numbered.drop("_n").join(offsets, grp, "inner")
        .withColumn(out, (F.col("_offset") + F.col("_local")).cast("bigint"))
        .drop("_seq_bucket", "_local", "_offset")
    )
