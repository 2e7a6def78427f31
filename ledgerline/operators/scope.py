"""Filtering a log by a set of keys before it is folded or shuffled.

A semi-join of a log with the keys in scope shuffles the whole log first. Here the keys set bits of a bit array of
fixed size (a Bloom filter with one hash): ``scope_bits`` folds them into 64-bit words, ``reduced`` looks each log row's
word up in a broadcast and keeps the row if its bit is set. The array has ``BITS`` bits whatever the number of keys, so
the broadcast has at most ``BITS / 64`` rows of two numbers (16 MB), and fewer while there are few keys.

The filter is one-sided: every row of a key in scope stays; of the other rows as many stay as the array is full
(1.5 % at a million keys), and the join that the log is folded for drops them. Rows with a null key go.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 26


def _place(key: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(key.cast("bigint")), F.lit(bits))


def scope_bits(keys: DataFrame, key: str, bits: int = BITS) -> DataFrame:
    """The non-empty words of the bit array: ``_word, _bits``."""
    at = keys.where(F.col(key).isNotNull()).select(_place(F.col(key), bits).alias("_at"))
    one = F.expr("shiftleft(1L, cast(_at % 64 as int))")
    return at.groupBy(F.expr("_at div 64").alias("_word")).agg(F.bit_or(one).alias("_bits"))


def reduced(log: DataFrame, key: str, words: DataFrame, bits: int = BITS) -> DataFrame:
    """The rows of ``log`` whose ``key`` may be in scope, without a shuffle of ``log``."""
    columns = log.columns
    placed = log.where(F.col(key).isNotNull()).withColumn("_at", _place(F.col(key), bits))
    placed = placed.withColumn("_word", F.expr("_at div 64"))
    kept = placed.join(F.broadcast(words), "_word").where(F.expr("getbit(_bits, cast(_at % 64 as int)) = 1"))
    return kept.select(*columns)
