"""Key checks that ride on a job's own joins.

A repeated key on a joined side multiplies rows. Counting every key beforehand costs one more scan and one
more shuffle for each source. ``KeyAudit`` instead counts the copies of a key where the join needs its rows together
anyway: a window on the join key asks for the distribution and the order that the sort-merge join on it asks for
too, so a watched side gains neither an exchange nor a sort. The greatest count and its key leave the job
as an ``Observation``: one row, whatever the size of the source.

The counts are known when the job that reads the sources has ended, so a writer asks ``check()`` after writing and
before committing: duplicates raise, and nothing becomes visible.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ledgerline.operators.keys import DuplicateKeyError


class KeyAudit:
    def __init__(self) -> None:
        self._seen: list[tuple[str, Observation]] = []

    def _observe(self, df: DataFrame, copies: Column, keys: Sequence[str], name: str) -> DataFrame:
        seen = Observation(f"{name} {uuid.uuid4().hex}")
        self._seen.append((name, seen))
        text = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])
        return df.observe(seen, F.max(F.struct(copies.alias("copies"), text.alias("key"))).alias("most"))

    def watch(self, df: DataFrame, keys: Sequence[str], name: str, joined_to: bool = True) -> DataFrame:
        """``df``, whose ``keys`` must not repeat; use the result as a side of a join on ``keys``. Rows with a null key go
        if other rows are ``joined_to`` this side: they meet none, and without them the side shuffles the very
        rows that it shuffles unwatched, so one shuffle serves all uses of a source."""
        if joined_to:
            df = df.where(reduce(Column.__and__, [F.col(k).isNotNull() for k in keys]))
        counted = df.withColumn("_copies", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
        return self._observe(counted, F.col("_copies"), keys, name).drop("_copies")

    def watch_count(self, df: DataFrame, copies: str, keys: Sequence[str], name: str) -> DataFrame:
        """The same for a frame that is one row a key already and carries how many rows it was folded from."""
        return self._observe(df, F.col(copies), keys, name)

    def check(self) -> None:
        """Raise for the first watched side with a repeated key. Call it after the action that reads the sides."""
        for name, seen in self._seen:
            most = seen.get.get("most")
            if most is not None and most["copies"] is not None and most["copies"] > 1:
                raise DuplicateKeyError(f"{name}: key ({most['key']}) appears {most['copies']} times")
        self._seen.clear()


def watched(audit: KeyAudit | None, df: DataFrame, keys: Sequence[str], name: str, joined_to: bool = True) -> DataFrame:
    return audit.watch(df, keys, name, joined_to) if audit else df
