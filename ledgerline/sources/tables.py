"""Production sources: logical table name -> catalog table or storage path.

The operators take DataFrames with the source schemas of FIXTURES.md part A.
``TableSources`` resolves each logical name once, either from the catalog
(``catalog.schema.table``, which also covers tables that live in other
databases) or from a path with an explicit format. Filters and column pruning
then reach the scan through Catalyst as usual.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from ledgerline.sources.contracts import checked, required
from ledgerline.sources.ingest import ingested


class TableSources:
    """``TableSources(spark, {"wf_history": "prod.ops.wf_history", "ca": "parquet:/data/ca"})``.

    A value ``"<format>:<path>"`` reads files (``parquet``, ``orc``, ``delta``, ...);
    anything else is a catalog table name. Codes and column names are normalised
    (``sources.ingest``); tables that already hold plain names and exact codes can be read
    with ``normalise=False``, and then filters on code columns reach the scan as well.

    Types are checked against ``sources.contracts`` when a table is resolved. With a ``job`` (``turnaround``
    or ``snapshot``) its columns must be there too; ``also`` names further ones by source.
    """

    def __init__(
        self, spark: SparkSession, mapping: Mapping[str, str], normalise: bool = True,
        job: str | None = None, also: Mapping[str, Iterable[str]] | None = None,
    ):
        self.spark = spark
        self.job = job
        self.also = dict(also or {})
        self.normalise = normalise
        self.mapping = dict(mapping)
        self._cache: dict[str, DataFrame] = {}

    def df(self, name: str) -> DataFrame:
        if name not in self._cache:
            ref = self.mapping[name]
            fmt, sep, path = ref.partition(":")
            if sep and "/" in path and "." not in fmt:
                df = self.spark.read.format(fmt).load(path)
            else:
                df = self.spark.table(ref)
            needed = {*(required(self.job, name) if self.job else ()), *self.also.get(name, ())}
            df = checked(df, name, needed)
            self._cache[name] = ingested(df, name) if self.normalise else df
        return self._cache[name]

    __getitem__ = df
