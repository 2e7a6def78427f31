"""Helpers shared by the row-wise operators: whole texts in Arrow batches, no shuffle."""

from __future__ import annotations

import gc
import hashlib
import re
import tempfile
import time
import uuid
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

AT_ONCE = 1_000


def ddl(fields: Sequence[tuple[str, str]]) -> StructType:
    return _parse_datatype_string(", ".join(f"`{n}` {t}" for n, t in fields))


def map_texts(
    df: DataFrame,
    text: str,
    make: Callable[[], Callable[[list[str | None]], dict[str, list]]],
    out: Sequence[tuple[str, str]],
    keep: Sequence[str],
) -> DataFrame:
    """``keep`` columns plus the columns ``out`` computed from the whole text of each row.

    ``make()`` runs once per task and returns the batch function. A column of ``keep``
    with the name of an output column is left out, so inputs with clashing names are safe.
    The text may be any type that casts to string; one row comes out for each row in.
    """
    made = {n for n, _ in out}
    keep = [c for c in keep if c not in made]
    rows = df.select(*[F.col(_q(c)) for c in keep], F.col(_q(text)).cast("string").alias("__text"))
    schema = StructType([rows.schema[c] for c in keep] + ddl(out).fields)
    names = [n for n, _ in out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        fn = make()
        for batch in few(batches):
            got = fn(batch.column(len(keep)).to_pylist())
            columns = [batch.column(i).cast(target.field(i).type) for i in range(len(keep))]
            columns += [_array(got[n], target.field(n).type) for n in names]
            yield pa.RecordBatch.from_arrays(columns, schema=target)

    return rows.mapInArrow(run, schema)


def few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, ``AT_ONCE`` at a time: a worker holds few texts as Python strings."""
    for batch in batches:
        for start in range(0, batch.num_rows, AT_ONCE):
            yield batch.slice(start, AT_ONCE)


def _array(values, kind: pa.DataType) -> pa.Array:
    return values if isinstance(values, pa.Array) else pa.array(values, type=kind)


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def held_out(key: Column) -> Column:
    """True for the third of the keys that no model may learn from (a null key: false)."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


class Taken:
    """A growing set of half-open ranges, asked for overlaps in logarithmic time."""

    def __init__(self, ranges: Sequence[tuple[int, int]] = ()):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for start, end in sorted(ranges):
            self.add(start, end)

    def overlaps(self, start: int, end: int) -> bool:
        k = bisect_left(self.starts, end) - 1
        return k >= 0 and self.ends[k] > start

    def add(self, start: int, end: int) -> None:
        """Ranges that meet become one, so the kept ones are disjoint and in order."""
        first, last = bisect_left(self.ends, start), bisect_right(self.starts, end)
        if first < last:
            start, end = min(start, self.starts[first]), max(end, self.ends[last - 1])
        self.starts[first:last], self.ends[first:last] = [start], [end]


def sha256_hex(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the shared one that the session names in ``spark.checkpoint.dir``. Only a
    local session, whose one machine is all there is, gets a folder of its own if it names none."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base and re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        base = tempfile.mkdtemp(prefix="ledgerline-llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    if not base:
        raise ValueError("spark.checkpoint.dir is not set: name a folder that all executors share")
    return f"{base.rstrip('/')}/ledgerline-llm/{uuid.uuid4().hex}"


def stored(df: DataFrame, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives lost
    executors, and gives later plans true sizes."""
    path = shared_folder(df.sparkSession)
    df.write.options(**options).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner remove shuffle files and broadcasts that no plan of the driver refers to any more; it
    learns of them when the driver collects its garbage. Events of the last query hold its plan for a moment, so this is
    done again after that."""
    gc.collect()
    spark._jvm.System.gc()
    time.sleep(0.5)
    spark._jvm.System.gc()


def discard(df: DataFrame) -> None:
    """Remove what ``stored`` wrote for ``df``, once all that was made from it is stored itself."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.stored_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shrunk(values: np.ndarray) -> bytes:
    """Numbers as bytes: all first bytes, all second ones and so on, compressed."""
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()
    return len(values).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def full(data: bytes, kind: type) -> np.ndarray:
    n, width = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    planes = pa.decompress(data[8:], decompressed_size=n * width, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(width, n).T).view(kind).reshape(n)
