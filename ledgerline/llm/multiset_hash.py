"""Document fingerprints: a homomorphic multiset hash of paragraphs.

A text is a multiset of paragraphs (lines; a line of over ``LONG`` code points is cut after its
sentences). Each is hashed to a wide vector of small odd numbers, and the vectors are summed
modulo 2**16. So the order of paragraphs does not matter, and a paragraph can be added or taken
out by adding or subtracting its vector. While the sums stay small the squared distance of two
fingerprints estimates how many paragraphs differ, which gives the likeness.

``linked`` pairs each document with the next one in descending id order without gathering rows in
one place: id ranges are buckets, the first row of each bucket is also sent to the bucket before
it, and each bucket is read as a sorted stream.

Nulls count as empty texts, whose fingerprint is zero. Rows with a null id come last; rows with the
same id are ordered by a hash of their text. A single row is its own next row. Wrapping sums (over
2,184 equal paragraphs) leave equality exact and only blur the likeness.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.rows import _q, ddl, few

WIDTH = 128
LONG = 160
RANGES = 4  # id ranges a partition: several small ones even out what a partition gets
_SENTENCE = re.compile(r"(?<=[.!?]) ")


def paragraphs(text: str | None) -> list[str]:
    if not text:
        return []
    out: list[str] = []
    for line in text.split("\n"):
        if len(line) > LONG:
            out += _SENTENCE.split(line)
        else:
            out.append(line)
    return out


def vector(parts: Sequence[str]) -> np.ndarray:
    """The sum, modulo 2**16, of the vectors of ``parts``."""
    if not parts:
        return np.zeros(WIDTH, np.uint16)
    raw = b"".join([hashlib.blake2b(p.encode("utf-8", "surrogatepass"), digest_size=WIDTH // 2).digest() for p in parts])
    table = np.frombuffer(raw, np.uint8).reshape(len(parts), WIDTH // 2)
    sums = np.concatenate([(table & 15).sum(0, dtype=np.int64), (table >> 4).sum(0, dtype=np.int64)])
    return (2 * sums - 15 * len(parts)).astype(np.uint16)


def insert(fingerprint: np.ndarray, parts: Sequence[str]) -> np.ndarray:
    return fingerprint + vector(parts)


def delete(fingerprint: np.ndarray, parts: Sequence[str]) -> np.ndarray:
    return fingerprint - vector(parts)


def as_text(fingerprint: np.ndarray) -> str:
    return fingerprint.astype(">u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """1 - |a-b|^2 / (|a|^2 + |b|^2), held to 0..1, about the share of paragraphs in common."""
    x, y = a.view(np.int16).astype(np.int64), b.view(np.int16).astype(np.int64)
    size = int(x @ x + y @ y)
    if not size:
        return 1.0
    gap = (a - b).view(np.int16).astype(np.int64)
    return float(min(1.0, max(0.0, 1 - int(gap @ gap) / size)))


def edited(fingerprint: np.ndarray, parts: Sequence[str], new_parts: Sequence[str]) -> np.ndarray:
    """The fingerprint after ``parts`` became ``new_parts``: only what differs is hashed."""
    same = 0
    for a, b in zip(parts, new_parts, strict=False):
        if a != b:
            break
        same += 1
    return insert(delete(fingerprint, parts[same:]), new_parts[same:])


def fingerprints(df: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` and the fingerprint of every whole text as hexadecimal digits."""
    from ledgerline.llm.rows import map_texts

    def make():
        return lambda texts: {"fingerprint": [as_text(vector(paragraphs(t))) for t in texts]}

    return map_texts(df, text, make, [("fingerprint", "string")], keep)


def linked(df: DataFrame, out: Sequence[tuple[str, str]], pair, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, *out) per row of ``df``; ``pair(text, next text, state)`` gives the values of ``out``
    and the state that is handed on to the next row's call (None at the start of a stream)."""
    from pyspark.ml.feature import Bucketizer

    spark = df.sparkSession
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranges = RANGES * parts
    rows = df.select(F.col(_q(id_col)).cast("bigint").alias("id"), F.coalesce(F.col(_q(text)).cast("string"), F.lit("")).alias("text"))
    ids = rows.select("id", F.coalesce(-F.col("id").cast("double"), F.lit(float("nan"))).alias("at"))
    cuts = sorted(set(ids.where("id is not null").approxQuantile("at", [k / ranges for k in range(1, ranges)], 0.5 / ranges)))
    bucketizer = Bucketizer(splits=[-float("inf"), *cuts, float("inf")] if cuts else [-float("inf"), 0.0, float("inf")], inputCol="at", outputCol="bucket", handleInvalid="keep")
    # one row for each bucket, RANGES times as many as partitions: which id comes first in it
    heads = bucketizer.transform(ids).groupBy("bucket").agg(F.max("id").alias("id")).collect()
    heads.sort(key=lambda r: r["bucket"])
    before = [(heads[k]["id"], heads[k - 1]["bucket"]) for k in range(len(heads))]
    first = spark.createDataFrame(before, "head bigint, before double")
    placed = bucketizer.transform(rows.withColumn("at", F.coalesce(-F.col("id").cast("double"), F.lit(float("nan"))))).drop("at")
    sent = placed.join(F.broadcast(first), F.col("id").eqNullSafe(F.col("head")), "left").select(
        "id",
        "text",
        F.explode(
            F.when(F.col("before").isNull(), F.array(F.struct("bucket", F.lit(False).alias("extra")))).otherwise(
                F.array(F.struct("bucket", F.lit(False).alias("extra")), F.struct(F.col("before").alias("bucket"), F.lit(True).alias("extra")))
            )
        ).alias("p"),
    )
    sorted_rows = (
        sent.select("id", "text", "p.bucket", "p.extra", F.xxhash64("text").alias("tie"))
        .repartition(parts, "bucket")
        .sortWithinPartitions("bucket", "extra", F.desc_nulls_last("id"), "tie")
        .select("bucket", "extra", "id", "text")
    )
    schema = ddl([(id_col, "bigint"), *out])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        waiting = state = bucket = None
        for batch in few(batches):
            made: list[tuple] = []
            for b, extra, i, t in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if b != bucket:
                    bucket, waiting, state = b, None, None
                if waiting is not None:
                    values, state = pair(waiting[1], t, state)
                    made.append((waiting[0], *values))
                    waiting = None
                if not extra:
                    waiting = (i, t)
            columns = list(zip(*made, strict=True)) if made else [[] for _ in target]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, target, strict=True)], schema=target)

    return sorted_rows.mapInArrow(run, schema)
