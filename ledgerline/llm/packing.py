"""Packing: concatenate and cut.

Every document becomes its token ids and one end id. The documents stand in one long row of ids, in the order of
the partitions they are read in; sequence s is the window of ``size`` ids from ``s * size``. Two passes give every
document its place:

1. ``tokenised`` encodes each partition once and writes, for each document, the ids before it in the partition.
   What was written fixes the order, so a task that runs again can't move anything.
2. ``pack`` sums the written partitions to totals (one row for each partition), adds up the totals before each
   partition, and cuts every document at the window ends it crosses. This pass is plain DataFrame work.

The offsets are broadcast: two numbers for each partition of the written table, however many documents it holds.
No ids are shuffled and only the last sequence can be short. ``sequences`` groups the pieces of a window (at most
``size``) for writing.

Nulls: a null text is empty, so its document is the end id alone; a null key stays null. Repeated rows are packed as
often as they occur. A text of any length is cut into as many pieces as it needs. An empty table gives no pieces. Other
columns are not read.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerline.llm.rows import _q, ddl, few, stored

SIZE, END = 2048, 1

# Fixed value: the words of byte-level tokenizers.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_of_character() -> dict[str, int]:
    """The alphabet of byte-level vocabularies: printable Latin-1 bytes stand for themselves, the others, in order, for 256, 257, ..."""
    plain = [b for b in range(256) if 33 <= b <= 126 or (161 <= b and b != 173)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


def encoder(path: str) -> Callable[[str], np.ndarray]:
    """The ids that the tokenizers library gives with the file at ``path`` and add_special_tokens=False.

    A plain byte-level vocabulary whose merges stand in the order of their ids means the same as ranks to tiktoken,
    which is about five times as fast. Texts that its word pattern refuses (white space of a million signs)
    and all other vocabularies go to the tokenizers library, which is loaded with the first of them.
    """
    from tokenizers import Tokenizer

    library = cache(lambda: Tokenizer.from_file(path))

    def slow(text: str) -> np.ndarray:
        return np.array(library().encode(text, add_special_tokens=False).ids, np.uint32)

    with open(path, encoding="utf-8") as f:
        said = json.load(f)
    byte, vocabulary = byte_of_character(), said["model"].get("vocab", {})
    special = {t["content"]: t["id"] for t in said["added_tokens"]}
    plain = said["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
    plain &= said["model"]["type"] == "BPE" and not said["normalizer"] and not said["post_processor"]
    plain &= not any(said["model"].get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    plain = plain and all(vocabulary.get("".join(m)) == 256 + k for k, m in enumerate(said["model"]["merges"]))
    plain = plain and all(t["special"] and not (t["single_word"] or t["lstrip"] or t["rstrip"]) for t in said["added_tokens"])
    if not plain:
        return slow

    import tiktoken

    ranks = {bytes(byte[c] for c in token): k for token, k in vocabulary.items() if token not in special}
    fast = tiktoken.Encoding("ledgerline", pat_str=WORDS, mergeable_ranks=ranks, special_tokens=special)

    def encode(text: str) -> np.ndarray:
        try:
            return fast.encode_to_numpy(text, allowed_special="all")
        except ValueError:
            return slow(text)

    return encode


def tokenised(docs: DataFrame, tokenizer: str, *, key: str = "doc_id", text: str = "text", end: int = END) -> DataFrame:
    """key, part, before (ids of the part before this document), n (ids with the end id), ids (four bytes each, little-endian); written."""
    rows = docs.select(F.col(_q(key)).alias("key"), F.coalesce(F.col(_q(text)).cast("string"), F.lit("")).alias("text"))
    schema = StructType([rows.schema["key"], *ddl([("part", "bigint"), ("before", "bigint"), ("n", "bigint"), ("ids", "binary")])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target, encode = to_arrow_schema(schema), encoder(tokenizer)
        part, before, last = TaskContext.get().partitionId(), 0, np.array([end], "<u4").tobytes()
        for batch in few(batches):
            ids = [encode(t.as_py()).astype("<u4").tobytes() + last for t in batch.column(1)]
            n = np.array([len(x) // 4 for x in ids], np.int64)
            starts = before + np.cumsum(n) - n
            before += int(n.sum())
            columns = [batch.column(0).cast(target.field(0).type), pa.repeat(part, len(ids)).cast(pa.int64()), pa.array(starts), pa.array(n), pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, schema=target)

    return stored(rows.mapInArrow(run, schema), compression="zstd")


def part_offsets(tokens: DataFrame) -> DataFrame:
    """part, offset (ids of all parts before it): one row for each part of the written table."""
    totals = tokens.groupBy("part").agg(F.sum("n").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))


def pack(docs: DataFrame, tokenizer: str, *, key: str = "doc_id", text: str = "text", size: int = SIZE, end: int = END) -> DataFrame:
    """The pieces: key, start, length, ids, doc_tokens, sequence_id, offset. Every id of every document lies in one piece."""
    tokens = tokenised(docs, tokenizer, key=key, text=text, end=end)
    placed = tokens.join(F.broadcast(part_offsets(tokens)), "part").withColumn("at", F.col("offset") + F.col("before"))
    at, stop = F.col("at"), F.col("at") + F.col("n")

    def piece(s: Column) -> Column:
        start = F.greatest(at, s * size)
        length = F.least(stop, (s + 1) * size) - start
        ids = F.col("ids").substr(((start - at) * 4 + 1).cast("int"), (length * 4).cast("int"))
        return F.struct((start - at).alias("start"), length.alias("length"), ids.alias("ids"), s.alias("sequence_id"), (start - s * size).alias("offset"))

    windows = F.sequence(F.expr(f"at div {size}"), F.expr(f"(at + n - 1) div {size}"))
    cut = placed.select("key", F.col("n").alias("doc_tokens"), F.transform(windows, piece).alias("pieces"))
    cut = cut.select("key", "doc_tokens", F.explode_outer("pieces").alias("p"))  # never empty; outer, or the optimizer would test that
    return cut.select(F.col("key").alias(key), "p.start", "p.length", "p.ids", "doc_tokens", "p.sequence_id", "p.offset")


def sequences(pieces: DataFrame, *, key: str = "doc_id") -> DataFrame:
    """The windows: sequence_id, n, ids (four bytes each), boundaries (offset, key, start, length of each piece, in order)."""
    parts = F.array_sort(F.collect_list(F.struct("offset", F.col(_q(key)).alias("key"), "start", "length", "ids")))
    rows = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n"), parts.alias("parts"))
    ids = F.aggregate("parts", F.lit(b""), lambda whole, p: F.concat(whole, p["ids"]))
    boundaries = F.transform("parts", lambda p: F.struct(p["offset"].alias("offset"), p["key"].alias("key"), p["start"].alias("start"), p["length"].alias("length")))
    return rows.select("sequence_id", "n", ids.alias("ids"), boundaries.alias("boundaries"))
