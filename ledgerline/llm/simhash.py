"""SimHash near-duplicates: a binary trie self-join over the distinct fingerprints.

Two fingerprints that differ in at most ``max_bits`` bits agree on one of ``max_bits`` + 1 blocks of their
bits. So the trie is built once for each block with the block's bits on top, and the subtries below
those top levels are the units that Spark deals out. In a unit node pairs are descended together, the
differing bits are added up and a pair is dropped as soon as they exceed the budget; pairs of small
nodes are compared directly. A unit returns a spanning forest of its links, never all pairs. A block with
over ``UNIT`` fingerprints is cut further by the following bits into pairs of subtries that the budget
allows. Components come from rounds of star contractions over the forests.

Null and wordless texts have fingerprint zero and link like any other. Repeated rows get one result
each; equal fingerprints always share a component. The component id is the smallest id in it
(null only if all its ids are null). An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.rows import _q, map_texts, stored

SHINGLE = 3
MAX_BITS = 3
UNIT = 20_000
MOST_SPLIT_BITS = 12
SMALL = 64
AT_ONCE = 4_000_000


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of one whole text: a bit is set if over half the shingle hashes have it."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # both work on ASCII only
    if not words:
        return 0
    plain = b" ".join(words)
    if len(words) <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(plain, 42)], np.uint64)
    else:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1) - 1
        starts = (ends - sizes)[: len(words) - shingle + 1].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = np.array([digest(plain[a:b], 42) for a, b in zip(starts, ends[shingle - 1 :].tolist(), strict=True)], np.uint64)
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 65_536):
        ones += np.unpackbits(hashes[k : k + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    value = sum(1 << int(j) for j in np.flatnonzero(2 * ones > len(hashes)))
    return value - (1 << 64) if value >> 63 else value


def with_fingerprints(df: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",), shingle: int = SHINGLE, name: str = "fp") -> DataFrame:
    return map_texts(df, text, lambda: lambda texts: {name: [fingerprint(t, shingle) for t in texts]}, [(name, "bigint")], keep)


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _turned(fp: Column, by: int) -> Column:
    return F.shiftleft(fp, by).bitwiseOR(F.shiftrightunsigned(fp, 64 - by)) if by else fp


def _merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the sets of each pair (i, j); ``label`` holds the least index of a set."""
    while len(i):
        a, b = label[i], label[j]
        differ = a != b
        if not differ.any():
            return
        i, j, a, b = i[differ], j[differ], a[differ], b[differ]
        low = np.minimum(a, b)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up


def trie_links(x: np.ndarray, pairs: list[tuple[int, int, int, int]], top: int, max_bits: int) -> np.ndarray:
    """Labels (least index of each linked set) of the sorted fingerprints ``x``. ``pairs`` are the node
    pairs (a0, a1, b0, b1) to start from; all of a node's fingerprints agree above bit ``top``."""
    label = np.arange(len(x))
    ones: dict[int, np.ndarray] = {}

    def split(lo, hi, bit):
        if bit not in ones:
            ones[bit] = np.concatenate([[0], np.cumsum((x >> np.uint64(bit)) & np.uint64(1), dtype=np.int64)])
        return hi - (ones[bit][hi] - ones[bit][lo])

    def compare(a0, a1, b0, b1):
        rows, cols = a1 - a0, b1 - b0
        sizes = rows * cols
        cut = np.concatenate([[0], np.flatnonzero(np.diff(np.cumsum(sizes) // AT_ONCE)) + 1, [len(sizes)]])
        for s, e in zip(cut[:-1], cut[1:], strict=True):
            n = sizes[s:e]
            if not n.sum():
                continue
            which = np.repeat(np.arange(s, e), n)
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            i, j = a0[which] + at // cols[which], b0[which] + at % cols[which]
            near = (np.bitwise_count(x[i] ^ x[j]) <= max_bits) & (i < j)
            _merge(label, i[near], j[near])

    stack = [(np.array(pairs, np.int64).reshape(-1, 4), np.zeros(len(pairs), np.int8), top)]
    while stack:
        nodes, spent, bit = stack.pop()
        small = ((nodes[:, 1] - nodes[:, 0]) * (nodes[:, 3] - nodes[:, 2]) <= SMALL) | (bit < 0)
        if small.any():
            compare(*nodes[small].T)
            nodes, spent = nodes[~small], spent[~small]
        if not len(nodes):
            continue
        if len(nodes) > AT_ONCE // 8:
            half = len(nodes) // 2
            stack += [(nodes[half:], spent[half:], bit), (nodes[:half], spent[:half], bit)]
            continue
        a0, a1, b0, b1 = nodes.T
        am, bm = split(a0, a1, bit), split(b0, b1, bit)
        own = (a0 == b0) & (a1 == b1)  # a node with itself: its two mixed pairs are one
        parts = [(a0, am, b0, bm, 0, None), (am, a1, bm, b1, 0, None), (a0, am, bm, b1, 1, None), (am, a1, b0, bm, 1, ~own)]
        found, costs = [], []
        for p0, p1, q0, q1, cost, which in parts:
            kept = (p1 > p0) & (q1 > q0) & (spent + cost <= max_bits)
            kept = kept if which is None else kept & which
            found.append(np.stack([p0, p1, q0, q1], 1)[kept])
            costs.append(spent[kept] + np.int8(cost))
        stack.append((np.concatenate(found), np.concatenate(costs), bit - 1))
    return label


def forest(fps: DataFrame, max_bits: int = MAX_BITS, unit: int = UNIT) -> DataFrame:
    """(u, v): a spanning forest of the links within each unit, for distinct fingerprints ``fp``."""
    if not 0 <= max_bits <= 15:
        raise ValueError("max_bits must be from 0 to 15")
    blocks = max_bits + 1
    width = 64 // blocks
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    turns = F.explode(F.array(*[F.struct(F.lit(r).alias("turn"), _turned(F.col("fp"), r * width).alias("x")) for r in range(blocks)])).alias("t")
    rows = fps.select(turns).select("t.turn", "t.x", F.shiftrightunsigned("t.x", 64 - width).alias("block"))
    sizes = rows.groupBy("turn", "block").count().where(F.col("count") > unit)
    bits = F.least(F.lit(min(MOST_SPLIT_BITS, 64 - width)), F.ceil(F.log2(F.col("count") / unit)).cast("int"))
    large = stored(sizes.select("turn", "block", bits.alias("bits")))
    own = F.expr(f"shiftrightunsigned(shiftleft(x, {width}), 64 - bits)")
    masks = F.expr(f"transform(filter(sequence(0, cast(pow(2, bits) as int) - 1), m -> bit_count(m) <= {max_bits}), m -> own ^ cast(m as bigint))")
    dealt = (
        rows.join(large, ["turn", "block"], "left")
        .withColumn("own", F.when(F.col("bits").isNull(), F.lit(0).cast("bigint")).otherwise(own))
        .withColumn("other", F.explode(F.when(F.col("bits").isNull(), F.array(F.lit(0).cast("bigint"))).otherwise(masks)))
        .select("turn", "block", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "x")
    )
    keys = ["turn", "block", "low", "high"]
    dealt = dealt.repartition(parts, *keys).sortWithinPartitions(*keys, "own", F.col("x").bitwiseXOR(F.lit(-(1 << 63))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solve(columns):
            turn, block, low, high, own, x = columns
            new = np.ones(len(x), bool)
            new[1:] = (turn[1:] != turn[:-1]) | (block[1:] != block[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
            start = np.append(np.flatnonzero(new), len(x))
            inner = np.ones(len(x), bool)
            inner[1:] = new[1:] | (own[1:] != own[:-1])
            middle = np.flatnonzero(inner & ~new)
            at = np.searchsorted(middle, start[:-1], "right")
            mid = np.where((at < len(middle)) & (np.append(middle, len(x))[at] < start[1:]), np.append(middle, len(x))[at], -1)
            a, z = start[:-1], start[1:]
            lone = (low == high)[a]  # a subtrie with itself, else two subtries
            pairs = np.where(lone[:, None], np.stack([a, z, a, z], 1), np.stack([a, np.maximum(mid, a), np.maximum(mid, a), np.where(mid < 0, a, z)], 1))
            pairs = pairs[(pairs[:, 1] > pairs[:, 0]) & (pairs[:, 3] > pairs[:, 2]) & (z - a > 1)]
            label = trie_links(x, pairs, 63 - width, max_bits)
            linked = np.flatnonzero(label != np.arange(len(x)))
            by = (turn[linked] * width).astype(np.uint64)
            back = lambda v: np.where(by > 0, v >> by | v << (np.uint64(64) - by) % np.uint64(64), v).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(back(x[linked])), pa.array(back(x[label[linked]]))], ["u", "v"])

        held: list[np.ndarray] | None = None
        for batch in batches:
            own = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(6)]
            own[5] = own[5].view(np.uint64)
            held = own if held is None else [np.concatenate(p) for p in zip(held, own, strict=True)]
            if len(held[5]) >= 2 * UNIT:  # whole units only; the last one may go on
                turn, block, low, high = held[:4]
                last = np.flatnonzero((turn != turn[-1]) | (block != block[-1]) | (low != low[-1]) | (high != high[-1]))
                if len(last):
                    yield solve([c[: last[-1] + 1] for c in held])
                    held = [c[last[-1] + 1 :] for c in held]
        if held is not None and len(held[5]):
            yield solve(held)

    return dealt.mapInArrow(run, "u bigint, v bigint")


def _all_stars(edges: DataFrame) -> bool:
    """Whether every u has one edge and no v is a u: then each component is a star around its least node."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    odd = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or up = 1 and down = 1")
    return odd.isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): star contractions until every edge leads to the least node of its component."""
    now = stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct())
    while not _all_stars(now):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").unionByName(least.select("u", F.col("m").alias("v")))
        now = stored(small.distinct())
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_duplicates(
    df: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",), shingle: int = SHINGLE, max_bits: int = MAX_BITS, unit: int = UNIT
) -> DataFrame:
    """``keep``, fp, root and component_id for each row of ``df``: the signed fingerprint, the least one
    of its component, and the least value that the first column of ``keep`` has in the component."""
    keep = [c for c in keep if c not in ("fp", "root", "component_id")]
    docs = stored(with_fingerprints(df, text, keep, shingle))
    firsts = docs.groupBy("fp").agg(F.min(F.col(_q(keep[0]))).alias("first"))
    roots = components(forest(firsts.select("fp"), max_bits, unit)).withColumnRenamed("root", "least")
    placed = firsts.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("least", "fp").alias("root"))
    least = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = placed.join(least, "root").select("fp", "root", "component_id")
    return docs.join(classes, "fp").select(*[_q(c) for c in keep], "fp", "root", "component_id")


def one_of_each(df: DataFrame, text: str = "text", id_col: str = "doc_id", **options) -> DataFrame:
    """``df`` with one row of each component: the one with the least id (a null id only if all are
    null); of several texts with that id the one with the least hash, of equal rows any one."""
    marked = df.withColumn("__hash", F.xxhash64(F.col(_q(text)).cast("string"))).withColumn("__none", F.col(_q(id_col)).isNull())
    marked = marked.withColumn("__id", F.coalesce(F.col(_q(id_col)), F.lit(0)))
    keys = ["__id", "__none", "__hash"]
    found = near_duplicates(marked, text, keys, **options)
    kept = found.groupBy("root").agg(F.min(F.struct("__none", "__id", "__hash")).alias("k")).select("k.*")
    return marked.join(kept, keys, "left_semi").dropDuplicates(keys).select(*[_q(c) for c in df.columns])
