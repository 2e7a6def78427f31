"""Hard-negative mining with an STR-packed R-tree.

All rows are dealt to slabs by ranges of the coordinate that varies most (the row's number breaks ties, so copies of
one vector spread), each slab is sorted and tiled by label and further coordinates into leaves of ``LEAF`` rows, and each
leaf is written with its box: the least and greatest value of every coordinate, and of the label. Runs of ``FANOUT``
neighbouring boxes make the nodes above, up to the slab's root.

The inner product of an anchor with any row of a box lies between two numbers that follow from the signs of the anchor's
coordinates. A search keeps a queue of boxes, the one with the greatest upper number first. A box is left out if its label
range can't fit, if it lies outside every score window, or if its upper number is strictly below the kth score found; at
a tie it is opened, since a smaller id may lie in it.

The anchors are a stated query set. They meet the slabs in blocks: one task gets one slab (``SLAB`` rows) and one block
(``BLOCK`` anchors) and returns the best k of its slab; the best of all slabs are taken by a window limit, which cuts
before it shuffles. The first search finds each anchor's positives, the second the negatives in the score window of each
positive. Nothing but the spread of each coordinate reaches the driver, and nothing is broadcast. All is exact: scores are
whole numbers, computed in doubles while they fit 53 bits and else in integers of any size; beyond 64 bits they count as
the greatest or least number of 64 bits.

Nulls: rows with a null label, a null vector, or a null or not finite component (times ``SCALE``) take no part. A row with a
null id is never an anchor and comes last among equal scores. Repeated rows are rows of their own: an anchor leaves
out only itself, and an anchor row that occurs twice is answered twice. Missing components of a shorter vector count
as 0. Empty tables, and anchors without positives or negatives, give no rows. Other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.rows import _q, discard, stored

SCALE, LEAF, FANOUT, SLAB, BLOCK = 256, 128, 8, 4_096, 2_048
POSITIVES, NEGATIVES, LOW, HIGH = 5, 10, 30, 90
TILED = 6

_LEAVES = "slab int, leaf int, n int, low binary, high binary, label_low bigint, label_high bigint, rows binary, ids binary, labels binary, vectors binary"
_FOUND = "anchor bigint, slot int, row bigint, id bigint, score bigint"
_NO_ID = _MOST = 2**63 - 1


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "double": pa.float64()}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in ddl.split(", "))])


def scaled(vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding", label: Column | str = "label", scale: int = SCALE) -> DataFrame:
    """row (its own number), id, label and the scaled whole components of the rows that take part; written."""
    rows = vectors.select(F.col(_q(key)).cast("bigint").alias("id"), (label if isinstance(label, Column) else F.col(_q(label))).cast("bigint").alias("label"), F.col(_q(vector)).cast("array<double>").alias("x"))
    rows = rows.withColumn("x", F.transform("x", lambda x: x * float(scale)))
    finite = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("label").isNotNull() & F.col("x").isNotNull() & F.coalesce(finite, F.lit(False)))
    return stored(rows.withColumn("row", F.monotonically_increasing_id()))


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((2, 0))
    for batch in batches:
        x = batch.column(0)
        sizes = np.diff(x.offsets.to_numpy())
        at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        values = np.floor(x.flatten().to_numpy(zero_copy_only=False))
        with np.errstate(over="ignore"):
            got = np.array([np.bincount(at, w) for w in (values, values * values)]).reshape(2, -1)
        d = max(total.shape[1], got.shape[1])
        total = sum(np.pad(t, ((0, 0), (0, d - t.shape[1]))) for t in (total, got))
    schema = _arrow("at int, s double, ss double")
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.shape[1]), pa.int32()), pa.array(total[0]), pa.array(total[1])], schema=schema)


def _coordinates(rows: DataFrame, n: int) -> list[int]:
    """All coordinates, the one with the greatest variance first."""
    sums = rows.select("x").mapInArrow(_spread, "at int, s double, ss double").groupBy("at").agg(F.sum("s").alias("s"), F.sum("ss").alias("ss")).collect()
    variance = {r["at"]: float(np.nan_to_num(r["ss"] / n - (r["s"] / n) ** 2)) for r in sums}
    return sorted(variance, key=lambda k: (-variance[k], k))


def _tiles(idx: np.ndarray, keys: Sequence[np.ndarray], leaf: int) -> Iterator[np.ndarray]:
    """Sort-tile-recursive: slices of the first key, each cut into slices of the next, down to leaves."""
    leaves = -(-len(idx) // leaf)
    if leaves <= 1 or not keys:
        yield from (idx[k : k + leaf] for k in range(0, len(idx), leaf))
        return
    idx = idx[np.argsort(keys[0][idx], kind="stable")]
    slices = max(1, round(leaves ** (1 / len(keys))))
    size = -(-leaves // slices) * leaf
    for k in range(0, len(idx), size):
        yield from _tiles(idx[k : k + size], keys[1:], leaf)


def _pack(order: Sequence[int], leaf: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))  # one slab
        n, d = table.num_rows, len(order)
        if not n:
            return
        rows, labels = table["row"].to_numpy(), table["label"].to_numpy()
        ids = table["id"].fill_null(_NO_ID).to_numpy()
        x = np.floor(table["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False)).reshape(n, d)
        slab, schema = TaskContext.get().partitionId(), _arrow(_LEAVES)
        for k, at in enumerate(_tiles(np.arange(n), [labels, *(x[:, c] for c in order[:TILED])], leaf)):
            box = x[at]
            values = [slab, k, len(at), box.min(0).tobytes(), box.max(0).tobytes(), int(labels[at].min()), int(labels[at].max())]
            values += [v[at].tobytes() for v in (rows, ids, labels)] + [box.tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema, strict=True)], schema=schema)

    return run


def index(rows: DataFrame, order: Sequence[int], n: int, *, slab: int = SLAB, leaf: int = LEAF) -> DataFrame:
    """The leaves of all slabs, written."""
    first = [F.col("x")[order[0]]] if order else []
    slabs = rows.repartitionByRange(max(1, -(-n // slab)), *first, "row")
    return stored(slabs.select("row", "id", "label", "x").mapInArrow(_pack(order, leaf), _LEAVES))


class Tree:
    """The R-tree of one slab."""

    def __init__(self, leaves: pa.Table, d: int, whole: bool):
        leaves = leaves.sort_by("leaf")
        exact = (lambda v: v) if whole else _integers
        self.fit = (lambda v: v) if whole else (lambda v: np.clip(v, -_MOST, _MOST))

        def matrix(name: str) -> np.ndarray:
            return exact(np.frombuffer(b"".join(leaves[name].to_pylist()), np.float64).reshape(leaves.num_rows, d))

        self.leaves = []
        for r in leaves.select(["n", "rows", "ids", "labels", "vectors"]).to_pylist():
            parts = [np.frombuffer(r[c], np.int64) for c in ("rows", "ids", "labels")]
            self.leaves.append([*parts, exact(np.frombuffer(r["vectors"], np.float64).reshape(r["n"], d))])
        self.levels = [(matrix("low"), matrix("high"), leaves["label_low"].to_numpy(), leaves["label_high"].to_numpy())]
        while len(self.levels[-1][0]) > 1:
            low, high, first, last = self.levels[-1]
            at = np.arange(0, len(low), FANOUT)
            self.levels.append((np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), np.minimum.reduceat(first, at), np.maximum.reduceat(last, at)))

    def search(self, row: int, label: int, a: np.ndarray, windows: list[tuple[int, int]], k: int, same: bool) -> list[list[tuple[int, int, int]]]:
        """For each score window the best k (score, id, row) of the rows with the same label, or of those with another."""
        up, down = np.maximum(a, 0), np.minimum(a, 0)
        best: list[list[tuple]] = [[] for _ in windows]
        floors = [low for low, _ in windows]
        top = max(high for _, high in windows)
        queue: list[tuple] = []

        def push(level: int, nodes: slice) -> None:
            low, high, first, last = (v[nodes] for v in self.levels[level])
            most, least = self.fit(high @ up + low @ down), self.fit(low @ up + high @ down)
            fits = (first <= label) & (label <= last) if same else ~((first == label) & (last == label))
            fits &= ((most >= min(floors)) & (least <= top)).astype(bool)
            for node in np.flatnonzero(fits):
                heapq.heappush(queue, (-most[node], level, nodes.start + int(node), least[node]))

        push(len(self.levels) - 1, slice(0, 1))
        while queue and -queue[0][0] >= min(floors):
            most, level, node, least = heapq.heappop(queue)
            if not any(-most >= floor and least <= high for floor, (_, high) in zip(floors, windows, strict=True)):
                continue
            if level:
                push(level - 1, slice(node * FANOUT, min((node + 1) * FANOUT, len(self.levels[level - 1][0]))))
                continue
            rows, ids, labels, x = self.leaves[node]
            scores = self.fit(x @ a)
            fits = ((labels == label) & (rows != row)) if same else labels != label
            fits &= ((scores >= min(floors)) & (scores <= top)).astype(bool)
            at = np.flatnonzero(fits)
            if not len(at):
                continue
            found = sorted((-int(s), int(i), int(r)) for s, i, r in zip(scores[at], ids[at], rows[at], strict=True))
            for w, (_, high) in enumerate(windows):
                inside = [f for f in found if floors[w] <= -f[0] <= high][:k]
                if inside:
                    best[w] = sorted(best[w] + inside)[:k]
                    if len(best[w]) == k:
                        floors[w] = -best[w][-1][0]
        return [[(-s, i, r) for s, i, r in b] for b in best]


def _integers(x: np.ndarray) -> np.ndarray:
    return np.array([int(v) for v in x.ravel()] + [None], object)[:-1].reshape(x.shape)


def _search(d: int, k: int, same: bool):
    """For a slab's leaves and a block of anchors: the best k of each of an anchor's windows (``slot``)."""

    def run(leaves: pa.Table, anchors: pa.Table) -> pa.Table:
        schema = _arrow(_FOUND)
        if not leaves.num_rows or not anchors.num_rows:
            return schema.empty_table()
        a = np.floor(anchors["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False)).reshape(anchors.num_rows, d)
        boxes = np.frombuffer(b"".join(leaves["low"].to_pylist() + leaves["high"].to_pylist()), np.float64)
        whole = d * float(np.abs(a).max(initial=1)) * float(np.abs(boxes).max(initial=1)) < 2**53
        tree, out = Tree(leaves, d, whole), []
        for vector, r in zip(a if whole else _integers(a), anchors.select(["row", "label", "slots", "lows", "highs"]).to_pylist(), strict=True):
            windows = list(zip(r["lows"], r["highs"], strict=True))
            for slot, got in zip(r["slots"], tree.search(r["row"], r["label"], vector, windows, k, same), strict=True):
                out += [(r["row"], slot, row, None if i == _NO_ID else i, s) for s, i, row in got]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True) if out else [[]] * 5, schema, strict=True)], schema=schema)

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    """The best k of every anchor and slot, over all slabs, with their rank."""
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame, anchor: Column, *, key: str = "vec_id", vector: str = "embedding", label: Column | str = "label", scale: int = SCALE,
    positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, slab: int = SLAB, leaf: int = LEAF, block: int = BLOCK,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchor`` tells, from the column id, which rows are anchors. Each anchor's positives are the best ``positives`` other rows of its
    label; for each, the best ``negatives`` rows of other labels whose score is ``low`` to ``high`` percent of the positive's.
    """
    spark = vectors.sparkSession
    rows = scaled(vectors, key=key, vector=vector, label=label, scale=scale)
    n = rows.count()
    order = _coordinates(rows, n) if n else []
    d = len(order)
    if d:  # missing components of shorter vectors count as 0
        rows = rows.withColumn("x", F.concat("x", F.array_repeat(F.lit(0.0), d - F.size("x"))))
    leaves = index(rows, order, n, slab=slab, leaf=leaf)
    slabs = leaves.agg(F.max("slab")).first()[0]
    asked = rows.where(F.coalesce(anchor, F.lit(False)))
    blocks = max(1, -(-asked.count() // block))
    spread = leaves.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def searched(anchors: DataFrame, k: int, same: bool) -> DataFrame:
        anchors = anchors.withColumn("to_block", F.pmod(F.hash("row"), F.lit(blocks)))
        anchors = anchors.withColumn("to_slab", F.explode(F.sequence(F.lit(0), F.lit(slabs or 0))))
        found = spread.groupBy("slab", "block").cogroup(anchors.groupBy("to_slab", "to_block")).applyInArrow(_search(d, k, same), _FOUND)
        return stored(_best(found, k))

    one = asked.withColumns({"slots": F.array(F.lit(0)), "lows": F.array(F.lit(-_MOST)), "highs": F.array(F.lit(_MOST))})
    first = searched(one, positives, True)
    exact = lambda percent: F.col("score").cast("decimal(19,0)") * percent
    windows = first.withColumns({"low": F.ceil(exact(low) / 100).cast("bigint"), "high": F.floor(exact(high) / 100).cast("bigint")}).where("low <= high")
    windows = windows.groupBy("anchor").agg(F.collect_list(F.struct("rank", "low", "high")).alias("w"))  # at most ``positives``
    windows = windows.select(F.col("anchor").alias("row"), F.col("w.rank").alias("slots"), F.col("w.low").alias("lows"), F.col("w.high").alias("highs"))
    second = searched(asked.join(windows, "row"), negatives, False)
    named = first.select("anchor", F.col("rank").alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    out = second.join(named, ["anchor", "slot"]).join(asked.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
    out = out.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
    discard(leaves)
    return out


ORACLE = """
WITH v AS (
  SELECT row_number() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
pairs AS (
  SELECT a.row AS anchor, a.vec_id AS anchor_id, v.row, v.vec_id, a.label = v.label AS same, list_dot_product(a.x, v.x)::BIGINT AS score
  FROM v a, v WHERE a.vec_id % 100 = 0 AND a.row <> v.row),
positives AS (
  SELECT anchor, row AS positive, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, row) <= 5)
SELECT p.anchor_id, q.positive_id,
       row_number() OVER (PARTITION BY q.anchor, q.positive ORDER BY p.score DESC, p.vec_id, p.row)::INTEGER AS rank,
       p.vec_id AS negative_id, q.positive_score, p.score AS negative_score
FROM positives q JOIN pairs p ON p.anchor = q.anchor AND NOT p.same
WHERE 30 * q.positive_score <= 100 * p.score AND 100 * p.score <= 90 * q.positive_score
QUALIFY rank <= 10
"""
