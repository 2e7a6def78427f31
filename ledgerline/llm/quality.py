"""Quality classifier: random Fourier features over document statistics.

Each whole text gives a fixed vector of statistics. Standardised and projected on random Gaussian
frequencies, their cosines approximate a Gaussian kernel. Every task sums its part of the normal
equations; a tree of sums brings one matrix of ``FEATURES`` + 1 columns to the driver, which solves
the ridge regression. Isotonic calibration runs over a fixed number of score bins, whose label sums
are counted on the cluster, from learning rows that the regression did not see.

Only learning rows (see ``rows.held_out``) with a label enter the fit, all of them. Rows of one id with
both labels count by their mean. Nulls count as empty texts, which are scored like any other;
repeated rows give repeated results; with no labelled rows at all every score is 0.5.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.rows import _q, held_out, map_texts, stored

FEATURES = 256
BINS = 1000
RIDGE = 1e-3
WIDTH = 0.35
STATS = (
    "log_words", "log_chars", "mean_word", "distinct_words", "top_word", "repeated_next", "longest_run", "upper_words",
    "capital_words", "sign_ends", "mixed_words", "bare_signs", "bars", "shouts", "digits", "letters", "spaces",
    "signs", "distinct_lines", "mean_line", "short_lines", "stops", "repeated_pairs", "sign_tail_words",
)
# a run of signs is read once, from its start: a long divider line costs no more than its length
_SIGN_END = re.compile(r"(?<![^\w\s.,;:?\"')\]])[^\w\s.,;:?\"')\]]{2,}+[.,]?(?=\s|$)")
_SIGN = re.compile(r"[^\w\s]")
_DIGIT = re.compile(r"[0-9]")
_SPACE = re.compile(r"\s")
_LETTER = re.compile(r"[^\W\d_]+")


def statistics(text: str | None) -> list[float]:
    """The vector ``STATS`` of one whole text; every share is of words, lines or characters."""
    text = text or ""
    words = text.split()
    n, chars = len(words), len(text)
    if not n:
        return [0.0] * len(STATS)
    lines = [x for x in text.split("\n") if x.strip()]
    counts = Counter(words)
    again = run = longest = 0
    for a, b in zip(words, words[1:], strict=False):
        if a == b:
            again += 1
            run += 1
            longest = run if run > longest else longest
        else:
            run = 0
    pairs = len(set(zip(words, words[1:], strict=False))) if n > 1 else 1
    letters = sum(map(len, _LETTER.findall(text)))
    signs = len(_SIGN.findall(text))
    upper = sum(c for w, c in counts.items() if len(w) > 1 and w.isupper())
    capital = sum(c for w, c in counts.items() if w[0].isupper())
    mixed = sum(c for w, c in counts.items() if not w.isalpha())
    bare = sum(c for w, c in counts.items() if not any(map(str.isalnum, w)))
    return [
        float(np.log1p(n)), float(np.log1p(chars)), min(letters / n, 30.0), len(counts) / n, max(counts.values()) / n, again / n,
        longest / n, upper / n, capital / n, len(_SIGN_END.findall(text)) / n, mixed / n, bare / n, text.count("|") / n,
        text.count("!") / n, len(_DIGIT.findall(text)) / chars, letters / chars, len(_SPACE.findall(text)) / chars, signs / chars,
        len(set(lines)) / max(1, len(lines)), min(n / max(1, len(lines)), 300.0) / 300, sum(len(x) < 20 for x in lines) / max(1, len(lines)),
        (text.count(".") + text.count(",")) / n, 1 - pairs / max(1, n - 1), sum(c for w, c in counts.items() if not w[-1].isalnum()) / n,
    ]


def with_statistics(df: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    return map_texts(df, text, lambda: lambda texts: {"stats": [statistics(t) for t in texts]}, [("stats", "array<double>")], keep)


@dataclass(frozen=True)
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    frequencies: np.ndarray
    phases: np.ndarray
    weights: np.ndarray | None = None
    steps: tuple[tuple[float, float], ...] = ()

    def features(self, stats: np.ndarray) -> np.ndarray:
        x = (stats - self.mean) / self.scale
        z = np.cos(x @ self.frequencies + self.phases) * np.sqrt(2 / len(self.phases))
        return np.hstack([z, np.ones((len(x), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return np.zeros(len(stats)) if self.weights is None else self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        if not self.steps:
            return np.full(len(stats), 0.5)
        at, value = np.array(self.steps).T
        return np.clip(np.interp(self.raw(stats), at, value), 0.0, 1.0)


def _summed(rows: DataFrame, make, length: int) -> np.ndarray | None:
    """Sum of one long vector per task, added up in chunks of it: 64 ways first, then to one."""
    size = 512

    def run(batches):
        total = None
        for batch in batches:
            got = make(batch)
            total = got if total is None else total + got
        if total is not None:
            cut = [total[k : k + size].tolist() for k in range(0, length, size)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(cut)), pa.int32()), pa.array(cut, pa.list_(pa.float64()))], ["k", "v"])

    def add(key, batches):  # one chunk of up to `size` numbers at a time
        total = np.zeros(size)
        for t in batches:
            for v in t.column("v").to_pylist():
                total[: len(v)] += v
        return pa.table({"k": pa.array([key[0].as_py()], pa.int32()), "v": pa.array([total.tolist()], pa.list_(pa.float64()))})

    parts = rows.mapInArrow(run, "k int, v array<double>").withColumn("way", F.spark_partition_id() % 64)
    fold = lambda table_or_key, table=None: add(table_or_key, [table])
    once = parts.groupBy("k", "way").applyInArrow(fold, "k int, v array<double>")
    sums = once.groupBy("k").applyInArrow(fold, "k int, v array<double>").collect()
    if not sums:
        return None
    return np.concatenate([np.array(r["v"]) for r in sorted(sums, key=lambda r: r["k"])])[:length]


def _matrix(batch: pa.RecordBatch, column: str = "stats") -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATS))


def isotonic(counts: Sequence[tuple[float, float, float]]) -> tuple[tuple[float, float], ...]:
    """Pool adjacent violators over (score, label sum, rows), ascending; one point per pool."""
    pools: list[list[float]] = []
    for at, good, n in counts:
        pools.append([at * n, good, n])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    return tuple((s / n, g / n) for s, g, n in pools)


def fit(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label: str = "quality", seed: int = 7) -> QualityModel:
    """``stats`` holds id and statistics, ``labels`` id and label 0 or 1."""
    marked = labels.where(F.col(label).isNotNull()).groupBy(F.col(_q(id_col)).cast("bigint").alias("id")).agg(F.avg(F.col(label).cast("double")).alias("y"))
    rows = stats.select(F.col(_q(id_col)).cast("bigint").alias("id"), "stats").where(F.col("id").isNotNull() & ~held_out(F.col("id")))
    # a fifth of the learning rows calibrates
    rows = stored(rows.join(marked, "id").select("stats", "y", (F.crc32(F.concat(F.lit("calibrate"), F.col("id").cast("string")).cast("binary")) % 5 == 0).alias("late")))
    fitting, d = rows.where("not late"), len(STATS)

    def moments(batch):
        x = _matrix(batch)
        return np.concatenate([[len(x)], x.sum(0), (x**2).sum(0)])

    rng = np.random.default_rng(seed)
    frequencies = rng.normal(size=(d, FEATURES)) * WIDTH
    phases = rng.uniform(0, 2 * np.pi, FEATURES)
    sums = _summed(fitting, moments, 1 + 2 * d)
    if sums is None:
        return QualityModel(np.zeros(d), np.ones(d), frequencies, phases)
    mean = sums[1 : 1 + d] / sums[0]
    scale = np.sqrt(np.maximum(sums[1 + d :] / sums[0] - mean**2, 1e-12))
    model = QualityModel(mean, np.where(scale < 1e-5, 1.0, scale), frequencies, phases)
    size = FEATURES + 1

    def equations(batch):
        z, y = model.features(_matrix(batch)), batch.column("y").to_numpy(zero_copy_only=False)
        return np.concatenate([(z.T @ z).ravel(), z.T @ y])

    total = _summed(fitting, equations, size * size + size)
    gram, right = total[: size * size].reshape(size, size), total[size * size :]
    penalty = RIDGE * np.eye(size) * sums[0] / size
    model = QualityModel(model.mean, model.scale, frequencies, phases, np.linalg.solve(gram + penalty, right))

    def binned(batch):
        at = np.clip(((model.raw(_matrix(batch)) + 1) / 3 * BINS).astype(int), 0, BINS - 1)
        y = batch.column("y").to_numpy(zero_copy_only=False)
        return np.concatenate([np.bincount(at, minlength=BINS), np.bincount(at, y, BINS)]).astype(float)

    late = _summed(rows.where("late"), binned, 2 * BINS)
    if late is None:
        late = _summed(rows, binned, 2 * BINS)
    counts = [((k + 0.5) / BINS * 3 - 1, late[BINS + k], late[k]) for k in range(BINS) if late[k]]
    return QualityModel(model.mean, model.scale, frequencies, phases, model.weights, isotonic(counts))


def scored(stats: DataFrame, model: QualityModel, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep``, ``score`` and ``predicted`` for each row of statistics."""
    from pyspark.sql.types import StructType

    keep = [c for c in keep if c not in ("score", "predicted")]
    schema = StructType([stats.schema[c] for c in keep]).add("score", "double").add("predicted", "integer")

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        for batch in batches:
            score = model.score(_matrix(batch)) if batch.num_rows else np.zeros(0)
            columns = [batch.column(c).cast(target.field(c).type) for c in keep]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(score, pa.float64()), pa.array((score >= 0.5).astype(np.int32), pa.int32())], schema=target)

    return stats.select(*[_q(c) for c in keep], "stats").mapInArrow(run, schema)


def accepted(df: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows of ``df`` whose text scores 0.5 or more under a model fitted on its labelled rows."""
    learning = df.where(F.col(_q(id_col)).isNotNull() & ~held_out(F.col(_q(id_col))))
    model = fit(with_statistics(learning, text, [id_col]).withColumnRenamed(id_col, "doc_id"), labels.withColumnRenamed(id_col, "doc_id"))
    columns = list(df.columns)

    def make():
        def fn(texts):
            stats = np.array([statistics(t) for t in texts]).reshape(-1, len(STATS))
            return {"__good": (model.score(stats) >= 0.5).tolist()}

        return fn

    rows = map_texts(df, text, make, [("__good", "boolean")], columns)
    return rows.where("__good").select(*[_q(c) for c in columns])
