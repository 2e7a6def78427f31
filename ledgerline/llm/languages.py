"""Language identification with hyperdimensional profiles.

Each letter has a random vector of plus and minus ones. A trigram's vector binds the vectors of its
letters, permuted by their place, into an elementwise product; a text's profile bundles the vectors of
its trigrams (a sum), and so does the prototype of a language over all its learning texts. The
language whose prototype has the greatest cosine with the text's profile is predicted.

Texts are lower-cased; a run of other signs counts as one space. Prototypes come from trigram counts
that each task bundles per language, so one row of ``WIDTH`` numbers per task and language is shuffled.

Only learning rows (see ``rows.held_out``) with a language and a text enter the prototypes. Null
texts and texts without a letter are ``und`` with score 0, and so are all texts if nothing could be
learned. Equal cosines go to the first language by name. Repeated rows give repeated results.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.rows import _q, held_out, map_texts

WIDTH = 1024
KEPT_TRIGRAMS = 16_000
BLOCK = 128
_LOWER = np.zeros(0, np.uint32)
_VECTORS: dict[int, np.ndarray] = {}
_ROWS: dict[int, int] = {}
_TABLE = np.zeros((0, WIDTH), np.float32)


def _lower_table() -> np.ndarray:
    """Code point to lower-case letter, or a space for every other sign (basic plane and beyond)."""
    global _LOWER
    if not len(_LOWER):
        out = np.full(0x110000, 32, np.uint32)
        for c in range(0x110000):
            s = chr(c)
            if s.isalpha():
                low = s.lower()
                out[c] = ord(low) if len(low) == 1 else c
        _LOWER = out
    return _LOWER


def trigrams(text: str | None) -> np.ndarray:
    """The codes of the trigrams of one whole text, with a space at both ends; none without letters."""
    codes = np.frombuffer((" " + (text or "") + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = _lower_table()[codes]
    blank = codes == 32
    codes = codes[~(blank & np.concatenate([[False], blank[:-1]]))].astype(np.uint64)
    if len(codes) < 3:
        return np.zeros(0, np.uint64)
    return codes[:-2] << np.uint64(42) | codes[1:-1] << np.uint64(21) | codes[2:]


def _letter(code: int) -> np.ndarray:
    if code not in _VECTORS:
        if len(_VECTORS) > 20_000:
            _VECTORS.clear()
        _VECTORS[code] = (np.random.default_rng([20, code]).integers(0, 2, WIDTH, np.int8) * 2 - 1).astype(np.int8)
    return _VECTORS[code]


def _bound(code: int) -> np.ndarray:
    a, b, c = code >> 42, code >> 21 & 0x1FFFFF, code & 0x1FFFFF
    return np.roll(_letter(a), 2) * np.roll(_letter(b), 1) * _letter(c)


def _row(code: int) -> int | None:
    """The row of a trigram in the worker's table; None once the table is full."""
    global _TABLE
    row = _ROWS.get(code)
    if row is None and len(_ROWS) < KEPT_TRIGRAMS:
        row = _ROWS[code] = len(_ROWS)
        if row >= len(_TABLE):
            _TABLE = np.vstack([_TABLE, np.zeros((max(2048, len(_TABLE) // 2), WIDTH), np.float32)])
        _TABLE[row] = _bound(code)
    return row


def profiles(texts: Sequence[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """One bundle per (trigrams, counts) pair, as a product of counts and the trigrams' vectors;
    rows of the first ``KEPT_TRIGRAMS`` trigrams seen stay in memory."""
    total = np.zeros((len(texts), WIDTH))
    for start in range(0, len(texts), BLOCK):
        block = texts[start : start + BLOCK]
        own: list[tuple[np.ndarray, np.ndarray]] = []
        for k, (codes, counts) in enumerate(block):
            rows = [_row(c) for c in codes.tolist()]
            if None in rows:
                for c, n, row in zip(codes.tolist(), counts.tolist(), rows, strict=True):
                    if row is None:
                        total[start + k] += n * _bound(c).astype(np.float64)
                known = np.array([r is not None for r in rows])
                counts = counts[known]
            own.append((np.array([r for r in rows if r is not None], np.int64), counts))
        used = np.unique(np.concatenate([r for r, _ in own]))
        for k in range(0, len(used), 8192):
            part = used[k : k + 8192]
            table = np.zeros((len(block), len(part)), np.float32)
            for i, (rows, counts) in enumerate(own):
                at = np.searchsorted(part, rows)
                inside = (at < len(part)) & (part[np.minimum(at, len(part) - 1)] == rows)
                table[i, at[inside]] = counts[inside]
            total[start : start + len(block)] += table @ _TABLE[part]
    return total


def prototypes(df: DataFrame, text: str = "text", lang: str = "lang", id_col: str = "doc_id") -> dict[str, np.ndarray]:
    """Language name to unit vector, bundled over all learning rows."""
    rows = df.select(
        F.col(_q(id_col)).alias("id"), F.col(_q(lang)).cast("string").alias("lang"), F.col(_q(text)).cast("string").alias("text")
    ).where(F.col("id").isNotNull() & ~held_out(F.col("id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())

    def run(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            own: dict[str, list[np.ndarray]] = {}
            for name, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own.setdefault(name, []).append(trigrams(t))
            for name, parts in own.items():
                codes, counts = np.unique(np.concatenate(parts), return_counts=True)
                total[name] = total.get(name, 0) + profiles([(codes, counts)])[0]
        names = [n for n, v in total.items() if np.any(v)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([total[n].tolist() for n in names], pa.list_(pa.float64()))], ["lang", "bundle"]
        )

    parts = rows.select("lang", "text").mapInArrow(run, "lang string, bundle array<double>")
    sums = parts.select("lang", F.posexplode("bundle").alias("k", "v")).groupBy("lang", "k").agg(F.sum("v").alias("v"))
    found = sums.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("k", "v"))).alias("v")).collect()  # WIDTH numbers a language
    out = {}
    for r in sorted(found, key=lambda r: r["lang"]):
        v = np.array([x["v"] for x in r["v"]])
        if np.any(v):
            out[r["lang"]] = v / np.linalg.norm(v)
    return out


def predict(
    df: DataFrame, learned: dict[str, np.ndarray], text: str = "text", keep: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """``keep``, ``lang_pred`` and ``score``, the greatest cosine (0 if negative), of every whole text."""
    names = sorted(learned)
    table = np.array([learned[n] for n in names])

    def make():
        def fn(texts):
            counted = [np.unique(trigrams(t), return_counts=True) for t in texts]
            bundles = profiles(counted) if texts else np.zeros((0, WIDTH))
            langs, scores = [], []
            for (codes, _), v in zip(counted, bundles, strict=True):
                if not len(codes) or not names:
                    langs.append("und")
                    scores.append(0.0)
                    continue
                size = np.linalg.norm(v)
                cosines = table @ v / size if size else np.zeros(len(names))
                best = int(np.argmax(cosines))
                langs.append(names[best])
                scores.append(float(min(1.0, max(0.0, cosines[best]))))
            return {"lang_pred": langs, "score": scores}

        return fn

    return map_texts(df, text, make, [("lang_pred", "string"), ("score", "double")], keep)
