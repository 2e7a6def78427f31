"""Secret scans with a linear-chain conditional random field.

Tokens are runs of the signs that secrets are made of. A token that could be part of a secret (eight
signs or more with a digit or a joining sign among them, or twenty signs) may be tagged begin, inside
or outside; every other token is outside by constraint, so a text falls into short chains of
neighbouring candidate tokens that Viterbi decodes exactly. Features are the token's shape, the words
and signs around it, and features of the whole text.

The strict patterns (the base, which always stays) label the training chains. Equal chains are
counted over all texts; the field is fitted on the ``MOST_CHAINS`` most frequent distinct ones under ``LONGEST_CHAIN`` characters, a
documented bound. A decoded secret that overlaps no base span becomes a span of kind ``tagged``.

Nulls and empty texts have no spans; repeated rows give repeated results; without training chains
(empty tables) only base spans are returned. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.rows import Taken, map_texts, sha256_hex

KINDS = ("assign", "access", "hex", "tagged")
MOST_CHAINS = 4000
LONGEST_CHAIN = 20_000  # characters of a chain that the field is fitted on; all chains are tagged
BEGIN, INSIDE, OUTSIDE = 0, 1, 2

_ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""", re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
_TOKEN = re.compile(r"[A-Za-z0-9+/_.=-]+")
_SOME = re.compile(r"[0-9]|(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{20}")
_KEYWORD = re.compile(r"(?i:password|passwd|secret|token|api_?key|credential|bearer|private)", re.A)
_JOINING = re.compile(r"[0-9+/_=]")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the strict patterns, in this order."""
    low = text.lower()
    out = []
    if "passw" in low or "secret" in low or "token" in low or "api_key" in low or "apikey" in low:
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def _candidate(token: str) -> bool:
    return len(token) >= 20 or (len(token) >= 8 and _JOINING.search(token) is not None)


def _entropy(token: str) -> float:
    n = len(token)
    return -sum(c / n * math.log2(c / n) for c in Counter(token).values())


def _features(text: str, tokens: list[tuple[int, int]], k: int, file: tuple[str, ...]) -> tuple[str, ...]:
    s, e = tokens[k]
    token = text[s:e]
    kinds = "".join(
        mark for mark, pattern in (("a", "[a-z]"), ("A", "[A-Z]"), ("0", "[0-9]"), ("+", "[+/=]"), ("_", "[_-]"), (".", "[.]")) if re.search(pattern, token)
    )
    hexes = "hex" if re.fullmatch("[0-9a-f]+|[0-9A-F]+", token) else "num" if token.replace(".", "").isdigit() else "mix"
    words = [text[a:b].lower() for a, b in tokens[max(0, k - 2) : k]]
    near = "key" if any(_KEYWORD.search(w) for w in words) else "word" if words else "none"
    before, after = text[max(0, s - 3) : s], text[e : e + 1]
    sign = "set" if "=" in before or ":" in before or words[-1:] == ["="] else "plain"
    quote = "quoted" if before[-1:] in "\"'`" and before and after in "\"'`" and after else "bare"
    return (
        f"shape={kinds}", f"hex={hexes}", f"len={min(6, len(token) // 8)}", f"bits={min(5, int(_entropy(token)))}",
        f"near={near}", f"sign={sign}", f"quote={quote}", f"near+sign+quote={near}{sign}{quote}", f"hex+len={hexes}{min(6, len(token) // 8)}", *file,
    )


def chains(text: str) -> list[list[tuple[int, int, tuple[str, ...]]]]:
    """Runs of neighbouring candidate tokens as (start, end, features)."""
    if not _SOME.search(text):
        return []
    out: list[list[tuple[int, int, tuple[str, ...]]]] = []
    file = None
    offset = 0
    for line in text.split("\n"):
        if _SOME.search(line):
            tokens = [(m.start() + offset, m.end() + offset) for m in _TOKEN.finditer(line)]
            last = -2
            for k, (s, e) in enumerate(tokens):
                if _candidate(text[s:e]):
                    if file is None:
                        file = (f"file_key={bool(_KEYWORD.search(text))}", f"file_code={text.count('=') > 3 or '{' in text}")
                    if last != k - 1:
                        out.append([])
                    out[-1].append((s, e, _features(text, tokens, k, file)))
                    last = k
        offset += len(line) + 1
    return out


def _reach(base: list[tuple[int, int, int]]) -> list[int]:
    """The greatest end of the spans up to each: the first span that ends after a place is found by bisection."""
    return list(accumulate((b for _, _, b in base), max))


def _labels(chain, base: list[tuple[int, int, int]], reach: list[int] | None = None) -> tuple[int, ...]:
    reach = _reach(base) if reach is None else reach
    tags, within = [], None
    for s, e, _ in chain:
        k = bisect_right(reach, s)
        hit = (base[k][0], base[k][2]) if k < len(base) and base[k][0] < e else None
        tags.append(OUTSIDE if hit is None else INSIDE if hit == within else BEGIN)
        within = hit
    return tuple(tags)


@dataclass(frozen=True)
class Field:
    """Feature weights per tag and tag transitions (begin, inside, outside; the border is outside)."""

    weights: dict[str, tuple[float, float, float]]
    moves: tuple[tuple[float, float, float], ...]

    def emissions(self, feats: Sequence[str]) -> list[float]:
        got = [self.weights[f] for f in feats if f in self.weights]
        return [sum(w[t] for w in got) for t in range(3)]

    def viterbi(self, chain: Sequence[Sequence[str]]) -> list[int]:
        if not self.weights:
            return [OUTSIDE] * len(chain)
        best, back = list(self.moves[OUTSIDE]), []
        for k, feats in enumerate(chain):
            own = self.emissions(feats)
            if k == 0:
                best = [best[t] + own[t] for t in range(3)]
            else:
                steps = [max(range(3), key=lambda a: best[a] + self.moves[a][t]) for t in range(3)]
                best = [best[steps[t]] + self.moves[steps[t]][t] + own[t] for t in range(3)]
                back.append(steps)
            if k == 0:
                best[INSIDE] = -1e9  # a chain starts after an outside token
        tag = max(range(3), key=lambda t: best[t] + self.moves[t][OUTSIDE])
        tags = [tag]
        for steps in reversed(back):
            tag = steps[tag]
            tags.append(tag)
        return tags[::-1]


def learn(counted: Sequence[tuple[tuple[tuple[str, ...], ...], tuple[int, ...], int]], rounds: int = 120) -> Field:
    """Maximum likelihood with ridge damping over counted (chain, tags) patterns; gradients by
    forward-backward, steps by Adagrad."""
    if not any(t != OUTSIDE for _, tags, _ in counted for t in tags):
        return Field({}, ((0.0,) * 3,) * 3)
    names = sorted({f for chain, _, _ in counted for feats in chain for f in feats})
    at = {f: i for i, f in enumerate(names)}
    data = [([[at[f] for f in feats] for feats in chain], tags, math.log1p(n)) for chain, tags, n in counted]
    total = sum(n for _, _, n in data)
    w, m = np.zeros((len(names), 3)), np.zeros((3, 3))
    m[OUTSIDE, INSIDE] = -50.0  # inside never follows outside
    seen_w, seen_m = np.full_like(w, 1e-8), np.full_like(m, 1e-8)
    for _ in range(rounds):
        gw, gm = -1e-4 * w, -1e-4 * m
        for chain, tags, n in data:
            own = np.array([w[ids].sum(0) for ids in chain])
            size = len(chain)
            fwd, bwd = np.zeros((size, 3)), np.zeros((size, 3))
            fwd[0] = m[OUTSIDE] + own[0]
            for k in range(1, size):
                fwd[k] = own[k] + np.logaddexp.reduce(fwd[k - 1][:, None] + m, axis=0)
            bwd[-1] = m[:, OUTSIDE]
            for k in range(size - 2, -1, -1):
                bwd[k] = np.logaddexp.reduce(m + (own[k + 1] + bwd[k + 1])[None, :], axis=1)
            z = np.logaddexp.reduce(fwd[-1] + bwd[-1])
            share = n / total
            p = np.exp(fwd + bwd - z)
            for k, ids in enumerate(chain):
                delta = -p[k]
                delta[tags[k]] += 1
                gw[ids] += share * delta
            edge = np.zeros((3, 3))
            edge[OUTSIDE] -= p[0]
            edge[OUTSIDE, tags[0]] += 1
            edge[:, OUTSIDE] -= p[-1]
            edge[tags[-1], OUTSIDE] += 1
            for k in range(1, size):
                edge -= np.exp(fwd[k - 1][:, None] + m + (own[k] + bwd[k])[None, :] - z)
                edge[tags[k - 1], tags[k]] += 1
            gm += share * edge
        gm[OUTSIDE, INSIDE] = 0
        seen_w += gw**2
        seen_m += gm**2
        w += 0.5 * gw / np.sqrt(seen_w)
        m += 0.5 * gm / np.sqrt(seen_m)
    return Field({f: tuple(map(float, w[i])) for f, i in at.items()}, tuple(tuple(map(float, r)) for r in m))


def fit(df: DataFrame, text: str = "text", most: int = MOST_CHAINS, longest: int = LONGEST_CHAIN) -> Field:
    """Count the labelled chains of all texts; learn from the ``most`` frequent distinct ones."""

    def make():
        def fn(texts):
            out = []
            for t in texts:
                t = t or ""
                base = base_spans(t)
                reach = _reach(base)
                own = Counter("\n".join(["".join(map(str, _labels(c, base, reach))), *(" ".join(f) for _, _, f in c)]) for c in chains(t))
                out.append([{"chain": c, "n": n} for c, n in own.items()])
            return {"seen": out}

        return fn

    rows = map_texts(df, text, make, [("seen", "array<struct<chain:string,n:bigint>>")], [])
    counted = rows.select(F.explode("seen").alias("c")).groupBy("c.chain").agg(F.sum("c.n").alias("n"))
    frequent = counted.where(F.length("chain") < longest).orderBy(F.desc("n"), "chain").limit(most).collect()
    return learn(
        [(tuple(tuple(f.split(" ")) for f in r["chain"].split("\n")[1:]), tuple(map(int, r["chain"].split("\n")[0])), r["n"]) for r in frequent]
    )


def spans(text: str | None, field: Field) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, is base) by start, then kind."""
    text = text or ""
    base = base_spans(text)
    out, taken = list(base), Taken([(a, b) for a, _, b in base])
    for chain in chains(text):
        tags = field.viterbi([f for _, _, f in chain])
        found: list[list[int]] = []
        for (s, e, _), tag in zip(chain, tags, strict=True):
            if tag == BEGIN:
                found.append([s, e])
            elif tag == INSIDE and found:
                found[-1][1] = e
        out += [(s, 3, e) for s, e in found if not taken.overlaps(s, e)]
    return [(KINDS[k], s, e, k < 3) for s, k, e in sorted(out)]


def find(df: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",), field: Field | None = None) -> DataFrame:
    """``keep`` and the secrets of every whole text (fits the field on ``df`` if none is given)."""
    field = field or fit(df, text)

    def make():
        return lambda texts: {"secrets": [[dict(zip(("kind", "start", "end", "base"), x, strict=True)) for x in spans(t, field)] for t in texts]}

    return map_texts(df, text, make, [("secrets", "array<struct<kind:string,start:int,end:int,base:boolean>>")], keep)


def joined(found: Sequence[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in found)


def digest(found: Sequence[tuple[str, int, int]]) -> str:
    return sha256_hex(joined(found))


