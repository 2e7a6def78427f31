"""Personal data by weak supervision.

Candidate spans come from strict patterns (the base, which always stays) and from loose ones.
Labelers (regex, checksum, gazetteer, context, border, grouping) vote 1, -1 or 0 on each candidate.
Expectation-maximisation over the counted vote patterns of all texts estimates how reliable
each labeler is; the posteriors then train a logistic span classifier on votes and shape.
A loose candidate that the classifier accepts, that passes its checksum and that overlaps no base
span becomes a span.

The corpus is only counted: one row per distinct pattern reaches the driver, and the patterns
are products of small finite sets. Texts are read once to count and once to apply.

Nulls and empty texts have no spans; repeated rows give repeated results; with no candidates at
all (empty tables) only base spans are returned. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.rows import Taken, _q, map_texts, sha256_hex

KINDS = ("email", "ip", "card", "phone")
ACCEPT = 0.9
LABELERS = 6

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_ANY = re.compile(r"[0-9@]")
_LOOSE = {
    "email": re.compile(r"(?<![\w.])[\w.+-]{1,64} ?(?:@|\(at\)|\[at\]) ?[\w-]{1,63} ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z]{2,}(?!\w)", re.I),
    "ip": re.compile(r"(?<![\w:])(?:[0-9A-Fa-f]{1,4}:){4,7}[0-9A-Fa-f]{1,4}(?![\w:])|(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w.])"),
    "card": re.compile(r"(?<!\w)\d{4}(?:[ ./-]?\d{4}){2}[ ./-]?\d{1,7}(?!\w)"),
    "phone": re.compile(r"(?<![\w+])(?:00)?\(?\d{2,4}\)?[ ./-]\d{2,4}(?:[ ./-]\d{2,4}){1,3}(?!\w)"),
}

# gazetteers (fixed values)
TOP_DOMAINS = frozenset("com org net edu gov io de fr es it uk eu us ca ch at be nl pl info biz dev app".split())
RESERVED_FIRST = frozenset({0, 127, 255})
CARD_FIRST = frozenset("3456")
CALLING = ("1", "20", "27", "30", "31", "32", "33", "34", "36", "39", "4", "5", "6", "7", "8", "90", "91", "92", "98")
FOR_WORDS = {
    "email": ("mail", "contact", "write", "correo", "courriel"),
    "ip": ("ip", "host", "server", "address", "ping"),
    "card": ("card", "visa", "credit", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "fax", "mobile", "whatsapp"),
}
AGAINST_WORDS = ("version", "license", "isbn", "issn", "page", "release", "build", "chapter", "order", "doi")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of the strict email pattern in linear time: the local part is the whole
    run of its signs before the at sign, back to the end of the last match."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            done = m.end()
            out.append((start, done))
        at = text.find("@", max(at + 1, done))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of the strict patterns, by kind, then start."""
    if not _ANY.search(text):
        return []
    out = [(0, s, e) for s, e in _emails(text)]
    out += [(1, *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split("."))]
    for m in _CARD.finditer(text):
        if 16 <= (m.end() - m.start()):
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append((2, *m.span()))
    if "+" in text:
        out += [(3, *m.span()) for m in _PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m.group()) <= 15]
    return out


def _votes(text: str, kind: str, start: int, end: int, strict: bool) -> tuple[int, ...]:
    span = text[start:end]
    digits = "".join(c for c in span if "0" <= c <= "9")
    before, after = text[max(0, start - 40) : start].lower(), text[end : end + 1]
    words = re.findall(r"\w+", before)[-4:]
    if kind == "email":
        top = re.split(r"[.\])]", span)[-1].strip().lower()
        valid, listed = (1 if re.fullmatch(r"[a-z]{2,12}", top) else -1), (1 if top in TOP_DOMAINS else -1)
        grouped = 1 if " " not in span else 0
    elif kind == "ip":
        parts = span.split(".") if "." in span else []
        valid = 1 if not parts or all(len(p) <= 3 and int(p) <= 255 for p in parts if p.isdigit()) else -1
        listed = -1 if parts and parts[0].isdigit() and (len(parts[0]) > 3 or int(parts[0]) in RESERVED_FIRST or int(parts[0]) > 239) else 1
        grouped = -1 if parts and any(len(p) > 1 and p[0] == "0" for p in parts) else 1
    elif kind == "card":
        valid, listed = (1 if 16 <= len(digits) <= 19 and luhn(digits) else -1), (1 if digits[:1] in CARD_FIRST else -1)
        grouped = 1 if len({c for c in span if not c.isdigit()}) <= 1 and "." not in span and "/" not in span else -1
    else:
        valid, listed = (1 if 8 <= len(digits) <= 15 else -1), (1 if span[0] == "+" and digits.startswith(CALLING) else 0)
        grouped = -1 if re.fullmatch(r"\d{4}[-/.]\d{2}[-/.]\d{2,4}|\d{2}[-/.]\d{2}[-/.]\d{4}", span) else 1 if span[0] in "+(" else 0
    context = -1 if any(w in AGAINST_WORDS for w in words) else 1 if any(w.startswith(FOR_WORDS[kind]) for w in words) else 0
    border = -1 if (before[-1:].isalnum() or after.isalnum()) else 1
    return (1 if strict else 0, valid, listed, context, border, grouped)


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, bool, tuple]]:
    """(kind, start, end, is base, pattern) of base spans and of loose matches beside them.
    A pattern is the six votes, a length class and a digit share class."""
    found = [(k, s, e, True) for k, s, e in base]
    if _ANY.search(text) or "(at)" in text or "[at]" in text:
        taken = Taken([(s, e) for _, s, e in base])
        for k, kind in enumerate(KINDS):
            found += [(k, *m.span(), False) for m in _LOOSE[kind].finditer(text) if not taken.overlaps(*m.span())]
    out = []
    for k, s, e, strict in found:
        share = sum("0" <= c <= "9" for c in text[s:e]) / (e - s)
        shape = (min(3, (e - s) // 8), int(share * 3.99))
        out.append((k, s, e, strict, _votes(text, KINDS[k], s, e, strict) + shape))
    return out


@dataclass(frozen=True)
class SpanModel:
    """Labeler reliabilities and classifier weights; ``scores`` by (kind, pattern) of the fit."""

    prior: dict[int, float] = field(default_factory=dict)
    reliability: np.ndarray | None = None
    weights: np.ndarray | None = None

    def score(self, kind: int, pattern: Sequence[int]) -> float:
        if self.weights is None:
            return 0.0
        return float(1 / (1 + np.exp(-(_features(kind, pattern) @ self.weights))))


def _features(kind: int, pattern: Sequence[int]) -> np.ndarray:
    x = np.zeros(1 + len(KINDS) + 2 * LABELERS + 8)
    x[0] = x[1 + kind] = 1
    for j in range(LABELERS):
        if pattern[j]:
            x[1 + len(KINDS) + 2 * j + (pattern[j] > 0)] = 1
    x[1 + len(KINDS) + 2 * LABELERS + pattern[LABELERS]] = 1
    x[5 + len(KINDS) + 2 * LABELERS + pattern[LABELERS + 1]] = 1
    return x


def learn(counts: dict[tuple[int, tuple[int, ...]], int], rounds: int = 30) -> SpanModel:
    """Dawid-Skene estimation over counted patterns, then a ridge-damped logistic fit (Newton)."""
    if not counts:
        return SpanModel()
    keys = sorted(counts)
    n = np.array([counts[k] for k in keys], float)
    kind = np.array([k for k, _ in keys])
    votes = np.array([p[:LABELERS] for _, p in keys]) + 1
    mean = (votes - 1).sum(1)
    q = np.where(mean >= 3, 0.95, np.where(mean <= 0, 0.05, 0.5))
    for _ in range(rounds):
        prior = np.array([((n * q)[kind == k].sum() + 1) / (n[kind == k].sum() + 2) for k in range(len(KINDS))])
        table = np.ones((2, LABELERS, 3))  # add-one: P(vote | class) of each labeler
        for j in range(LABELERS):
            table[1, j] += np.bincount(votes[:, j], n * q, 3)
            table[0, j] += np.bincount(votes[:, j], n * (1 - q), 3)
        table /= table.sum(2, keepdims=True)
        log_odds = np.log(prior / (1 - prior))[kind]
        for j in range(LABELERS):
            log_odds = log_odds + np.log(table[1, j, votes[:, j]] / table[0, j, votes[:, j]])
        q = 1 / (1 + np.exp(-np.clip(log_odds, -30, 30)))
    x = np.array([_features(k, p) for k, p in keys])
    w = np.zeros(x.shape[1])
    n = n / n.sum() * min(n.sum(), 1e4)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (n * (q - p)) - 0.1 * w
        hess = (x * (n * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + 0.1 * np.eye(len(w))
        w = w + np.clip(np.linalg.solve(hess, grad), -2, 2)
    return SpanModel({k: float(v) for k, v in enumerate(prior)}, table, w)


def fit(df: DataFrame, text: str = "text") -> SpanModel:
    """Count the candidate patterns of all texts and learn the model from the counts."""

    def make():
        def fn(texts):
            seen = []
            for t in texts:
                t = t or ""
                own = Counter(f"{k}:{','.join(map(str, p))}" for k, _, _, _, p in candidates(t, base_spans(t)))
                seen.append(list(own.items()))
            return {"seen": [[{"pattern": p, "n": c} for p, c in one] for one in seen]}

        return fn

    rows = map_texts(df, text, make, [("seen", "array<struct<pattern:string,n:bigint>>")], [])
    counted = rows.select(F.explode("seen").alias("c")).groupBy("c.pattern").agg(F.sum("c.n").alias("n")).collect()
    counts = {}
    for r in counted:
        k, _, p = r["pattern"].partition(":")
        counts[int(k), tuple(map(int, p.split(",")))] = r["n"]
    return learn(counts)


def spans(text: str | None, model: SpanModel) -> list[tuple[str, int, int, bool, float]]:
    """(kind, start, end, is base, score) by kind, then start."""
    text = text or ""
    base = base_spans(text)
    out, taken = [], Taken()
    for k, s, e, strict, p in sorted(candidates(text, base), key=lambda c: (not c[3], c[0], c[1])):
        score = model.score(k, p)
        if strict or (score >= ACCEPT and p[1] >= 0 and not taken.overlaps(s, e)):
            taken.add(s, e)
            out.append((k, s, e, strict, score))
    return [(KINDS[k], s, e, strict, score) for k, s, e, strict, score in sorted(out)]


def masked(text: str | None, model: SpanModel) -> str | None:
    """The text with each span replaced by its kind in angle brackets; the earliest, then the
    longest of overlapping spans is replaced and covers the others."""
    if text is None:
        return None
    parts, done = [], 0
    for kind, s, e, _, _ in sorted(spans(text, model), key=lambda x: (x[1], -x[2])):
        if s >= done:
            parts += [text[done:s], f"<{kind.upper()}>"]
        done = max(done, e)
    return "".join([*parts, text[done:]])


def find(df: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",), model: SpanModel | None = None) -> DataFrame:
    """``keep`` and the spans of every whole text (fits the model on ``df`` if none is given)."""
    model = model or fit(df, text)

    def make():
        def fn(texts):
            return {"pii": [[dict(zip(("kind", "start", "end", "base", "score"), x, strict=True)) for x in spans(t, model)] for t in texts]}

        return fn

    return map_texts(df, text, make, [("pii", "array<struct<kind:string,start:int,end:int,base:boolean,score:double>>")], keep)


def mask(df: DataFrame, text: str = "text", model: SpanModel | None = None) -> DataFrame:
    """``df`` with the spans of the text column masked; all columns and rows stay."""
    model = model or fit(df, text)

    def make():
        return lambda texts: {text: [masked(t, model) for t in texts]}

    return map_texts(df, text, make, [(text, "string")], df.columns).select(*[_q(c) for c in df.columns])


def joined(found: Sequence[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in found)


def digest(found: Sequence[tuple[str, int, int]]) -> str:
    return sha256_hex(joined(found))
