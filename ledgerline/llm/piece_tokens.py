"""SentencePiece encoding and decoding through a merge-type prefix table.

For every prefix of a chunk the table holds the one token that can end its encoding.
Candidates are the vocabulary pieces that end there, found by an Aho-Corasick automaton;
a candidate fits if the token that ends the prefix before it may stand next to it, that
is, if merging the two strings side by side never joins symbols across their border.
The ids are then read backwards from the table.

Texts are cut first where no piece of the vocabulary can cross (before a word mark that
follows another character, and between letters and other signs where the vocabulary has
no such pair), and chunk encodings are kept in a bounded memory per worker.

Nulls encode as empty texts; an empty text has no ids and decodes to an empty text.
Repeated rows give repeated results. The work is linear in the text's length.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame

from ledgerline.llm.rows import map_texts, sha256_hex

MARK = "▁"
MODEL = "piece_bpe_32k.model"
KEPT_CHUNKS = 200_000
KEPT_PAIRS = 300_000
_LOADED: dict[str, PieceTable] = {}

OUTPUTS = {
    "ids": "array<int>",
    "decoded": "string",
    "n_tokens": "bigint",
    "ids_sha256": "string",
    "decoded_sha256": "string",
}


class PieceTable:
    """The vocabulary of one BPE model with byte fallback, word mark and no normaliser."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(model.vocab_size())
        self.pieces = [model.id_to_piece(i) for i in every]
        self.byte_of = {i: int(self.pieces[i][3:5], 16) for i in every if model.is_byte(i)}
        silent = {i for i in every if model.is_control(i)}
        unknown = model.unk_id()
        self.byte_id = {b: i for i, b in self.byte_of.items()}
        if len(self.byte_id) != 256:
            raise ValueError("the model has no byte fallback")
        text_ids = [i for i in every if i not in self.byte_of and i not in silent and i != unknown]
        self.id_of = {self.pieces[i]: i for i in text_ids}
        self.mark_id = self.id_of[MARK]
        # how an id is written: bytes over 127 as escapes, which decode() turns into UTF-8
        self.high_bytes = {i for i, b in self.byte_of.items() if b > 127}
        self.shown = [
            "" if i in silent else " ⁇ " if i == unknown else bytes([self.byte_of[i]]).decode("utf-8", "surrogateescape") if i in self.byte_of else self.pieces[i]
            for i in every
        ]
        self.sizes = [len(p) for p in self.pieces]

        # runs of marks are joined after everything else, left to right: they share the last priority
        self.runs = {len(p) for p in self.id_of if len(p) > 1 and set(p) == {MARK}}
        joined = [p for p in self.id_of if len(p) > 1 and set(p) != {MARK}]
        joined.sort(key=lambda p: -model.get_score(self.id_of[p]))
        self.rank = {p: k for k, p in enumerate(joined)}
        scores = [model.get_score(self.id_of[p]) for p in joined]
        run_scores = [model.get_score(self.id_of[MARK * n]) for n in self.runs]
        signs = {p for p in self.id_of if len(p) == 1}
        if any(a == b for a, b in zip(scores, scores[1:], strict=False)) or len(set(run_scores)) > 1:
            raise ValueError("two pieces have the same priority")
        if (run_scores and scores and run_scores[0] >= scores[-1]) or any(p.count(MARK) > 1 or MARK in p[1:] for p in joined):
            raise ValueError("word marks inside pieces are not supported")
        if any(c not in signs for p in joined for c in p):
            raise ValueError("a piece holds a sign that is no piece itself")

        self.left: dict[int, list[tuple[int, int]]] = {}
        self.right: dict[int, list[tuple[int, int]]] = {}
        self._spines(joined, signs)
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.id_of.items():
            if i in self.left:
                self.automaton.add_word(piece, i)
        self.automaton.make_automaton()
        self.chunk = re.compile(self._cuts(joined, signs))
        self.fits: dict[int, bool] = {}
        self.chunks: dict[str, tuple[int, ...]] = {}

    def _spines(self, joined: list[str], signs: set[str]) -> None:
        """Per piece: the symbols at its left and right edge while it is being merged, each with
        the priority at which the next one takes its place (no end: the piece itself)."""
        never = len(joined)
        for sign in signs:
            self.left[self.id_of[sign]] = self.right[self.id_of[sign]] = [(self.id_of[sign], never)]
        for piece in joined:  # parts come before the whole, because they are merged earlier
            parts = list(piece)
            while len(parts) > 1:
                best = min(range(len(parts) - 1), key=lambda k: (self.rank.get(parts[k] + parts[k + 1], never), k))
                if parts[best] + parts[best + 1] not in self.rank:
                    break
                if len(parts) > 2:
                    parts[best : best + 2] = [parts[best] + parts[best + 1]]
                    continue
                i, at = self.id_of[piece], self.rank[piece]
                ends = []
                for spine, part in ((self.left, parts[0]), (self.right, parts[1])):
                    below = spine.get(self.id_of[part])
                    if below is None or (len(below) > 1 and below[-2][1] >= at):
                        raise ValueError(f"piece {piece!r} is merged before its parts")
                    ends.append([*below[:-1], (below[-1][0], at), (i, never)])
                self.left[i], self.right[i] = ends
                break

    def _cuts(self, joined: list[str], signs: set[str]) -> str:
        """Chunks end before a mark and where a Latin word meets other signs, unless a piece of
        the vocabulary has such a pair of signs; signs outside the vocabulary stand alone."""
        word = {c for c in signs if re.match("[A-Za-z\u00c0-\u024f]", c)}
        pairs = {(a, b) for p in joined for a, b in zip(p, p[1:], strict=False) if b != MARK}
        while more := {b for a, b in pairs if a in word and b not in word}:
            word |= more
        inside = "".join(map(re.escape, sorted(word)))
        line = "" if "\n" in signs else "\n"
        return rf"{MARK}*[^{MARK}{line}{inside}]*[{inside}]+|{MARK}*[^{MARK}{line}{inside}]+|{MARK}+" + (r"|\n+" if line else "")

    def may_follow(self, a: int, b: int) -> bool:
        """Whether ``a`` and ``b`` stay apart when the text of both is merged."""
        ends, starts, i, j, apart = self.right[a], self.left[b], 0, 0, True
        while True:
            (x, x_gone), (y, y_gone) = ends[i], starts[j]
            at = self.rank.get(self.pieces[x] + self.pieces[y])
            if at is not None and at < x_gone and at <= y_gone:
                apart = False
                break
            if i + 1 < len(ends) and (x_gone <= y_gone or j + 1 == len(starts)):
                i += 1
            elif j + 1 < len(starts):
                j += 1
            else:
                break
        if len(self.fits) >= KEPT_PAIRS:
            self.fits.clear()
        self.fits[a << 20 | b] = apart
        return apart

    def encode_chunk(self, chunk: str) -> tuple[int, ...]:
        last = [-1] * len(chunk)
        sizes, fits = self.sizes, self.fits
        for end, token in self.automaton.iter(chunk):
            if last[end] < 0:
                before = end - sizes[token]
                if before >= 0 and (prior := last[before]) >= 0:
                    apart = fits.get(prior << 20 | token)
                    if not (self.may_follow(prior, token) if apart is None else apart):
                        continue
                last[end] = token
        out: list[int] = []
        at = len(chunk) - 1
        while at >= 0:
            token = last[at]
            if token >= 0:
                out.append(token)
                at -= sizes[token]
            else:
                out += [self.byte_id[b] for b in reversed(chunk[at].encode("utf-8", "surrogatepass"))]
                at -= 1
        out.reverse()
        if self.runs and chunk.startswith(MARK * 2):
            return tuple(self._joined_runs(out))
        return tuple(out)

    def _joined_runs(self, ids: list[int]) -> list[int]:
        """Join the leading marks of a chunk, always the leftmost pair that makes a piece."""
        count = 0
        while count < len(ids) and ids[count] == self.mark_id:
            count += 1
        sizes: list[int] = []
        for k in range(count):
            sizes.append(1)
            if k + 1 < count and len(sizes) == 1:
                continue
            while len(sizes) > 1 and sizes[-2] + sizes[-1] in self.runs:
                sizes[-2:] = [sizes[-2] + sizes[-1]]
        return [self.id_of[MARK * n] for n in sizes] + ids[count:]

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        out: list[int] = []
        chunks = self.chunks
        for chunk in self.chunk.findall(MARK + text.replace(" ", MARK)):
            ids = chunks.get(chunk)
            if ids is None:
                ids = self.encode_chunk(chunk)
                if len(chunk) <= 40:
                    if len(chunks) >= KEPT_CHUNKS:
                        chunks.clear()
                    chunks[chunk] = ids
            out += ids
        return out

    def decode(self, ids: Sequence[int]) -> str:
        """Pieces side by side, marks as spaces without the first one, bytes as UTF-8."""
        text = "".join(map(self.shown.__getitem__, ids))
        text = (text[1:] if text.startswith(MARK) else text).replace(MARK, " ")
        if self.high_bytes.isdisjoint(ids):
            return text
        return text.encode("utf-8", "surrogateescape").decode("utf-8", "replace")


def table(path: str | None = None) -> PieceTable:
    """The table of a model file, one per worker process (None: the public 32k model)."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(MODEL)
    if path not in _LOADED:
        _LOADED[path] = PieceTable(path)
    return _LOADED[path]


def encode_decode(
    df: DataFrame,
    text: str = "text",
    keep: Sequence[str] = ("doc_id",),
    outputs: Sequence[str] = ("ids", "decoded"),
    model: str | None = None,
) -> DataFrame:
    """``keep`` and, of each whole text, the ``outputs``: ids, the text decoded from them,
    the number of ids, or the digests of ids and decoded text."""

    def make():
        pieces = table(model)
        digits = [str(i) for i in range(len(pieces.pieces))]

        def fn(texts: list[str | None]) -> dict[str, list]:
            got: dict[str, list] = {n: [] for n in outputs}
            for one in texts:
                ids = pieces.encode(one)
                decoded = pieces.decode(ids) if any(n.startswith("decoded") for n in outputs) else None
                for n, values in got.items():
                    if n == "ids":
                        values.append(ids)
                    elif n == "decoded":
                        values.append(decoded)
                    elif n == "n_tokens":
                        values.append(len(ids))
                    elif n == "ids_sha256":
                        values.append(sha256_hex(",".join([digits[i] for i in ids])))
                    else:
                        values.append(sha256_hex(decoded))
            return got

        return fn

    return map_texts(df, text, make, [(n, OUTPUTS[n]) for n in outputs], keep)
