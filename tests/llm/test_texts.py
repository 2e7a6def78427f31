"""Row-wise operators against plain patterns, the tokenizer library and held-out labels."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from ledgerline.llm import languages, multiset_hash, piece_tokens, pii, quality, secret_tags, simhash
from ledgerline.llm.queries import QUERIES

from conftest import HARD, SF  # noqa: F401  (tests/llm/conftest.py)


def _strings(alphabet, n, longest, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, longest))) for _ in range(n)]


def test_piece_tokens_equal_the_library():
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(piece_tokens.MODEL))
    table = piece_tokens.table()
    texts = [t or "" for t in HARD] + _strings("abcdeth  ▁ \n.,!1é漢梦ｆ'\"(==--in er   the", 2000, 25)
    texts += [" " * n + x for n in range(40) for x in ("", "a", "漢")] + ["a" * n for n in range(40)]
    rng = random.Random(2)
    texts += ["".join(rng.choice(table.pieces[259:]).replace("▁", " ") for _ in range(rng.randint(1, 8))) for _ in range(2000)]
    for t in texts:
        ids = model.encode(t)
        assert table.encode(t) == ids, repr(t)
        assert table.decode(ids) == model.decode(ids), repr(t)


EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def _plain_pii(text):
    digits = lambda s: "".join(c for c in s if "0" <= c <= "9")
    out = [(0, *m.span()) for m in re.finditer(EMAIL, text)]
    out += [(1, *m.span()) for m in re.finditer(IP, text) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [(2, *m.span()) for m in re.finditer(CARD, text) if 16 <= len(digits(m.group())) <= 19 and pii.luhn(digits(m.group()))]
    return out + [(3, *m.span()) for m in re.finditer(PHONE, text) if 8 <= len(digits(m.group())) <= 15]


def test_private_base_spans_equal_the_plain_patterns():
    texts = _strings("a.@-+1 25(x%é", 6000, 30) + _strings("0123456789- .", 3000, 40, 3) + [t or "" for t in HARD]
    texts += ["4111 1111 1111 1111", "a@b.c@d.e f_x@y.z.", "1.2.3.4.5.6.7.8", "+1 (428) 555-5743 and 300.1.1.1"]
    for t in texts:
        assert pii.base_spans(t) == _plain_pii(t), repr(t)


def test_private_model_keeps_base_and_learns_checksums(docs):
    model = pii.fit(docs)
    text = "card 4111111111111112 or 4111111111111111, mail joe@example.com, License, Version 2.0."
    kinds = [(k, text[s:e], strict) for k, s, e, strict, _ in pii.spans(text, model)]
    assert kinds == [("email", "joe@example.com", True), ("card", "4111111111111111", True)]
    assert pii.masked("to joe@example.com!", model) == "to <EMAIL>!"
    assert pii.masked(None, model) is None
    assert model.reliability[1, 1, 2] > 0.8  # the checksum labeler agrees with true spans


def test_private_loose_span_is_added_when_labelers_agree():
    strict, loose = (0, (1, 1, 1, 0, 1, 1, 1, 0)), (0, (0, 1, 1, 1, 1, 1, 1, 0))
    wrong = (0, (0, -1, -1, -1, -1, 0, 1, 0))
    model = pii.learn({strict: 500, loose: 40, wrong: 300})
    assert model.score(*loose) > pii.ACCEPT > 0.5 > model.score(*wrong)


ASSIGN = r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def _plain_secrets(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(ASSIGN, text) if len(m.group(2)) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    return sorted(out + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 32])


def test_secret_base_spans_equal_the_plain_patterns():
    words = ["token", "TOKEN", "api_key", "apikey", "toKen", "pa", "passwd", "password", "=", ":", " ", '"', "'", "abcdef0123456789" * 2, "AKIA", "Z9" * 7, "x\n", "ſecret"]
    rng = random.Random(4)
    texts = ["".join(rng.choice(words) for _ in range(rng.randint(0, 12))) for _ in range(4000)] + [t or "" for t in HARD]
    for t in texts:
        assert secret_tags.base_spans(t) == _plain_secrets(t), repr(t)


def test_secret_field_decodes_like_brute_force_and_generalises():
    from itertools import product

    rng = np.random.default_rng(5)
    names = [f"f{k}" for k in range(6)]
    field = secret_tags.Field({n: tuple(rng.normal(size=3)) for n in names}, ((0.1, 0.5, -0.2), (0.3, 0.2, 0.1), (0.4, -50.0, 0.6)))
    for size in range(1, 6):
        chain = [[names[i] for i in rng.integers(0, 6, 3)] for _ in range(size)]

        def worth(tags):
            path = [2, *tags, 2]
            moves = sum(field.moves[a][b] for a, b in zip(path, path[1:]))
            return moves + sum(field.emissions(f)[t] for f, t in zip(chain, tags))

        allowed = [t for t in product(range(3), repeat=size) if t[0] != 1]
        assert worth(field.viterbi(chain)) == pytest.approx(max(map(worth, allowed)))


def test_secret_field_tags_an_unlabelled_shape():
    secret = 'key "9F86D081884C7D659A2FEAA0C55AD015A3BF4F1B" here'
    counted = Counter()
    for line in ['token = "9F86D081884C7D659A2FEAA0C55AD015A3BF4F1B"', "call 4111111111111112 now", "number 12345678 is"]:
        base = secret_tags.base_spans(line)
        for c in secret_tags.chains(line):
            counted[tuple(f for _, _, f in c), secret_tags._labels(c, base)] += 50
    field = secret_tags.learn([(c, t, n) for (c, t), n in counted.items()])
    assert [(k, secret[s:e]) for k, s, e, _ in secret_tags.spans(secret, field)] == [("tagged", "9F86D081884C7D659A2FEAA0C55AD015A3BF4F1B")]
    assert secret_tags.spans("call 4111111111111112 now", field) == []


def test_multiset_hash_is_homomorphic():
    parts = multiset_hash.paragraphs("one\ntwo\none\nthree")
    whole = multiset_hash.vector(parts)
    assert np.array_equal(whole, multiset_hash.vector(["three", "one", "one", "two"]))
    assert np.array_equal(multiset_hash.delete(multiset_hash.insert(whole, ["x", "y"]), ["y", "x"]), whole)
    assert not np.array_equal(whole, multiset_hash.vector(["one", "two", "three"]))
    new = multiset_hash.paragraphs("one\ntwo\nfour")
    assert np.array_equal(multiset_hash.edited(whole, parts, new), multiset_hash.vector(new))
    many = [f"paragraph {k}" for k in range(60)]
    near = multiset_hash.likeness(multiset_hash.vector(many), multiset_hash.vector(many[:50] + ["a", "b"]))
    assert 0.7 < near < 1 and multiset_hash.likeness(multiset_hash.vector(many), multiset_hash.vector(["q"] * 3)) < 0.35


def test_linked_fingerprints_equal_brute_force(spark, tmp_path):
    rows = [(5, "aaa\nb"), (9, "ccc\nd\ne"), (None, "nul"), (7, None), (7, ""), (1, "x" * 50), (-3, "y"), (9, "ccc")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = [r.asDict() for r in QUERIES["op9_fingerprints"](spark, str(tmp_path)).collect()]
    assert len(got) == len(rows)
    import xxhash

    signed = lambda t: (lambda v: v - (1 << 64) if v >> 63 else v)(xxhash.xxh64_intdigest(t.encode(), 42))
    order = sorted(((i is None, -(i or 0), signed(t or ""), t or "", i) for i, t in rows), key=lambda x: x[:3])
    want = []
    for k, (*_, t, i) in enumerate(order):
        after = order[(k + 1) % len(order)][3]
        n = len(t) // 3
        new = t[: len(t) - n] + after[:n]
        v = lambda x: multiset_hash.vector(multiset_hash.paragraphs(x))
        want.append((i, len(t), hashlib.sha256(new.encode()).hexdigest(), multiset_hash.as_text(v(t)), multiset_hash.as_text(v(new)), multiset_hash.likeness(v(t), v(after))))
    key = lambda x: tuple((y is None, y) for y in x)
    mine = [(r["doc_id"], r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"], r["near_next"]) for r in got]
    assert sorted(mine, key=key) == sorted(want, key=key)


def test_simhash_fingerprint_equals_brute_force():
    import xxhash

    def brute(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] * bool(w)
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes)) if hashes else 0

    for t in [*HARD, "A É\x0bx y\u00a0z  q", "The quick BROWN fox " * 9]:
        assert simhash.fingerprint(t) & (2**64 - 1) == brute(t)


def test_quality_on_held_out_labels(spark, tables):
    out = QUERIES["op1_quality"](spark, SF).join(tables("labels"), "doc_id").where("held_out").collect()
    assert sum(r["predicted"] == r["quality"] for r in out) / len(out) >= 0.85
    good, bad = ([r["score"] for r in out if r["quality"] == q] for q in (1, 0))
    assert sum(g > b for g in good for b in bad) >= 0.9 * len(good) * len(bad)


def test_isotonic_is_the_least_squares_monotone_fit():
    rng = np.random.default_rng(6)
    counts = [(float(k), float(g), 4.0) for k, g in enumerate(rng.integers(0, 5, 12))]
    steps = quality.isotonic(counts)
    values = [v for _, v in steps]
    assert values == sorted(values)
    # min-max formula of isotonic regression
    y = [g / n for _, g, n in counts]
    want = [max(min(np.mean(y[a : b + 1]) for b in range(i, 12)) for a in range(i + 1)) for i in range(12)]
    assert np.allclose(sorted(set(np.round(want, 9))), sorted(set(np.round(values, 9))))


def test_language_on_held_out_rows(spark, docs):
    out = QUERIES["op3_language"](spark, SF).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in out) / len(out) >= 0.95


def test_language_profile_is_the_sum_of_bound_vectors():
    codes, counts = np.unique(languages.trigrams("Abc abc! éa"), return_counts=True)
    want = sum(n * languages._bound(int(c)).astype(float) for c, n in zip(codes, counts))
    assert np.allclose(languages.profiles([(codes, counts)])[0], want)
    assert len(languages.trigrams("1 2 3")) == 0 and len(languages.trigrams(None)) == 0


ROWWISE = {
    "pieces": lambda df: piece_tokens.encode_decode(df),
    "private": lambda df: pii.find(df),
    "secrets": lambda df: secret_tags.find(df),
    "prints": lambda df: multiset_hash.fingerprints(df),
    "stats": lambda df: quality.with_statistics(df),
    "language": lambda df: languages.predict(df, languages.prototypes(df)),
    "simhash": lambda df: simhash.near_duplicates(df),
}


@pytest.mark.parametrize("name", ROWWISE)
def test_hard_rows_and_empty_tables(name, hard, empty):
    """One row out for each row in, whatever the columns are called."""
    op = ROWWISE[name]
    assert op(hard).count() == hard.count()
    assert op(empty).count() == 0
    clash = hard.withColumnsRenamed({"source": "score", "n_chars": "fp"}).selectExpr("*", "text as ids", "lang as spans", "1 as fingerprint", "2 as __text2")
    assert op(clash).count() == hard.count()


def test_language_without_letters_is_undetermined(hard):
    out = languages.predict(hard, languages.prototypes(hard)).collect()
    by = {(r["doc_id"], r["lang_pred"]) for r in out}
    assert (0, "und") in by and (1, "und") in by and (3, "und") in by and (4, "en") in by


def test_quality_without_labels_is_undecided(hard, spark):
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    stats = quality.with_statistics(hard)
    out = quality.scored(stats, quality.fit(stats, labels)).collect()
    assert len(out) == hard.count() and {r["score"] for r in out} == {0.5}
