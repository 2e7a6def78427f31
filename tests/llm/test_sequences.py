"""Phrases, hard negatives and packing, against brute force."""

import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerline.llm import collocations, hard_negatives, packing
from ledgerline.llm.queries import QUERIES

from conftest import SF

BYTE_LEVEL = public_tokenizers.path("byte_bpe_50k.json")


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


# --- phrases


def _phrases(texts, least, longest, top, covered):
    """(group, text) pairs to the rows of ``collocations``, counted one by one."""
    f, n = {}, Counter()
    for group, text in texts:
        group, lower = group or "und", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[group] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f.setdefault(group, Counter())[tuple(words[i : i + k])] += 1
    out = []
    for group, counts in f.items():
        found = {p: a for p, a in counts.items() if a >= least and len(p) >= 2}
        kept = []
        for p, a in found.items():
            holds = lambda q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))  # noqa: E731, B023
            if not any(len(q) > len(p) and 100 * b >= covered * a and holds(q) for q, b in found.items()):
                score, _, left, right = min((1000 * a * n[group] // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(group, k, p.decode(), -a, x, y, n[group], -s) for k, (s, a, p, x, y) in enumerate(sorted(kept)[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize(("least", "longest", "top", "covered", "part"), [(3, 5, 2000, 100, 40), (2, 4, 7, 60, 10**6), (5, 3, 10**6, 100, 1), (4, 2, 5, 100, 100)])
def test_phrases_equal_those_counted_one_by_one(spark, docs, least, longest, top, covered, part):
    texts = [(r["lang"], r["text"]) for r in docs.where("doc_id % 4 = 0").collect()]
    texts += [("en", "A b. a b a b a b"), ("en", "x" * 70 + " y ") , (None, "É é É é É é"), ("und", "\té \n é é,é é é"), ("en", None), (None, ""), ("de", " ,.! ")]
    df = spark.createDataFrame(texts, "lang string, text string").repartition(3)
    got = collocations.collocations(df, least=least, longest=longest, top=top, covered=covered, part=part, small=10 if part == 40 else collocations.SMALL)
    assert _rows(got) == _phrases(texts, least, longest, top, covered)


def test_a_text_longer_than_a_slice_is_cut_without_losing_phrases(spark, monkeypatch):
    monkeypatch.setattr(collocations, "SLICE", 64)
    texts = ["one two three four five six. " * 40 + "w" * 200 + " tail", "a b c d e f g h " * 60, ""]
    for text in texts:
        got = [w for words in collocations._words(text, 4) for w in words]
        assert got == text.lower().replace(".", " \n ").encode().replace(b"\n", b"\xff").split()
        assert all(len(words) > 4 for words in list(collocations._words(text, 4))[:-1])


def test_phrases_of_hard_rows(spark, hard, empty):
    assert _rows(collocations.collocations(empty)) == []
    clash = hard.selectExpr("*", "doc_id AS gid", "text AS phrase", "text AS word", "1 AS n", "lang AS part")
    want = _phrases([(r["lang"], r["text"]) for r in hard.collect()], 100, 5, 2000, 100)
    assert _rows(collocations.collocations(clash)) == want


def test_phrase_products_beyond_64_bits(spark, monkeypatch):
    """The score's terms are decimals: 1000 * a * n and l * r pass 64 bits here."""
    real = collocations.frequent_phrases
    big = 3_000_000_000

    def scaled_up(*args, **named):
        tables, totals = real(*args, **named)
        tables = [t.withColumn("a", F.col("a") * big).withColumns({c: F.transform(c, lambda x: x * big) for c in ("first", "last")}) for t in tables]
        return tables, totals.withColumn("n", F.col("n") * big)

    monkeypatch.setattr(collocations, "frequent_phrases", scaled_up)
    df = spark.createDataFrame([("en", "a b. " * 5 + "a c b a. " * 3)], "lang string, text string")
    got = {r["phrase"]: r for r in collocations.collocations(df, least=2).collect()}
    plain = {p: s for _, _, p, _, _, _, _, s in _phrases([("en", "a b. " * 5 + "a c b a. " * 3)], 2, 5, 99, 100)}
    assert {p: r["score"] for p, r in got.items()} == plain and got["a b"]["n"] == 22 * big


# --- hard negatives


def _negatives(rows, anchors, positives=5, negatives=10, low=30, high=90):
    """rows: (id, vector of ints, label)."""
    out = []
    last = lambda i: (i is None, i or 0)
    dot = lambda x, y: max(1 - 2**63, min(2**63 - 1, sum(p * q for p, q in zip(x, y, strict=False))))
    for k, (i, x, label) in enumerate(rows):
        if i is None or not anchors(i):
            continue
        scores = [(-dot(x, y), last(j), n, m) for n, (j, y, m) in enumerate(rows) if n != k]
        for p, j, _, _ in sorted(s for s in scores if s[3] == label)[:positives]:
            fit = sorted(s for s in scores if s[3] != label and 30 * -p <= 100 * -s[0] <= 90 * -p)[:negatives]
            out += [(i, None if j[0] else j[1], r, None if m[0] else m[1], -p, -s) for r, (s, m, _, _) in enumerate(fit, 1)]
    return out


def _text(rows):
    return sorted(map(str, rows))


@pytest.mark.parametrize(("dims", "labels", "slab", "leaf", "block", "spread"), [(8, 3, 50, 7, 4, 1.0), (3, 2, 40, 5, 1000, 0.02), (1, 40, 1000, 16, 3, 1.0), (20, 5, 64, 8, 16, 1e6), (20, 5, 64, 8, 16, 1e9)])
def test_negatives_equal_those_found_one_by_one(spark, dims, labels, slab, leaf, block, spread):
    rng = np.random.default_rng(dims)
    x = rng.normal(0, spread, (300, dims))
    x[100:200] = x[100]  # copies: ties everywhere
    rows = [(int(k) if k % 90 else None if k == 90 else 0, [float(v) for v in x[k]], int(rng.integers(labels))) for k in range(300)]
    rows += [rows[4], rows[5], (20, [], 1), (30, [1.0], 0)]
    bad = [(40, None, 1), (50, [float("nan")] * dims, 0), (60, [float("inf")] * dims, 0), (70, [None] * dims, 1), (80, [0.5] * dims, None)]
    df = spark.createDataFrame(rows + bad, "vec_id bigint, embedding array<double>, label int").withColumn("row", F.lit(1)).withColumn("slab", F.lit("x"))
    got = hard_negatives.hard_negatives(df.repartition(3), F.col("id") % 10 == 0, slab=slab, leaf=leaf, block=block)
    whole = [(i, [int(np.floor(256 * v)) for v in e], y) for i, e, y in rows]
    assert _text(tuple(r) for r in got.collect()) == _text(_negatives(whole, lambda i: i % 10 == 0))


def test_scores_between_53_and_63_bits(spark):
    rows = [(k, [float(2**29 + 3 * k), float(2**28 - k)], k % 2) for k in range(40)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got = hard_negatives.hard_negatives(df, F.col("id") % 10 == 0, scale=1, leaf=4, low=30, high=100)
    assert got.count() > 0
    want = []
    for i, x, y in rows[::10]:
        s = {j: sum(int(p) * int(q) for p, q in zip(x, v, strict=True)) for j, v, _ in rows}
        for p in sorted((j for j, _, z in rows if z == y and j != i), key=lambda j: (-s[j], j))[:5]:
            fit = [j for j, _, z in rows if z != y and 30 * s[p] <= 100 * s[j] <= 100 * s[p]]
            want += [(i, p, r, m, s[p], s[m]) for r, m in enumerate(sorted(fit, key=lambda j: (-s[j], j))[:10], 1)]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_a_slab_opens_only_some_of_its_leaves():
    """Boxes outside the window or strictly below the kth score stay closed."""
    import pyarrow as pa

    rng = np.random.default_rng(1)
    n, d = 4096, 2
    x = np.floor(rng.normal(0, 100, (n, d)))
    table = pa.table({"row": np.arange(n), "id": np.arange(n), "label": np.zeros(n, np.int64) + np.arange(n) % 2, "x": pa.array(list(x))})
    batches = []
    from pyspark import TaskContext

    real, TaskContext.get = TaskContext.get, classmethod(lambda cls: type("T", (), {"partitionId": lambda self: 0})())
    try:
        batches = list(hard_negatives._pack([0, 1], 64)(iter(table.to_batches())))
    finally:
        TaskContext.get = real
    tree = hard_negatives.Tree(pa.Table.from_batches(batches), d, True)
    opened = []
    tree.leaves = _Counting(tree.leaves, opened)
    for a in x[:50]:
        opened.clear()
        got = tree.search(0, 0, a, [(0, 5000), (-(2**60), 2**60)], 5, False)
        scores = x @ a
        for (low, high), g in zip([(0, 5000), (-(2**60), 2**60)], got, strict=True):
            assert g == sorted(((int(s), k, k) for k, s in enumerate(scores) if k % 2 and low <= s <= high), key=lambda t: (-t[0], t[1]))[:5]
        assert len(opened) < len(tree.leaves.all)
    assert len(opened) <= len(tree.leaves.all) / 2


class _Counting:
    def __init__(self, leaves, opened):
        self.all, self.opened = leaves, opened

    def __getitem__(self, k):
        self.opened.append(k)
        return self.all[k]


def test_negatives_of_empty_tables_and_without_anchors(spark):
    none = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")
    assert hard_negatives.hard_negatives(none, F.col("id") % 100 == 0).collect() == []
    some = spark.createDataFrame([(1, [1.0], 0), (2, [1.0], 1)], none.schema)
    assert hard_negatives.hard_negatives(some, F.col("id") % 100 == 0).collect() == []
    assert hard_negatives.hard_negatives(some, F.col("id") == 1).collect() == []  # no positive
    empty_vectors = spark.createDataFrame([(k, [], k % 2) for k in range(6)], none.schema)
    got = hard_negatives.hard_negatives(empty_vectors, F.col("id") == 0)
    assert sorted(tuple(r)[:4] for r in got.collect()) == [(0, p, r, m) for p in (2, 4) for r, m in ((1, 1), (2, 3), (3, 5))]


# --- packing


def _packed(pieces, ids, size):
    """Every id of ``ids`` (key to list) lies in one piece; sequences have no gaps and all but the last are full."""
    parts = {}
    for r in pieces:
        parts.setdefault(r["sequence_id"], []).append(r)
    for s, rows in parts.items():
        at = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at == size or (s == max(parts) and at < size)
    assert sorted(parts) == list(range(len(parts)))
    for key, want in ids.items():
        at = 0
        for r in sorted((r for r in pieces if r["doc_id"] == key), key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(want)
            assert np.frombuffer(r["ids"], "<u4").tolist() == want[at : at + r["length"]]
            at += r["length"]
        assert at == len(want)


@pytest.mark.parametrize("size", [1, 7, 2048])
def test_every_id_lies_in_one_piece(spark, docs, size):
    docs = docs.where("doc_id % 5 = 0") if size == 1 else docs
    library = Tokenizer.from_file(BYTE_LEVEL)
    ids = {r["doc_id"]: [*library.encode(r["text"] or "", add_special_tokens=False).ids, 1] for r in docs.collect()}
    pieces = packing.pack(docs.repartition(5), BYTE_LEVEL, size=size)
    _packed(pieces.collect(), ids, size)
    if size == 7:
        whole = packing.sequences(pieces).collect()
        assert sum(r["n"] for r in whole) == sum(map(len, ids.values()))
        for r in whole:
            row = np.frombuffer(r["ids"], "<u4").tolist()
            assert len(row) == r["n"] and [b["offset"] for b in r["boundaries"]] == np.cumsum([0] + [b["length"] for b in r["boundaries"]])[:-1].tolist()
            for b in r["boundaries"]:
                assert row[b["offset"] : b["offset"] + b["length"]] == ids[b["key"]][b["start"] : b["start"] + b["length"]]


def test_packing_of_hard_rows(spark, hard, empty):
    clash = hard.selectExpr("*", "1 AS part", "text AS ids", "text AS key", "2 AS n", "3 AS sequence_id")
    pieces = packing.pack(clash, BYTE_LEVEL, size=64).collect()
    library = Tokenizer.from_file(BYTE_LEVEL)
    lengths = Counter(len(library.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in hard.collect())
    assert sum(r["length"] for r in pieces) == sum(k * v for k, v in lengths.items())
    assert Counter(r["doc_tokens"] for r in pieces if r["start"] == 0) == lengths
    rows = {}
    for r in pieces:
        rows[r["sequence_id"]] = rows.get(r["sequence_id"], 0) + r["length"]
    assert set(list(rows.values())[:-1]) <= {64, min(rows.values())} and sorted(rows) == list(range(len(rows)))
    assert packing.pack(empty, BYTE_LEVEL).collect() == [] and packing.sequences(packing.pack(empty, BYTE_LEVEL)).collect() == []


def test_ids_equal_those_of_the_library(docs):
    library, own = Tokenizer.from_file(BYTE_LEVEL), packing.encoder(BYTE_LEVEL)
    texts = [r["text"] or "" for r in docs.collect()]
    texts += [" " * 1_200_000, "\n" * 3000 + "x", "z" * 50_000, "漢" * 9000, "a<|endoftext|>b", "I'LL i'll 'tis ٣½² é́ \x00‍　 \U0001fae8", "\t \t", "\r\n\r\n x"]
    for text in texts:
        assert own(text).tolist() == library.encode(text, add_special_tokens=False).ids
    other = public_tokenizers.path("word_bpe_49k.json")
    assert packing.encoder(other)("Hello  World").tolist() == Tokenizer.from_file(other).encode("Hello  World", add_special_tokens=False).ids


def test_the_library_is_loaded_for_texts_that_need_it(monkeypatch):
    import tokenizers

    made = []
    monkeypatch.setattr(tokenizers, "Tokenizer", type("Counting", (), {"from_file": staticmethod(lambda path: made.append(path) or Tokenizer.from_file(path))}))
    own = packing.encoder(BYTE_LEVEL)
    assert own("Plain words.").tolist() == Tokenizer.from_file(BYTE_LEVEL).encode("Plain words.", add_special_tokens=False).ids
    assert made == []
    for text in (" " * 1_200_000, " " * 1_200_001):
        assert len(own(text)) == len(Tokenizer.from_file(BYTE_LEVEL).encode(text, add_special_tokens=False).ids)
    assert made == [BYTE_LEVEL]
    word_level = public_tokenizers.path("word_bpe_49k.json")
    assert len(packing.encoder(word_level)("Hello  World")) and made == [BYTE_LEVEL, word_level]


def test_registered_packing(spark, docs):
    got = QUERIES["op13_packing"](spark, SF)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    library = Tokenizer.from_file(BYTE_LEVEL)
    ids = {r["doc_id"]: [*library.encode(r["text"] or "", add_special_tokens=False).ids, 1] for r in docs.collect()}
    rows = [r.asDict() for r in got.collect()]
    for r in rows:
        r["ids"] = np.array(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]], "<u4").tobytes()
        assert r["ids_crc32"] == zlib.crc32(r["ids"])
    _packed(rows, ids, 2048)


def test_pairs_of_all_parts_are_counted_by_bucket():
    rng = np.random.default_rng(8)
    idx = np.arange(1, 31, dtype=np.int32)
    gid = (rng.permutation(30) * 7 + (5 << 33)).astype(np.int64)
    name = dict(zip(idx.tolist(), gid.tolist(), strict=True))
    want, lists, texts = Counter(), [], {}
    for part in (4, 9, 11):
        places = rng.integers(0, 40, 400).astype(np.int32)  # 0 ends a piece, above 30 is rare
        own = 396
        relation = pa.table({"part": [part], "n": [own], "places": [collocations.shrunk(places)]})
        made = collocations._extend(relation, idx, gid, 4)
        assert made.num_rows <= 5  # a row for each bucket, not for each pair
        pairs = [(name.get(x), name.get(y)) if x in name and y in name else None for x, y in zip(places.tolist(), places.tolist()[1:], strict=False)]
        want.update(x for x in pairs[:own] if x)
        at = made.filter(pc.is_valid(made["places"]))["places"][0].as_py()
        texts[part] = pairs, collocations.full(at, np.int32)
        lists.append(made.filter(pc.is_valid(made["bucket"])))
    lists = pa.concat_tables(lists)
    ids, told = {}, {}
    for b in set(lists["bucket"].to_pylist()):
        got = collocations._counted(3, False)(lists.filter(pc.equal(lists["bucket"], b)))
        for r in got.to_pylist():
            if r["gid"] is not None:
                ids[r["ga"], r["gb"]] = r["gid"], r["a"]
            else:
                seq = collocations.full(r["seq"], np.int32).tolist()
                told |= {(r["part"], i): (b << 32) + x for i, x in zip(collocations.full(r["idx"], np.int32).tolist(), seq, strict=True)}
    assert {x: a for x, (_, a) in ids.items()} == {x: a for x, a in want.items() if a >= 3}
    assert len({x for x, _ in ids.values()}) == len(ids)
    for part, (pairs, longer) in texts.items():
        assert [told.get((part, i)) for i in longer.tolist()[:-1]] == [ids.get(x, (None,))[0] if x else None for x in pairs]


def test_words_of_all_parts_are_counted_by_bucket():
    rng = np.random.default_rng(9)
    want, lists, texts = Counter(), [], {}
    for number in (4, 9, 11):
        part, own, texts[number] = collocations._Part(number), [], []
        for lang in ("en", "line\nfeed", "en", "de"):
            words = [b"\xff" if x == 0 else b"w%d" % x for x in rng.integers(0, 40, 60).tolist()] + [b"rare%d" % number]
            part.add(lang, words)
            own += [None if w == b"\xff" else (lang, w.decode()) for w in words]
        texts[number] = own + [("", "after")]
        want.update(x for x in own if x)
        made = pa.Table.from_batches(list(part.rows("", [b"after"])))
        assert made.num_rows == 5 and sum(made["n"].to_pylist()[1:]) == sum(x is not None for x in own)  # a row for each group, not for each word
        places = collocations.full(made["places"][0].as_py(), np.int32).tolist()
        texts[number] = list(zip(places, texts[number], strict=True))
        made = made.filter(pc.is_valid(made["words"])).select(["part", "lang", "idx", "words", "counts"])
        lists += collocations._dealt(4)(iter(made.to_batches()))
    lists = pa.Table.from_batches(lists)
    assert lists.num_rows <= 3 * 4 * 4
    ids, told = {}, {}
    for b in set(lists["bucket"].to_pylist()):
        for r in collocations._counted_words(3)(lists.filter(pc.equal(lists["bucket"], b))).to_pylist():
            if r["gid"] is not None:
                assert (r["lang"], r["word"]) not in ids
                ids[r["lang"], r["word"]] = r["gid"], r["a"]
            else:
                seq = collocations.full(r["seq"], np.int32).tolist()
                told |= {(r["part"], i): (b << 32) + x for i, x in zip(collocations.full(r["idx"], np.int32).tolist(), seq, strict=True)}
    assert {x: a for x, (_, a) in ids.items()} == {x: a for x, a in want.items() if a >= 3}
    assert len({x for x, _ in ids.values()}) == len(ids)
    for number, own in texts.items():
        assert [told.get((number, place)) for place, _ in own] == [ids.get(x, (None,))[0] for _, x in own]


def test_frequent_words_reach_their_parts_without_a_join(spark, monkeypatch):
    """A join of the lists with the frequent words makes a row for each entry of each part that is frequent."""
    from pyspark.sql.classic.dataframe import DataFrame

    by, real = [], DataFrame.join
    monkeypatch.setattr(DataFrame, "join", lambda self, other, on=None, how=None: by.append(on) or real(self, other, on, how))
    df = spark.createDataFrame([("en", "a b c. " * 9)], "lang string, text string")
    tables, _ = collocations.frequent_phrases(df, least=3)
    assert [t.count() for t in tables] == [3, 2, 1, 0, 0] and by and all(x in ("ga", "gb") for x in by)
