"""Operators that join documents, against brute force and SQL."""

import os
import random

import duckdb
import numpy as np
import pytest

from ledgerline.llm import decontaminate, passages, simhash, url_templates
from ledgerline.llm.queries import ORACLES, QUERIES

from conftest import SF


def _sql(folder, sql):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels", "embeddings"):
        p = f"{folder}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p}{'/*.parquet' if os.path.isdir(p) else ''}'")
    return con.execute(sql)


def _same(spark, name, folder):
    got = QUERIES[name](spark, folder)
    found = _sql(folder, ORACLES[name])
    cols = [d[0] for d in found.description]
    key = lambda rows: sorted(tuple(map(str, r)) for r in rows)
    assert sorted(cols) == sorted(got.columns)
    assert key(got.select(*cols).collect()) == key(found.fetchall())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    _same(spark, name, SF)


def _components(fps, most):
    nodes = sorted(set(fps))
    up = {a: a for a in nodes}

    def top(a):
        while up[a] != a:
            a = up[a]
        return a

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= most:
                x, y = top(a), top(b)
                up[max(x, y)] = min(x, y)
    return {a: top(a) for a in nodes}


@pytest.mark.parametrize(("most", "unit"), [(3, 20_000), (3, 8), (0, 20_000), (2, 16)])
def test_trie_join_equals_brute_force(spark, most, unit):
    rng = random.Random(most + unit)
    fps = [0, -1, 1, 1 << 62]
    while len(fps) < 500:
        centre = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 5, 60])):
            x = centre
            for _ in range(rng.randint(0, 5)):
                x ^= 1 << rng.randrange(64)
            fps.append(x - (1 << 64) if x >> 63 else x)
    df = spark.createDataFrame([(x,) for x in set(fps)], "fp bigint")
    got = {r["node"]: r["root"] for r in simhash.components(simhash.forest(df, most, unit)).collect()}
    want = _components(fps, most)
    assert {a: got.get(a, a) for a in want} == want


def test_simhash_components_of_documents(spark, docs):
    got = {r["doc_id"]: r["component_id"] for r in QUERIES["op7_simhash"](spark, SF).collect()}
    fps = {r["doc_id"]: simhash.fingerprint(r["text"]) for r in docs.collect()}
    roots = _components(fps.values(), simhash.MAX_BITS)
    least = {}
    for d, v in fps.items():
        least[roots[v]] = min(d, least.get(roots[v], d))
    assert got == {d: least[roots[v]] for d, v in fps.items()}


def test_one_of_each_component_stays(hard, empty):
    kept = simhash.one_of_each(hard)
    assert kept.columns == hard.columns
    found = simhash.near_duplicates(hard).select("root").distinct().count()
    assert kept.count() == found and simhash.one_of_each(empty).count() == 0


def test_decontamination_cases(spark, tmp_path, empty):
    words = [f"w{k}" for k in range(60)]
    item = " ".join(words[:30])
    docs = [
        (0, "a b c " + " ".join(words[5:15]) + " z"),  # one window
        (1, " ".join(words[5:14])),  # nine words are none
        (2, f"{item} {item}, {item.upper()}"),
        (3, " ".join(words[0:12]) + " x " + " ".join(words[10:25])),
        (4, None), (5, ""), (6, "Short Item!"), (7, "a short, item a short item"), (8, "É é ß 1 2"), (2, f"{item} {item}, {item.upper()}"), (None, item), (9, "tie " * 40),
    ]
    items = [(100, item), (20, "short item"), (3, None), (4, "!!"), (5, " ".join(words[20:31])), (100, item), (6, "é É"), (7, "tie " * 12), (8, "tie " * 11), (9, "ß")]
    spark.createDataFrame(docs, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    _same(spark, "op8_decontamination", str(tmp_path))
    bench = spark.read.parquet(str(tmp_path / "benchmark.parquet"))
    assert decontaminate.contamination(empty, bench).count() == 0
    some = spark.read.parquet(str(tmp_path / "documents.parquet"))
    assert decontaminate.contamination(some, bench.limit(0)).where("contaminated").count() == 0
    assert {r["doc_id"] for r in decontaminate.clean(some, bench).collect()} == {1, 4, 5}


def test_url_cases(spark, tmp_path):
    urls = [
        None, "", "no scheme", "http://", "http://A.Org", "http://a.org?x", "https://x.EXAMPLE.org/es/1#f", "http://example.org/en/12", "http://example.org/en/2",
        "http://sub.com/fr/1", "http://sub.com/de/1", "http://sub.com/xx/" + "/".join("abcdefghijk"), "http://notorg/x", "ftp://u@h.net:8080/a//b/", "x://y://z/w",
        *[f"http://many.net/u/name{chr(97 + k % 26)}{'x' * (k // 26)}/p{k}.html" for k in range(60)], *["http://m.com/de/7"] * 20, *["http://m.com/zz/7"] * 3,
    ]
    spark.createDataFrame([(k if k != 3 else None, u, "h") for k, u in enumerate(urls)], "page_id bigint, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    _same(spark, "op6_url_filter", str(tmp_path))
    clash = spark.read.parquet(str(tmp_path / "pages.parquet")).selectExpr("page_id", "url", "html as host", "html as rule", "1 as share", "2 as __salt2")
    assert url_templates.judged(clash, keep=("page_id", "host", "rule")).count() == len(urls)
    assert url_templates.judged(clash.limit(0)).count() == 0


def _pages(spark, urls):
    return spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")


def test_url_variable_segments_become_wildcards(spark):
    rows = [("h", ["u", f"n{chr(97 + k)}", "x", "y"], 1) for k in range(25)] + [("h", ["about"], 9)]
    urls = spark.createDataFrame([(*r, 0, 0) for r in rows], "host string, shape array<string>, n bigint, labelled bigint, blocked bigint")
    got = {tuple(r["shape"]): r["node"] for r in url_templates.grown(urls).collect()}
    assert len(got) == 26 and got[("about",)] == "/about"
    assert {got[tuple(r[1])] for r in rows[:25]} == {"/u/*/x/y"}


def test_url_verdicts_come_from_deeper_levels(spark):
    """What differs below the first segment: the branches of s1 to s6 are alike and merged, forum and news are told apart."""
    names = [f"s{chr(97 + k)}" for k in range(6)]
    rules = [(f"a.{t}", f"/{s}/forum/", "block") for t in ("net",) for s in names] + [("a.net", f"/{s}/news/", "allow") for s in names]
    urls = [f"http://a.net/{s}/{kind}/page{k}" for s in [*names, "sk"] for kind in ("forum", "news") for k in range(4)]
    got = {(r["path"].split("/")[1], r["path"].split("/")[2], r["verdict"]) for r in url_templates.judged(_pages(spark, urls), rules=rules).collect()}
    assert got == {(s, kind, verdict) for s in [*names, "sk"] for kind, verdict in (("forum", "block"), ("news", "allow"))}


def test_url_deep_paths_are_told_apart_to_their_end(spark):
    """Paths that differ only behind the last level of the tree."""
    front = "/".join("abcdefghijklmnop")
    rules = [("a.net", f"/{front}/bad/x", "block"), ("a.net", f"/{front}/good/x", "allow")]
    urls = [f"http://a.net/{front}/{kind}/x{k}" for kind in ("bad", "good") for k in range(30)]
    for depth in (1, url_templates.DEPTH):
        out = url_templates.judged(_pages(spark, [*urls, f"http://a.net/{front}/other"]), rules=rules, depth=depth)
        assert {(r["path"][len(front) + 2 : len(front) + 5], r["verdict"]) for r in out.collect()} == {("bad", "block"), ("goo", "allow"), ("oth", "allow")}


def _text(rng, n):
    return [f"{rng.choice('bcdfg')}{rng.randint(0, 400)}" for _ in range(n)]


def test_shared_passages_are_found_and_nothing_else(spark, hard, empty):
    rng = random.Random(9)
    shared, fuzzy = _text(rng, 60), _text(rng, 100)
    rows, holds = [], {}
    for k in range(40):
        words = _text(rng, 150)
        if k % 4 == 0:
            words[40:40] = shared
        elif k % 4 == 1:
            copy = list(fuzzy)
            for j in range(3):
                copy[rng.randrange(10, 90)] = f"edit{k}{j}"
            words[90:90] = copy
        holds[k] = k % 4 if k % 4 < 2 else None
        rows.append((k, " ".join(words)))
    rows += [(100, rows[2][1]), (101, rows[2][1])]
    got = {r["doc_id"]: r for r in passages.shared_passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert len(got) == len(rows)
    for k, kind in holds.items():
        assert (got[k]["n_passages"] > 0) == (kind is not None), k
        if kind == 0:
            assert 60 <= got[k]["passage_words"] <= 64
    up = {k: k for k in holds}
    top = lambda a: a if up[a] == a else top(up[a])
    for k in holds:
        for x in got[k]["linked_to"]:
            up[top(k)] = top(x)
    assert len({top(k) for k, kind in holds.items() if kind == 0}) == 1
    assert len({top(k) for k, kind in holds.items() if kind == 1}) == 1
    assert {got[k]["class_id"] for k in (2, 100, 101)} == {2} and got[100]["linked_to"] == [2] and got[2]["n_links"] == 0
    assert {got[k]["component_id"] for k, kind in holds.items() if kind == 0} == {0}
    assert {got[k]["component_id"] for k, kind in holds.items() if kind == 1} == {1}
    assert all(got[k]["component_id"] == k for k, kind in holds.items() if kind is None) and got[101]["component_id"] == 2
    assert passages.shared_passages(hard).count() == hard.count()
    assert passages.shared_passages(empty).count() == 0


def test_chain_is_the_best_one():
    """The Fenwick chain has the score of a quadratic search."""
    import numpy as np

    rng = np.random.default_rng(3)
    for _ in range(60):
        pairs = np.unique(rng.integers(0, 60, (25, 2)), axis=0)
        best = []
        for i, (x, y) in enumerate(pairs):
            before = [best[j] - passages.GAP_COST * ((x - a) + (y - b)) for j, (a, b) in enumerate(pairs[:i]) if a < x and b < y]
            best.append(passages.GAIN + max([0.0, *before]))
        chains = passages.chain(pairs[:, 0], pairs[:, 1])
        if chains:
            p = pairs[chains[0]]
            gaps = (p[1:] - p[:-1]).sum()
            assert (np.diff(p, axis=0) > 0).all()
            assert passages.GAIN * len(p) - passages.GAP_COST * gaps == pytest.approx(max(best))


def test_alignment_of_inner_and_outer_edits():
    import numpy as np

    a = np.arange(1, 101)
    b = np.concatenate([np.arange(500, 520), a[:40], [900], a[41:70], [901, 902], a[70:], np.arange(600, 640)])
    s, e, s2, e2, same = passages.align(a, b, [10, 50, 80], [30, 70, 102])
    assert (s, e, s2, e2, same) == (0, 100, 20, 122, 99)


def test_chain_is_cut_at_gaps_that_pull_it_down(spark):
    """Two exact passages with other words between, and one passage with a stray shared run."""
    rng = random.Random(21)
    first, second, stray = _text(rng, 50), _text(rng, 50), _text(rng, 5)
    own = lambda k, n: [f"own{k}x{j}" for j in range(n)]
    texts = []
    for k, gap in enumerate([40, 90]):
        texts.append(own(f"a{k}", 30) + first + own(f"b{k}", gap) + second + own(f"c{k}", 30))
    third = _text(rng, 50)
    for k in (2, 3):
        texts.append(own(f"a{k}", 30) + third + own(f"b{k}", 30) + stray + own(f"c{k}", 30))
    got = {r["doc_id"]: r for r in passages.shared_passages(spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(texts)], "doc_id bigint, text string")).collect()}
    assert [(got[k]["n_passages"], got[k]["passage_words"]) for k in range(4)] == [(2, 100), (2, 100), (1, 50), (1, 50)]
    assert [got[k]["component_id"] for k in range(4)] == [0, 0, 2, 2]


def test_pieces_of_an_alignment():
    import numpy as np

    a = np.concatenate([np.arange(50), np.arange(100, 140), np.arange(200, 250), np.arange(300, 330), np.arange(400, 405)])
    b = np.concatenate([np.arange(50), np.arange(500, 600), np.arange(200, 250), np.arange(700, 760), np.arange(400, 405)])
    own = passages.matched(a, b, [10, 30, 100, 120, 170], [10, 30, 160, 180, 260])
    assert sorted(passages.pieces(own)) == [(0, 50, 0, 50, 50), (90, 140, 150, 200, 50)]
    rng = np.random.default_rng(4)
    for _ in range(30):
        x, y = rng.integers(0, 4, rng.integers(0, 30)), rng.integers(0, 4, rng.integers(0, 30))
        pairs = passages._common(x, y)
        assert all(x[i] == y[j] for i, j in pairs) and len(pairs) == int(passages._lengths(x, y)[-1])
        assert all(i < k and j < m for (i, j), (k, m) in zip(pairs, pairs[1:], strict=False))


def _own(k, n):
    return [f"own{k}x{j}" for j in range(n)]


def test_every_copy_of_a_passage_is_found(spark):
    """A second copy beside another text, whichever represents it, and copies in one text only."""
    rng = random.Random(22)
    rows = []
    for k in range(0, 24, 4):
        twice, alone = _text(rng, 50), _text(rng, 60)
        rows.append((k, _own(f"a{k}", 30) + twice + _own(f"b{k}", 60) + twice + _own(f"c{k}", 30)))
        rows.append((k + 1, _own(f"d{k}", 30) + twice + _own(f"e{k}", 30)))
        rows.append((k + 2, _own(f"f{k}", 30) + alone + alone + _own(f"g{k}", 40) + alone))
        rows.append((k + 3, _own(f"h{k}", 200)))
    docs = spark.createDataFrame([(k, " ".join(w)) for k, w in rows], "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in passages.shared_passages(docs).collect()}
    for k in range(0, 24, 4):
        assert [got[k + j]["passage_words"] for j in range(4)] == [100, 50, 180, 0]
        assert got[k]["component_id"] == got[k + 1]["component_id"] == k and got[k + 2]["linked_to"] == []


def test_links_are_counted_in_both_directions(spark):
    """Texts with one passage each link to all others that hold it, whichever represents it."""
    rng = random.Random(23)
    one, two = _text(rng, 60), _text(rng, 55)
    rows = [(k, _own(f"a{k}", 30) + one + _own(f"b{k}", 30)) for k in range(12)]
    rows += [(k, _own(f"a{k}", 30) + two + _own(f"b{k}", 30)) for k in (20, 21)]
    rows += [(30, _own("a30", 30) + one + _own("b30", 100) + two + _own("c30", 30)), (31, rows[0][1]), (40, _own("a40", 99))]
    got = {r["doc_id"]: r for r in passages.shared_passages(spark.createDataFrame([(k, " ".join(w)) for k, w in rows], "doc_id bigint, text string")).collect()}
    assert {got[k]["n_links"] for k in range(12)} == {12} and {got[k]["n_links"] for k in (20, 21)} == {2}
    assert (got[30]["n_links"], got[31]["n_links"], got[40]["n_links"]) == (14, 13, 0)
    for k in got:
        assert all(k in got[x]["linked_to"] or got[k]["class_id"] != k for x in got[k]["linked_to"])
    assert max(len(got[k]["linked_to"]) for k in [*range(12), 30]) >= 12


def test_passages_with_many_edits_are_found(spark):
    """60 words with every tenth, eighth, seventh or sixth replaced."""
    rng = random.Random(24)
    rows, each = [], 12
    for every in (10, 8, 7, 6):
        for k in range(each):
            words, k = _text(rng, 60), 1000 * every + 2 * k
            edited = [f"edit{k}x{j}" if j % every == every // 2 else w for j, w in enumerate(words)]
            rows += [(k, _own(f"a{k}", 30) + words + _own(f"b{k}", 30)), (k + 1, _own(f"c{k}", 40) + edited + _own(f"d{k}", 20))]
    got = {r["doc_id"]: r for r in passages.shared_passages(spark.createDataFrame([(k, " ".join(w)) for k, w in rows], "doc_id bigint, text string")).collect()}
    assert [k for k, _ in rows if not 50 <= got[k]["passage_words"] <= 62] == []
    assert all(got[k]["component_id"] == k - k % 2 for k, _ in rows)


def _passages(spark, rows, **options):
    docs = spark.createDataFrame([(k, " ".join(w)) for k, w in rows], "doc_id bigint, text string")
    return {r["doc_id"]: r for r in passages.shared_passages(docs, **options).collect()}


def test_no_link_is_lost_to_a_third_text(spark):
    """A and B share 50 words, X and Y hold one half of them each; so seeds often lead to X and Y. The same with edits."""
    rng = random.Random(25)
    rows = []
    for k in range(0, 240, 4):
        words = _text(rng, 50)
        edited = [f"edit{k}x{j}" if k >= 160 and j % 11 == 5 else w for j, w in enumerate(words)]
        rows.append((k, _own(f"a{k}", 30) + words + _own(f"b{k}", 30)))
        rows.append((k + 1, _own(f"c{k}", 40) + edited + _own(f"d{k}", 20)))
        rows.append((k + 2, _own(f"e{k}", 30) + words[:25] + _own(f"f{k}", 30)))
        rows.append((k + 3, _own(f"g{k}", 30) + words[25:] + _own(f"h{k}", 30)))
    got = _passages(spark, rows)
    for k in range(0, 240, 4):
        assert [got[k + j]["component_id"] for j in range(4)] == [k, k, k + 2, k + 3]
        assert [got[k + j]["n_links"] for j in range(4)] == [1, 1, 0, 0]
        assert [got[k + j]["passage_words"] >= 45 for j in range(4)] == [True, True, False, False]


def test_no_exact_passage_is_lost_among_many_texts(spark):
    """Each half of a passage stands in many texts, more than are matched with one another; so do the quarters between."""
    rng = random.Random(26)
    rows, holders = [], {}
    for g in range(12):
        words, k = _text(rng, 60), 1000 * g
        holders[k] = list(range(k, k + 3))
        rows += [(x, _own(f"a{x}", 30) + words + _own(f"b{x}", 30)) for x in holders[k]]
        for j, (s, e) in enumerate([(0, 25), (15, 40), (30, 60)] * 20):
            rows.append((k + 10 + j, _own(f"c{k}x{j}", 30) + words[s:e] + _own(f"d{k}x{j}", 30)))
    for options in ({}, {"near": 200, "bucket": 1000}):
        got = _passages(spark, rows, **options)
        for k, texts in holders.items():
            assert [(got[x]["component_id"], got[x]["n_links"], got[x]["passage_words"]) for x in texts] == [(k, 2, 60)] * 3
            assert sum(got[x]["n_links"] for x, _ in rows if k <= x < k + 1000) == 6


def test_three_seeds_in_a_row_make_a_passage(spark):
    """Of 51 words one run of nine is whole, the others have four words."""
    rng = random.Random(27)
    rows = []
    for k in range(0, 20, 2):
        words = _text(rng, 51)
        edited = [f"edit{k}x{j}" if j % 5 == 0 and j != 20 else w for j, w in enumerate(words)]
        rows += [(k, _own(f"a{k}", 30) + words + _own(f"b{k}", 30)), (k + 1, _own(f"c{k}", 40) + edited + _own(f"d{k}", 20))]
    got = _passages(spark, rows)
    assert [k for k, _ in rows if not got[k]["passage_words"] >= 45] == []


def test_seeds_of_many_texts_are_those_of_each_text(spark):
    """A run that a text holds again is numbered within that text only."""
    rng = np.random.default_rng(5)
    texts = [rng.integers(1, high, n).astype(np.uint64) for high, n in ((2, 30), (50, 3), (3, 200), (10**9, 80), (2, 6))]
    for span in (1, 4):
        h, p, numbered, text = passages.seeds(np.concatenate(texts), np.array([len(x) for x in texts]), span=span)
        for k, ids in enumerate(texts):
            own = passages.seeds(ids, np.array([len(ids)]), span=span)
            order = np.lexsort((p[text == k], numbered[text == k]))
            mine = np.lexsort((own[1], own[2]))
            for got, want in zip((h, p, numbered), own, strict=False):
                assert (got[text == k][order] == want[mine]).all()
            if span == 1:
                runs = [tuple(ids[i : i + 5]) for i in range(len(ids) - 4)]
                again = {i for i, x in enumerate(runs) if x in runs[:i]}
                assert sorted(own[1][own[2]].tolist()) == sorted(again) and len(own[0]) == len(runs) + len(again)


def test_pairs_that_many_representatives_tell_of_are_not_multiplied(spark):
    rows = [(1, 2, 0, 60, 0, 60, 60, False), (1, 3, 0, 60, 0, 60, 60, False), (1, 4, 0, 60, 0, 60, 60, False)]
    for x in range(100, 140):
        rows += [(1, x, 0, 60, 0, 60, 60, True), (2, x, 0, 60, 10, 70, 60, True), (3, x, 0, 60, 20, 80, 60, True)]
        rows += [(4, x + 100, 0, 60, 0, 60, 60, True)]
    found = spark.createDataFrame(rows, "c bigint, r bigint, start int, end int, start2 int, end2 int, same int, star boolean")
    out = passages.unimplied(found)
    # 1 and 2 share 50 words of a representative, 1 and 3 only 40, 1 and 4 none
    assert sorted((x["c"], x["r"]) for x in out.where("not star").collect()) == [(1, 3), (1, 4)]
    assert out.where("star").count() == len(rows) - 3
    assert "LeftSemi" in out._jdf.queryExecution().optimizedPlan().toString()
