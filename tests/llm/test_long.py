"""Long texts cost in proportion to their length, and long numbers don't crash."""

import random
import re
import time

from ledgerline.llm import decontaminate, pii, quality, secret_tags
from ledgerline.llm.rows import Taken


def test_ranges_overlap_as_if_compared_one_by_one():
    rng = random.Random(1)
    for _ in range(200):
        ranges = [(a, a + rng.randint(1, 9)) for a in (rng.randrange(60) for _ in range(rng.randrange(12)))]
        taken, known = Taken(ranges[:4]), ranges[:4]
        for s, e in ranges[4:] + [(k, k + 2) for k in range(0, 70, 3)]:
            assert taken.overlaps(s, e) == any(a < e and s < b for a, b in known)
            if rng.random() < 0.3:
                taken.add(s, e)
                known.append((s, e))


def test_a_long_number_beside_dots_is_no_crash():
    model = pii.learn({})
    for text, n in (("0" * 5000 + ".1.1.1", 1), ("9" * 5000 + ".1.1.1", 0), ("0" * 5000 + "255.0.00.1 x", 1), ("1." * 5000, None)):
        spans = pii.spans(text, model)
        assert n is None or sum(k == "ip" and strict for k, _, _, strict, _ in spans) == n


def test_a_divider_line_is_read_once():
    old = re.compile(r"[^\w\s.,;:?\"')\]]{2,}[.,]?(?=\s|$)")
    rng = random.Random(2)
    for _ in range(3000):
        text = "".join(rng.choice("==-*a .,;\n\"]") for _ in range(rng.randrange(30)))
        assert len(old.findall(text)) == len(quality._SIGN_END.findall(text)), text
    began = time.process_time()
    quality.statistics("=" * 200_000 + "x")
    assert time.process_time() - began < 5


def test_many_spans_in_one_text():
    text = "\n".join(f"{k:032x} user{k}@mail.example.com from 10.0.{k % 256}.{k // 256 % 256}" for k in range(25_000))
    began = time.process_time()
    assert len(pii.spans(text, pii.learn({}))) >= 50_000
    base = secret_tags.base_spans(text)
    reach = secret_tags._reach(base)
    tags = [secret_tags._labels(c, base, reach) for c in secret_tags.chains(text)]
    assert len(base) == 25_000 and sum(t.count(secret_tags.BEGIN) for t in tags) == 25_000
    assert time.process_time() - began < 60


def test_labels_equal_those_of_a_plain_search():
    rng = random.Random(3)
    for _ in range(300):
        base = sorted((a, rng.randrange(3), a + rng.randint(1, 15)) for a in (rng.randrange(80) for _ in range(rng.randrange(6))))
        cuts = sorted(rng.sample(range(100), 20))
        chain = [(s, e, ()) for s, e in zip(cuts[::2], cuts[1::2], strict=True)]
        tags, within = [], None
        for s, e, _ in chain:
            hit = next(((a, b) for a, _, b in base if a < e and s < b), None)
            tags.append(secret_tags.OUTSIDE if hit is None else secret_tags.INSIDE if hit == within else secret_tags.BEGIN)
            within = hit
        assert secret_tags._labels(chain, base, secret_tags._reach(base)) == tuple(tags)


def test_windows_of_a_long_document(spark, tables):
    items = tables("benchmark")
    passage = items.first()["text"]
    text = " ".join(f"w{k}" for k in range(150_000)) + " " + passage
    docs = spark.createDataFrame([(1, text), (2, "nothing here")], "doc_id bigint, text string")
    began = time.time()
    got = {r["doc_id"]: r for r in decontaminate.contamination(docs, items).collect()}
    assert got[1]["contaminated"] and got[1]["n_words"] > 150_000 and not got[2]["contaminated"]
    assert time.time() - began < 90
