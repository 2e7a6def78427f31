"""The corpus pipeline, stage by stage against brute force."""

import hashlib
import re

import corpus_pipeline
import public_tokenizers
import sentencepiece

from ledgerline.llm import decontaminate, piece_tokens, pii, quality, simhash

from conftest import SF


def test_stages_on_the_test_documents(spark, docs, tables):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "SimHash near-dedup", "benchmark decontamination", "PII", "SentencePiece encoding and decoding"]
    steps, now = [docs], docs
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, now, SF)
        now = spark.createDataFrame(out.collect(), out.schema)
        steps.append(now)
    assert all(s.columns == docs.columns for s in steps[:-1])
    texts = [{r["doc_id"]: r["text"] for r in s.collect()} for s in steps[:-1]]
    labels = {r["doc_id"]: r["quality"] for r in tables("labels").collect()}
    clean = [d for d, q in labels.items() if q == 1 and d in texts[0]]
    assert sum(d in texts[1] for d in clean) >= 0.97 * len(clean)
    assert sum(d not in texts[1] for d, q in labels.items() if q == 0) >= 0.7 * sum(q == 0 for q in labels.values())
    # one of each component, the least id
    found = simhash.near_duplicates(steps[1]).collect()
    assert set(texts[2]) == {r["component_id"] for r in found}
    tainted = {r["doc_id"] for r in decontaminate.contamination(steps[2], tables("benchmark")).where("contaminated").collect()}
    assert set(texts[3]) == set(texts[2]) - tainted and set(texts[4]) == set(texts[3])
    model = pii.fit(steps[3])
    assert texts[4] == {d: pii.masked(t, model) for d, t in texts[3].items()}
    assert not any(re.search(r"[\w.]+@mail\d", t) for t in texts[4].values())
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(piece_tokens.MODEL))
    for r in steps[5].collect():
        ids = library.encode(texts[4][r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_hard_rows_pass_every_stage(spark, hard, empty):
    for rows in (hard, empty):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, rows, SF)
            assert k == 4 or out.columns == rows.columns
            assert out.count() <= rows.count()
            if k in (3, 4):
                assert out.count() == rows.count()


def test_quality_stage_without_labels_keeps_everything(spark, hard):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert quality.accepted(hard, none).count() == hard.count()
