"""The registered queries of this package: thin, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import collocations, decontaminate, hard_negatives, languages, multiset_hash, packing, passages, piece_tokens, pii, quality, secret_tags, simhash, url_templates
from ledgerline.llm.rows import held_out, map_texts, sha256_hex, stored


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document (ridge on random Fourier features, isotonic)."""
    stats = stored(quality.with_statistics(_table(spark, sf_dir, "documents")))
    model = quality.fit(stats, _table(spark, sf_dir, "labels"))
    out = quality.scored(stats, model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op2_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fuzzy passages that documents share (collinear chaining)."""
    return passages.shared_passages(_table(spark, sf_dir, "documents"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document (hyperdimensional profiles)."""
    docs = _table(spark, sf_dir, "documents")
    out = languages.predict(docs, languages.prototypes(docs))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op4_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document (weak supervision)."""
    docs = _table(spark, sf_dir, "documents")
    model = pii.fit(docs)
    fields = [(f"n_{k}", "bigint") for k in pii.KINDS] + [("base_sha256", "string"), ("spans", "string")]

    def make():
        def fn(texts):
            got = {n: [] for n, _ in fields}
            for t in texts:
                found = pii.spans(t, model)
                base = [(k, s, e) for k, s, e, strict, _ in found if strict]
                for kind in pii.KINDS:
                    got[f"n_{kind}"].append(sum(k == kind for k, _, _ in base))
                got["base_sha256"].append(pii.digest(base))
                got["spans"].append(pii.joined([(k, s, e) for k, s, e, _, _ in found]))
            return got

        return fn

    return map_texts(docs, "text", make, fields, ["doc_id"])


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document (conditional random field)."""
    docs = _table(spark, sf_dir, "documents")
    field = secret_tags.fit(docs)
    fields = [(f"n_{k}", "bigint") for k in secret_tags.KINDS[:3]] + [("base_sha256", "string"), ("spans", "string"), ("n_tagged", "bigint")]

    def make():
        def fn(texts):
            got = {n: [] for n, _ in fields}
            for t in texts:
                found = secret_tags.spans(t, field)
                base = [(k, s, e) for k, s, e, strict in found if strict]
                for kind in secret_tags.KINDS:
                    got[f"n_{kind}"].append(sum(k == kind for k, _, _, _ in found))
                got["base_sha256"].append(secret_tags.digest(base))
                got["spans"].append(secret_tags.joined([(k, s, e) for k, s, e, _ in found]))
            return got

        return fn

    return map_texts(docs, "text", make, fields, ["doc_id"])


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every url (path-template trees)."""
    out = url_templates.judged(_table(spark, sf_dir, "pages"))
    return out.select("page_id", "host", "path", "rule", "verdict", "template")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document (trie self-join)."""
    out = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document (prefix-filtered set join)."""
    out = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multiset fingerprint of every document, of its edited text, and their likeness."""

    def pair(text: str, following: str, state):
        parts, own = state or (multiset_hash.paragraphs(text), None)
        own = multiset_hash.vector(parts) if own is None else own
        after = multiset_hash.paragraphs(following)
        next_fp = multiset_hash.vector(after)
        k = len(text) // 3
        new = text[: len(text) - k] + following[:k]
        new_fp = multiset_hash.edited(own, parts, multiset_hash.paragraphs(new))
        values = (
            len(text), sha256_hex(new), multiset_hash.as_text(own), multiset_hash.as_text(new_fp),
            multiset_hash.likeness(own, new_fp), multiset_hash.likeness(own, next_fp),
        )
        return values, (after, next_fp)

    out = [
        ("n_chars", "bigint"), ("edited_sha256", "string"), ("fingerprint", "string"), ("edited_fingerprint", "string"),
        ("near_edited", "double"), ("near_next", "double"),
    ]
    return multiset_hash.linked(_table(spark, sf_dir, "documents"), out, pair)


def op10_piece_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and their decoded text, as digests."""
    return piece_tokens.encode_decode(_table(spark, sf_dir, "documents"), outputs=("n_tokens", "ids_sha256", "decoded_sha256"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's first phrases by score (SETM relations)."""
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor's positives (STR-packed R-tree)."""
    label, key = F.col("label").cast("bigint"), F.col("vec_id")
    label = F.when(key % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.hard_negatives(_table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, label=label)


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2,048 ids (concatenate and cut)."""
    import public_tokenizers

    pieces = packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_passages": op2_passages,
    "op3_language": op3_language,
    "op4_private_data": op4_private_data,
    "op5_secrets": op5_secrets,
    "op6_url_filter": op6_url_filter,
    "op7_simhash": op7_simhash,
    "op8_decontamination": op8_decontamination,
    "op9_fingerprints": op9_fingerprints,
    "op10_piece_tokens": op10_piece_tokens,
    "op11_collocations": op11_collocations,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_packing": op13_packing,
}

ORACLES: dict[str, str] = {
    "op6_url_filter": url_templates.ORACLE,
    "op8_decontamination": decontaminate.ORACLE,
    "op11_collocations": collocations.ORACLE,
    "op12_hard_negatives": hard_negatives.ORACLE,
}
