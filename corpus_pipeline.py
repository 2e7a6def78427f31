"""Corpus pipeline: documents to token digests in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but the last
return the columns of ``documents``. ``run`` writes each stage's rows to the shared folder and reads
them again as the next one's documents, so a lost executor costs one stage at most.

Nulls, empty texts and repeated rows: quality scores a null like an empty text; of repeated rows
SimHash near-dedup leaves one; null texts have no benchmark words, stay null when masked, and encode to
no ids. Empty tables pass through as empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import decontaminate, piece_tokens, pii, quality, simhash
from ledgerline.llm.rows import stored


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.accepted(docs, _table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    return simhash.one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a benchmark window occurs go."""
    return decontaminate.clean(docs, _table(spark, sf_dir, "benchmark"))


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind in angle brackets; n_chars follows the new text."""
    return pii.mask(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def piece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the text decoded from them."""
    return piece_tokens.encode_decode(docs, keep=("doc_id", "lang", "source"), outputs=("n_tokens", "ids_sha256", "decoded_sha256"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("PII", private_data),
    ("SentencePiece encoding and decoding", piece_encoding),
]

#: No stage but the third can be told in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
