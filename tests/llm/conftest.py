import os

import pytest

SF = os.environ.get("LLM_TEST_SF", "/root/testdata/sf0.001")

LONG = "Ab cd. " * 6000
HARD = [None, "", " ", "\n\n", "x", "a.b@c.de", LONG, "é漢 😀 ▁▁  <s> \x00", "Same text here, twice.", "Same text here, twice.", "z" * 30000]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def hard(spark):
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    rows = [(k, t, "en" if k % 2 else None, None, None) for k, t in enumerate(HARD)]
    rows += [(None, "No id here.", "en", "s", 11), (None, None, None, None, None), rows[8], rows[8]]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def tables(spark):
    return lambda name: spark.read.parquet(f"{SF}/{name}.parquet")
