import os

import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def sf():
    return os.environ.get("SPARKMINE_SF", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty and blank texts, a long one, repeated rows, and columns
    whose names clash with those that operators add."""
    rows = [
        (1, "The quick brown fox jumps over the lazy dog again and again.", "en", "a", 5, 1.0, "x"),
        (1, "The quick brown fox jumps over the lazy dog again and again.", "en", "a", 5, 1.0, "x"),
        (2, None, None, None, None, None, None),
        (3, "", "en", "a", 0, 0.0, "y"),
        (4, " \t\n\x0b ", "de", "b", 5, 0.0, "y"),
        (5, "Wörter und Zeichen 😀   é password=24be64439e3e49cf46 x", "de", None, 5, 0.0, ""),
        (None, "no id but text", "en", "b", 5, 0.0, "z"),
        (6, "word " * 60_000, "en", "c", 300_000, 0.0, "z"),
        (7, "a" * 3_000 + "é" * 700, "fr", "c", 0, 0.0, "z"),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, taken string"
    df = spark.createDataFrame(rows, schema)
    return df.withColumns({c: F.lit(1) for c in ("size", "fp", "root", "component_id", "ids", "findings", "predicted")})
