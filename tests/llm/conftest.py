from __future__ import annotations

import duckdb
import pytest

TABLES = ("documents", "pages", "benchmark", "labels")


@pytest.fixture(scope="session")
def small(spark):
    """Documents with the awkward cases that every operator has to stand: nulls, empty texts, ties, a clashing column."""
    rows = [
        (1, "the quick brown fox jumps over the lazy dog " * 12, "a", 0),
        (2, None, "a", None),
        (3, "", None, 0),
        (4, " \n\t ", "b", 0),
        (5, "one", "b", 0),
        (6, "the quick brown fox jumps over the lazy dog " * 12, "a", 0),
        (6, "the quick brown fox jumps over the lazy dog " * 12, "a", 0),
        (None, "no id but words é 😀", "é", 0),
        (8, "x" * 50_000 + " " + "long " * 20_000, "b", 0),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")


@pytest.fixture(scope="session")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    yield con
    con.close()
