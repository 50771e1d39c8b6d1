import duckdb
import pytest

SF = "/root/testdata/sf0.001"

EDGE = [
    (1, "plain words only, nothing else here"), (2, None), (3, ""), (4, " \n\t "), (None, "a text without an id"),
    (5, "plain words only, nothing else here"), (5, "plain words only, nothing else here"),
    (6, "long " + "word abc " * 30000), (7, "x" * 70000), (8, "é🙂 日本語   it's 'll 12 ３"),
    (9, "mail a.b@c.example.org and 10.0.0.1 or 4111 1111 1111 1111, +1 (474) 555-5602"),
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls, empty, very long and repeated rows, and extra columns whose names clash."""
    rows = [(i, t, "s", 1, 2, 3, 0.5, True, "c") for i, t in EDGE]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_tokens int, n_bytes int, "
                                       "fp int, score double, contaminated boolean, component_id string")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string, lang string, n_chars int")


@pytest.fixture(scope="session")
def small_texts():
    return duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet' order by 1").fetchall()
