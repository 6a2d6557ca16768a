import pytest

from llm_cases import DOC_SCHEMA, SF


@pytest.fixture(scope="session")
def make_docs(spark):
    """documents-like table from (doc_id, text) pairs, with extra columns of clashing names."""
    def make(rows):
        return spark.createDataFrame(
            [(i, t, None, "s", None if t is None else len(t), *["x"] * (len(DOC_SCHEMA) - 5)) for i, t in rows], DOC_SCHEMA)
    return make


@pytest.fixture(scope="session")
def sample():
    """(doc_id, text) of the smallest documents table."""
    import duckdb
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY 1").fetchall()
