import pytest

from loanmart.llm.shared import ready

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def table(spark, tmp_path):
    """Writes ``documents`` with these texts (or whole rows) into a folder of its own; returns the folder."""

    def write(texts, schema=SCHEMA, name="documents"):
        rows = [t if isinstance(t, tuple) else (i, t, "en", f"src{i % 7}", None) for i, t in enumerate(texts)]
        ready(spark).createDataFrame(rows, schema).write.mode("overwrite").parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)

    return write


@pytest.fixture(scope="session")
def small(tmp_path_factory):
    """The smallest given documents as plain rows."""
    import pyarrow.parquet as pq

    return pq.read_table("/root/testdata/sf0.001/documents.parquet").to_pylist()
