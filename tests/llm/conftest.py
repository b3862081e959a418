import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark):
    """A documents table from texts or (id, text) pairs."""

    def make(rows, source="s", lang="en"):
        pairs = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        full = [(i, t, lang, source, None if t is None else len(t)) for i, t in pairs]
        return spark.createDataFrame(full, DOCS)

    return make
