import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Documents of the given texts, numbered from 1 unless ``(id, text)`` pairs are given."""
    def make(texts, lang="en"):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts, 1)]
        return spark.createDataFrame([(i, t, lang, "s", len(t) if t is not None else None) for i, t in rows], DOCUMENTS)
    return make
