import pytest
from corpus_samples import DOCS, prose


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows):
        """rows: (doc_id, text) pairs."""
        return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], DOCS)
    return make


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Nulls, empty and blank texts, repeated rows, a long text, other scripts."""
    long = prose(30_000, 99)
    return make_docs([(1, prose(80, 1)), (1, prose(80, 1)), (2, None), (3, ""), (4, " \n\t "), (None, "lost row"),
                      (None, None), (5, "word"), (6, long), (7, prose(80, 1)), (8, "漢字かな 🙂 naïve Äpfel\x00x"),
                      (9, "x" * 5000)])
