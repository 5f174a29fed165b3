import pytest
from rows import doc_rows


@pytest.fixture
def docs(spark):
    """With extra columns whose names clash with the operators' own."""
    rows = [(*r, len(r[1] or ""), -1, "x", 0.5, [1]) for r in doc_rows()]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, size long, target string, ids double, n_words array<int>")


@pytest.fixture
def no_docs(docs):
    return docs.where("false")
