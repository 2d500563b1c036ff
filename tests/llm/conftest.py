import pytest

from spendgroups.llm.tables import importable


@pytest.fixture(autouse=True)
def workers_find_the_package(spark):
    importable(spark)


@pytest.fixture(scope="session")
def documents(spark):
    """Builds a table of documents from texts, with a column that clashes with inner names."""

    def build(texts, langs=None, sources=None, ids=None):
        ids = range(len(texts)) if ids is None else ids
        langs = langs or [None] * len(texts)
        sources = sources or [None] * len(texts)
        rows = [
            (i, t, lang, s, None if t is None else len(t), "kept")
            for i, t, lang, s in zip(ids, texts, langs, sources)
        ]
        schema = "doc_id long, text string, lang string, source string, n_chars long, _email_found string"
        return spark.createDataFrame(rows, schema)

    return build
