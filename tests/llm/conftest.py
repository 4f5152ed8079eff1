import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """Small documents table from (doc_id, text) pairs or (doc_id, text, lang)."""

    def make(rows):
        full = [(i, t, rest[0] if rest else "en", "s", None if t is None else len(t)) for i, t, *rest in rows]
        return spark.createDataFrame(full, "doc_id bigint, text string, lang string, source string, n_chars bigint")

    return make
