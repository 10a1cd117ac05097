import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make_docs(spark):
    def make(rows):
        """rows: (doc_id, text) or (doc_id, text, lang)"""
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOC_SCHEMA)
    return make
