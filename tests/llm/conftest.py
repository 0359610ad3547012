import pytest


@pytest.fixture
def documents(spark):
    """A frame of the documents' columns from (doc_id, text) or (doc_id, text, source), with a clashing extra column."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), "clash") for r in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, size string")

    return make
