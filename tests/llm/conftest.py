import pytest


@pytest.fixture
def docs(spark):
    """Rows -> a documents table with every column."""
    def build(rows):
        full = [(i, t, lang, "s", None if t is None else len(t)) for i, t, *rest in rows for lang in [rest[0] if rest else "en"]]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")
    return build
