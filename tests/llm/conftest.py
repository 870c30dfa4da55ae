import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, llr double, best int, score double, c0 string"


@pytest.fixture()
def docs(spark):
    """Make a documents table with extra, clashing columns from (doc_id, text[, lang]) rows."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or ""), 9.0, 3, 7.0, "x") for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make
