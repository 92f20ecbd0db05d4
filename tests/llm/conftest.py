import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """Rows of (doc_id, text[, source]) as a documents table whose extra columns
    have the names that operators use for their results."""
    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1]) if r[1] else 0,
                 9, 9, "x", True, 1.5) for r in rows]
        return spark.createDataFrame(
            full, DOCS + ", size long, shard int, tag string, kept boolean, score double")
    return make
