import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark):
    """Documents of (doc_id, text) pairs; extra columns are named like results."""
    def make(pairs, extra="score double, n_lines long, drop string, fp string, contaminated boolean, c0 string, near string"):
        n = len(extra.split(",")) if extra else 0
        return spark.createDataFrame([(i, t, None, "s", None) + (None,) * n for i, t in pairs], DOC + (", " + extra if extra else ""))
    return make
