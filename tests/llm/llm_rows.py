import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, rid string, fp string"


@pytest.fixture()
def docs(spark):
    """Make documents from ``(doc_id, text)``; other columns clash with names the operators use."""
    def make(rows, lang="en"):
        return spark.createDataFrame(
            [(i, t, lang, "s", None if t is None else len(t), "x", "y", "z") for i, t in rows], DOCS)
    return make


def by_id(df, *cols):
    return {r["doc_id"]: tuple(r[c] for c in cols) for r in df.collect()}
