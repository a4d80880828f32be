import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """Rows of (doc_id, text, lang, source, n_chars), with extra columns whose names clash with inner ones."""

    clashing = ("size", "gone", "key", "label", "fp", "uid", "prob", "name", "data", "at", "score", "range", "guest", "digest", "n_bytes", "copies", "target", "line", "block", "component_id")

    def make(texts, ids=None, sources=None):
        ids = list(range(len(texts))) if ids is None else ids
        sources = ["s"] * len(texts) if sources is None else sources
        rows = [(i, t, "en", s, None if t is None else len(t), *["x"] * len(clashing)) for i, t, s in zip(ids, texts, sources, strict=True)]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in clashing))

    return make
