import pytest

#: Names that operators use for their own columns.
CLASHING = ["_text", "key", "blob", "print", "fingerprint", "component_id", "score", "rank", "source_tokens", "removed"]


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text[, lang, source]) rows, with further columns whose names clash."""

    def make(rows, clash=True):
        full = [(*row, *[None] * (4 - len(row)), len(row[1] or ""))[:5] for row in rows]
        docs = spark.createDataFrame(full, "doc_id bigint, text string, lang string, source string, n_chars bigint")
        return docs.selectExpr("*", *[f"'x' as {name}" for name in CLASHING]) if clash else docs

    return make


@pytest.fixture
def edges(documents):
    """Null id, null text, empty and blank texts, repeated rows, one long text."""
    long = " ".join(f"word{i % 977}" for i in range(60_000))
    return documents([
        (1, "one two three four five six"), (1, "one two three four five six"), (2, None), (3, ""), (4, " \n\t "),
        (5, long), (6, long), (None, "no id here at all"), (7, "naïve 漢字 🙂 text\nwith lines"), (8, "x"),
    ])


@pytest.fixture
def nothing(documents):
    return documents([])


@pytest.fixture
def labels_of(spark):
    def make(rows, columns="doc_id bigint, quality int, toxic int"):
        return spark.createDataFrame(rows, columns)

    return make
