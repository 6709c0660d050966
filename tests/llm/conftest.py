import pytest

from reelhouse.llm.util import prepare

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def llm(spark):
    return prepare(spark)


@pytest.fixture
def docs(llm):
    """Rows of documents from (doc_id, text) or (doc_id, text, lang)."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", None if r[1] is None else len(r[1])) for r in rows]
        return llm.createDataFrame(full, COLUMNS)

    return make
