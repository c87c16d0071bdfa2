import pytest

from reviewloom.session import prepare_workers

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def llm(spark):
    prepare_workers(spark)
    return spark


@pytest.fixture
def documents(llm):
    """``documents([(id, text), ...])`` with the other columns of the table."""
    def make(rows):
        return llm.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], DOCS)
    return make
