import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, n_words string, id string"
PAGES = "page_id long, url string, html string, text string, original string"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) pairs or longer tuples, with extra columns of clashing names."""

    def make(rows):
        full = [(*r, *[None, None, None, None][len(r) - 2 :])[:5] for r in rows]
        return spark.createDataFrame([(*r, "x", "y", "z") for r in full], DOCS)

    return make


@pytest.fixture(scope="session")
def pages_of(spark):
    return lambda rows: spark.createDataFrame([(*r, "x", "y") for r in rows], PAGES)


@pytest.fixture(scope="session")
def sample_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
