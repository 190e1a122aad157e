"""Small tables for the operators of this folder."""
import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """rows -> documents with further columns whose names an operator might use itself."""
    def make(rows):
        return spark.createDataFrame([(d, t, "en", "s", 0, "k", 1) for d, t in rows],
                                     "doc_id long, text string, lang string, source string, n_chars long, sha string, length int")
    return make
