import pytest

from clickstrata.llm.common import workers_find_package


@pytest.fixture(autouse=True)
def package_on_workers(spark):
    workers_find_package(spark)


@pytest.fixture
def rows_of(spark):
    """A table of documents from ``(doc_id, text)`` pairs, with columns that clash with results."""

    def make(rows, extra=()):
        names = ["doc_id bigint", "text string", *(f"{c} string" for c in extra)]
        return spark.createDataFrame([(*r, *(c for c in extra)) for r in rows], ", ".join(names))

    return make
