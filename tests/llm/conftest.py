import pytest

from tierwell.llm.common import ship


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def docs(spark):
    """Rows (doc_id, text, lang, source) of the hard cases, with an extra column of a clashing name."""

    def make(rows, extra=True):
        kind = "doc_id long, text string, lang string, source string"
        full = [tuple(r) + (None,) * (4 - len(r)) for r in rows]
        df = spark.createDataFrame(full, kind)
        return df.selectExpr("*", "'x' AS n", "1 AS component_id", "'y' AS rank", "2 AS _n") if extra else df

    return make
