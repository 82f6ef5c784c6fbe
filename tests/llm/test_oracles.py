"""Registered queries of this package against their SQL, where there is one, and the columns of the others."""

import os

import oracle
import pytest

from tierwell.llm.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_and_types_as_the_oracle(spark, name):
    db, df = oracle.connect(SF_DIR), QUERIES[name](spark, SF_DIR)
    assert oracle.type_differences(db, df, ORACLES[name]) == {}
    assert oracle.from_spark(df) == oracle.from_duckdb(db, ORACLES[name])


@pytest.mark.parametrize(("name", "table", "key"), [
    ("op1_kneser_ney_quality", "documents", "doc_id"), ("op10_language_id", "documents", "doc_id"),
    ("language_id_of_pages", "pages", "page_id"),
])
def test_every_row_is_judged(spark, name, table, key):
    rows = QUERIES[name](spark, SF_DIR).collect()
    assert sorted(r[key] for r in rows) == sorted(r[0] for r in spark.read.parquet(f"{SF_DIR}/{table}.parquet").select(key).collect())
