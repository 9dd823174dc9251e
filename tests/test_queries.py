"""Every registered query against its oracle, on whole tables."""

import pytest

from __spark_entry__ import oracle_sql, queries
from check_oracles import oracle_connection, rows_of

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SF_DIR)


#: Queries that SQL can express; the others have tests of their own.
COMPARED = [name for name in queries() if name in oracle_sql()]


@pytest.mark.parametrize("name", COMPARED)
def test_query_matches_oracle(spark, oracle, name):
    df = queries()[name](spark, SF_DIR)
    cursor = oracle.execute(oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    found = rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert found == rows_of(columns, cursor.fetchall())
