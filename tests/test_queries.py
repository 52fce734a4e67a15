"""Every registered query beside its SQL on the small driver tables."""

import compare
import pytest

import __spark_entry__ as entry
from caremart.registry import queries as registry

SF_DIR = "/root/testdata/sf0.001"
QUERIES = registry.queries()
ORACLE = registry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    got = compare.canonical(df.columns, df.collect())
    result = duck.execute(ORACLE[name])
    want = compare.canonical([d[0] for d in result.description], result.fetchall())
    assert want[1], "an oracle without rows proves nothing"
    assert compare.differences(got, want) is None


def test_entry(spark):
    assert entry.entry(spark).count() == 120
