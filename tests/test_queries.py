"""Every registered query of the core against its SQL, over the smallest whole tables."""

import os

import duckdb
import pytest

from assaymill.plans import fixtures, problems, reference

D = "/root/testdata/sf0.001"
QUERIES, SQL = reference.QUERIES | problems.QUERIES | fixtures.QUERIES, reference.SQL | problems.SQL | fixtures.SQL
pytestmark = pytest.mark.skipif(not os.path.isdir(D), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    base = duckdb.connect()
    base.execute("SET timezone = 'UTC'")
    for name in os.listdir(D):
        base.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{D}/{name}'")
    return base


def plain(value):
    if value is None:
        return "None"
    return repr(round(value, 6)) if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, D)
    columns = sorted(df.columns)
    relation = duck.execute(SQL[name])
    names = [c[0] for c in relation.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    wanted = sorted(tuple(plain(row[i]) for i in order) for row in relation.fetchall())
    assert sorted(tuple(plain(v) for v in row) for row in df.select(*columns).collect()) == wanted


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_runs(spark, name):
    assert QUERIES[name](spark, D).count() > 0
