import pytest
from helpers import same_as_sql

from gridloom.plans import registered

CASES = [(n, m.QUERIES[n], sql) for m in registered() for n, sql in m.ORACLES.items()]


@pytest.mark.parametrize(("query", "sql"), [c[1:] for c in CASES], ids=[c[0] for c in CASES])
def test_query_gives_what_its_sql_gives(query, sql, spark, small, duck):
    same_as_sql(query, sql, spark, small, duck)


def test_every_oracle_has_a_query():
    for m in registered():
        assert set(m.ORACLES) <= set(m.QUERIES)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
