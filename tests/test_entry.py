import duckdb
import pytest

import __spark_entry__ as entry
import verify
from sifterra.plans import core_queries


def test_entry_runs(spark, sf):
    assert entry.entry(spark).limit(5).count() == 5


@pytest.fixture(scope="module")
def con(sf):
    from pathlib import Path

    c = duckdb.connect()
    for p in sorted(Path(sf).glob("*.parquet")):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(core_queries.queries()))
def test_core_queries_match_their_sql(spark, sf, con, name):
    got = core_queries.queries()[name](spark, sf).toPandas()
    sql = core_queries.oracle_sql().get(name)
    if sql:
        assert verify.canon(got) == verify.canon(con.execute(sql).df())


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
