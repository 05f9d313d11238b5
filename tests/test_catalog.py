import duckdb
import pytest

import __spark_entry__ as driver
from risewatch.catalog import oracle
from risewatch.catalog.queries import all_queries

SF = "/root/testdata/sf0.001"
NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for name in NAMES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def normal(rows):
    return sorted((tuple("NULL" if v is None else str(v) for v in row) for row in rows))


def test_every_query_has_a_twin():
    assert all_queries().keys() == oracle.all_sql().keys()
    assert all_queries().keys() <= driver.queries().keys()


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_equals_its_twin(spark, engine, name):
    got = driver.queries()[name](spark, SF)
    columns = sorted(got.columns)
    want = engine.execute(driver.oracle_sql()[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = [[row[i] for i in order] for row in want.fetchall()]
    assert normal(expected) == normal(got.select(*columns).collect())


def test_row_counts_detect_once_for_the_rollup(spark):
    plan = all_queries()["row_counts"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") == 1  # for the events; weekly mentions and velocity read the stored rollup


def test_flagship(spark):
    assert driver.entry(spark).count() > 0
