"""Every registered query of the reference's operators against its SQL in DuckDB."""

import pytest

import __spark_entry__ as entry_points
from streamwatch.registry.oracles import ORACLES as SQL
from streamwatch.registry.queries import QUERIES
from tests.conftest import TESTDATA
from tools.check_queries import connect, difference, types_differ


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, name):
    result = QUERIES[name](spark, TESTDATA)
    got = result.toPandas()
    assert len(got) > 0
    connection = connect(TESTDATA)
    assert difference(got, connection.execute(SQL[name]).df()) is None
    assert types_differ(result, connection, SQL[name]) is None
    if not name.startswith(("stream", "job")):
        # no query joins all pairs
        text = result._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in text and "NestedLoop" not in text


@pytest.fixture(scope="module")
def split_tables(spark, tmp_path_factory):
    """The same tables in several files, in another order."""
    folder = tmp_path_factory.mktemp("split")
    for name in ("events", "lineitem"):
        rows = spark.read.parquet(f"{TESTDATA}/{name}.parquet").repartition(5)
        rows.write.parquet(str(folder / f"{name}.parquet"))
    return str(folder)


@pytest.mark.parametrize("name", sorted(n for n in SQL if not n.startswith("job")))
def test_query_equals_sql_on_split_tables(spark, split_tables, name):
    got = QUERIES[name](spark, split_tables).toPandas()
    assert difference(got, connect(TESTDATA).execute(SQL[name]).df()) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_points.queries()) and set(SQL) <= set(entry_points.oracle_sql())


def test_entry(spark):
    result = entry_points.entry(spark)
    assert result.count() > 0 and {r.is_anomaly for r in result.collect()} == {True}
