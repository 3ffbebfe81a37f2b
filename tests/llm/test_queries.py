"""The registered queries of this subpackage and the pipeline on the test tables, and against their SQL where there is one."""

import pytest

import __spark_entry__ as entry_points
from streamwatch.llm.queries import QUERIES
from tests.conftest import TESTDATA
from tools.check_queries import connect, difference, types_differ

SQL = {name: sql for name, sql in entry_points.oracle_sql().items() if name in QUERIES}


def test_all_are_registered():
    registered = entry_points.queries()
    assert set(QUERIES) <= set(registered) and "pipeline" in registered
    assert set(SQL) == {"op7_arc_to_warc", "op9_chat_format", "op11_phrase_mining", "op12_merkle_manifest"}


@pytest.mark.parametrize("name", [*QUERIES, "pipeline"])
def test_query_on_the_test_tables(spark, name):
    result = entry_points.queries()[name](spark, TESTDATA)
    got = result.toPandas()
    assert len(got) > 0
    # no query joins all pairs
    text = result._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    if name in SQL:
        connection = connect(TESTDATA)
        assert difference(got, connection.execute(SQL[name]).df()) is None
        assert types_differ(result, connection, SQL[name]) is None


@pytest.fixture(scope="module")
def split_tables(spark, tmp_path_factory):
    """The same tables in several files, in another order."""
    folder = tmp_path_factory.mktemp("split")
    for name in ("documents", "pages", "conversations"):
        spark.read.parquet(f"{TESTDATA}/{name}.parquet").repartition(5).write.parquet(str(folder / f"{name}.parquet"))
    return str(folder)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql_on_split_tables(spark, split_tables, name):
    got = QUERIES[name](spark, split_tables).toPandas()
    assert difference(got, connect(TESTDATA).execute(SQL[name]).df()) is None
