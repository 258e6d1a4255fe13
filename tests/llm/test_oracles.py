import duckdb
import pytest

from tabulary.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_match_their_sql(spark, sf, name):
    connection = duckdb.connect()
    for table in ("documents", "benchmark", "pages", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    result = connection.execute(queries.ORACLE_SQL[name])
    columns = [d[0] for d in result.description]
    df = queries.QUERIES[name](spark, sf)
    assert sorted(columns) == sorted(df.columns)
    want = sorted(repr([row[columns.index(c)] for c in df.columns]) for row in result.fetchall())
    assert sorted(repr(list(r)) for r in df.collect()) == want
