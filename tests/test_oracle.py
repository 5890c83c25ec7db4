"""Every registered query against its SQL, over the whole small tables."""

import duckdb
import pytest

from catalog import QUERIES, SQL

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def plain(frame, columns):
    cells = frame[columns].astype(object).where(frame[columns].notna(), None).astype(str)
    return cells.sort_values(columns).reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, duck):
    result = QUERIES[name](spark, SF)
    types = {c: TYPES[t] for c, t in result.dtypes}
    got = result.toPandas()
    relation = duck.sql(SQL[name])
    assert types == dict(zip(relation.columns, map(str, relation.types)))
    columns = sorted(types)
    expected = relation.df()
    assert len(got) == len(expected)
    assert plain(got, columns).equals(plain(expected, columns))


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
