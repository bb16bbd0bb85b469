import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__
from turnloom import queries

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def canonical(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(None if isinstance(r[i], float) and math.isnan(r[i]) else r[i] for i in order) for r in rows), key=repr)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(queries.QUERIES) <= set(__spark_entry__.queries()) and set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_equals_sql(spark, oracle, name):
    df = queries.QUERIES[name](spark, SF)
    rows = df.collect()
    if name not in queries.ORACLE_SQL:
        assert rows
        return
    cur = oracle.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names)
    assert canonical(rows, df.columns) == canonical(cur.fetchall(), names)
