from pathlib import Path

import duckdb
import pytest

from turnloom.llm import queries

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    df = queries.QUERIES[name](spark, SF)
    found = con.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(names)
    assert sorted(map(repr, (tuple(r[n] for n in names) for r in df.collect()))) == sorted(map(repr, found.fetchall()))
