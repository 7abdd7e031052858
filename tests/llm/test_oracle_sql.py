"""Every corpus query that has SQL, against DuckDB."""

import duckdb
import pytest

from coevo.llm import registry

DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DIR}/{t}.parquet')")
    got = registry.QUERIES[name](spark, DIR)
    names = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(names)} FROM ({registry.ORACLES[name]})").fetchall()
    assert sorted(tuple(r) for r in got.select(*names).collect()) == sorted(want)
