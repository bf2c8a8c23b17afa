"""Every query that SQL can express against its SQL, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from tidemark.llm.catalog import ORACLES, QUERIES

TABLES = Path("/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    for table in TABLES.glob("*.parquet"):
        connection.sql(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    found = QUERIES[name](spark, str(TABLES))
    columns = sorted(found.columns)
    expected = connection.sql(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall()
    assert sorted(map(tuple, found.select(columns).collect()), key=repr) == sorted(expected, key=repr)
