"""The training-data queries with SQL, against DuckDB."""

import os

import duckdb
import pytest

from allelic.llm import catalog
from tests.conftest import SF001
from tools.check_oracle import TABLES, _rows


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(p := f"{SF001}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    df = catalog.queries()[name](spark, SF001)
    rows, columns = df.collect(), df.columns
    res = con.execute(catalog.oracle_sql()[name])
    names = [d[0] for d in res.description]
    assert sorted(columns) == sorted(names)
    assert _rows(columns, rows) == _rows(names, res.fetchall())


def test_entry_has_all_queries():
    import __spark_entry__ as entry
    found = entry.queries()
    assert {f"op{n}_" for n in range(1, 14)} == {x[:x.index("_") + 1] for x in found if x.startswith("op")}
    assert "pipeline" in found and set(catalog.oracle_sql()) <= set(entry.oracle_sql())
