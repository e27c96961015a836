"""Every registered query against its DuckDB oracle SQL (the driver's gate
runs the same comparison at sf 0.01; here sf 0.001 keeps the suite fast)."""
import os

import duckdb
import pytest

from tests.conftest import SF001
from tools.check_oracle import TABLES, _rows

from __spark_entry__ import entry
from allelic.plans.registry import oracle_sql, queries

QS, SQL = queries(), oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF001}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_contract():
    assert set(SQL) <= set(QS)
    assert len(QS) >= 80


def test_entry_smoke(spark):
    df = entry(spark)
    rows = df.collect()
    assert len(rows) == 3 and df.columns[0] == "member_type"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    df = QS[name](spark, SF001)
    srows, scols = df.collect(), df.columns
    res = duck.execute(SQL[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(scols) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _rows(scols, srows) == _rows(dcols, drows)
