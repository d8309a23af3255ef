"""Every registered query against its SQL on the smallest tables."""

from pathlib import Path

import pytest

import check
from tallycast.plans import catalogue
from tallycast.plans.inputs import TABLES

FOLDER = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    if not FOLDER.exists():
        pytest.skip("test tables are not here")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, name):
    df = catalogue.QUERIES[name](spark, str(FOLDER))
    ours = check.rows_of(df.columns, [tuple(r) for r in df.collect()])
    if name not in catalogue.ORACLES:
        assert ours
        return
    answer = duck.execute(catalogue.ORACLES[name])
    columns = [d[0] for d in answer.description]
    assert sorted(columns) == sorted(df.columns)
    assert ours == check.rows_of(columns, answer.fetchall())
