"""Every registered forecast query against its SQL in DuckDB, on the driver's smallest tables."""

from __future__ import annotations

from pathlib import Path

import pandas as pd
import pytest

from brume.plans import catalog

DATA = Path("/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
ORACLES = catalog.oracle_sql()

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def cell(x):
    if x is None or x is pd.NaT or x is pd.NA or isinstance(x, float) and x != x:
        return "null"
    return f"{x:.6g}" if isinstance(x, float) else str(x)


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(tuple(map(cell, r)) for r in frame.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, duck, name):
    ours, theirs = catalog.queries()[name](spark, str(DATA)).toPandas(), duck.sql(ORACLES[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)
    assert len(ours) > 0 or name in ("align_steps", "stream_run_complete")


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(ORACLES) | {"fetch_ranges"}


def test_ranges_of_a_table(spark):
    got = catalog.queries()["fetch_ranges"](spark, str(DATA)).collect()
    assert got and all(r.status == "ok" and r.n_read == r.length for r in got)
    assert sum(r.n_read for r in got) == (DATA / "orders.parquet").stat().st_size
