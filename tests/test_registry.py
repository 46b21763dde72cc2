"""Every registered query against its SQL twin on the smallest tables."""

import math

import duckdb
import pytest

from tests.conftest import SF, TABLES
from tickloom.operators import ordered
from tickloom.plans.catalog import QUERIES, SQL


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def table_of(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def text(v):
        if v is None:
            return "NULL"
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(v + 0.0)
        return str(v)

    return sorted(columns), sorted(tuple(text(r[i]) for i in order) for r in rows)


def test_names_agree():
    assert set(SQL) <= set(QUERIES)
    assert len(QUERIES) > 100


@pytest.mark.parametrize("name", [
    "tick_features", "future_volatility", "asof_past_price", "gap_stats", "replay_delay", "rolling_mean", "ks_test",
    "wasserstein", "roc_auc", "latency_report", "temporal_split", "stratified_split", "replay_ticks",
])
def test_query_in_small_chunks(spark, con, name, monkeypatch):
    """Every key is cut into chunks of at most 90 rows; the results stay the same."""
    monkeypatch.setattr(ordered, "MIN_CHUNK_ROWS", 90)
    monkeypatch.setattr(ordered, "MAX_CHUNK_ROWS", 90)
    test_query(spark, con, name)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    if name not in SQL:
        assert rows
        return
    twin = con.sql(SQL[name])
    assert table_of(rows, df.columns) == table_of(twin.fetchall(), twin.columns)
