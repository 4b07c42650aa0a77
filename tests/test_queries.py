"""Every registered query against its SQL on the small sample, the ordered ones in few and in many slices."""

import compare
import pytest
from conftest import SMALL

from __spark_entry__ import oracle_sql, queries
from tickloom.registry.oracle import ORACLE
from tickloom.registry.queries import QUERIES

# Queries whose panels hold scans or long frames.
SLICED = ("ema", "macd", "adx", "max_drawdown", "sma_ratios", "volume_trend", "gap_ranges", "intraday_features", "daily_features", "sparse_ema", "sparse_macd", "sparse_atr", "sparse_adx", "sparse_drawdown", "long_range_position", "long_drawdown", "sparse_long_drawdown")


@pytest.fixture(scope="module")
def con():
    return compare.connect(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare.difference(queries()[name](spark, SMALL), con, oracle_sql()[name]) is None


@pytest.mark.parametrize("name", SLICED)
def test_query_in_many_slices(spark, con, name, monkeypatch):
    from tickloom.operators import panel

    plain = panel.open_panel
    monkeypatch.setattr(panel, "open_panel", lambda df, **kw: plain(df, **{**kw, "slice_rows": 256 if kw["lookback"] > 60 else 32}))
    assert compare.difference(queries()[name](spark, SMALL), con, oracle_sql()[name]) is None
