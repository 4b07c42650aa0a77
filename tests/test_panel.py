"""Positions, slices and scans against plain pandas, in few and many slices."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickloom.operators.panel import (
    Affine,
    Block,
    LastKnown,
    RunningMax,
    ema_decay,
    open_panel,
    run_blocks,
    with_positions,
)


@pytest.fixture(scope="module")
def history():
    """Three tickers, one with most of the rows, over 12 years with holes."""
    rng = np.random.default_rng(7)
    parts = []
    for ticker, n in (("BIG", 2500), ("MID", 300), ("ONE", 1)):
        days = np.sort(rng.choice(4400, n, replace=False))
        close = 100 + np.cumsum(rng.normal(0, 1, n)).clip(-60)
        parts.append(
            pd.DataFrame(
                {
                    "ticker": ticker,
                    "date": [d.date() for d in pd.Timestamp("2010-01-01") + pd.to_timedelta(days, "D")],
                    "close": close,
                    "volume": rng.integers(1, 1000, n),
                }
            )
        )
    return pd.concat(parts, ignore_index=True)


def collected(df):
    return df.toPandas().sort_values(["ticker", "date"]).reset_index(drop=True)


class Probe(Block):
    lookback = 21
    decays = (ema_decay(5), ema_decay(12))

    def first(self, panel):
        return {
            "before": panel.lag("close", 3),
            "mean_20": panel.mean("close", 20),
            "long_20": panel.long_mean(20),
            "trend_5": panel.whole_number_slope("volume", 5),
            "at": panel.position,
            "is_end": panel.is_last,
        }

    def scans(self, panel):
        return [
            Affine("fast", self.decays[0], f"close * {1 - self.decays[0]!r}D"),
            Affine("slow", self.decays[1], f"close * {1 - self.decays[1]!r}D"),
            RunningMax("peak", "close"),
            LastKnown("round", "CASE WHEN volume % 50 = 0 THEN volume END"),
        ]

    def second(self, panel):
        # A frame over a scanned value needs the scan to be right before the slice.
        return {"fast_low": f"min(fast) OVER ({panel.frame(10)})"}

    def columns(self):
        return ["before", "mean_20", "long_20", "trend_5", "at", "is_end", "fast", "slow", "peak", "round", "fast_low"]


@pytest.mark.parametrize("slice_rows", [64, 2048])
def test_blocks_equal_pandas(spark, layout, history, slice_rows):
    # The low scale of the input makes the powers of slices of 64 rows small too.
    out = collected(run_blocks(spark.createDataFrame(history), Probe(), slice_rows=slice_rows))
    want = history.sort_values(["ticker", "date"]).reset_index(drop=True)
    by = want.groupby("ticker")

    def scan(span):
        decay = ema_decay(span)

        def walk(s):
            y, out = 0.0, []
            for x in s:
                y = decay * y + x * (1 - decay)
                out.append(y)
            return pd.Series(out, s.index)

        return by["close"].transform(walk)

    expected = {
        "before": by["close"].shift(3),
        "mean_20": by["close"].transform(lambda s: s.rolling(20).mean()),
        "long_20": by["close"].transform(lambda s: s.rolling(20).mean()),
        "trend_5": by["volume"].transform(lambda s: s.rolling(5).apply(lambda v: np.polyfit(range(5), v, 1)[0])),
        "at": by.cumcount().astype(float),
        "fast": scan(5),
        "slow": scan(12),
        "peak": by["close"].cummax(),
        "round": want["volume"].where(want["volume"] % 50 == 0).groupby(want["ticker"]).ffill(),
    }
    expected["fast_low"] = expected["fast"].groupby(want["ticker"]).transform(lambda s: s.rolling(10, min_periods=1).min())
    for name, values in expected.items():
        np.testing.assert_allclose(
            out[name].astype(float).to_numpy(), values.to_numpy(dtype=float), rtol=1e-9, atol=1e-9, err_msg=name
        )
    assert out["is_end"].sum() == 3


def test_row_and_partition_order_do_not_matter(spark, layout, history):
    shuffled = spark.createDataFrame(history.sample(frac=1, random_state=1)).repartition(7)
    a = collected(run_blocks(shuffled, Probe(), slice_rows=64))
    b = collected(run_blocks(spark.createDataFrame(history).coalesce(1), Probe(), slice_rows=64))
    pd.testing.assert_frame_equal(a, b, rtol=1e-12)


def test_ticker_alone_equals_ticker_among_others(spark, layout, history):
    every = spark.createDataFrame(history)
    alone = collected(run_blocks(every.filter("ticker = 'MID'"), Probe(), slice_rows=64))
    among = collected(run_blocks(every, Probe(), slice_rows=64))
    pd.testing.assert_frame_equal(alone, among[among["ticker"] == "MID"].reset_index(drop=True), rtol=1e-12)


def test_future_rows_do_not_change_the_past(spark, layout, history):
    big = history[history["ticker"] == "BIG"]
    cut = sorted(big["date"])[1500]
    whole = collected(run_blocks(spark.createDataFrame(big), Probe(), slice_rows=64))
    early = collected(run_blocks(spark.createDataFrame(big[big["date"] < cut]), Probe(), slice_rows=64))
    same = [c for c in early.columns if c != "is_end"]
    pd.testing.assert_frame_equal(whole[whole["date"] < cut][same].reset_index(drop=True), early[same], rtol=1e-12)


def test_a_long_flat_stretch_keeps_the_old_state(spark, layout):
    """The state survives hundreds of rows that add nothing, across slices."""
    n, decay = 700, 0.9
    frame = pd.DataFrame(
        {
            "ticker": "FLAT",
            "date": [d.date() for d in pd.date_range("2015-01-01", periods=n)],
            "x": [1.0] + [0.0] * (n - 1),
        }
    )
    panel = open_panel(spark.createDataFrame(frame), lookback=1, decays=(decay,), slice_rows=64)
    out = collected(panel.scan(Affine("y", decay, "x")).close())
    np.testing.assert_allclose(out["y"], decay ** np.arange(n), rtol=1e-9)


def test_slices_are_bounded(spark, history):
    panel = open_panel(spark.createDataFrame(history), lookback=20, slice_rows=64)
    largest = panel.df.groupBy("ticker", "_slice").count().agg({"count": "max"}).first()[0]
    assert largest <= 64 + 21
    assert panel.close().count() == len(history)


def test_positions_start_at_zero_and_know_the_total(spark, history):
    out = with_positions(spark.createDataFrame(history), ("ticker",), "date").toPandas()
    for ticker, group in out.groupby("ticker"):
        group = group.sort_values("date")
        assert list(group["_index"]) == list(range(len(group)))
        assert set(group["_total"]) == {len(group)}


def test_decay_too_strong_for_the_lookback_is_refused(spark):
    frame = spark.createDataFrame([("A", 1.0)], "ticker string, close double").selectExpr("*", "current_date() date")
    with pytest.raises(ValueError, match="too strong"):
        open_panel(frame, lookback=2000, decays=(ema_decay(2),))


def test_rows_without_key_or_time_are_kept(spark):
    frame = spark.createDataFrame(
        [("A", "2024-01-01", 1.0), ("A", None, 2.0), (None, "2024-01-01", 3.0), (None, "2024-01-02", 4.0)], "ticker string, date string, close double"
    ).selectExpr("ticker", "CAST(date AS DATE) AS date", "close", "1L AS volume")
    out = run_blocks(frame, Probe(), slice_rows=64).collect()
    assert sorted((r["ticker"] or "", r["close"], r["at"]) for r in out) == [("", 3.0, 0), ("", 4.0, 1), ("A", 1.0, 1), ("A", 2.0, 0)]


def test_long_window_and_short_average_together(spark, history):
    from tickloom.config import PriceFeatureConfig
    from tickloom.operators.price import price_features

    cfg = PriceFeatureConfig(sma_windows=(600,), ema_windows=(3,))
    frame = history.assign(open=history.close, high=history.close, low=history.close)
    out = collected(price_features(spark.createDataFrame(frame), cfg))
    by = history.sort_values(["ticker", "date"]).groupby("ticker")["close"]
    np.testing.assert_allclose(out["ema_3"], by.transform(lambda s: s.ewm(span=3, adjust=False).mean()).to_numpy(), rtol=1e-9)
    np.testing.assert_allclose(out["sma_600"].astype(float), by.transform(lambda s: s.rolling(600).mean()).to_numpy(), rtol=1e-9)


@pytest.mark.parametrize("hole", [0, 3, 5])
def test_missing_closes(spark, hole):
    """A missing close leaves averages and the drawdown of the other rows alone."""
    from tickloom.operators.price import Drawdown, ExponentialAverages
    from tickloom.operators.technical import AverageTrueRange
    from tickloom.config import PriceFeatureConfig

    closes = [100.0] * 6
    closes[hole] = None
    days = [d.date() for d in pd.date_range("2024-01-01", periods=6)]
    frame = spark.createDataFrame([("A", d, c, c, c, 1) for d, c in zip(days, closes)], "ticker string, date date, close double, high double, low double, volume long")
    out = run_blocks(frame, ExponentialAverages((3,)), Drawdown(PriceFeatureConfig()), AverageTrueRange(3)).orderBy("date").collect()
    want = pd.Series(closes).ewm(span=3, adjust=False).mean()
    assert [r["ema_3"] for r in out] == [None if pd.isna(w) else pytest.approx(w, rel=1e-12) for w in want]
    assert all(r["max_drawdown_5d"] in (None, 0.0) for r in out) and out[-1 if hole < 5 else -2]["max_drawdown_5d"] == 0.0
    known = sum(1 for a, b in zip(closes, closes[1:]) if a is not None and b is not None)
    assert (out[-1]["atr_3"] is not None) == (known >= 3)


def test_exponential_averages_with_holes_equal_pandas(spark, history, layout):
    """Missing values at the start, scattered, and for longer than several slices."""
    from tickloom.operators.price import ExponentialAverages

    holes = history.copy()
    rng = np.random.default_rng(3)
    holes.loc[rng.random(len(holes)) < 0.3, "close"] = np.nan
    big = holes.index[holes.ticker == "BIG"]
    holes.loc[[*big[:5], *big[300:1100], *big[1700:1703]], "close"] = np.nan
    holes.loc[holes.ticker == "ONE", "close"] = np.nan
    rows = holes.assign(close=holes.close.astype(object).where(holes.close.notna(), None))
    table = spark.createDataFrame(list(rows.itertuples(index=False, name=None)), "ticker string, date date, close double, volume long")
    spans = (3, 12, 200)
    got = collected(run_blocks(table, ExponentialAverages(spans)))
    for n in spans:
        want = holes.sort_values(["ticker", "date"]).groupby("ticker").close.transform(lambda c, n=n: c.ewm(span=n, adjust=False).mean()).reset_index(drop=True)
        np.testing.assert_allclose(got[f"ema_{n}"].astype(float), want, rtol=1e-9, err_msg=str(n))


def test_seeded_average_after_a_hole_equals_pandas(spark, layout):
    from tickloom.operators.technical import Macd

    closes = [100.0, 101.0, None, 103.0, 99.0, None, None, 110.0, 120.0] + [100.0 + (k * 37 % 23) if k % 7 else None for k in range(900)]
    days = pd.date_range("2015-01-01", periods=len(closes)).date
    table = spark.createDataFrame([("A", d, c) for d, c in zip(days, closes)], "ticker string, date date, close double")

    def average(series, n, start=0):
        seeded = series.copy()
        seeded[: start + n - 1] = np.nan
        seeded[start + n - 1] = series[start : start + n].mean()
        return seeded.ewm(span=n, adjust=False).mean()

    close = pd.Series(closes, dtype=float)
    line = average(close, 5) - average(close, 9)
    got = collected(run_blocks(table, Macd(5, 9, 4)))
    np.testing.assert_allclose(got["macd_5_9_4"].astype(float), line, rtol=1e-8, atol=1e-9)
    np.testing.assert_allclose(got["macd_signal_5_9_4"].astype(float), average(line, 4, 8), rtol=1e-8, atol=1e-9)


@pytest.mark.parametrize("n", [1, 7, 64, 100])
@pytest.mark.parametrize("rows", [2048, 64])
def test_long_extremes_equal_frames(spark, rows, n):
    """Running extremes of blocks against the frame evaluated per row: holes, negative values, equal values, keys shorter than the frame."""
    value = F.when(F.hash("k", "id") % 5 != 0, (F.hash("id", "k") % 50).cast("double"))
    table = spark.range(700).select(F.when(F.col("id") < 600, "a").when(F.col("id") < 640, "b").alias("k"), F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("date"), value.alias("v"), "id")
    panel = open_panel(table, key=("k",), lookback=max(n, 2), slice_rows=rows)
    parts = panel.add(panel.extreme_parts("up", "v", n) | panel.extreme_parts("down", "-v", n))
    done = parts.add({"high": parts.long_extreme("up", n), "low": f"-({parts.long_extreme('down', n)})", "max": f"max(v) OVER ({panel.frame(n)})", "min": f"min(v) OVER ({panel.frame(n)})"}).close()
    assert done.count() == 700
    assert done.where("NOT (high <=> max AND low <=> min)").count() == 0
