"""Hand-built cases of the feature blocks."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest

from tickloom.config import ConfluenceConfig, PriceFeatureConfig, TechnicalIndicatorConfig, TimeFeatureConfig
from tickloom.operators.candles import candle_features
from tickloom.operators.clock import market_hours_only, time_features
from tickloom.operators.confluence import confluence_features
from tickloom.operators.market import market_features
from tickloom.operators.news import attach_news, news_daily, news_rolling
from tickloom.operators.panel import run_blocks
from tickloom.operators.price import Drawdown, ExponentialAverages, SimpleAverages, price_features
from tickloom.operators.sentiment import combine_sentiment_scores, rule_sentiment
from tickloom.operators.technical import AverageTrueRange, technical_features
from tickloom.operators.volume import volume_features

BARS = "ticker string, date date, open double, high double, low double, close double, volume long"


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def bars(rows, closes, ticker="A", volume=100):
    data = [(ticker, day(i), float(c), c + 1.0, c - 1.0, float(c), volume) for i, c in enumerate(closes)]
    return rows(data, BARS)


def column(df, name):
    return [r[name] for r in df.orderBy("ticker", "date").collect()]


def walk(n, seed=3):
    rng = np.random.default_rng(seed)
    return [float(x) for x in 100 + np.cumsum(rng.normal(0, 1, n))]


def test_exponential_average_starts_at_the_first_close(rows, layout):
    out = run_blocks(bars(rows, [1, 2, 4]), ExponentialAverages((3,)))
    assert column(out, "ema_3") == pytest.approx([1, 1.5, 2.75])


def test_drawdown_peak_starts_at_the_second_row(rows, layout):
    cfg = PriceFeatureConfig(volatility_windows=(1,))
    out = run_blocks(bars(rows, [100, 110, 55, 66]), Drawdown(cfg))
    assert column(out, "max_drawdown_1d")[0] is None
    assert column(out, "max_drawdown_1d")[1:] == pytest.approx([0, -0.5, -0.4])


def test_warm_up_rows_are_null(rows, layout):
    assert column(run_blocks(bars(rows, [1, 2, 3, 4]), SimpleAverages((5,))), "sma_5") == [None] * 4
    out = run_blocks(bars(rows, [1, 2, 3, 4, 5, 6]), SimpleAverages((5,)))
    assert column(out, "sma_5")[4:] == pytest.approx([3, 4])


def test_a_missing_price_empties_the_frames_that_hold_it(rows, layout):
    data = [("A", day(i), 1.0, 2.0, 0.5, None if i == 2 else 1.0, 5 if i != 4 else None) for i in range(8)]
    cfg = PriceFeatureConfig(sma_windows=(2, 3), keep_na=True)
    out = price_features(rows(data, BARS), cfg)
    assert [v is None for v in column(out, "sma_2")] == [True, False, True, True, False, False, False, False]
    assert len(column(price_features(rows(data, BARS), PriceFeatureConfig()), "sma_5")) == 7
    vol = volume_features(rows(data, BARS))
    assert [v is None for v in column(vol, "volume_sma_5")] == [True] * 8
    assert column(vol, "volume_spike") == [0] * 8


def test_missing_column_is_named(rows):
    with pytest.raises(ValueError, match="volume"):
        price_features(bars(rows, [1, 2]).drop("volume"))


def test_empty_input_keeps_the_schema(rows):
    out = price_features(bars(rows, []))
    assert out.count() == 0 and "max_drawdown_20d" in out.columns


def test_indicators_stay_in_range(rows, layout):
    out = technical_features(bars(rows, walk(120))).toPandas()
    for name in ("rsi_14", "stoch_k_14_3_3", "stoch_d_14_3_3", "adx_14"):
        known = out[name].dropna()
        assert len(known) > 60 and known.between(-1e-9, 100 + 1e-9).all(), name
    assert out.sort_values("date")["rsi_14"].isna().sum() == 14
    assert out["adx_14"].isna().sum() == 27
    assert out["macd_signal_12_26_9"].isna().sum() == 33


def test_simple_smoothing_of_the_true_range(rows):
    out = run_blocks(bars(rows, walk(30)), AverageTrueRange(5, "sma")).toPandas().sort_values("date")
    previous = out["close"].shift()
    tr = pd.concat([out["high"] - out["low"], (out["high"] - previous).abs(), (out["low"] - previous).abs()], axis=1)
    want = tr.max(axis=1).where(previous.notna()).rolling(5).mean()
    np.testing.assert_allclose(out["atr_5"].to_numpy(float), want.to_numpy(float))
    with pytest.raises(ValueError):
        AverageTrueRange(5, "other")


def test_volume_trend_of_a_flat_series_is_zero(rows, layout):
    out = volume_features(bars(rows, walk(40)))
    assert set(column(out, "volume_trend_5d")[4:]) == {0.0}


def test_config_changes_the_columns(rows):
    cfg = TechnicalIndicatorConfig(rsi_length=3, bollinger_length=4, bollinger_std=1.5, wma_length=2)
    out = technical_features(bars(rows, walk(50)), cfg)
    assert {"rsi_3", "bb_pct_4_1.5", "wma_2"} <= set(out.columns)
    closes = walk(50)
    assert column(out, "wma_2")[1] == pytest.approx((closes[0] + 2 * closes[1]) / 3)


def test_market_columns(rows):
    index = rows([(day(0), 10.0), (day(1), 11.0), (day(2), 11.0)], "date date, close double")
    out = market_features(bars(rows, [100, 120, 132]), index)
    assert column(out, "stock_vs_market_return")[1:] == pytest.approx([0.1, 0.1])
    assert column(out, "relative_return")[1] == pytest.approx(2)
    assert column(out, "relative_return")[2] is None


INTRADAY = "ticker string, timestamp timestamp, open double, high double, low double, close double"


def ticks(rows, data, ticker="A"):
    start = dt.datetime(2024, 1, 2, 14, 30)
    return rows([(ticker, start + dt.timedelta(minutes=5 * i), *v) for i, v in enumerate(data)], INTRADAY)


def test_candle_patterns_do_not_cross_tickers(rows, layout):
    up, down = (1.0, 3.0, 0.5, 2.0), (2.0, 3.0, 0.5, 1.0)
    frame = ticks(rows, [down, up, up, up], "A").unionByName(ticks(rows, [up, down, down, down], "B"))
    out = candle_features(frame).toPandas().set_index(["ticker", "timestamp"]).sort_index()
    assert list(out.loc["A"]["is_bullish_engulfing"]) == [0, 1, 0, 0]
    assert list(out.loc["A"]["is_three_white_soldiers"]) == [0, 0, 0, 1]
    assert list(out.loc["B"]["is_three_black_crows"]) == [0, 0, 0, 1]
    assert list(out.loc["B"]["is_bearish_engulfing"]) == [0, 1, 0, 0]


def test_flat_bar_has_no_shares(rows):
    row = candle_features(ticks(rows, [(1.0, 1.0, 1.0, 1.0)])).first()
    assert row["body_size_pct"] is None and row["price_range_pct"] is None and row["is_hammer"] == 0


def test_session_clock_follows_daylight_saving(rows):
    summer, winter = dt.datetime(2024, 7, 1, 13, 30), dt.datetime(2024, 1, 2, 14, 30)
    frame = rows([("A", summer), ("A", winter), ("A", dt.datetime(2024, 1, 2, 21, 0))], "ticker string, timestamp timestamp")
    out = time_features(frame).orderBy("timestamp").collect()
    assert [(r["hour"], r["minute"], r["is_opening_window"]) for r in out][0] == (9, 30, 1)
    assert (out[2]["hour"], out[2]["minute"], out[2]["is_first_hour"]) == (9, 30, 1)
    assert out[0]["hour_sin"] == pytest.approx(math.sin(2 * math.pi * 9 / 24))
    assert market_hours_only(frame).count() == 2
    early = TimeFeatureConfig(market_close_hour=9, market_close_minute=0, closing_window_minutes=600)
    assert time_features(frame, early).filter("is_closing_window = 1").count() == 0


def test_lexicon_scores(rows):
    frame = rows(
        [("Strong growth but weak",), ("they beat,",), ("",), (None,), ("loss LOSS\tloss",)], "description string"
    )
    out = {r["description"]: r for r in rule_sentiment(frame).collect()}
    assert out["Strong growth but weak"]["sentiment_rule_score"] == pytest.approx(0.5)
    assert out["Strong growth but weak"]["sentiment_rule_label"] == "positive"
    assert out["they beat,"]["sentiment_rule_score"] == 0
    assert out[""]["sentiment_rule_score"] == 0 and out[None]["sentiment_rule_score"] == 0
    assert out["loss LOSS\tloss"]["sentiment_rule_score"] == pytest.approx(-3 / math.sqrt(3))


def test_combined_sentiment(rows):
    frame = rows(
        [("t", "strong", 0.5, None), ("t", "plain", None, None)],
        "title string, description string, sentiment_score double, sentiment_label string",
    )
    a, b = combine_sentiment_scores(frame).collect()
    rule = 1 / math.sqrt(2)
    assert a["sentiment_score"] == pytest.approx((rule + 0.5) / 2) and a["sentiment_vendor_score"] == 0.5
    assert (b["sentiment_score"], b["sentiment_label"]) == (0.0, "neutral")
    bare = combine_sentiment_scores(rows([(1,)], "id int"), text_column="absent").first()
    assert (bare["sentiment_score"], bare["sentiment_label"]) == (0.0, "neutral")


NEWS = (
    "ticker string, published_at timestamp, title string, description string, author string, type string, "
    "keywords array<string>, tickers array<string>, sentiment_score double, sentiment_label string"
)


def article(n, score, label=None, author="x", hour=12):
    return ("A", dt.datetime(2024, 1, 1, hour) + dt.timedelta(days=n), "abc", None, author, "article", ["k", "l"], None, score, label)


def test_news_days(rows):
    frame = rows([article(0, 0.2, "positive"), article(0, 0.4, "neutral", "y", 23), article(1, None)], NEWS)
    first, second = news_daily(frame).orderBy("date").collect()
    assert (first["news_count"], first["unique_authors"], first["total_keywords"]) == (2, 2, 4)
    assert first["sentiment_score_std"] == pytest.approx(math.sqrt(0.02))
    assert (first["positive_count"], first["neutral_count"], first["total_related_tickers"]) == (1, 1, 0)
    assert second["sentiment_score_std"] == 0 and second["sentiment_score_mean"] is None


def test_news_trend_counts_only_days_with_a_score(rows, layout):
    frame = rows([article(0, 0.1), article(1, None), article(2, 0.3)], NEWS)
    out = news_rolling(news_daily(frame))
    assert column(out, "sentiment_trend") == pytest.approx([0, 0, 0.2])
    assert column(out, "news_rolling_count") == [1, 2, 3]
    assert column(out, "sentiment_rolling_avg") == pytest.approx([0.1, 0.1, 0.2])


def test_days_without_news_are_filled(rows):
    days = rows([("A", day(0)), ("A", day(1))], "ticker string, date date")
    out = attach_news(days, rows([article(0, 0.5)], NEWS))
    assert column(out, "news_count") == [1, 0] and column(out, "sentiment_score_mean") == [0.5, 0.0]
    blank = attach_news(days, None)
    assert set(blank.columns) == set(out.columns) and column(blank, "sentiment_trend") == [0.0, 0.0]


def test_confluence_weights_and_literal_names(rows):
    schema = (
        "ticker string, volume_ratio double, macd_12_26_9 double, macd_signal_12_26_9 double, macd_hist_12_26_9 double, "
        "close_vs_sma20 double, sentiment_score_mean double, hammer_count int, bearish_engulf_count int"
    )
    frame = rows([("A", 1.3, 2.0, 1.0, 1.0, 0.1, 0.4, 3, 1)], schema)
    out = confluence_features(frame).first()
    assert out["pattern_strength"] == 2
    assert out["bullish_confluence_score"] == pytest.approx(0.3 + 0.2 + 0.2 + 0.1 + 0.2)
    assert out["bearish_confluence_score"] == pytest.approx(0.3)
    literal = confluence_features(frame, ConfluenceConfig(compat=True)).first()
    assert literal["momentum_macd_cross"] == 0 and literal["news_sentiment_positive"] == 0
    assert literal["bearish_confluence_score"] == pytest.approx(0.4)
