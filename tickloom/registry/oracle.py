"""SQL the registered queries are checked against (DuckDB dialect).

Written from the definitions, with plain windows per ticker and recursive
queries for the exponential averages; it shares no code with the operators.
"""

from __future__ import annotations

from .digits import digits_of

# -- views ---------------------------------------------------------------------------
_BARS = {
    "bars": ("o_orderpriority AS ticker, CAST(o_orderdate AS DATE) AS date", "o_totalprice", "o_orderkey", "o_custkey", "orders"),
    "ibars": ("event_type AS ticker, time_bucket(INTERVAL 30 MINUTE, ts) AS timestamp", "value", "ts", "user_id", "events"),
    "ebars": ("event_type AS ticker, CAST(ts AS DATE) AS date", "value", "ts", "user_id", "events"),
}


def _bars(name: str) -> str:
    keys, value, order, weight, source = _BARS[name]
    return f"""{name} AS MATERIALIZED (SELECT {keys}, arg_min({value}, {order}) AS open, max({value}) AS high,
      min({value}) AS low, arg_max({value}, {order}) AS close, CAST(sum({weight} + 1) AS BIGINT) AS volume,
      count(*) AS transactions, CAST(sum(CAST({value} AS DECIMAL(12, 4)) * ({weight} + 1)) AS DOUBLE) / sum({weight} + 1) AS volume_weighted_avg_price
      FROM {source} GROUP BY 1, 2)"""


INDEX = """idx AS (SELECT date, close AS market_close, close / lag(close) OVER (ORDER BY date) - 1 AS market_return
  FROM (SELECT CAST(o_orderdate AS DATE) AS date, CAST(sum(CAST(o_totalprice AS DECIMAL(12, 4))) AS DOUBLE) / count(*) AS close FROM orders GROUP BY 1))"""

NEWS = """news AS (SELECT CAST(d.doc_id AS VARCHAR) AS id,
    ['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'][d.doc_id % 5 + 1] AS ticker,
    CAST(DATE '1995-01-02' + CAST(d.doc_id // 10 AS INTEGER) AS TIMESTAMP) + to_hours(d.doc_id % 24) AS published_at,
    string_split(text, chr(10))[1] AS title, text AS description, source AS author, lang AS type,
    string_split(text, ' ') AS keywords, [source] AS tickers,
    CASE WHEN toxic = 1 THEN -0.8 WHEN quality = 1 THEN 0.5 WHEN toxic IS NOT NULL THEN 0.0 END AS sentiment_score,
    CASE WHEN toxic = 1 THEN 'negative' WHEN quality = 1 THEN 'positive' WHEN toxic IS NOT NULL THEN 'neutral' END AS sentiment_label
  FROM documents d LEFT JOIN labels l USING (doc_id))"""

_W = "OVER (PARTITION BY ticker ORDER BY i)"


def _frame(n: int) -> str:
    return f"OVER (PARTITION BY ticker ORDER BY i ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def _full(fn: str, x: str, n: int) -> str:
    return f"CASE WHEN count({x}) {_frame(n)} >= {n} THEN {fn}({x}) {_frame(n)} END"


def _slope(x: str, n: int) -> str:
    # Whole numbers: exact sums, so a flat series has slope 0.
    top = f"{n} * sum(i * {x}) {_frame(n)} - sum(i) {_frame(n)} * sum({x}) {_frame(n)}"
    return f"CASE WHEN count({x}) {_frame(n)} >= {n} THEN CAST({top} AS DOUBLE) / {n * n * (n * n - 1) // 12} END"


def _lag(x: str, n: int = 1) -> str:
    return f"lag({x}, {n}) {_W}"


def _flag(cond: str) -> str:
    return f"CAST(CASE WHEN {cond} THEN 1 ELSE 0 END AS INT)"


def _div(a: str, b: str) -> str:
    return f"(({a}) / nullif({b}, 0))"


def numbered(source: str, time: str, name: str = "nb") -> str:
    return f"""{name} AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY {time}) - 1 AS i FROM {source})"""


# -- price -----------------------------------------------------------------------------
RETURNS = {"price_change": f"close - {_lag('close')}", "daily_return": f"{_div('close', _lag('close'))} - 1"}
for _n in (5, 10, 20):
    RETURNS[f"return_{_n}d"] = RETURNS[f"momentum_{_n}d"] = f"{_div('close', _lag('close', _n))} - 1"
RISK: dict[str, str] = {}
for _n in (5, 20):
    RISK[f"return_volatility_{_n}d"] = _full("stddev_samp", "daily_return", _n)
    RISK[f"mean_daily_return_{_n}d"] = _full("avg", "daily_return", _n)
SHARPE = {
    f"sharpe_ratio_{n}d": f"CASE WHEN return_volatility_{n}d > 1e-10 THEN mean_daily_return_{n}d / return_volatility_{n}d * sqrt(252) END"
    for n in (5, 20)
}
SMA = {f"sma_{n}": _full("avg", "close", n) for n in (5, 10, 20, 50, 200)}
SMA_GAP = {f"close_vs_sma{n}": f"(close - sma_{n}) / (sma_{n} + 1e-10)" for n in (5, 10, 20, 50, 200)}
EMA_GAP = {f"close_vs_ema{n}": f"(close - ema_{n}) / (ema_{n} + 1e-10)" for n in (12, 26)}
RANGE = {
    f"price_vs_{n}d_range": f"(close - {_full('min', 'low', n)}) / ({_full('max', 'high', n)} - {_full('min', 'low', n)} + 1e-10)"
    for n in (5, 20)
}
LONG_RANGE = {
    f"price_vs_{n}d_range": f"(close - {_full('min', 'low', n)}) / ({_full('max', 'high', n)} - {_full('min', 'low', n)} + 1e-10)"
    for n in (100, 1000)
}
TRUE_RANGE = f"greatest(high - low, abs(high - {_lag('close')}), abs(low - {_lag('close')}))"

# Growth by multiplying the returns, its peak so far, and the fall from it.
DRAWDOWN = f"""grown AS (SELECT *, CASE WHEN i >= 1 THEN product(1 + daily_return) OVER (PARTITION BY ticker ORDER BY i ROWS UNBOUNDED PRECEDING) END AS cum
    FROM (SELECT *, {RETURNS['daily_return']} AS daily_return FROM nb)),
  fallen AS (SELECT *, (cum - peak) / (peak + 1e-10) AS dd FROM
    (SELECT *, max(cum) OVER (PARTITION BY ticker ORDER BY i ROWS UNBOUNDED PRECEDING) AS peak FROM grown)),
  drawn AS (SELECT ticker, date, min(dd) {_frame(5)} AS max_drawdown_5d, min(dd) {_frame(20)} AS max_drawdown_20d FROM fallen)"""

# -- recurrences: one step per row ---------------------------------------------------------
_INPUT = f"""step_in AS MATERIALIZED (SELECT ticker, date, i, high, low, close,
    greatest(close - {_lag('close')}, 0) AS gain, greatest({_lag('close')} - close, 0) AS loss,
    CASE WHEN i >= 1 THEN {TRUE_RANGE} END AS tr,
    CASE WHEN high - {_lag('high')} > {_lag('low')} - low AND high - {_lag('high')} > 0 THEN high - {_lag('high')} ELSE 0 END AS up,
    CASE WHEN {_lag('low')} - low > high - {_lag('high')} AND {_lag('low')} - low > 0 THEN {_lag('low')} - low ELSE 0 END AS dn,
    avg(close) {_frame(12)} AS m12, avg(close) {_frame(14)} AS m14, avg(close) {_frame(26)} AS m26 FROM nb)"""


def _seeded(prev: str, x: str, mean: str, n: int, seed_at: int) -> str:
    return f"CASE WHEN s.i = {seed_at} THEN {mean} WHEN s.i > {seed_at} THEN {prev} + ({x} - {prev}) * 2.0 / {n + 1} END"


STEPS = f"""{_INPUT},
  walk AS (SELECT ticker, i, close AS e12, close AS e26, CAST(NULL AS DOUBLE) AS s12, CAST(NULL AS DOUBLE) AS s14, CAST(NULL AS DOUBLE) AS s26,
      CAST(0 AS DOUBLE) AS g, CAST(0 AS DOUBLE) AS l, CAST(0 AS DOUBLE) AS t, CAST(0 AS DOUBLE) AS p, CAST(0 AS DOUBLE) AS m, CAST(0 AS DOUBLE) AS w
    FROM step_in WHERE i = 0
    UNION ALL
    SELECT s.ticker, s.i, e12 + (s.close - e12) * 2.0 / 13, e26 + (s.close - e26) * 2.0 / 27,
      {_seeded('s12', 's.close', 's.m12', 12, 11)}, {_seeded('s14', 's.close', 's.m14', 14, 13)}, {_seeded('s26', 's.close', 's.m26', 26, 25)},
      g * 13 / 14 + s.gain, l * 13 / 14 + s.loss, t * 13 / 14 + s.tr, p * 13 / 14 + s.up, m * 13 / 14 + s.dn, w * 13 / 14 + 1
    FROM walk JOIN step_in s ON s.ticker = walk.ticker AND s.i = walk.i + 1),
  walked AS MATERIALIZED (SELECT s.date, s.close, k.*, CASE WHEN k.i >= 25 THEN s12 - s26 END AS line,
      CASE WHEN k.i >= 14 THEN 100 * abs(p - m) / nullif(p + m, 0) END AS dx
    FROM walk k JOIN step_in s USING (ticker, i)),
  late_in AS MATERIALIZED (SELECT *, avg(line) {_frame(9)} AS m9 FROM walked),
  late AS (SELECT ticker, i, CAST(NULL AS DOUBLE) AS sig, CAST(0 AS DOUBLE) AS a, CAST(0 AS DOUBLE) AS aw FROM late_in WHERE i = 0
    UNION ALL
    SELECT s.ticker, s.i, {_seeded('sig', 's.line', 's.m9', 9, 33)}, a * 13 / 14 + coalesce(s.dx, 0),
      CASE WHEN s.i >= 14 THEN aw * 13 / 14 + 1 ELSE 0 END
    FROM late JOIN late_in s ON s.ticker = late.ticker AND s.i = late.i + 1),
  rec AS MATERIALIZED (SELECT k.ticker, k.date, k.i, e12 AS ema_12, e26 AS ema_26, s14 AS ema_14,
      CASE WHEN k.i >= 14 THEN 100 * g / nullif(g + l, 0) END AS rsi_14,
      line AS macd_12_26_9, sig AS macd_signal_12_26_9, line - sig AS macd_hist_12_26_9,
      CASE WHEN k.i >= 14 THEN t / w END AS atr_14, CASE WHEN k.i >= 27 THEN a / aw END AS adx_14
    FROM late_in k JOIN late USING (ticker, i))"""

# -- technical without recurrences ----------------------------------------------------------
RAW_K = f"100 * (close - {_full('min', 'low', 14)}) / nullif({_full('max', 'high', 14)} - {_full('min', 'low', 14)}, 0)"
WMA = "(" + " + ".join(f"{14 - k} * {_lag('close', k) if k else 'close'}" for k in range(14)) + ") / 105"
BANDS = {
    "bb_middle_20_2.0": _full("avg", "close", 20),
    "bb_lower_20_2.0": f"{_full('avg', 'close', 20)} - 2 * {_full('stddev_samp', 'close', 20)}",
    "bb_upper_20_2.0": f"{_full('avg', 'close', 20)} + 2 * {_full('stddev_samp', 'close', 20)}",
}
BANDS_REST = {
    "bb_bandwidth_20_2.0": '("bb_upper_20_2.0" - "bb_lower_20_2.0") / ("bb_middle_20_2.0" + 1e-10)',
    "bb_pct_20_2.0": '(close - "bb_lower_20_2.0") / nullif("bb_upper_20_2.0" - "bb_lower_20_2.0", 0)',
}

# -- volume -----------------------------------------------------------------------------------
VOLUME = {f"volume_sma_{n}": _full("avg", "volume", n) for n in (5, 20)}
VOLUME |= {f"volume_trend_{n}d": _slope("volume", n) for n in (5, 20)}
VOLUME |= {"price_volume": "close * volume", "price_volume_sma_20": _full("avg", "close * volume", 20)}
for _n in (5, 20):
    VOLUME[f"liquidity_{_n}d"] = f"{_full('avg', 'close', _n)} * {_full('avg', 'volume', _n)}"
    VOLUME[f"avg_dollar_volume_{_n}d"] = _full("avg", "close * volume", _n)
VOLUME_REST = {"volume_ratio": "volume / (volume_sma_20 + 1e-10)"}
VOLUME_FLAGS = {"volume_spike": _flag("volume_ratio > 2"), "volume_dry": _flag("volume_ratio < 0.5")}


def _cols(columns: dict[str, str]) -> str:
    return ", ".join(f'{sql} AS "{name}"' for name, sql in columns.items())


def _level(name: str, source: str, columns: dict[str, str]) -> str:
    return f"{name} AS (SELECT *, {_cols(columns)} FROM {source})"


FEATURES = ",\n  ".join(
    [
        _level("f1", "nb", RETURNS | SMA | RANGE | BANDS | VOLUME | {"true_range": TRUE_RANGE, "raw_k": RAW_K, "sma_14": _full("avg", "close", 14),
               "wma_14": f"CASE WHEN i >= 13 THEN {WMA} END", "days_since_prev_close": f"CAST(coalesce(date - {_lag('date')}, 0) AS INT)"}),
        _level("f2", "f1", RISK | SMA_GAP | BANDS_REST | VOLUME_REST | {"avg_true_range_14": _full("avg", "true_range", 14),
               "stoch_k_14_3_3": _full("avg", "raw_k", 3), "tr_percent": "true_range / (close + 1e-10)",
               "is_monday": _flag("dayofweek(date) = 1"), "is_friday": _flag("dayofweek(date) = 5")}),
        _level("f3", "f2", SHARPE | VOLUME_FLAGS | {"stoch_d_14_3_3": _full("avg", "stoch_k_14_3_3", 3)}),
        DRAWDOWN,
        f"""f4 AS (SELECT f3.*, {_cols(EMA_GAP)}, rec.* EXCLUDE (ticker, date, i), atr_14 / nullif(close, 0) AS atr_pct_14,
      atr_14 AS atr, atr_14 / nullif(close, 0) AS atr_pct, adx_14 AS adx, max_drawdown_5d, max_drawdown_20d
    FROM f3 JOIN rec USING (ticker, date) JOIN drawn USING (ticker, date))""",
    ]
)

# -- news ---------------------------------------------------------------------------------------
NEWS_DAYS = """nd AS (SELECT ticker, CAST(published_at AS DATE) AS date, count(ticker) AS news_count,
    avg(length(coalesce(title, ''))) AS avg_title_length, avg(length(coalesce(description, ''))) AS avg_description_length,
    count(DISTINCT author) AS unique_authors, count(DISTINCT type) AS unique_types,
    CAST(sum(coalesce(len(keywords), 0)) AS BIGINT) AS total_keywords, CAST(sum(coalesce(len(tickers), 0)) AS BIGINT) AS total_related_tickers,
    avg(sentiment_score) AS sentiment_score_mean, coalesce(stddev_samp(sentiment_score), 0) AS sentiment_score_std,
    CAST(count(*) FILTER (sentiment_label = 'positive') AS BIGINT) AS positive_count,
    CAST(count(*) FILTER (sentiment_label = 'negative') AS BIGINT) AS negative_count,
    CAST(count(*) FILTER (sentiment_label = 'neutral') AS BIGINT) AS neutral_count FROM news GROUP BY 1, 2),
  ndi AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date) AS i FROM nd)"""
NEWS_ROLLING = f"""ndx AS (SELECT *, count(sentiment_score_mean) OVER (PARTITION BY ticker ORDER BY i ROWS UNBOUNDED PRECEDING) AS x FROM ndi),
  nr AS (SELECT *, CAST(sum(news_count) {_frame(7)} AS BIGINT) AS news_rolling_count, avg(sentiment_score_mean) {_frame(7)} AS sentiment_rolling_avg,
    CASE WHEN count(sentiment_score_mean) {_frame(7)} < 2 OR abs(regr_slope(sentiment_score_mean, x) {_frame(7)}) < 1e-12 THEN 0
      ELSE regr_slope(sentiment_score_mean, x) {_frame(7)} END AS sentiment_trend FROM ndx)"""
NEWS_COUNTS = ("news_count", "unique_authors", "unique_types", "total_keywords", "total_related_tickers",
               "positive_count", "negative_count", "neutral_count", "news_rolling_count")
NEWS_VALUES = ("avg_title_length", "avg_description_length", "sentiment_score_mean", "sentiment_score_std",
               "sentiment_rolling_avg", "sentiment_trend")

# -- confluence -----------------------------------------------------------------------------------
FLAGS = {
    "vol_confirm_primary": _flag("volume_ratio >= 1.2"),
    "vol_confirm_secondary": _flag("volume_ratio >= 1.5"),
    "vol_trend_up": _flag("volume_trend_5d > 0"),
    "momentum_rsi_confirm": _flag("(rsi_14 < 30 AND price_change > 0) OR (rsi_14 > 70 AND price_change < 0)"),
    "momentum_macd_cross": _flag("macd_12_26_9 > macd_signal_12_26_9 AND macd_hist_12_26_9 > 0"),
    "trend_price_above_sma20": _flag("close_vs_sma20 > 0"),
    "trend_price_above_sma50": _flag("close_vs_sma50 > 0"),
    "trend_strong_adx": _flag("adx_14 > 20"),
    "bb_reentry_signal": _flag('"bb_pct_20_2.0" < 0 AND close_vs_sma20 > 0'),
    "atr_breakout": _flag("true_range >= 1.2 * avg_true_range_14"),
    "near_high_volume_node": _flag("price_vs_20d_range BETWEEN 0.4 AND 0.6 AND volume_ratio > 1"),
    "near_range_extreme": _flag("price_vs_20d_range <= 0.1 OR price_vs_20d_range >= 0.9"),
}
NEWS_FLAGS = {
    "news_sentiment_positive": _flag("sentiment_score_mean > 0"),
    "news_sentiment_trending_up": _flag("sentiment_trend > 0"),
}
NO_NEWS_FLAGS = dict.fromkeys(NEWS_FLAGS, "CAST(0 AS INT)")


def _scores(strength: str) -> dict[str, str]:
    return {
        "bullish_confluence_score": "0.3 * vol_confirm_primary + 0.2 * momentum_macd_cross + 0.2 * trend_price_above_sma20"
        " + 0.1 * momentum_rsi_confirm + 0.1 * bb_reentry_signal + 0.1 * news_sentiment_positive"
        f" + 0.1 * CASE WHEN {strength} IS NOT NULL THEN greatest({strength}, 0) END",
        "bearish_confluence_score": "0.3 * vol_confirm_primary + 0.2 * (1 - trend_price_above_sma20) + 0.2 * momentum_rsi_confirm"
        " + 0.1 * atr_breakout + 0.1 * (1 - news_sentiment_positive)"
        f" + 0.1 * CASE WHEN {strength} IS NOT NULL THEN greatest(-({strength}), 0) END",
    }


# -- intraday ----------------------------------------------------------------------------------------
_UP, _DOWN = "close > open", "close < open"
_UP1, _DOWN1 = f"{_lag('close')} > {_lag('open')}", f"{_lag('close')} < {_lag('open')}"
_UP2, _DOWN2 = f"{_lag('close', 2)} > {_lag('open', 2)}", f"{_lag('close', 2)} < {_lag('open', 2)}"
_TOP, _BOTTOM = "high - close < 0.05 * (high - low)", "close - low < 0.05 * (high - low)"
SHAPE = {
    "body_size": "abs(close - open)",
    "body_size_pct": _div("abs(close - open)", "high - low"),
    "shadow_upper": "high - greatest(close, open)",
    "shadow_lower": "least(close, open) - low",
    "shadow_upper_pct": _div("high - greatest(close, open)", "high - low"),
    "shadow_lower_pct": _div("least(close, open) - low", "high - low"),
    "bullish": _flag(_UP),
    "bearish": _flag(_DOWN),
}
SPREAD = {"price_range": "high - low", "price_range_pct": _div("high - low", "high - low")}
MOMENTUM = {
    "price_change": f"{_div('close', _lag('close'))} - 1",
    "price_change_5m": f"{_div('close', _lag('close', 5))} - 1",
    "price_change_10m": f"{_div('close', _lag('close', 10))} - 1",
}
PATTERNS = {
    "is_bullish_engulfing": _flag(f"{_UP} AND {_DOWN1}"),
    "is_bearish_engulfing": _flag(f"{_DOWN} AND {_UP1}"),
    "is_hammer": _flag(f"{_DOWN} AND {_TOP}"),
    "is_inverted_hammer": _flag(f"{_UP} AND {_BOTTOM}"),
    "is_shooting_star": _flag(f"{_DOWN} AND {_BOTTOM}"),
    "is_hanging_man": _flag(f"{_DOWN} AND {_BOTTOM}"),
    "is_bullish_morning_star": _flag(f"{_UP} AND {_DOWN1} AND {_UP2}"),
    "is_bearish_evening_star": _flag(f"{_DOWN} AND {_UP1} AND {_DOWN2}"),
    "is_dragonfly_doji": _flag(f"close = open AND {_TOP}"),
    "is_gravestone_doji": _flag(f"close = open AND {_BOTTOM}"),
    "is_long_legged_doji": _flag(f"close = open AND {_TOP}"),
    "is_piercing_pattern": _flag(f"{_DOWN} AND {_UP1} AND close > {_lag('open')}"),
    "is_dark_cloud_cover": _flag(f"{_UP} AND {_DOWN1} AND close < {_lag('open')}"),
    "is_three_black_crows": _flag(f"{_DOWN} AND {_DOWN1} AND {_DOWN2}"),
    "is_three_white_soldiers": _flag(f"{_UP} AND {_UP1} AND {_UP2}"),
}
_LOCAL = "(timestamp AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York'"
_H, _M = f"hour({_LOCAL})", f"minute({_LOCAL})"
_OF_DAY = f"({_H} * 60 + {_M})"
HOURS = f"{_OF_DAY} >= 570 AND {_OF_DAY} < 960"
CLOCK = {
    "hour": f"CAST({_H} AS INT)",
    "minute": f"CAST({_M} AS INT)",
    "day_of_week": f"CAST(isodow({_LOCAL}) - 1 AS INT)",
    "is_opening_window": _flag(f"{_OF_DAY} >= 570 AND {_OF_DAY} < 600"),
    "is_closing_window": _flag(f"{_OF_DAY} >= 930 AND {_OF_DAY} < 960"),
    "is_lunch_hour": _flag(f"{_H} >= 11 AND {_H} < 14"),
    "hour_sin": f"sin(2 * pi() * {_H} / 24.0)",
    "hour_cos": f"cos(2 * pi() * {_H} / 24.0)",
    "minute_sin": f"sin(2 * pi() * {_M} / 60.0)",
    "minute_cos": f"cos(2 * pi() * {_M} / 60.0)",
    "is_morning": _flag(f"{_H} >= 9 AND {_H} < 12"),
    "is_afternoon": _flag(f"{_H} >= 12 AND {_H} < 16"),
    "is_first_hour": _flag(f"{_H} = 9"),
    "is_last_hour": _flag(f"{_H} = 15"),
}
LOADED = {
    "date": "CAST(timestamp AS DATE)",
    "is_monday": _flag("dayofweek(timestamp) = 1"),
    "is_friday": _flag("dayofweek(timestamp) = 5"),
    "seconds_since_prev_bar": f"CAST(coalesce(date_diff('second', {_lag('timestamp')}, timestamp), 0) AS BIGINT)",
}
INTRA = f"{_bars('ibars')}, {numbered('ibars', 'timestamp')}"
CANDLES = _level("c", "nb", SHAPE | SPREAD | MOMENTUM | PATTERNS)
ROLLUP = f"""rolled AS (SELECT ticker, CAST({_LOCAL} AS DATE) AS date, CAST(sum(is_hammer) AS BIGINT) AS hammer_count,
    CAST(sum(is_bullish_engulfing) AS BIGINT) AS bullish_engulf_count, CAST(sum(is_bearish_engulfing) AS BIGINT) AS bearish_engulf_count,
    CAST(sum({CLOCK['is_opening_window']}) AS BIGINT) AS opening_activity, CAST(sum({CLOCK['is_closing_window']}) AS BIGINT) AS closing_activity,
    avg(body_size_pct) AS avg_body_size, max(price_range_pct) AS max_range_pct FROM c GROUP BY 1, 2)"""
GAPS = """steps AS (SELECT ticker, lag(timestamp) OVER (PARTITION BY ticker ORDER BY timestamp) AS previous_timestamp, timestamp AS current_timestamp FROM ibars),
  gaps AS (SELECT ticker, previous_timestamp, current_timestamp, gap_seconds / 60 AS gap_minutes, gap_seconds,
      CAST(ceil(gap_seconds / 1800) AS INT) - 1 AS missing_count
    FROM (SELECT *, date_diff('microsecond', previous_timestamp, current_timestamp) / 1e6 AS gap_seconds FROM steps)
    WHERE gap_seconds / 60 > 45 AND gap_seconds <> 201900 AND gap_seconds <> 29100),
  missing AS (SELECT ticker, timestamp, CAST(timestamp AS DATE) AS date FROM
    (SELECT ticker, unnest(generate_series(previous_timestamp + INTERVAL 30 MINUTE, current_timestamp - INTERVAL 1 MICROSECOND, INTERVAL 30 MINUTE)) AS timestamp FROM gaps))"""
_TURNED = "CASE ticker WHEN 'click' THEN 'error' WHEN 'error' THEN 'purchase' WHEN 'purchase' THEN 'signup' WHEN 'signup' THEN 'view' WHEN 'view' THEN 'click' END"
FILL = f"""landed AS (SELECT * REPLACE ({_TURNED} AS ticker) FROM ibars),
  recent AS (SELECT * FROM missing),
  filled AS (SELECT * FROM landed SEMI JOIN recent USING (ticker, timestamp))"""

# -- ingest ---------------------------------------------------------------------------------------------
LEDGER = """ledger AS (SELECT o_orderpriority AS ticker, CASE o_orderstatus WHEN 'F' THEN 'daily' WHEN 'O' THEN 'intraday' ELSE 'news' END AS data_type,
    CAST(o_orderdate AS DATE) AS last_fetch_date, CASE WHEN o_totalprice < 100000 THEN 'failed' ELSE 'completed' END AS status,
    CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + to_seconds(o_orderkey) AS updated_at FROM orders),
  latest AS (SELECT ticker, data_type, arg_max(last_fetch_date, updated_at) AS last_fetch_date FROM ledger WHERE status = 'completed' GROUP BY 1, 2),
  who AS (SELECT DISTINCT o_orderpriority AS ticker FROM orders UNION SELECT 'SPY'),
  todo AS (SELECT who.ticker, kind, least(coalesce(last_fetch_date + 1, DATE '2001-08-14' - 60), DATE '2001-08-14') AS start_date, DATE '2001-08-14' AS end_date
    FROM who CROSS JOIN (VALUES ('daily'), ('intraday'), ('news')) k(kind) LEFT JOIN latest ON latest.ticker = who.ticker AND data_type = kind)"""

BAR_TYPES = {"open", "high", "low", "close", "volume_weighted_avg_price"}


def _out(name: str, double: bool = True) -> str:
    digits = digits_of(name) if double else None
    return f'"{name}"' if digits is None else f'round("{name}", {digits}) AS "{name}"'


_INTEGERS = {
    "ticker", "date", "timestamp", "volume", "transactions", "days_since_prev_close", "is_monday", "is_friday",
    "seconds_since_prev_bar", "volume_spike", "volume_dry", "pattern_strength", "missing_next_bar", "missing_previous_bar",
    "bullish", "bearish", "hour", "minute", "day_of_week", "hammer_count", "bullish_engulf_count", "bearish_engulf_count",
    "opening_activity", "closing_activity", *FLAGS, *NEWS_FLAGS, *PATTERNS, *NEWS_COUNTS,
    *[c for c in CLOCK if c.startswith("is_")],
}


def select(names, source: str) -> str:
    return "SELECT " + ", ".join(_out(n, n not in _INTEGERS) for n in names) + f" FROM {source}"


def sql(parts: list[str], body: str, recursive: bool = False) -> str:
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n  ".join(parts) + "\n" + body


KEY, TKEY = ["ticker", "date"], ["ticker", "timestamp"]
PRICES = ["open", "high", "low", "close"]
BAR_TAIL = ["volume", "transactions", "volume_weighted_avg_price"]
DAILY = [_bars("bars"), numbered("bars", "date")]


def windows(*levels: dict[str, str], names=None, source: str = "nb", base=None, key=None) -> str:
    """Stacked levels of window columns over numbered bars."""
    parts, current = list(base or DAILY), source
    for k, level in enumerate(levels):
        parts.append(_level(f"l{k}", current, level))
        current = f"l{k}"
    return sql(parts, select([*(key or KEY), *(names or [n for lv in levels for n in lv])], current))


def recurrences(names) -> str:
    body = select([*KEY, *names], f"(SELECT rec.*, close, {_cols(EMA_GAP)}, atr_14 / nullif(close, 0) AS atr_pct_14, atr_14 AS atr, atr_14 / nullif(close, 0) AS atr_pct, adx_14 AS adx FROM rec JOIN nb USING (ticker, date))")
    return sql([*DAILY, STEPS], body, recursive=True)


PRICE_NAMES = [
    "price_change", "daily_return", "return_5d", "return_10d", "return_20d", *RISK, *SHARPE, "max_drawdown_5d", "max_drawdown_20d",
    "momentum_5d", "momentum_10d", "momentum_20d", *SMA, *SMA_GAP, "ema_12", "ema_26", *EMA_GAP, *RANGE, "true_range", "avg_true_range_14", "tr_percent",
]
TECH_NAMES = [
    "rsi_14", "macd_12_26_9", "macd_signal_12_26_9", "macd_hist_12_26_9", "stoch_k_14_3_3", "stoch_d_14_3_3", *BANDS, *BANDS_REST,
    "atr_14", "atr_pct_14", "atr", "atr_pct", "adx_14", "adx", "ema_14", "sma_14", "wma_14",
]
MARKET_NAMES = ["market_close", "market_return", "stock_vs_market_return", "relative_return"]
MARKET = {"stock_vs_market_return": "daily_return - market_return", "relative_return": _div("daily_return", "market_return")}
DAILY_NAMES = [
    *KEY, *PRICES, *BAR_TAIL, "is_monday", "is_friday", "days_since_prev_close", *PRICE_NAMES, *TECH_NAMES, *VOLUME, *VOLUME_REST, *VOLUME_FLAGS,
    *FLAGS, *NEWS_FLAGS, "pattern_strength", "bullish_confluence_score", "bearish_confluence_score", *MARKET_NAMES,
]
_NEWS_JOIN = "LEFT JOIN nr USING (ticker, date)"
_WITH_NEWS = {n: f"coalesce({n}, 0)" for n in (*NEWS_COUNTS, *NEWS_VALUES)}


def daily(body: str, extra: list[str] | None = None) -> str:
    """Body over ``feat``: all daily columns with flags, scores and index."""
    parts = [
        *DAILY, STEPS, FEATURES, INDEX, *(extra or []),
        _level("flagged", "f4", FLAGS | NO_NEWS_FLAGS | {"pattern_strength": "CAST(0 AS INT)"}),
        f"feat AS (SELECT flagged.*, market_close, market_return, {_cols(MARKET | _scores('pattern_strength'))} FROM flagged LEFT JOIN idx USING (date))",
    ]
    return sql(parts, body, recursive=True)


_COMPLETE = "(SELECT * FROM feat WHERE " + " AND ".join(f'"{n}" IS NOT NULL' for n in DAILY_NAMES) + ")"
INTRA_VOLUME = {k: v for k, v in VOLUME.items() if k.startswith(("volume_", "price_volume"))}
INTRADAY_NAMES = [
    *TKEY, *PRICES, *BAR_TAIL, *LOADED, *SHAPE, *MOMENTUM, *PATTERNS, *SPREAD, *CLOCK, *INTRA_VOLUME, *VOLUME_REST, *VOLUME_FLAGS,
    "missing_next_bar", "missing_previous_bar",
]
_BOUNDARY = {
    "missing_previous_bar": _flag("i = 0"),
    "missing_next_bar": _flag("i = max(i) OVER (PARTITION BY ticker)"),
}
_SESSION = [
    INTRA,
    _level("seen", "nb", SHAPE | SPREAD | MOMENTUM | PATTERNS | LOADED),
    f"open_bars AS (SELECT * EXCLUDE (i) FROM seen WHERE {HOURS})",
    numbered("open_bars", "timestamp", "sb"),
    _level("v1", "sb", INTRA_VOLUME | CLOCK | _BOUNDARY),
    _level("v2", "v1", VOLUME_REST),
    _level("v3", "v2", VOLUME_FLAGS),
]
_EVENT_DAILY = [_bars("ebars"), numbered("ebars", "date", "nb"), STEPS, FEATURES]
_EVENT_INTRA = [
    _bars("ibars"), numbered("ibars", "timestamp", "inb"), CANDLES.replace("FROM nb", "FROM inb"), ROLLUP,
]
_STRENGTH = "hammer_count + bullish_engulf_count - bearish_engulf_count"
_ROLL_NAMES = ["hammer_count", "bullish_engulf_count", "bearish_engulf_count", "opening_activity", "closing_activity", "avg_body_size", "max_range_pct"]


def _score_text(text: str, good: tuple[str, ...], bad: tuple[str, ...]) -> str:
    tokens = f"list_filter(regexp_split_to_array(lower({text}), '\\s+'), lambda t: t <> '')"
    g = "[" + ", ".join(f"'{w}'" for w in good) + "]"
    b = "[" + ", ".join(f"'{w}'" for w in bad) + "]"
    return (
        f"coalesce((len(list_filter({tokens}, lambda t: list_contains({g}, t))) - len(list_filter({tokens}, lambda t: list_contains({b}, t) AND NOT list_contains({g}, t))))"
        f" / nullif(sqrt(len({tokens})), 0), 0)"
    )


def _label(x: str) -> str:
    return f"CASE WHEN {x} > 0.1 THEN 'positive' WHEN {x} < -0.1 THEN 'negative' ELSE 'neutral' END"


_GOOD = ("les", "que", "au", "de", "of", "the", "der", "und", "el")
_BAD = ("un", "en", "la", "le", "and", "die", "des", "los", "in")
_BAR_COLUMNS = [*PRICES, *BAR_TAIL]
_APPLIED = f"""plan AS (SELECT ticker, DATE '2000-01-10' AS start_date, DATE '2000-03-31' AS end_date FROM who),
  batch AS (SELECT * REPLACE (close + 1 AS close) FROM bars WHERE date BETWEEN DATE '2000-01-10' AND DATE '2000-03-31' AND ticker <> '5-LOW')"""

_NEWS_BATCH = "batch AS (SELECT * FROM news WHERE CAST(published_at AS DATE) BETWEEN DATE '1995-02-01' AND DATE '1995-03-14' AND ticker <> '5-LOW')"

# Every calendar day from a ticker's first bar to its last; days without a bar have no prices.
_SPARSE = [
    _bars("bars"),
    """days AS (SELECT ticker, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM bars GROUP BY 1)""",
    "sparse AS MATERIALIZED (SELECT ticker, date, high, low, close, row_number() OVER (PARTITION BY ticker ORDER BY date) - 1 AS i FROM days LEFT JOIN bars USING (ticker, date))",
]
_SPARSE_MOVES = f"""moves AS MATERIALIZED (SELECT *, CASE WHEN high IS NOT NULL AND {_lag('high')} IS NOT NULL THEN high - {_lag('high')} END AS u,
    CASE WHEN high IS NOT NULL AND {_lag('high')} IS NOT NULL THEN {_lag('low')} - low END AS d,
    CASE WHEN i >= 1 THEN {TRUE_RANGE} END AS tr, close - {_lag('close')} AS move,
    count(close) OVER (PARTITION BY ticker ORDER BY i ROWS UNBOUNDED PRECEDING) AS known,
    avg(close) OVER (PARTITION BY ticker ORDER BY i ROWS UNBOUNDED PRECEDING) AS mean FROM sparse)"""


def _sparse_walk(*more: str) -> list[str]:
    """One step per row. In decayed sums a missing value adds neither to the sum nor to its weights; an exponential average
    stays as it is and the weight of its past (1 after each known value) decays until the next known one."""

    def decayed(name: str, decay: str, value: str) -> str:
        return f"{name} * {decay} + coalesce({value}, 0)"

    one = "CASE WHEN {} IS NOT NULL THEN 1 END".format
    start = {"e": "close", "ew": "1", "f": "NULL", "fw": "1", "s": "NULL", "sw": "1"}
    zeros = ("g", "l", "t", "tw", "n", "p", "m")
    first = ", ".join([f"CAST({v} AS DOUBLE) AS {k}" for k, v in start.items()] + [f"CAST(0 AS DOUBLE) AS {z}" for z in zeros])
    def ewm(name: str, n: int, value: str) -> list[str]:
        left = f"({name}w * ({n - 1}.0 / {n + 1}))"
        mixed = f"({left} * {name} + 2.0 / {n + 1} * ({value})) / ({left} + 2.0 / {n + 1})"
        return [f"CASE WHEN ({value}) IS NULL THEN {name} WHEN {name} IS NULL THEN {value} ELSE {mixed} END", f"CASE WHEN ({value}) IS NULL THEN {left} ELSE 1 END"]

    def seeded(n: int) -> str:
        return f"CASE WHEN v.i = {n - 1} THEN v.mean WHEN v.i >= {n} THEN v.close END"

    steps = [
        *ewm("e", 12, "v.close"), *ewm("f", 12, seeded(12)), *ewm("s", 26, seeded(26)),
        decayed("g", "13.0 / 14", "CASE WHEN v.move > 0 THEN v.move END"), decayed("l", "13.0 / 14", "CASE WHEN v.move < 0 THEN -v.move END"),
        decayed("t", "13.0 / 14", "v.tr"), decayed("tw", "13.0 / 14", one("v.tr")), f"n + coalesce({one('v.tr')}, 0)",
        decayed("p", "13.0 / 14", "CASE WHEN v.u > v.d AND v.u > 0 THEN v.u END"), decayed("m", "13.0 / 14", "CASE WHEN v.d > v.u AND v.d > 0 THEN v.d END"),
    ]
    return [
        *_SPARSE, _SPARSE_MOVES,
        f"walk AS (SELECT ticker, i, {first} FROM moves WHERE i = 0 UNION ALL SELECT v.ticker, v.i, {', '.join(steps)} FROM walk JOIN moves v ON v.ticker = walk.ticker AND v.i = walk.i + 1)",
        """walked AS MATERIALIZED (SELECT v.*, walk.* EXCLUDE (ticker, i), e AS ema_12, (v.close - e) / (e + 1e-10) AS close_vs_ema12, CASE WHEN walk.i >= 25 THEN f - s END AS macd,
      CASE WHEN walk.i >= 14 THEN 100 * g / nullif(g + l, 0) END AS rsi, CASE WHEN n >= 14 THEN t / nullif(tw, 0) END AS atr,
      CASE WHEN walk.i >= 14 AND u IS NOT NULL THEN 100 * abs(p - m) / nullif(p + m, 0) END AS dx FROM walk JOIN moves v USING (ticker, i))""",
        *more,
    ]


_SPARSE_SIGNAL = [
    "lines AS MATERIALIZED (SELECT ticker, date, i, macd, CASE WHEN i = 33 THEN avg(macd) OVER (PARTITION BY ticker ORDER BY i ROWS UNBOUNDED PRECEDING) WHEN i > 33 THEN macd END AS x FROM walked)",
    "signal_walk AS (SELECT ticker, i, CAST(NULL AS DOUBLE) AS y, CAST(1 AS DOUBLE) AS w FROM lines WHERE i = 0 UNION ALL"
    " SELECT l.ticker, l.i, CASE WHEN x IS NULL THEN y WHEN y IS NULL THEN x ELSE (w * 0.8 * y + 0.2 * x) / (w * 0.8 + 0.2) END, CASE WHEN x IS NULL THEN w * 0.8 ELSE 1 END"
    " FROM signal_walk s JOIN lines l ON l.ticker = s.ticker AND l.i = s.i + 1)",
]
_SPARSE_ADX = [
    "adx_walk AS (SELECT ticker, i, CAST(0 AS DOUBLE) AS a, CAST(0 AS DOUBLE) AS aw, 0 AS an FROM walked WHERE i = 0 UNION ALL"
    " SELECT w.ticker, w.i, a * 13.0 / 14 + coalesce(w.dx, 0), aw * 13.0 / 14 + CASE WHEN w.dx IS NULL THEN 0 ELSE 1 END, an + CASE WHEN w.dx IS NULL THEN 0 ELSE 1 END"
    " FROM adx_walk JOIN walked w ON w.ticker = adx_walk.ticker AND w.i = adx_walk.i + 1)",
]
_SPARSE_FALL = f"""first_close AS (SELECT ticker, arg_min(close, i) FILTER (WHERE close IS NOT NULL) AS base, min(i) FILTER (WHERE close IS NOT NULL) AS began FROM sparse GROUP BY 1),
  high_so_far AS (SELECT sparse.*, base, max(CASE WHEN i > began THEN close END) OVER (PARTITION BY ticker ORDER BY i ROWS UNBOUNDED PRECEDING) AS top FROM sparse JOIN first_close USING (ticker)),
  fell AS (SELECT *, (close / base - top / base) / (top / base + 1e-10) AS dd FROM high_so_far),
  drawn_sparse AS (SELECT ticker, date, min(dd) {_frame(5)} AS max_drawdown_5d, min(dd) {_frame(20)} AS max_drawdown_20d FROM fell)"""

CHECKED_RECORDS = (
    "records AS (SELECT event_id, value,"
    " CASE event_id % 10 WHEN 1 THEN 'missing ticker' WHEN 2 THEN 'corrupt record' WHEN 4 THEN 'missing close'"
    " WHEN 3 THEN CASE WHEN round(value * 1e7, 4) >= 1e8 THEN 'out of range open' END END AS reason,"
    " CASE WHEN event_id % 10 NOT IN (1, 2) THEN event_type END AS ticker,"
    " CASE WHEN event_id % 10 <> 2 THEN CAST(ts AS DATE) END AS day FROM events)"
)

ORACLE: dict[str, str] = {
    "sparse_ema": sql(_sparse_walk(), select([*KEY, "ema_12", "close_vs_ema12"], "walked"), recursive=True),
    "sparse_macd": sql(
        _sparse_walk(*_SPARSE_SIGNAL),
        f"""SELECT ticker, date, round(macd, {digits_of('macd_12_26_9')}) AS macd_12_26_9, round(CASE WHEN i >= 33 THEN y END, {digits_of('macd_signal_12_26_9')}) AS macd_signal_12_26_9,
            round(macd - CASE WHEN i >= 33 THEN y END, {digits_of('macd_hist_12_26_9')}) AS macd_hist_12_26_9 FROM lines JOIN signal_walk USING (ticker, i)""",
        recursive=True,
    ),
    "sparse_rsi": sql(_sparse_walk(), f"SELECT ticker, date, round(rsi, {digits_of('rsi_14')}) AS rsi_14 FROM walked", recursive=True),
    "sparse_atr": sql(_sparse_walk(), f"SELECT ticker, date, round(atr, {digits_of('atr_14')}) AS atr_14 FROM walked", recursive=True),
    "sparse_adx": sql(
        _sparse_walk(*_SPARSE_ADX), f"SELECT ticker, date, round(CASE WHEN an >= 14 THEN a / nullif(aw, 0) END, {digits_of('adx_14')}) AS adx_14 FROM adx_walk JOIN walked USING (ticker, i)", recursive=True
    ),
    "sparse_drawdown": sql([*_SPARSE, _SPARSE_FALL], select([*KEY, "max_drawdown_5d", "max_drawdown_20d"], "drawn_sparse")),
    "sparse_long_drawdown": sql([*_SPARSE, _SPARSE_FALL], select([*KEY, "max_drawdown_250d"], f"(SELECT ticker, date, min(dd) {_frame(250)} AS max_drawdown_250d FROM fell)")),
    "bars_daily": sql(DAILY, select([*KEY, *_BAR_COLUMNS], "bars")),
    "bars_intraday": sql([INTRA], select([*TKEY, *_BAR_COLUMNS], "ibars")),
    "loaded_daily": sql(
        DAILY,
        select(
            [*KEY, *_BAR_COLUMNS, "is_monday", "is_friday", "days_since_prev_close"],
            f"(SELECT *, {_flag('dayofweek(date) = 1')} AS is_monday, {_flag('dayofweek(date) = 5')} AS is_friday,"
            f" CAST(coalesce(date - {_lag('date')}, 0) AS INT) AS days_since_prev_close FROM nb) WHERE ticker IN ('1-URGENT', '2-HIGH', '5-LOW')",
        ),
    ),
    "loaded_intraday": windows(LOADED, base=[INTRA], key=TKEY),
    "returns": windows(RETURNS),
    "volatility_sharpe": windows(RETURNS, RISK, SHARPE, names=[*RISK, *SHARPE]),
    "max_drawdown": sql([*DAILY, DRAWDOWN], select([*KEY, "max_drawdown_5d", "max_drawdown_20d"], "drawn")),
    "sma_ratios": windows(SMA, SMA_GAP),
    "ema": recurrences(["ema_12", "ema_26", *EMA_GAP]),
    "price_range_position": windows(RANGE),
    "long_range_position": windows(LONG_RANGE),
    "long_drawdown": sql([*DAILY, DRAWDOWN], select([*KEY, "max_drawdown_250d"], f"(SELECT ticker, date, min(dd) {_frame(250)} AS max_drawdown_250d FROM fallen)")),
    "true_range": windows(
        {"true_range": TRUE_RANGE},
        {"avg_true_range_14": _full("avg", "true_range", 14), "tr_percent": "true_range / (close + 1e-10)"},
    ),
    "volume_ratio_flags": windows(
        {n: VOLUME[n] for n in ("volume_sma_5", "volume_sma_20")}, VOLUME_REST, VOLUME_FLAGS
    ),
    "volume_trend": windows({n: VOLUME[n] for n in ("volume_trend_5d", "volume_trend_20d")}),
    "dollar_volume": windows({n: s for n, s in VOLUME.items() if "volume" in n and not n.startswith("volume_") or n.startswith("liq")}),
    "rsi": recurrences(["rsi_14"]),
    "macd": recurrences(["macd_12_26_9", "macd_signal_12_26_9", "macd_hist_12_26_9"]),
    "stochastic": windows(
        {"raw_k": RAW_K},
        {"stoch_k_14_3_3": _full("avg", "raw_k", 3)},
        {"stoch_d_14_3_3": _full("avg", "stoch_k_14_3_3", 3)},
        names=["stoch_k_14_3_3", "stoch_d_14_3_3"],
    ),
    "bollinger": windows(BANDS, BANDS_REST),
    "atr": recurrences(["atr_14", "atr_pct_14", "atr", "atr_pct"]),
    "atr_simple": windows(
        {"tr": f"CASE WHEN i >= 1 THEN {TRUE_RANGE} END"},
        {"atr_14": _full("avg", "tr", 14)},
        {"atr_pct_14": "atr_14 / nullif(close, 0)"},
        names=["atr_14", "atr_pct_14"],
    ),
    "adx": recurrences(["adx_14", "adx"]),
    "ema_seeded": recurrences(["ema_14"]),
    "wma": windows({"sma_14": _full("avg", "close", 14), "wma_14": f"CASE WHEN i >= 13 THEN {WMA} END"}),
    "market_relative": sql(
        [*DAILY, INDEX, _level("r", "nb", {"daily_return": RETURNS["daily_return"]}),
         f"m AS (SELECT *, {_cols(MARKET)} FROM r LEFT JOIN idx USING (date))"],
        select([*KEY, "daily_return", *MARKET_NAMES], "m"),
    ),
    "beta": sql(
        [*DAILY, INDEX, _level("r", "nb", {"daily_return": RETURNS["daily_return"]}),
         "m AS (SELECT *, CASE WHEN daily_return IS NOT NULL AND market_return IS NOT NULL THEN 1 END AS both_known FROM r LEFT JOIN idx USING (date))",
         _level("b", "m", {"beta_20d": f"CASE WHEN count(both_known) {_frame(20)} >= 20 THEN covar_samp(daily_return, market_return) {_frame(20)} / nullif(var_samp(CASE WHEN both_known = 1 THEN market_return END) {_frame(20)}, 0) END"})],
        select([*KEY, "beta_20d"], "b"),
    ),
    "confluence_flags": sql(
        [*DAILY, STEPS, FEATURES, NEWS, NEWS_DAYS, NEWS_ROLLING,
         f"nf AS (SELECT f4.*, sentiment_score_mean, sentiment_trend FROM f4 {_NEWS_JOIN})", _level("fl", "nf", FLAGS | NEWS_FLAGS)],
        select([*KEY, *FLAGS, *NEWS_FLAGS], "fl"), recursive=True,
    ),
    "confluence_scores": sql(
        [*_EVENT_DAILY, *_EVENT_INTRA,
         f"joined AS (SELECT f4.*, {', '.join(_ROLL_NAMES)} FROM f4 LEFT JOIN rolled USING (ticker, date))",
         _level("fl", "joined", FLAGS | NO_NEWS_FLAGS | {"pattern_strength": _STRENGTH}), _level("sc", "fl", _scores("pattern_strength"))],
        select([*KEY, *_ROLL_NAMES, *FLAGS, *NEWS_FLAGS, "pattern_strength", "bullish_confluence_score", "bearish_confluence_score"], "sc"),
        recursive=True,
    ),
    "daily_features": daily(select(DAILY_NAMES, _COMPLETE)),
    "daily_features_with_news": daily(
        select([*KEY, *NEWS_COUNTS, *NEWS_VALUES], f"(SELECT ticker, date, {_cols(_WITH_NEWS)} FROM {_COMPLETE} {_NEWS_JOIN})"),
        [NEWS, NEWS_DAYS, NEWS_ROLLING],
    ),
    "feature_row_counts": daily(f"SELECT ticker, count(*) AS rows FROM {_COMPLETE} GROUP BY 1"),
    "candle_shape": windows(SHAPE | SPREAD, base=[INTRA], key=TKEY),
    "candle_momentum": windows(MOMENTUM, base=[INTRA], key=TKEY),
    "candle_patterns": windows(PATTERNS, base=[INTRA], key=TKEY),
    "session_clock": windows(CLOCK, base=[INTRA], key=TKEY),
    "market_hours": sql([INTRA], select([*TKEY, *_BAR_COLUMNS], f"ibars WHERE {HOURS}")),
    "intraday_volume": windows(VOLUME, VOLUME_REST, VOLUME_FLAGS, base=[INTRA], key=TKEY),
    "neighbor_flags": sql(
        [INTRA], select([*TKEY, *_BOUNDARY], f"(SELECT *, {_cols(_BOUNDARY)} FROM nb) WHERE missing_next_bar = 1 OR missing_previous_bar = 1")
    ),
    "intraday_features": sql(
        _SESSION, select(INTRADAY_NAMES, "v3 WHERE " + " AND ".join(f'"{n}" IS NOT NULL' for n in INTRADAY_NAMES))
    ),
    "intraday_daily_rollup": sql([INTRA, CANDLES, ROLLUP], select([*KEY, *_ROLL_NAMES], "rolled")),
    "daily_gaps": sql(
        DAILY,
        "SELECT ticker, previous_date, current_date_ AS current_date, CAST(current_date_ - previous_date AS INT) AS gap_days FROM"
        " (SELECT ticker, lag(date) OVER (PARTITION BY ticker ORDER BY date) AS previous_date, date AS current_date_ FROM bars) g"
        " WHERE current_date_ - previous_date > 3 AND NOT (current_date_ - previous_date >= 4 AND EXISTS (SELECT 1 FROM"
        " (VALUES (DATE '1995-01-16'), (DATE '1996-07-04'), (DATE '1998-12-25'), (DATE '2000-05-29')) h(d)"
        " WHERE isodow(d) < 6 AND d > previous_date AND d < current_date_))",
    ),
    "intraday_gaps": sql(
        [INTRA, GAPS],
        "SELECT ticker, previous_timestamp, current_timestamp, round(gap_minutes, 6) AS gap_minutes, round(gap_seconds, 6) AS gap_seconds, missing_count,"
        " previous_timestamp + INTERVAL 30 MINUTE AS first_missing, previous_timestamp + missing_count * INTERVAL 30 MINUTE AS last_missing FROM gaps",
    ),
    "missing_timestamps": sql([INTRA, GAPS], "SELECT ticker, timestamp, date FROM missing"),
    "gap_ranges": sql(
        DAILY,
        "SELECT ticker, min(date) AS range_start, max(date) AS range_end, count(*) AS dates FROM (SELECT ticker, date, sum(opens) OVER (PARTITION BY ticker ORDER BY date) AS island FROM"
        " (SELECT ticker, date, CASE WHEN date - lag(date) OVER (PARTITION BY ticker ORDER BY date) <= 2 THEN 0 ELSE 1 END AS opens FROM bars)) GROUP BY ticker, island",
    ),
    "gap_summary": sql(
        [INTRA, GAPS],
        "SELECT g.ticker, gaps, missing_bars, first_missing, last_missing FROM (SELECT ticker, count(*) AS gaps, CAST(sum(missing_count) AS BIGINT) AS missing_bars FROM gaps GROUP BY 1) g"
        " JOIN (SELECT ticker, min(timestamp) AS first_missing, max(timestamp) AS last_missing FROM missing GROUP BY 1) f USING (ticker)",
    ),
    "gap_fill": sql([INTRA, GAPS, FILL], select([*TKEY, *_BAR_COLUMNS], "filled")),
    "gap_fill_stored": sql([INTRA, GAPS, FILL], select([*TKEY, *_BAR_COLUMNS], "(SELECT * FROM ibars UNION ALL BY NAME SELECT * FROM filled)")),
    "gap_fill_remaining": sql(
        [INTRA, GAPS, FILL],
        "SELECT ticker, previous_timestamp, current_timestamp, CAST(ceil(seconds / 1800) AS INT) - 1 AS missing_count FROM (SELECT *, date_diff('microsecond', previous_timestamp, current_timestamp) / 1e6 AS seconds FROM"
        " (SELECT ticker, lag(timestamp) OVER (PARTITION BY ticker ORDER BY timestamp) AS previous_timestamp, timestamp AS current_timestamp FROM"
        " (SELECT ticker, timestamp FROM ibars UNION ALL SELECT ticker, timestamp FROM filled))) WHERE seconds > 2700 AND seconds <> 201900 AND seconds <> 29100",
    ),
    "gap_fill_summary": sql(
        [INTRA, GAPS, FILL,
         "days AS (SELECT DISTINCT ticker, date FROM recent)",
         "islands AS (SELECT ticker, min(date) AS s, max(date) AS e FROM (SELECT *, sum(o) OVER (PARTITION BY ticker ORDER BY date) AS k FROM"
         " (SELECT *, CASE WHEN date - lag(date) OVER (PARTITION BY ticker ORDER BY date) <= 7 THEN 0 ELSE 1 END AS o FROM days)) GROUP BY ticker, k)"],
        "SELECT (SELECT count(*) FROM days) AS dates_processed, (SELECT count(*) FROM filled) AS bars_inserted,"
        " (SELECT count(*) FROM islands i WHERE NOT EXISTS (SELECT 1 FROM landed l WHERE l.ticker = i.ticker AND CAST(l.timestamp AS DATE) BETWEEN i.s AND i.e)) AS errors,"
        " 0 AS skipped_old",
    ),
    "news_daily": sql([NEWS, NEWS_DAYS], select([*KEY, *NEWS_COUNTS[:-1], *NEWS_VALUES[:4]], "nd")),
    "news_rolling": sql([NEWS, NEWS_DAYS, NEWS_ROLLING], select([*KEY, "news_rolling_count", "sentiment_rolling_avg"], "nr")),
    "news_trend": sql([NEWS, NEWS_DAYS, NEWS_ROLLING], select([*KEY, "sentiment_trend"], "nr")),
    "news_attached": sql(
        [*DAILY, NEWS, NEWS_DAYS, NEWS_ROLLING],
        select([*KEY, *NEWS_COUNTS, *NEWS_VALUES], f"(SELECT bars.ticker, bars.date, {_cols(_WITH_NEWS)} FROM bars {_NEWS_JOIN})"),
    ),
    "news_latest": sql(
        [NEWS],
        "SELECT id, ticker, published_at, author, type FROM news WHERE published_at >= TIMESTAMP '1995-02-01' AND published_at <= TIMESTAMP '1995-12-31'",
    ),
    "lexicon_sentiment": sql(
        [NEWS, f"s AS (SELECT id, {_score_text('description', _GOOD, _BAD)} AS x FROM news)"],
        f"SELECT id, round(x, 6) AS sentiment_rule_score, {_label('x')} AS sentiment_rule_label FROM s",
    ),
    "combined_sentiment": sql(
        [NEWS,
         f"s AS (SELECT id, sentiment_score AS v, {_score_text('title || $$. $$ || description', _GOOD, _BAD)} AS x FROM news)",
         "m AS (SELECT *, CASE WHEN v IS NULL THEN x ELSE (x + v) / 2 END AS y FROM s)"],
        f"SELECT id, round(x, 6) AS sentiment_rule_score, round(CAST(v AS DOUBLE), 6) AS sentiment_vendor_score, round(y, 6) AS sentiment_score, {_label('y')} AS sentiment_label FROM m",
    ),
    "landing_bars": "SELECT event_type AS ticker, date_trunc('millisecond', ts) AS timestamp, "
    + ", ".join(f"round(value, {digits_of(n)}) AS {n}" for n in PRICES)
    + ", value AS volume_weighted_avg_price"
    + ", user_id AS volume, CAST(json_extract(props, '$.k') AS BIGINT) AS transactions, CAST(ts AS DATE) AS date FROM events",
    "landing_quarantine": sql(
        [CHECKED_RECORDS],
        "SELECT event_id, reason, ticker, day, CASE WHEN reason IS NULL THEN round(value, " + str(digits_of("close")) + ") END AS close FROM records",
    ),
    "landing_failed_chunks": sql(
        [CHECKED_RECORDS],
        "SELECT ticker, start_date, start_date + 6 AS end_date, count(*) || ' bad records, among them: ' || min(reason) AS error_message FROM"
        " (SELECT *, DATE '2024-01-01' + CAST(7 * ((day - DATE '2024-01-01') // 7) AS INTEGER) AS start_date FROM records"
        " WHERE reason IS NOT NULL AND ticker IS NOT NULL AND day BETWEEN DATE '2024-01-01' AND DATE '2024-02-11')"
        " GROUP BY ticker, start_date",
    ),
    "landing_news": sql(
        [NEWS],
        "SELECT id, ticker, published_at, CASE WHEN type <> 'en' THEN title ELSE '' END AS title, length(description) AS description, '' AS url, author, 'article' AS type,"
        " round(CAST(sentiment_score AS DOUBLE), 6) AS sentiment_score, sentiment_label, author AS sentiment_reasoning,"
        " CASE WHEN type = 'en' THEN ticker ELSE author END AS tickers, CASE WHEN type <> 'en' THEN len(keywords) ELSE 0 END AS keywords"
        " FROM news WHERE sentiment_label IS NOT NULL",
    ),
    "upsert_bars": sql(
        [*DAILY, "batch AS (SELECT * REPLACE (close * 1.01 AS close) FROM bars WHERE date >= DATE '1999-06-01')",
         "merged AS (SELECT * FROM batch UNION ALL SELECT b.* FROM bars b ANTI JOIN batch USING (ticker, date) WHERE b.date < DATE '2000-01-01')"],
        select([*KEY, *_BAR_COLUMNS], "merged"),
    ),
    "upsert_news": sql(
        [NEWS],
        "SELECT id, CASE WHEN old THEN ticker ELSE 'NEW' END AS ticker, published_at, CASE WHEN fresh THEN 'NEW ' || title ELSE title END AS title,"
        " CASE WHEN fresh THEN description || ' (new)' ELSE description END AS description, '' AS url, CASE WHEN old THEN author ELSE 'NEW' END AS author, type,"
        " round(CAST(sentiment_score AS DOUBLE), 6) AS sentiment_score, sentiment_label, CAST(NULL AS VARCHAR) AS sentiment_reasoning,"
        " array_to_string(CASE WHEN fresh THEN list_reverse(keywords) ELSE keywords END, '|') AS keywords,"
        " array_to_string(CASE WHEN fresh THEN list_concat(tickers, ['NEW']) ELSE tickers END, '|') AS tickers FROM"
        " (SELECT *, published_at < TIMESTAMP '1995-03-15' AS old, published_at >= TIMESTAMP '1995-02-15' AS fresh FROM news)",
    ),
    "ledger_latest": sql([LEDGER], "SELECT * FROM latest"),
    "backfill_ranges": sql([LEDGER], "SELECT ticker, start_date, end_date FROM todo WHERE kind = 'daily'"),
    "backfill_plan": sql(
        [LEDGER],
        "SELECT ticker, d AS start_date, least(end_date, d + CASE kind WHEN 'news' THEN 6 ELSE 29 END) AS end_date, kind || '_resume' AS plan FROM"
        " (SELECT *, CAST(unnest(generate_series(start_date, end_date, CASE kind WHEN 'news' THEN INTERVAL 7 DAY ELSE INTERVAL 30 DAY END)) AS DATE) AS d FROM todo)"
        " UNION ALL SELECT ticker, d, least(d + 6, DATE '2001-07-05'), 'news_full' FROM who CROSS JOIN"
        " (SELECT CAST(unnest(generate_series(DATE '2001-06-01', DATE '2001-07-05', INTERVAL 7 DAY)) AS DATE) AS d)",
    ),
    "backfill_table": sql(
        [*DAILY, LEDGER, _APPLIED,
         "merged AS (SELECT * FROM batch UNION ALL SELECT b.* FROM bars b ANTI JOIN batch USING (ticker, date) WHERE b.date < DATE '2000-02-01')"],
        select([*KEY, *_BAR_COLUMNS], "merged"),
    ),
    "backfill_ledger": sql(
        [*DAILY, LEDGER, _APPLIED, "n AS (SELECT ticker, count(*) AS rows FROM batch GROUP BY 1)"],
        "SELECT ticker, 'daily' AS data_type, start_date AS date_range_start, end_date AS date_range_end, end_date AS last_fetch_date,"
        " CASE WHEN ticker <> '5-LOW' THEN end_date END AS last_success_date, CASE WHEN ticker = '5-LOW' THEN 'failed' ELSE 'completed' END AS status,"
        " CASE WHEN ticker = '5-LOW' THEN 'timeout' END AS error_message, CAST(coalesce(rows, 0) AS INT) AS rows_inserted,"
        " TIMESTAMP '2001-08-15 00:00:00' AS updated_at FROM plan LEFT JOIN n USING (ticker)",
    ),
}

_OWN_NAMES = [n for n in DAILY_NAMES if n not in MARKET_NAMES]
ORACLE |= {
    "backfill_stored_table": ORACLE["backfill_table"],
    "backfill_stored_ledger": ORACLE["backfill_ledger"],
    "upsert_news_stored": ORACLE["upsert_news"],
    "backfill_stored_news": sql(
        [NEWS, _NEWS_BATCH], "SELECT id, ticker, published_at, 'NEW ' || title AS title FROM batch UNION ALL"
        " SELECT id, ticker, published_at, title FROM news ANTI JOIN batch USING (id) WHERE published_at < TIMESTAMP '1995-02-20'",
    ),
    "backfill_stored_news_ledger": sql(
        [NEWS, LEDGER, _NEWS_BATCH,
         "chunks AS (SELECT ticker, d, CAST(least(d + 6, DATE '1995-03-14') AS DATE) AS e FROM who CROSS JOIN (SELECT CAST(unnest(generate_series(DATE '1995-02-01', DATE '1995-03-14', INTERVAL 7 DAY)) AS DATE) AS d))"],
        "SELECT ticker, 'news' AS data_type, d AS date_range_start, e AS date_range_end, e AS last_fetch_date, CASE WHEN ticker <> '5-LOW' THEN e END AS last_success_date,"
        " CASE WHEN ticker = '5-LOW' THEN 'failed' ELSE 'completed' END AS status, CASE WHEN ticker = '5-LOW' THEN 'timeout' END AS error_message,"
        " CAST((SELECT count(*) FROM batch b WHERE b.ticker = chunks.ticker AND CAST(b.published_at AS DATE) BETWEEN d AND e) AS INT) AS rows_inserted,"
        " TIMESTAMP '2001-08-15 00:00:00' AS updated_at, 'load-1' AS batch_id FROM chunks",
    ),
    "backfill_stored_intraday": sql(
        [INTRA, "batch AS (SELECT * REPLACE (close + 1 AS close) FROM ibars WHERE CAST(timestamp AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-20' AND ticker <> 'click')",
         "merged AS (SELECT * FROM batch UNION ALL SELECT b.* FROM ibars b ANTI JOIN batch USING (ticker, timestamp) WHERE b.timestamp < TIMESTAMP '2024-01-15')"],
        select([*TKEY, *_BAR_COLUMNS], "merged"),
    ),
    "upsert_intraday": sql(
        [INTRA, "batch AS (SELECT * REPLACE (close + 1 AS close) FROM ibars WHERE day(timestamp) >= 10)",
         "merged AS (SELECT * FROM batch UNION ALL SELECT b.* FROM ibars b ANTI JOIN batch USING (ticker, timestamp) WHERE day(b.timestamp) <= 20)"],
        select([*TKEY, *_BAR_COLUMNS], "merged"),
    ),
    "upsert_stored": sql(
        [*DAILY, "batch AS (SELECT * REPLACE (close * 1.01 AS close) FROM bars WHERE date BETWEEN DATE '1999-11-15' AND DATE '2000-02-15')",
         "merged AS (SELECT * FROM batch UNION ALL SELECT b.* FROM bars b ANTI JOIN batch USING (ticker, date) WHERE b.date < DATE '2000-01-01')"],
        select([*KEY, *_BAR_COLUMNS], "merged"),
    ),
    "news_loaded": sql(
        [NEWS],
        "SELECT ticker, published_at, title, description, '' AS url, author, type, array_to_string(keywords, '|') AS keywords, array_to_string(tickers, '|') AS tickers,"
        " round(CAST(sentiment_score AS DOUBLE), 6) AS sentiment_score, sentiment_label, CAST(NULL AS VARCHAR) AS sentiment_reasoning FROM news",
    ),
    "index_loaded": sql(DAILY, select(["date", "close"], "bars WHERE ticker = '1-URGENT'")),
    "news_blank": sql(
        DAILY, "SELECT ticker, date, " + ", ".join([f"CAST(0 AS BIGINT) AS {c}" for c in NEWS_COUNTS] + [f"CAST(0 AS DOUBLE) AS {c}" for c in NEWS_VALUES]) + " FROM bars"
    ),
    "news_per_ticker": sql(
        [NEWS],
        "SELECT id, ticker, published_at FROM news WHERE published_at >= TIMESTAMP '1995-02-01' AND published_at <= TIMESTAMP '1995-12-31'"
        " QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY published_at, id) <= 3",
    ),
    "daily_own_index": daily(
        select(
            [*KEY, *MARKET_NAMES],
            "(SELECT c.ticker, c.date, o.market_close, o.market_return, c.daily_return - o.market_return AS stock_vs_market_return,"
            f" {_div('c.daily_return', 'o.market_return')} AS relative_return FROM"
            " (SELECT * FROM feat WHERE ticker IN ('1-URGENT', '2-HIGH') AND " + " AND ".join(f'"{n}" IS NOT NULL' for n in _OWN_NAMES) + ") c"
            " LEFT JOIN (SELECT date, close AS market_close, close / lag(close) OVER (ORDER BY date) - 1 AS market_return FROM bars WHERE ticker = '3-MEDIUM') o USING (date))",
        )
    ),
    "intraday_with_landed": sql(
        [_bars("ibars"), GAPS, FILL, "mbars AS (SELECT * FROM ibars UNION ALL SELECT f.* FROM filled f ANTI JOIN ibars USING (ticker, timestamp))", numbered("mbars", "timestamp"), *_SESSION[1:]],
        select(INTRADAY_NAMES, "v3 WHERE " + " AND ".join(f'"{n}" IS NOT NULL' for n in INTRADAY_NAMES)),
    ),
}

# Read back, an export is what was written.
for _kind, _same in (("daily", "daily_own_index"), ("intraday", "intraday_with_landed"), ("news", "news_loaded")):
    ORACLE[f"export_{_kind}"] = ORACLE[_same]
ORACLE["saved_rows"] = " UNION ALL ".join(
    f"SELECT '{kind}' AS kind, count(*) AS saved_rows FROM ({ORACLE[query]})" for kind, query in (("daily", "export_daily"), ("intraday", "intraday_features"))
)
