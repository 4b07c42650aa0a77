"""Decimals to which doubles are compared, by column.

Sums of prices reach 1e9, so a value is rounded where the order of additions no
longer shows. Means of cents over 5 to 200 rows end within six decimals.
"""

from __future__ import annotations

import re

_RULES = (
    # From exact sums, so equal to the last bit.
    (r"volume_weighted|market_close", None),
    (r"liquidity_", -3),
    (r"avg_dollar_volume_|price_volume", 4),
    (r"sma_14$", 4),
    (r"sma_\d+$|volume_sma_", 6),
    (r"ema_\d+$|macd_|atr_\d+$|atr$|bb_(lower|upper)|wma_", 3),
    (r"avg_true_range_|true_range|volume_trend_|price_change$|relative_return", 4),
    (r"open$|high$|low$|close$", 4),
    (r"rsi|stoch|adx|sharpe|beta|bb_|sentiment|avg_title|avg_desc|gap_|_sin$|_cos$", 6),
)


def digits_of(name: str) -> int | None:
    """Digits of a column; None leaves it as it is."""
    return next((digits for pattern, digits in _RULES if re.match(pattern, name)), 8)
