"""Clock columns of a trading session, from a UTC timestamp."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import TimeFeatureConfig
from .expressions import flag

CLOCK_COLUMNS = (
    "hour",
    "minute",
    "day_of_week",
    "is_opening_window",
    "is_closing_window",
    "is_lunch_hour",
    "hour_sin",
    "hour_cos",
    "minute_sin",
    "minute_cos",
    "is_morning",
    "is_afternoon",
    "is_first_hour",
    "is_last_hour",
)


def local_time(timestamp: Column, cfg: TimeFeatureConfig) -> Column:
    """Wall-clock time of the session for an instant stored in UTC."""
    return F.from_utc_timestamp(timestamp, cfg.session_timezone)


def minute_of_day(local: Column) -> Column:
    return F.hour(local) * 60 + F.minute(local)


def in_market_hours(local: Column, cfg: TimeFeatureConfig) -> Column:
    """Opening minute included, closing minute excluded."""
    return _within(minute_of_day(local), cfg.open_minute_of_day, cfg.close_minute_of_day)


def _within(value: Column, start: int, end: int) -> Column:
    return (value >= start) & (value < end)


def _cycle(value: Column, period: float) -> tuple[Column, Column]:
    angle = value.cast("double") * (2 * math.pi) / period
    return F.sin(angle), F.cos(angle)


def clock_columns(local: Column, cfg: TimeFeatureConfig) -> dict[str, Column]:
    """Expressions of the clock columns, by name, for a local wall-clock time."""
    hour, minute, of_day = F.hour(local), F.minute(local), minute_of_day(local)
    opening, closing = cfg.open_minute_of_day, cfg.close_minute_of_day
    hour_sin, hour_cos = _cycle(hour, 24.0)
    minute_sin, minute_cos = _cycle(minute, 60.0)
    return {
        "hour": hour,
        "minute": minute,
        "day_of_week": F.weekday(local),
        "is_opening_window": flag(_within(of_day, opening, opening + cfg.opening_window_minutes)),
        "is_closing_window": flag(_within(of_day, max(closing - cfg.closing_window_minutes, 0), closing)),
        "is_lunch_hour": flag(_within(hour, *cfg.lunch_hours)),
        "hour_sin": hour_sin,
        "hour_cos": hour_cos,
        "minute_sin": minute_sin,
        "minute_cos": minute_cos,
        "is_morning": flag(_within(hour, *cfg.morning_hours)),
        "is_afternoon": flag(_within(hour, *cfg.afternoon_hours)),
        "is_first_hour": flag(hour == cfg.market_open_hour),
        "is_last_hour": flag(hour == cfg.market_close_hour - 1),
    }
