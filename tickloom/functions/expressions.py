"""Small column helpers with the null rules used throughout.

A missing value is SQL NULL everywhere; NaN and infinity are never produced.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: keeps a denominator away from zero in the published formulas.
EPSILON = 1e-10


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def divide(numerator: Column, denominator: Column) -> Column:
    """Double division; null when the denominator is zero or either side is null."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def guarded(denominator: str) -> str:
    """SQL of a denominator kept away from zero."""
    return f"({denominator} + {EPSILON!r}D)"


def ratio(numerator: str, denominator: str) -> str:
    """SQL of :func:`divide`."""
    return f"try_divide(CAST({numerator} AS DOUBLE), CAST({denominator} AS DOUBLE))"


def require_columns(df: DataFrame, names: Iterable[str], user: str) -> None:
    """Fail at plan time when the input lacks a column."""
    absent = sorted(set(names) - set(df.columns))
    if absent:
        raise ValueError(f"{user} needs columns {absent}; input has {df.columns}")


def q(name: str) -> Column:
    """Column by name, also when the name holds a dot."""
    return F.col(f"`{name}`")


def column_or(df: DataFrame, name: str, default) -> Column:
    """The column when the frame has it, else the default as a literal."""
    return q(name) if name in df.columns else F.lit(default)


def first_with_prefix(df: DataFrame, prefix: str) -> str | None:
    """First column whose name starts with the prefix."""
    return next((name for name in df.columns if name.startswith(prefix)), None)


def complete_rows(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Rows without a missing value in the columns, by default in all; also right for names that hold a dot."""
    return df.filter(" and ".join(f"`{name}` is not null" for name in columns or df.columns))
