"""Ordered per-key panels cut into slices of bounded size.

A window over ``partitionBy(ticker)`` puts a whole ticker in one task, so a
ticker that holds a third of the rows becomes a third of the job. A panel keeps
the same results with bounded tasks:

1. every row gets its position in its key's order. Positions come from row
   numbers inside calendar buckets plus the counts of the earlier buckets, so no
   task sees more than one bucket of rows;
2. rows are regrouped by ``(key, position // slice_rows)``. The last ``halo``
   rows of a slice are also sent to the next one, which makes every frame of up
   to ``halo`` preceding rows complete inside its slice;
3. values that depend on all earlier rows (exponential averages, running
   maxima) are scanned inside the slice and joined to the state that the slice
   before hands over. Only one row per slice takes part in that second step.

Every table is laid out this way, whatever its size; only the number of slices
follows the data. Rows with a null key form one group, and rows with a null
order value come first in their key.

The order column must be unique within a key, as it is in the bar tables.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET, OFFSET, INDEX, TOTAL, SLICE = "_bucket", "_offset", "_index", "_total", "_slice"
_INTERNAL = (INDEX, TOTAL, SLICE)

# From this many rows on, an extreme over a frame is taken from two running ones.
LONG_EXTREME = 64

# Columns of Panel.with_running, and which of them guards a frame over an input.
BAR_HOLE, VOLUME_HOLE, SUM_SO_FAR, MEAN_SO_FAR = "_bar_hole", "_volume_hole", "_close_sum", "_close_mean"
HOLE_OF = dict.fromkeys(("high", "low", "close", "true_range"), BAR_HOLE) | {"volume": VOLUME_HOLE}

DEFAULT_SLICE_ROWS = 2048
# Rows at the start of a slice whose own inputs may miss a lag of one row.
_LEAD = 1
# Bucket of the rows without a time: before all others.
_NO_BUCKET = -(2**62)
# exp(650) is representable with room for the data; exp(-745) is zero.
_EXPONENT_LIMIT = 650.0
_UNDERFLOW = 745.0
# Slices whose factors' log lies within one multiple of this are added up together.
_GROUP_LOG = 300.0


def _calendar_bucket(df: DataFrame, order: str) -> Column:
    """Bucket that holds at most a few thousand bars of one key: 1,024 days of
    daily bars, or seven days of intraday bars."""
    if isinstance(df.schema[order].dataType, T.DateType):
        return F.floor(F.unix_date(F.col(order)) / 1024)
    return F.floor(F.unix_seconds(F.col(order).cast("timestamp")) / (7 * 86400))


def group_columns(key: tuple[str, ...]) -> tuple[str, ...]:
    """Columns that stand for the key inside a panel."""
    return tuple(f"_key_{k}" for k in range(len(key)))


def with_groups(df: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Add the key as text that is never null, the null key being a value of its own. Windows and joins can then use plain
    equality on the same columns, so a join keeps the partitioning and the order that the window before it needed."""
    return df.selectExpr("*", *[f"coalesce(concat('=', CAST(`{c}` AS STRING)), '') AS {g}" for c, g in zip(key, group_columns(key))])


def _positions(grouped: DataFrame, group: tuple[str, ...], order: str) -> DataFrame:
    bucketed = grouped.withColumn(BUCKET, F.coalesce(_calendar_bucket(grouped, order), F.lit(_NO_BUCKET)))
    counts = bucketed.groupBy(*group, BUCKET).agg(F.count(F.lit(1)).alias("_rows"))
    whole = f"PARTITION BY {', '.join(group)}"
    before = f"{whole} ORDER BY {BUCKET} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    offsets = counts.selectExpr(
        *group, BUCKET, f"coalesce(sum(_rows) OVER ({before}), 0) AS {OFFSET}", f"sum(_rows) OVER ({whole}) AS {TOTAL}"
    )
    inside = f"PARTITION BY {', '.join(group)}, {BUCKET} ORDER BY `{order}`"
    ranked = bucketed.selectExpr("*", f"row_number() OVER ({inside}) AS _rank")
    return ranked.join(offsets, [*group, BUCKET]).selectExpr(f"* EXCEPT ({BUCKET}, {OFFSET}, _rank)", f"{OFFSET} + _rank - 1 AS {INDEX}")


def with_positions(df: DataFrame, key: tuple[str, ...], order: str) -> DataFrame:
    """Add the 0-based position of each row in its key and the key's row count."""
    group = group_columns(key)
    return _positions(with_groups(df, key), group, order).drop(*group)


def _fitting_slice_rows(wanted: int, halo: int, decays: tuple[float, ...], seed_rows: int = 0) -> int:
    # The copies lent to the second slice must not hold the rows that seed a scan.
    least = max(halo + seed_rows, 2)
    rows = wanted
    while rows < least:
        rows *= 2
    steepest = max((-math.log(d) for d in decays if d > 0), default=0.0)
    while steepest * (rows + halo) > _EXPONENT_LIMIT:
        rows //= 2
        if rows < least:
            raise ValueError(
                f"decay {min(d for d in decays if d > 0)} is too strong for a lookback of {halo} rows; "
                "compute the short average and the long window in separate panels"
            )
    return rows


@dataclass(frozen=True)
class Affine:
    """y[i] = decay * y[i-1] + term[i], y before the first row being 0.

    Inside a slice the sum of ``term / decay**place`` is a plain running sum; the
    slice length keeps the powers within double range.
    """

    name: str
    decay: float
    term: str

    def local(self, live: str, place: str, seen: str) -> str:
        term = f"CASE WHEN {live} THEN {self.term} END"
        if self.decay == 0:
            return term
        return (
            f"coalesce(sum({term} * power({self.decay!r}D, -({place}))) OVER ({seen}), 0D)"
            f" * power({self.decay!r}D, {place})"
        )

    def weights(self, rows: int) -> list[float]:
        """Weights of the end states of the previous slices in the state at the
        start of a slice. They are powers of decay**rows and underflow to zero
        after a few slices, so the list is short and the sum over it complete."""
        if self.decay == 0:
            return []
        step = -math.log(self.decay) * rows
        return [math.exp(-step * m) for m in range(int(_UNDERFLOW / step) + 1)]

    def handed_over(self, state: str, by_slice: str, rows: int) -> str:
        parts = [
            f"coalesce({f'lag({state}, {m}) OVER ({by_slice})' if m else state}, 0D) * {weight!r}D"
            for m, weight in enumerate(self.weights(rows))
        ]
        return " + ".join(parts) or "0D"

    def combine(self, own: str, handed: str, place: str) -> str:
        if self.decay == 0:
            return own
        return f"{own} + coalesce({handed}, 0D) * power({self.decay!r}D, {place} + 1)"


@dataclass(frozen=True)
class RunningMax:
    """Largest value so far in the key."""

    name: str
    value: str

    def local(self, live: str, place: str, seen: str) -> str:
        return f"max(CASE WHEN {live} THEN {self.value} END) OVER ({seen})"

    def handed_over(self, state: str, by_slice: str, rows: int) -> str:
        return f"max({state}) OVER ({by_slice} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"

    def combine(self, own: str, handed: str, place: str) -> str:
        return f"greatest({own}, {handed})"


@dataclass(frozen=True)
class LastKnown:
    """Latest non-null value so far in the key."""

    name: str
    value: str

    def local(self, live: str, place: str, seen: str) -> str:
        return f"last(CASE WHEN {live} THEN {self.value} END, true) OVER ({seen})"

    def handed_over(self, state: str, by_slice: str, rows: int) -> str:
        return f"last({state}, true) OVER ({by_slice} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"

    def combine(self, own: str, handed: str, place: str) -> str:
        return f"coalesce({own}, {handed})"


@dataclass(frozen=True)
class FirstKnown:
    """Earliest non-null value in the key, known from its row on."""

    name: str
    value: str

    def local(self, live: str, place: str, seen: str) -> str:
        return f"first(CASE WHEN {live} THEN {self.value} END, true) OVER ({seen})"

    def handed_over(self, state: str, by_slice: str, rows: int) -> str:
        return f"first({state}, true) OVER ({by_slice} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"

    def combine(self, own: str, handed: str, place: str) -> str:
        return f"coalesce({handed}, {own})"


@dataclass(frozen=True)
class RunningCount:
    """Number of non-null values so far in the key."""

    name: str
    value: str

    def local(self, live: str, place: str, seen: str) -> str:
        return f"count(CASE WHEN {live} THEN {self.value} END) OVER ({seen})"

    def handed_over(self, state: str, by_slice: str, rows: int) -> str:
        return f"sum({state}) OVER ({by_slice} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"

    def combine(self, own: str, handed: str, place: str) -> str:
        return f"{own} + coalesce({handed}, 0)"


@dataclass(frozen=True)
class Ewm:
    """Exponential average of the known values, a missing value leaving the average as it is.

    A known value after k rows makes ``y = (f * y + alpha * value) / (f + alpha)`` with ``f = (1 - alpha)**k``: rows without
    a value make the past weigh less once, and each known value sets its weight back to one. So the factor
    differs from row to row: logs of the factors are added up, in a slice and over the slices of a key. Averages of one
    ``source`` have the same values and share what only depends on them.
    """

    name: str
    span: int
    value: str
    source: str

    @property
    def alpha(self) -> float:
        return 2.0 / (self.span + 1.0)

    @property
    def _rate(self) -> float:
        return -math.log1p(-self.alpha)

    def _cost(self, rows: str) -> str:
        """Log of what a known value leaves of the past, ``rows`` after the value before it, negative. Written so that no gap overflows."""
        z = f"({self._rate!r}D * ({rows}))"
        return f"-(CASE WHEN {z} > 600 THEN {z} + {math.log(self.alpha)!r}D ELSE ln(1 + {self.alpha!r}D * exp({z})) END)"

    def own_levels(self, live: str, seen: str, before: str) -> list[dict[str, str]]:
        own, shared = f"_own_{self.name}", f"_own_{self.source}"
        known = f"{live} AND ({self.value}) IS NOT NULL"
        cost = self._cost(f"{INDEX} - {shared}_before")
        follows = f"{known} AND {shared}_before IS NOT NULL"
        return [
            {
                f"{shared}_before": f"last(CASE WHEN {known} THEN {INDEX} END, true) OVER ({before})",
                f"{shared}_last": f"last(CASE WHEN {known} THEN {INDEX} END, true) OVER ({seen})",
                f"{shared}_at": f"first(CASE WHEN {known} THEN {INDEX} END, true) OVER ({seen})",
                f"{shared}_first": f"first(CASE WHEN {known} THEN CAST({self.value} AS DOUBLE) END, true) OVER ({seen})",
            },
            {f"{own}_log": f"sum(CASE WHEN {follows} THEN {cost} ELSE 0D END) OVER ({seen})"},
            {
                f"{own}_sum": f"coalesce(sum(CASE WHEN {follows} THEN (1 - exp({cost})) * ({self.value}) * exp(-{own}_log) END) OVER ({seen}), 0D) * exp({own}_log)"
            },
        ]

    @property
    def own_names(self) -> list[str]:
        return [f"_own_{self.source}_{part}" for part in ("before", "last", "at", "first")] + [f"_own_{self.name}_{part}" for part in ("log", "sum")]

    def edge_levels(self, key: str, by_slice: str) -> list[dict[str, str]]:
        """States at the slices' ends. The product of all factors underflows, so slices are grouped by the size of its log:
        a value is needed from its own group and the two before it, whatever is older weighs nothing."""
        own, out = f"_own_{self.name}", f"_in_{self.name}"
        shared, came = f"_own_{self.source}", f"_in_{self.source}"
        so_far = f"({by_slice} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        earlier = f"({by_slice} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
        gap = self._cost(f"{shared}_at - {came}_known")
        starts = f"{came}_known IS NULL"
        scaled = f"{out}_plus * exp(-({out}_log + {_GROUP_LOG} * {out}_group))"

        def of_group(back: int) -> str:
            return f"coalesce(sum({scaled}) OVER (PARTITION BY {key} ORDER BY {out}_group RANGE BETWEEN {back} PRECEDING AND {back} PRECEDING), 0D)"

        return [
            {f"{came}_known": f"last({shared}_last, true) OVER {earlier}", f"{came}_last": f"last({shared}_last, true) OVER {so_far}"},
            {
                f"{out}_factor": f"CASE WHEN {shared}_at IS NULL THEN 0D WHEN {starts} THEN {own}_log ELSE {own}_log + {gap} END",
                f"{out}_plus": f"CASE WHEN {shared}_at IS NULL THEN 0D ELSE exp({own}_log) * (CASE WHEN {starts} THEN 1D ELSE 1 - exp({gap}) END) * {shared}_first + {own}_sum END",
            },
            {f"{out}_log": f"sum({out}_factor) OVER {so_far}"},
            {f"{out}_group": f"CAST(floor(-{out}_log / {_GROUP_LOG}) AS BIGINT)"},
            {
                f"{out}_inside": f"sum({scaled}) OVER (PARTITION BY {key}, {out}_group ORDER BY {SLICE} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)",
                f"{out}_older": " + ".join(f"{of_group(back)} * {math.exp(-_GROUP_LOG * back)!r}D" for back in (1, 2)),
            },
            {
                f"{out}": f"CASE WHEN {came}_last IS NOT NULL THEN exp({out}_log + {_GROUP_LOG} * {out}_group) * ({out}_inside + {out}_older) END",
            },
        ]

    @property
    def in_names(self) -> list[str]:
        return [f"_in_{self.name}", f"_in_{self.source}_last"]

    def combined(self) -> str:
        own, handed, shared, came = (f"_{side}_{name}" for name in (self.name, self.source) for side in ("own", "in"))
        kept = f"exp({self._cost(f'{shared}_at - {came}_last')})"
        first = f"CASE WHEN {came}_last IS NULL THEN {shared}_first ELSE {kept} * {handed} + (1 - {kept}) * {shared}_first END"
        return f"CASE WHEN {shared}_at IS NULL THEN {handed} ELSE exp({own}_log) * ({first}) + {own}_sum END"


Step = Affine | RunningMax | LastKnown | FirstKnown | RunningCount | Ewm


def _own_levels(step: Step, live: str, place: str, seen: str, before: str) -> list[dict[str, str]]:
    if isinstance(step, Ewm):
        return step.own_levels(live, seen, before)
    return [{f"_own_{step.name}": step.local(live, place, seen)}]


def _own_names(step: Step) -> list[str]:
    return step.own_names if isinstance(step, Ewm) else [f"_own_{step.name}"]


def _edge_levels(step: Step, key: str, by_slice: str, rows: int) -> list[dict[str, str]]:
    if isinstance(step, Ewm):
        return step.edge_levels(key, by_slice)
    return [{f"_in_{step.name}": step.handed_over(f"_own_{step.name}", by_slice, rows)}]


def _in_names(step: Step) -> list[str]:
    return step.in_names if isinstance(step, Ewm) else [f"_in_{step.name}"]


def _with_levels(df: DataFrame, steps: list[list[dict[str, str]]]) -> DataFrame:
    """Add the columns of all steps, level by level."""
    for level in range(max(map(len, steps))):
        added = {name: sql for levels in steps if level < len(levels) for name, sql in levels[level].items()}
        df = df.selectExpr("*", *[f"{sql} AS `{name}`" for name, sql in added.items()])
    return df


@dataclass(frozen=True)
class Panel:
    """Rows grouped so that the window expressions below are right on every row
    that ``close`` returns. Expressions are SQL text; columns and the results of
    earlier ``add`` calls may be used in them. ``key`` are the :func:`group_columns`."""

    df: DataFrame
    key: tuple[str, ...]
    rows: int
    halo: int

    # -- windows ---------------------------------------------------------------
    @property
    def window(self) -> str:
        """Partition and order of the panel, for an OVER clause."""
        return f"PARTITION BY {', '.join(self.key)}, {SLICE} ORDER BY {INDEX}"

    def frame(self, n: int) -> str:
        """The row and the n-1 rows before it."""
        if n > self.halo + 1:
            raise ValueError(f"frame of {n} rows needs a panel with lookback >= {n - 1}")
        return f"{self.window} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW"

    @property
    def _counter(self) -> str:
        """Row counter that stays small inside the panel's group."""
        return f"({INDEX} - {SLICE} * {self.rows})"

    @property
    def so_far(self) -> str:
        """The rows of the panel's group up to this one."""
        return f"{self.window} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"

    def lag(self, value: str, n: int = 1) -> str:
        return f"lag({value}, {n}) OVER ({self.window})"

    def full(self, n: int, result: str, *inputs: str) -> str:
        """The result only once the frame holds n rows with all inputs known.

        For prices and volume that is read from the distance to the last missing
        value, for anything else it is counted in the frame.
        """
        tests = []
        for name in inputs:
            hole = HOLE_OF.get(name)
            tests.append(
                f"{INDEX} - {hole} >= {n}" if hole else f"count({name}) OVER ({self.frame(n)}) >= {n}"
            )
        return f"CASE WHEN {' AND '.join(dict.fromkeys(tests))} THEN {result} END"

    def rolling(self, function: str, value: str, n: int) -> str:
        """Aggregate over a full frame."""
        return self.full(n, f"{function}({value}) OVER ({self.frame(n)})", value)

    def mean(self, value: str, n: int) -> str:
        return self.rolling("avg", value, n)

    def whole_number_slope(self, value: str, n: int) -> str:
        """Least-squares slope per row of a column of whole numbers, from exact
        sums, so that a flat series has slope 0 and not a rounding error. A frame
        of one row has slope 0."""
        if n < 2:
            return self.full(n, "0D", value)
        place = self._counter
        products = f"sum(CAST({value} AS DOUBLE) * {place}) OVER ({self.frame(n)})"
        total = f"sum(CAST({value} AS DOUBLE)) OVER ({self.frame(n)})"
        # Sum of y * (x - mean x) with x counted from the middle of the frame, doubled.
        doubled = f"(2 * {products} - (2 * {place} - {n - 1}) * {total})"
        return self.full(n, f"{doubled} / {n * (n * n - 1) / 6!r}D", value)

    def long_mean(self, n: int) -> str:
        """Mean close over a full frame of any length at the cost of one row.

        A sliding frame is evaluated anew for every row, which is wasteful for
        long ones; this takes the difference of two running sums.
        """
        total = f"{SUM_SO_FAR} - coalesce({self.lag(SUM_SO_FAR, n)}, 0D)"
        return self.full(n, f"({total}) / {n}", "close")

    def extreme_parts(self, name: str, value: str, n: int) -> dict[str, str]:
        """Columns from which :meth:`long_extreme` takes the largest value of any n rows, whatever n.

        Rows are cut into blocks of n, so a frame of n rows is the end of one block and the start of the next. The largest value
        since the start of the block and the one up to its end are running maxima of (block, value): later blocks
        exceed earlier ones, and in descending order the other way round. For the smallest value take that of the negated one.
        """
        block = f"floor({INDEX} / {n})"
        backwards = f"{self.window} DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
        return {
            f"{name}_to_end": f"(max(struct(-{block} AS block, {value} AS value)) OVER ({backwards})).value",
            f"{name}_from_start": f"(max(struct({block} AS block, {value} AS value)) OVER ({self.so_far})).value",
        }

    def long_extreme(self, name: str, n: int) -> str:
        """Largest known value of the row and the n-1 rows before it, of those there are; a stage after :meth:`extreme_parts`."""
        if n > self.halo + 1:
            raise ValueError(f"frame of {n} rows needs a panel with lookback >= {n - 1}")
        return f"greatest({self.lag(f'{name}_to_end', n - 1)}, {name}_from_start)"

    def with_running(self) -> Panel:
        """Add what the helpers above read: the position of the last missing price
        and volume, and the running sum and mean of the close."""
        have = set(self.df.columns)
        columns = {}
        prices = [name for name in ("high", "low", "close") if name in have]
        if prices:
            missing = f"CASE WHEN {' + '.join(prices)} IS NULL THEN {INDEX} END"
            columns[BAR_HOLE] = f"coalesce(last({missing}, true) OVER ({self.so_far}), -1)"
        if "close" in have:
            columns[SUM_SO_FAR] = f"sum(CAST(close AS DOUBLE)) OVER ({self.so_far})"
            columns[MEAN_SO_FAR] = f"avg(close) OVER ({self.so_far})"
        if "volume" in have:
            missing = f"CASE WHEN volume IS NULL THEN {INDEX} END"
            columns[VOLUME_HOLE] = f"coalesce(last({missing}, true) OVER ({self.so_far}), -1)"
        return self.add(columns)

    # -- row positions ---------------------------------------------------------
    position = INDEX
    is_first = f"{INDEX} = 0"
    later_slice = f"{SLICE} > 0"
    is_last = f"{INDEX} = {TOTAL} - 1"

    # -- building --------------------------------------------------------------
    def add(self, columns: dict[str, str]) -> Panel:
        """Add columns; names already present stay as they are. An expression that
        several columns share is computed once."""
        have = set(self.df.columns)
        fresh = {name: sql for name, sql in columns.items() if name not in have}
        if not fresh:
            return self
        owner: dict[str, str] = {}
        for name, sql in fresh.items():
            owner.setdefault(sql, name)
        df = self.df.selectExpr("*", *[f"{sql} AS `{name}`" for sql, name in owner.items()])
        shared = [f"`{owner[sql]}` AS `{name}`" for name, sql in fresh.items() if owner[sql] != name]
        return replace(self, df=df.selectExpr("*", *shared) if shared else df)

    def scan(self, *steps: Step) -> Panel:
        """Add one column per step, each a value that depends on all earlier rows."""
        if not steps:
            return self
        start = f"CASE WHEN {SLICE} = 0 THEN 0 ELSE {SLICE} * {self.rows} - {self.halo - _LEAD} END"
        placed = self.df.selectExpr("*", f"{INDEX} - {start} AS _place")
        before = f"{self.window} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
        own = _with_levels(placed, [_own_levels(s, "_place >= 0", "_place", self.so_far, before) for s in steps])
        own_names = list(dict.fromkeys(n for s in steps for n in _own_names(s)))
        in_names = list(dict.fromkeys(n for s in steps for n in _in_names(s)))
        # The row just before the next slice's first live row, in its home slice.
        edge = f"({INDEX} + {1 + self.halo - _LEAD}) % {self.rows} = 0 AND {self._at_home}"
        edges = own.filter(edge).selectExpr(*self.key, f"{SLICE} + 1 AS {SLICE}", *own_names)
        key = ", ".join(self.key)
        by_slice = f"PARTITION BY {key} ORDER BY {SLICE}"
        handed = _with_levels(edges, [_edge_levels(s, key, by_slice, self.rows) for s in steps]).select(*self.key, SLICE, *in_names)
        joined = own.join(handed, [*self.key, SLICE], "left")
        values = [
            f"CASE WHEN _place >= 0 THEN {s.combined() if isinstance(s, Ewm) else s.combine(f'_own_{s.name}', f'_in_{s.name}', '_place')} END AS {s.name}"
            for s in steps
        ]
        return replace(self, df=joined.selectExpr("*", *values).drop("_place", *own_names, *in_names))

    @property
    def _at_home(self) -> str:
        return f"floor({INDEX} / {self.rows}) = {SLICE}"

    def close(self) -> DataFrame:
        """The rows themselves, without the copies lent to neighbouring slices."""
        return self.df.filter(self._at_home).drop(*_INTERNAL, *self.key)


def open_panel(
    df: DataFrame,
    key: tuple[str, ...] = ("ticker",),
    order: str = "date",
    lookback: int = 1,
    decays: tuple[float, ...] = (),
    slice_rows: int = DEFAULT_SLICE_ROWS,
    seed_rows: int = 0,
) -> Panel:
    """Group a table for ordered work per key.

    ``lookback`` is the number of preceding rows the deepest chain of lags and
    frames reaches; ``decays`` are the factors of the recurrences to be scanned;
    ``seed_rows`` is how many first rows of a key seed them.
    """
    key, decays = tuple(key), tuple(decays)
    halo = lookback + _LEAD
    rows = _fitting_slice_rows(slice_rows, halo, decays, seed_rows)
    home = f"floor({INDEX} / {rows})"
    lent = f"{INDEX} >= ({home} + 1) * {rows} - {halo} AND ({home} + 1) * {rows} < {TOTAL}"
    sliced = _positions(with_groups(df, key), group_columns(key), order).selectExpr(
        "*", f"explode(CASE WHEN {lent} THEN array({home}, {home} + 1) ELSE array({home}) END) AS {SLICE}"
    )
    return Panel(sliced, group_columns(key), rows, halo)


def ema_decay(span: int) -> float:
    """Factor of an exponential average with the given span."""
    return 1.0 - 2.0 / (span + 1.0)


def wilder_decay(length: int) -> float:
    """Factor of Wilder's average of the given length."""
    return 1.0 - 1.0 / length


class Block:
    """Columns that belong together, in the stages a panel computes them.

    A stage may use the bars and everything of the stages before it. Stages keep
    the number of passes over the rows small: blocks that run together share them.
    """

    lookback: int = 1
    decays: tuple[float, ...] = ()
    seed_rows: int = 0

    def first(self, panel: Panel) -> dict[str, str]:
        """Window expressions over the bars."""
        return {}

    def scans(self, panel: Panel) -> list[Step]:
        """Values that depend on all earlier rows."""
        return []

    def second(self, panel: Panel) -> dict[str, str]:
        """Window expressions over the first stage and the scans."""
        return {}

    def late_scans(self, panel: Panel) -> list[Step]:
        """Scans over the second stage."""
        return []

    def third(self, panel: Panel) -> dict[str, str]:
        """Window expressions over the second stage."""
        return {}

    def rows(self) -> list[dict[str, str]]:
        """Row-wise expressions, in levels."""
        return []

    def columns(self) -> list[str]:
        """Names of the result, in output order."""
        raise NotImplementedError


def _fits(blocks: Sequence[Block], slice_rows: int) -> bool:
    try:
        _fitting_slice_rows(
            slice_rows,
            max(b.lookback for b in blocks) + _LEAD,
            tuple(d for b in blocks for d in b.decays),
            max(b.seed_rows for b in blocks),
        )
    except ValueError:
        return False
    return True


def run_blocks(
    df: DataFrame, *blocks: Block, order: str = "date", slice_rows: int = DEFAULT_SLICE_ROWS
) -> DataFrame:
    """Add the columns of all blocks in one pass over the ordered rows.

    A short exponential average and a window of many hundred rows don't fit into
    the same slices; then the blocks with recurrences get a panel of their own.
    """
    names = dict.fromkeys([*df.columns, *[c for b in blocks for c in b.columns()]])
    groups = [blocks]
    if not _fits(blocks, slice_rows):
        groups = [tuple(b for b in blocks if b.decays), tuple(b for b in blocks if not b.decays)]
    for group in filter(None, groups):
        df = _run_together(df, group, order, slice_rows)
    return df.select(*[f"`{name}`" for name in names])


def _run_together(df: DataFrame, blocks: Sequence[Block], order: str, slice_rows: int) -> DataFrame:
    panel = open_panel(
        df,
        order=order,
        lookback=max(b.lookback for b in blocks),
        decays=tuple(d for b in blocks for d in b.decays),
        slice_rows=slice_rows,
        seed_rows=max(b.seed_rows for b in blocks),
    )

    def merged(parts: list[dict[str, str]]) -> dict[str, str]:
        # The first block wins on a shared name.
        out: dict[str, str] = {}
        for part in parts:
            out = part | out
        return {name: out[name] for part in parts for name in part}

    panel = panel.with_running()
    panel = panel.add(merged([b.first(panel) for b in blocks]))
    panel = panel.scan(*[s for b in blocks for s in b.scans(panel)])
    panel = panel.add(merged([b.second(panel) for b in blocks]))
    panel = panel.scan(*[s for b in blocks for s in b.late_scans(panel)])
    panel = panel.add(merged([b.third(panel) for b in blocks]))
    for level in range(max(len(b.rows()) for b in blocks)):
        panel = panel.add(merged([b.rows()[level] for b in blocks if level < len(b.rows())]))
    names = dict.fromkeys([*df.columns, *[c for b in blocks for c in b.columns()]])
    return panel.close().select(*[f"`{name}`" for name in names])
