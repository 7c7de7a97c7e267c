"""Per-series windows. Frames end the day before: only the past is visible.

Features are described as two sets of columns: those read straight from the panel and those read
from the first set. ``add_columns`` puts any number of features into two window passes behind one
shuffle and one sort, however many lags and rolling statistics are asked for.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.schema import PANEL, Panel


def series_window(panel: Panel = PANEL):
    return Window.partitionBy(*panel.keys).orderBy(panel.date)


def before(panel: Panel = PANEL):
    """All earlier rows of the series."""
    return series_window(panel).rowsBetween(Window.unboundedPreceding, -1)


@dataclass
class Columns:
    """``base`` columns are windows over the panel's own columns, ``derived`` columns may use the
    base ones. Base names that start with an underscore are dropped at the end."""

    base: dict[str, Column] = field(default_factory=dict)
    derived: dict[str, Column] = field(default_factory=dict)

    def __or__(self, other: Columns) -> Columns:
        return Columns(self.base | other.base, self.derived | other.derived)


def add_columns(df: DataFrame, columns: Columns) -> DataFrame:
    out = df.withColumns(columns.base) if columns.base else df
    out = out.withColumns(columns.derived) if columns.derived else out
    return out.drop(*[n for n in columns.base if n.startswith("_")])


def lags(column: str, steps: dict[str, int], panel: Panel = PANEL) -> Columns:
    w = series_window(panel)
    return Columns({name: F.lag(column, n).over(w) for name, n in steps.items()})


def _running(name: str, term: Column, panel: Panel) -> dict[str, Column]:
    return {f"_run_{name}": F.coalesce(F.sum(term).over(before(panel)), F.lit(0))}


def _last(name: str, n: int, panel: Panel) -> Column:
    """Sum over the ``n`` rows before the current one, as a difference of running totals.

    Spark evaluates a sliding frame by visiting the whole frame for every row. A running total
    costs one step per row whatever the frame length, and on integers it is exact."""
    run = f"_run_{name}"
    return F.col(run) - F.lag(run, n, 0).over(series_window(panel))


def _mean(total: Column, count: Column) -> Column:
    return F.when(count > 0, total / count)


def _sample_sd(total: Column, squares: Column, count: Column) -> Column:
    """Sample deviation from integer sums: the numerator n*Sxx - Sx^2 is exact."""
    top = count * squares - total * total
    return F.when(count > 1, F.sqrt(top / (count * (count - 1))))


def rolling(
    value: str, integral: bool, means=(7, 28), stds=(28,), zero_shares=(28,), panel: Panel = PANEL
) -> Columns:
    """roll_mean_n, roll_std_n and pct_zeros_nd over the n rows before the current one."""
    v = F.col(value)
    if not integral:
        w = series_window(panel)
        zero = (v == 0).cast("double")
        return Columns(
            {f"roll_mean_{n}": F.avg(v).over(w.rowsBetween(-n, -1)) for n in means}
            | {f"roll_std_{n}": F.stddev_samp(v).over(w.rowsBetween(-n, -1)) for n in stds}
            | {f"pct_zeros_{n}d": F.avg(zero).over(w.rowsBetween(-n, -1)) for n in zero_shares}
        )
    x = v.cast("long")
    base: dict[str, Column] = {}
    if means or stds:
        base |= _running("n", v.isNotNull().cast("long"), panel) | _running("s", x, panel)
    if stds:
        base |= _running("ss", x * x, panel)
    if zero_shares:
        base |= _running("rows", F.lit(1).cast("long"), panel)
        base |= _running("z", F.coalesce((v == 0).cast("long"), F.lit(0)), panel)
    last = lambda name, n: _last(name, n, panel)
    return Columns(
        base,
        {f"roll_mean_{n}": _mean(last("s", n), last("n", n)) for n in means}
        | {f"roll_std_{n}": _sample_sd(last("s", n), last("ss", n), last("n", n)) for n in stds}
        | {f"pct_zeros_{n}d": _mean(last("z", n), last("rows", n)) for n in zero_shares},
    )


def days_since_last_sale(value: str = "sales", panel: Panel = PANEL) -> Columns:
    sold = F.when(F.col(value) > 0, F.col(panel.date))
    return Columns(
        {"_last_sale": F.max(sold).over(before(panel))},
        {"days_since_last_sale": F.datediff(panel.date, F.col("_last_sale"))},
    )


def moving_average(
    column: str, rows: int, out: str, decimals: int | None = None, panel: Panel = PANEL
) -> Columns:
    """Mean of the known values among the ``rows`` rows before the current one.

    With ``decimals`` the values are exact multiples of 10^-decimals (prices in cents) and are
    averaged through integer running totals; without it a sliding frame is used."""
    v = F.col(column)
    if decimals is None:
        return Columns({out: F.avg(v).over(series_window(panel).rowsBetween(-rows, -1))})
    scale = 10**decimals
    units = F.round(v * F.lit(scale)).cast("long")
    total, count = _last(f"{column}_s", rows, panel), _last(f"{column}_n", rows, panel)
    return Columns(
        _running(f"{column}_s", units, panel)
        | _running(f"{column}_n", v.isNotNull().cast("long"), panel),
        {out: F.when(count > 0, total / (count * F.lit(scale)))},
    )


def add_lags(df: DataFrame, steps=(7, 14, 28, 182), panel: Panel = PANEL) -> DataFrame:
    return add_columns(df, lags(panel.value, {f"lag_{n}": n for n in steps}, panel))


def is_integral(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.IntegralType)


def add_rolling(df: DataFrame, panel: Panel = PANEL, **frames) -> DataFrame:
    return add_columns(
        df, rolling(panel.value, is_integral(df, panel.value), panel=panel, **frames)
    )


def add_days_since_last_sale(df: DataFrame, panel: Panel = PANEL) -> DataFrame:
    return add_columns(df, days_since_last_sale(panel.value, panel))


def add_moving_average(
    df: DataFrame, column: str, rows: int, out: str, panel: Panel = PANEL, decimals: int | None = None
) -> DataFrame:
    return add_columns(df, moving_average(column, rows, out, decimals, panel))


def add_event_distance(calendar: DataFrame, is_event: Column, date: str = "date") -> DataFrame:
    """Days to the next and from the last event, the current day excluded.

    Runs on the calendar itself (one row per day, the same for all series), so the window
    without partition keys covers a few thousand rows however large the panel is. The
    look-ahead is a growing frame over the reversed order: an UNBOUNDED FOLLOWING frame is
    recomputed for every row.
    """
    marker = F.when(is_event, F.col(date))
    past = Window.orderBy(date).rowsBetween(Window.unboundedPreceding, -1)
    future = Window.orderBy(F.col(date).desc()).rowsBetween(Window.unboundedPreceding, -1)
    return calendar.withColumns(
        {
            "days_to_next_event": F.datediff(F.min(marker).over(future), date),
            "days_from_last_event": F.datediff(date, F.max(marker).over(past)),
        }
    )


def add_row_number(df: DataFrame, out: str = "rn", panel: Panel = PANEL) -> DataFrame:
    return df.withColumn(out, F.row_number().over(series_window(panel)))
