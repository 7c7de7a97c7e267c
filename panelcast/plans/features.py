"""The feature table: one row per series and day, nothing visible but the past and the calendar."""

from __future__ import annotations

from datetime import date as Date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions.calendar import date_parts, days_since, event_flags, fourier, prefix_switch
from panelcast.functions.numeric import tri_state_changed
from panelcast.operators.relational import attach_weekly_price
from panelcast.operators.windows import (
    add_columns,
    add_event_distance,
    days_since_last_sale,
    is_integral,
    lags,
    moving_average,
    rolling,
)
from panelcast.schema import PANEL, Panel

# Sales lags in days.
SALES_LAGS = (7, 14, 28, 182)


def calendar_features(
    calendar: DataFrame, epoch: Date, week: str = "wm_yr_wk", flags: list[str] | None = None
) -> DataFrame:
    """Everything that depends on the date alone, computed once per day instead of once per
    series and day: event flags and distances, date parts, day index, Fourier terms."""
    d = F.col("date")
    named = F.col("event_name_1").isNotNull() | F.col("event_name_2").isNotNull()
    index = days_since(d, epoch)
    return add_event_distance(calendar, named).select(
        "date",
        week,
        *(flags or []),
        *[
            c.alias(n)
            for n, c in event_flags(
                d, F.col("event_name_1"), F.col("event_name_2"), F.col("event_type_1")
            ).items()
        ],
        "days_to_next_event",
        "days_from_last_event",
        *[c.alias(n) for n, c in date_parts(d).items()],
        index.alias("days_since_start"),
        *[c.alias(n) for n, c in fourier(index.cast("double")).items()],
    )


def build_features(
    sales: DataFrame,
    calendar: DataFrame,
    prices: DataFrame,
    epoch: Date,
    state_flags: dict[str, str],
    panel: Panel = PANEL,
    week: str = "wm_yr_wk",
) -> DataFrame:
    """Sales + calendar + weekly price + temporal, Fourier and price features.

    The panel is shuffled once, on the series key, and sorted once: the price join and the two
    window passes reuse that partitioning. ``sales`` is taken as dense (see ``densify``); on a
    panel with gaps the row offsets would not be day offsets. ``state_flags``: store prefix ->
    calendar flag column.
    """
    flags = list(dict.fromkeys(state_flags.values()))
    days = calendar_features(calendar, epoch, week, flags).withColumnRenamed("date", panel.date)
    by_series = attach_weekly_price(
        sales.join(days.select(panel.date, week), panel.date, "left"), prices, week, panel
    )
    windows = (
        lags(panel.value, {f"lag_{n}": n for n in SALES_LAGS}, panel)
        | rolling(panel.value, is_integral(sales, panel.value), panel=panel)
        | days_since_last_sale(panel.value, panel)
        | lags("sell_price", {"prev_price": 1, "lag_price_28": 28}, panel)
        | moving_average("sell_price", 365, "price_mean", decimals=2, panel=panel)
    )
    staged = add_columns(by_series, windows)
    price, old = F.col("sell_price"), F.col("lag_price_28")
    full = staged.join(days.drop(week), panel.date, "left")
    parts = [*date_parts(F.lit(None).cast("date"))]
    waves = [*fourier(F.lit(0.0))]
    return full.select(
        *panel.grain,
        panel.value,
        "is_event",
        "is_christmas",
        "event_type",
        "days_to_next_event",
        "days_from_last_event",
        prefix_switch(F.col(panel.keys[1]), {p: F.col(c) for p, c in state_flags.items()}).alias(
            "snap_active"
        ),
        "sell_price",
        *[f"lag_{n}" for n in SALES_LAGS],
        "roll_mean_7",
        "roll_mean_28",
        "roll_std_28",
        *parts,
        "days_since_start",
        "days_since_last_sale",
        "pct_zeros_28d",
        *waves,
        F.try_divide(price, F.col("price_mean")).alias("price_rel_mean"),
        F.try_divide(price - old, old).alias("price_momentum_4w"),
        "lag_price_28",
        tri_state_changed(price, F.col("prev_price")).alias("price_changed"),
    )
