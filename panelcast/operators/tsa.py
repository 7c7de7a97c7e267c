"""Trend removal, autocorrelation and the choice of the training window, for all series at once."""

from __future__ import annotations

from datetime import date as Date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.operators.windows import series_window
from panelcast.schema import PANEL, Panel

# Lags reported by the window study.
KEY_LAGS = (7, 14, 28, 91, 182, 365, 546, 730)


def whole_series(panel: Panel = PANEL):
    """All rows of the series, in the order every other per-series window uses: a statistic of the
    whole series joins their pass over the data instead of being aggregated and joined back."""
    return series_window(panel).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def _day_index(origin: Date, panel: Panel):
    return F.datediff(panel.date, F.lit(origin)).cast("double")


def detrend(df: DataFrame, origin: Date, panel: Panel = PANEL, out: str = "residual") -> DataFrame:
    """Value minus its series' least-squares line, in one window pass."""
    x, y = _day_index(origin, panel), F.col(panel.value).cast("double")
    w = whole_series(panel)
    lined = df.withColumns(
        {"_slope": F.regr_slope(y, x).over(w), "_intercept": F.regr_intercept(y, x).over(w)}
    )
    return lined.withColumn(out, y - (F.col("_intercept") + F.col("_slope") * x)).drop(
        "_slope", "_intercept"
    )


def acf(
    df: DataFrame, lags=KEY_LAGS, panel: Panel = PANEL, value: str | None = None
) -> DataFrame:
    """(keys, lag, acf): sum((x_t-m)(x_{t+k}-m)) / sum((x_t-m)^2), m the full mean.

    On a dense panel the lagged value is a row offset, so every lag is one more column of the
    same window pass: no self join and no row multiplication."""
    v = F.col(value or panel.value).cast("double")
    w = series_window(panel)
    centred = df.select(*panel.grain, (v - F.avg(v).over(whole_series(panel))).alias("_c"))
    shifted = centred.select(
        *panel.keys, "_c", *[F.lag("_c", k).over(w).alias(f"_l{k}") for k in lags]
    )
    # a series shorter than the lag has no products: its sum is 0, as in the closed formula
    sums = shifted.groupBy(*panel.keys).agg(
        F.sum(F.col("_c") * F.col("_c")).alias("_ss"),
        *[
            F.coalesce(F.sum(F.col("_c") * F.col(f"_l{k}")), F.lit(0.0)).alias(f"_p{k}")
            for k in lags
        ],
    )
    entries = F.array(
        *[
            F.struct(F.lit(k).alias("lag"), F.try_divide(F.col(f"_p{k}"), F.col("_ss")).alias("acf"))
            for k in lags
        ]
    )
    return sums.select(*panel.keys, F.inline(entries))


def acf_curve(
    df: DataFrame, max_lag: int = 800, panel: Panel = PANEL, value: str | None = None, block_days: int = 128
) -> DataFrame:
    """The same estimator for every lag 0..max_lag that the series has pairs for; NULL for a level series.

    Days are cut into blocks, and a block meets only those that begin within ``max_lag`` of its end: an equi-join on series and
    block, whose pairs are summed by lag before they leave their task. One long series is thus spread
    over as many tasks as it has blocks."""
    keys = list(panel.keys)
    v = F.col(value or panel.value).cast("double")
    means = df.groupBy(*keys).agg(F.avg(v).alias("_m"))
    day = F.datediff(panel.date, F.lit("1970-01-01").cast("date"))
    centred = df.join(means, keys).select(*keys, day.alias("_t"), (v - F.col("_m")).alias("_c"))
    block = F.floor(F.col("_t") / block_days)
    reach = -(-max_lag // block_days)
    early = centred.select(*keys, F.explode(F.sequence(block, block + reach)).alias("_block"), "_t", "_c")
    late = centred.select(*keys, block.alias("_block"), F.col("_t").alias("_u"), F.col("_c").alias("_d"))
    pairs = early.join(late, [*keys, "_block"]).where((F.col("_u") >= F.col("_t")) & (F.col("_u") <= F.col("_t") + max_lag))
    sums = pairs.groupBy(*keys, (F.col("_u") - F.col("_t")).alias("lag")).agg(F.sum(F.col("_c") * F.col("_d")).alias("_s"))
    squares = sums.where("lag = 0").select(*keys, F.col("_s").alias("_ss"))
    return sums.join(squares, keys).select(*keys, "lag", F.try_divide("_s", "_ss").alias("acf"))


def choose_window(
    correlations: DataFrame,
    panel: Panel = PANEL,
    short: int = 365,
    long: int = 730,
    keep: float = 0.5,
) -> DataFrame:
    """365 or 730 training days per series, from its detrended correlations.

    The long window is chosen only when an annual echo exists and two years back still carry
    at least ``keep`` of it; otherwise older history adds noise."""
    at = lambda k: F.max(F.when(F.col("lag") == k, F.col("acf")))
    both = correlations.groupBy(*panel.keys).agg(at(short).alias("acf_short"), at(long).alias("acf_long"))
    far = (F.col("acf_short") > 0) & (F.col("acf_long") >= F.lit(keep) * F.col("acf_short"))
    return both.withColumn("window_size", F.when(far, F.lit(long)).otherwise(F.lit(short)))
