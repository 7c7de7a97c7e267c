"""Two forecasters made of plain aggregates. They share the contract of the fitted models, run at
any size, and give the evaluation half exact expected values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions.numeric import normal_quantiles
from panelcast.operators.forecast.common import over_validation_days, prediction_columns
from panelcast.schema import PANEL, QUANTILES, Panel


def window_stats(train: DataFrame, panel: Panel = PANEL) -> DataFrame:
    """Exact quantiles, mean and sample deviation of each training window: one row per fold and series. A group holds
    one training window, so the exact percentile keeps at most that many values.

    Written once and given to both forecasters below, it has the training rows read and grouped once for them."""
    levels = F.array(*[F.lit(v) for v in QUANTILES.values()])
    return train.groupBy("fold_id", *panel.keys).agg(
        F.percentile(panel.value, levels).alias("_q"),
        F.avg(panel.value).alias("_mean"),
        F.stddev_samp(panel.value).alias("_sd"),
    )


def empirical_quantiles(
    train: DataFrame, folds: DataFrame, panel: Panel = PANEL, stats: DataFrame | None = None
) -> DataFrame:
    """Exact quantiles of the training window, repeated over the validation days. ``stats``: the ``window_stats`` of
    ``train``, if they are at hand; here only the columns in use are computed."""
    stats = window_stats(train, panel) if stats is None else stats
    cols = {q: F.col("_q")[i] for i, q in enumerate(QUANTILES)}
    return prediction_columns(over_validation_days(stats, folds, panel), cols, panel)


def normal_forecast(
    train: DataFrame, folds: DataFrame, panel: Panel = PANEL, stats: DataFrame | None = None
) -> DataFrame:
    """Mean and sample deviation of the training window as normal quantiles, clipped at zero; ``stats`` as above."""
    stats = window_stats(train, panel) if stats is None else stats
    cols = normal_quantiles(F.col("_mean"), F.col("_sd"))
    return prediction_columns(over_validation_days(stats, folds, panel), cols, panel)
