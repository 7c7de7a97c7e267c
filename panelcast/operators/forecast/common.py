"""Shared steps of the forecasters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.functions.numeric import missing
from panelcast.schema import PANEL, QUANTILE_NAMES, Panel


def over_validation_days(per_series: DataFrame, folds: DataFrame, panel: Panel = PANEL) -> DataFrame:
    """Repeat each (fold, series) row for every validation day; ``step`` counts from 1."""
    days = folds.select("fold_id", F.sequence("val_start", "val_end").alias("_days"))
    return (
        per_series.join(days, "fold_id")
        .select(*per_series.columns, F.posexplode("_days").alias("step", panel.date))
        .withColumn("step", F.col("step") + 1)
    )


def prediction_columns(df: DataFrame, quantiles: dict[str, Column], panel: Panel = PANEL) -> DataFrame:
    return df.select(
        *panel.grain, *[quantiles[q].cast("double").alias(q) for q in QUANTILE_NAMES], "fold_id"
    )


def forecast_metadata(
    predictions: DataFrame, segments: DataFrame, panel: Panel = PANEL, by_fold: bool = True
) -> DataFrame:
    """One row per series (and fold): segment, zero rate, and whether the uncertainty failed.

    NULL and NaN both count as failed: a forecast that passed through a client comes back with
    NULL where the engine produced NaN."""
    group = [*panel.keys, *(["fold_id"] if by_fold else [])]
    flags = predictions.groupBy(*group).agg(
        F.max(missing(F.col("p05"))).alias("fallo_incertidumbre")
    )
    info = segments.select(*panel.keys, "categoria_zero_rate", "tasa_ceros")
    return flags.join(info, list(panel.keys), "left").select(
        *group, "categoria_zero_rate", "tasa_ceros", "fallo_incertidumbre"
    )
