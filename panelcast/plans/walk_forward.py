"""Walk-forward validation of any forecaster, all folds in one job, and its fold-wise storage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.operators.folds import split_folds
from panelcast.operators.forecast.arima import arima_predictions, fit_arima, training_arrays
from panelcast.operators.forecast.boost import (
    BoostParams,
    fit_quantile_boost,
    predict_quantile_boost,
)
from panelcast.operators.forecast.decomposed import decomposed_predictions, fit_decomposed
from panelcast.schema import PANEL, PREDICTIONS, Panel
from panelcast.session import checkpoint
from panelcast.sources.writers import conform

Forecaster = Callable[[DataFrame, DataFrame], DataFrame]


def walk_forward(
    panel_rows: DataFrame,
    folds: DataFrame,
    forecaster: Forecaster,
    panel: Panel = PANEL,
    fold_id: int | None = None,
) -> DataFrame:
    """Predictions of ``forecaster`` for every fold (or one).

    ``forecaster(train, folds)`` receives the training rows tagged with fold_id, so a per-series
    model sees all folds in a single grouped job rather than one job per fold."""
    train = split_folds(panel_rows, folds, panel, fold_id, roles=("train",))
    return conform(forecaster(train, folds), PREDICTIONS)


def arima_forecaster(panel: Panel = PANEL, **orders) -> Forecaster:
    def run(train: DataFrame, folds: DataFrame) -> DataFrame:
        # written once: a filter on the fit, pushed below it, would have every series fitted twice
        fits = checkpoint(fit_arima(training_arrays(train, panel), **orders), "arima-fits")
        return arima_predictions(fits, folds, panel)

    return run


def decomposed_forecaster(calendar: DataFrame, panel: Panel = PANEL) -> Forecaster:
    def run(train: DataFrame, folds: DataFrame) -> DataFrame:
        fits = checkpoint(fit_decomposed(train, calendar, panel), "decomposed-fits")
        return decomposed_predictions(fits, folds, calendar, panel)

    return run


def boost_walk_forward(
    features: DataFrame, folds: DataFrame, params: BoostParams = BoostParams(), panel: Panel = PANEL
) -> DataFrame:
    """The global model: one fit of its own for each fold, all of them grown in the same passes. The tagged
    features are written once and read by the fit and by the forecast."""
    tagged = checkpoint(split_folds(features, folds, panel), "fold-features")
    model = fit_quantile_boost(tagged.where(F.col("role") == "train"), panel, params)
    return conform(predict_quantile_boost(model, tagged.where(F.col("role") == "val"), panel), PREDICTIONS)
