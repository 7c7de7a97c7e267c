"""Names, quantile levels and table schemas shared by all operators."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Panel:
    """Column roles of a long panel: one row per ``keys`` and ``date``.

    The one-row-per-day grain is what keeps every per-series window bounded: a
    series can never hold more rows than the calendar has days, whatever share
    of the raw records it owned before aggregation.
    """

    keys: tuple[str, ...] = ("item_id", "store_id")
    date: str = "date"
    value: str = "sales"

    @property
    def grain(self) -> list[str]:
        return [*self.keys, self.date]


PANEL = Panel()

# Quantile levels and the matching standard normal scores.
QUANTILES = {"p05": 0.05, "p25": 0.25, "p50": 0.50, "p75": 0.75, "p95": 0.95}
Z_SCORES = {
    "p05": -1.6448536269514722,
    "p25": -0.6744897501960817,
    "p50": 0.0,
    "p75": 0.6744897501960817,
    "p95": 1.6448536269514722,
}
QUANTILE_NAMES = list(QUANTILES)

# Walk-forward layout, thresholds and report labels.
TRAIN_DAYS = 365
VAL_DAYS = 28
N_FOLDS = 5
UNSTABLE_THRESHOLD = 1000.0
DEGENERATE_VARIANCE = 1e-6
NEW_PRODUCT_DAYS = 90
PARTIAL_YEAR_DAYS = 300
ZERO_RATE_LABELS = ["rapido", "medio", "lento", "muy_lento"]
ZERO_RATE_CUTS = [0.20, 0.50, 0.80]
RELEASE_LABELS = ["sin_release_date", "antes_de_release", "nuevo_lt_90d", "establecido"]
EVENT_LABELS = ["navidad", "evento", "sin_evento"]
MODEL_ORDER = ["arima", "bqml", "lgbm"]
WEEKDAY_ORDER = ["Saturday", "Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday"]
CATEGORICAL_FEATURES = [
    "day_of_week",
    "day_of_month",
    "month",
    "week_of_year",
    "event_type",
    "is_event",
    "is_christmas",
    "snap_active",
    "price_changed",
]
SENTINEL_FEATURES = ["price_changed", "snap_active"]
SENTINEL = -1

SALES_LONG = T.StructType(
    [
        T.StructField("item_id", T.StringType()),
        T.StructField("store_id", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("sales", T.LongType()),
    ]
)

SELL_PRICES = T.StructType(
    [
        T.StructField("store_id", T.StringType()),
        T.StructField("item_id", T.StringType()),
        T.StructField("wm_yr_wk", T.LongType()),
        T.StructField("sell_price", T.DoubleType()),
    ]
)

FOLDS = T.StructType(
    [
        T.StructField("fold_id", T.IntegerType()),
        T.StructField("train_start", T.DateType()),
        T.StructField("train_end", T.DateType()),
        T.StructField("val_start", T.DateType()),
        T.StructField("val_end", T.DateType()),
    ]
)

PREDICTIONS = T.StructType(
    [
        T.StructField("item_id", T.StringType()),
        T.StructField("store_id", T.StringType()),
        T.StructField("date", T.DateType()),
        *[T.StructField(q, T.DoubleType()) for q in QUANTILE_NAMES],
        T.StructField("fold_id", T.IntegerType()),
    ]
)

ARIMA_METADATA = T.StructType(
    [
        T.StructField("item_id", T.StringType()),
        T.StructField("store_id", T.StringType()),
        T.StructField("fold_id", T.IntegerType()),
        T.StructField("categoria_zero_rate", T.StringType()),
        T.StructField("p", T.IntegerType()),
        T.StructField("d", T.IntegerType()),
        T.StructField("q", T.IntegerType()),
        T.StructField("aic", T.DoubleType()),
        T.StructField("convergio", T.BooleanType()),
        T.StructField("razon_fallo", T.StringType()),
    ]
)

UNCERTAINTY_METADATA = T.StructType(
    [
        T.StructField("item_id", T.StringType()),
        T.StructField("store_id", T.StringType()),
        T.StructField("fold_id", T.IntegerType()),
        T.StructField("categoria_zero_rate", T.StringType()),
        T.StructField("tasa_ceros", T.DoubleType()),
        T.StructField("fallo_incertidumbre", T.BooleanType()),
    ]
)
