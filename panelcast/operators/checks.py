"""Data-quality checks. Each returns rows, so results can be stored and compared."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions.calendar import prefix_switch
from panelcast.functions.numeric import missing
from panelcast.operators.windows import series_window
from panelcast.schema import PANEL, QUANTILE_NAMES, Panel


def check_counts(predictions: DataFrame, days: int, panel: Panel = PANEL) -> DataFrame:
    """Rows, series and days of a prediction table; ok when rows = series x days."""
    per_series = predictions.groupBy(*panel.keys).agg(F.count(F.lit(1)).alias("n"))
    n_days = predictions.select(panel.date).distinct().agg(F.count(F.lit(1))).scalar()
    return per_series.agg(
        F.sum("n").alias("filas"), F.count(F.lit(1)).alias("series"),
    ).select(
        "filas", "series", n_days.alias("dias"),
        (F.col("filas") == F.col("series") * F.lit(days)).alias("ok"),
    )


def has_nan(names=tuple(QUANTILE_NAMES)) -> Column:
    out = F.lit(False)
    for q in names:
        out = out | F.coalesce(F.isnan(F.col(q)), F.lit(False))
    return out


def crossed(names=tuple(QUANTILE_NAMES)) -> Column:
    """Some neighbouring quantiles are out of order; only meaningful without NaN."""
    out = F.lit(False)
    for low, high in zip(names, names[1:]):
        out = out | F.coalesce(F.col(low) > F.col(high), F.lit(False))
    return out


def check_monotone(predictions: DataFrame) -> DataFrame:
    """Real crossings and rows with NaN apart: every comparison with NaN is false, so a plain
    NOT (p05 <= p25 ...) reports NaN rows as crossings."""
    return predictions.agg(
        F.count(F.lit(1)).alias("filas"),
        F.count_if(~has_nan() & crossed()).alias("violaciones_monotonicidad"),
        F.count_if(has_nan()).alias("filas_nan"),
    )


def monotone_violations(predictions: DataFrame, n: int = 20, panel: Panel = PANEL) -> DataFrame:
    """The first n rows that fail the plain ordering test, NaN rows included, to look at."""
    return (
        predictions.where(has_nan() | crossed())
        .select(*panel.grain, "fold_id", *QUANTILE_NAMES, (F.col("p95") - F.col("p50")).alias("diferencia_p95_p50"))
        .orderBy(*panel.grain, "fold_id")
        .limit(n)
    )


def check_negative(predictions: DataFrame) -> DataFrame:
    negative = F.lit(False)
    for q in QUANTILE_NAMES:
        negative = negative | F.coalesce(F.col(q) < 0, F.lit(False))
    return predictions.agg(F.count_if(negative).alias("valores_negativos"))


def check_nan(predictions: DataFrame, panel: Panel = PANEL) -> DataFrame:
    """Series and rows without uncertainty, NULL and NaN counted apart."""
    per_series = predictions.groupBy(*panel.keys).agg(
        F.count_if(F.isnan("p05")).alias("nan"), F.count_if(F.col("p05").isNull()).alias("null")
    )
    return per_series.agg(
        F.count_if(F.col("nan") > 0).alias("series_afectadas"),
        F.sum("nan").alias("filas_afectadas"),
        F.sum("null").alias("filas_null"),
    )


def nan_series(predictions: DataFrame, segments: DataFrame, panel: Panel = PANEL) -> DataFrame:
    """Segment facts of the series without uncertainty, highest zero rate first."""
    affected = predictions.where(missing(F.col("p05"))).select(*panel.keys)
    return segments.join(affected, list(panel.keys), "left_semi").orderBy(
        F.desc("tasa_ceros"), *panel.keys
    )


def check_leakage(
    features: DataFrame, sales: DataFrame, panel: Panel = PANEL, tolerance: float = 1e-9
) -> DataFrame:
    """Recompute lag_7 and roll_mean_28 by date arithmetic for every row of every series and
    count disagreements.

    The day index orders a RANGE frame, so the expected values depend on dates and not on row
    positions, and the check needs one shuffle instead of a join of each day with its past."""
    day = F.unix_date(F.col(panel.date))
    w = Window.partitionBy(*panel.keys).orderBy("_day")
    expected = sales.select(*panel.grain, F.col(panel.value), day.alias("_day")).select(
        *panel.grain,
        F.max(panel.value).over(w.rangeBetween(-7, -7)).alias("manual_lag_7"),
        F.avg(panel.value).over(w.rangeBetween(-28, -1)).alias("manual_roll_mean_28"),
    )
    joined = features.select(*panel.grain, "lag_7", "roll_mean_28").join(expected, panel.grain)
    near = F.abs(F.col("manual_roll_mean_28") - F.col("roll_mean_28")) < tolerance
    both_null = F.col("manual_roll_mean_28").isNull() & F.col("roll_mean_28").isNull()
    return joined.agg(
        F.count(F.lit(1)).alias("filas"),
        F.count_if(~F.col("manual_lag_7").eqNullSafe(F.col("lag_7"))).alias("lag_7_mismatches"),
        F.count_if(~F.coalesce(near | both_null, F.lit(False))).alias("roll_mean_28_mismatches"),
    )


def leakage_sample(
    features: DataFrame, sales: DataFrame, ranks=(100, 500, 1000), panel: Panel = PANEL
) -> DataFrame:
    """The same comparison shown for given day numbers of each store's best-selling series."""
    item, store = panel.keys
    totals = sales.groupBy(store, item).agg(F.sum(panel.value).alias("t"))
    best = totals.groupBy(store).agg(
        F.min_by(item, F.struct((-F.col("t")).alias("t"), F.col(item).alias("i"))).alias(item)
    )
    series = sales.join(best, [item, store], "left_semi")
    days = series.withColumn("day_index", F.row_number().over(series_window(panel))).where(
        F.col("day_index").isin(*ranks)
    ).select(item, store, F.col(panel.date).alias("check_date"), "day_index")
    past = F.datediff("check_date", panel.date)
    manual = (
        days.join(series, [item, store])
        .where(past.between(1, 28))
        .groupBy(item, store, "check_date", "day_index")
        .agg(
            F.max(F.when(past == 7, F.col(panel.value))).alias("manual_lag_7"),
            F.avg(panel.value).alias("manual_roll_mean_28"),
        )
    )
    table = features.select(
        item, store, F.col(panel.date).alias("check_date"), "lag_7", "roll_mean_28"
    )
    return manual.join(table, [item, store, "check_date"]).select(
        item, store, "check_date", "day_index", "manual_lag_7", "lag_7",
        (F.col("manual_lag_7") == F.col("lag_7")).alias("lag_7_matches"),
        F.round("manual_roll_mean_28", 6).alias("manual_roll_mean_28"),
        F.round("roll_mean_28", 6).alias("roll_mean_28"),
        (F.abs(F.col("manual_roll_mean_28") - F.col("roll_mean_28")) < 1e-9).alias("roll_mean_28_matches"),
    )


def check_state_switch(
    features: DataFrame, calendar: DataFrame, flags: dict[str, str], panel: Panel = PANEL
) -> DataFrame:
    """Per store prefix: rows on days where the state flags differ, and rows whose snap_active is
    not the flag of the row's own state. ``flags``: store prefix -> calendar column."""
    store = F.col(panel.keys[1])
    columns = list(flags.values())
    contrast = F.lit(False)
    for c in columns[1:]:
        contrast = contrast | (F.col(columns[0]) != F.col(c))
    days = calendar.where(contrast).select(F.col("date").alias(panel.date), *columns)
    expected = prefix_switch(store, {p: F.col(c) for p, c in flags.items()})
    prefix = prefix_switch(store, {p: F.lit(p) for p in flags})
    return (
        features.select(*panel.grain, "snap_active")
        .join(days, panel.date)
        .groupBy(prefix.alias("state"))
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(~F.col("snap_active").eqNullSafe(expected)).alias("mismatches"),
        )
    )


def check_rolling_vs_expanding(features: DataFrame, panel: Panel = PANEL, warm_up: int = 400) -> DataFrame:
    """For every series, at its first priced day after the warm-up and at its last priced day:
    the table's price ratio, the ratio to a 365-day mean taken by date, and the ratio to the mean
    of all earlier prices. The first two must agree, the third shows that they are not the same.

    Checked days meet their series' history in an equi-join on the series; each series has at
    most two of them."""
    keys = list(panel.keys)
    priced = features.where(F.col("sell_price").isNotNull()).select(
        *panel.grain, "sell_price", "price_rel_mean"
    )
    first = F.min(panel.date).over(Window.partitionBy(*keys))
    ranked = priced.withColumn("_first", first)
    ends = ranked.groupBy(*keys).agg(
        F.min(F.when(F.col(panel.date) >= F.date_add("_first", warm_up), F.col(panel.date))).alias("early"),
        F.max(panel.date).alias("late"),
    )
    days = ends.where(F.col("early").isNotNull()).select(
        *keys, F.explode(F.array_distinct(F.array("early", "late"))).alias("check_date")
    )
    gap = F.datediff("check_date", panel.date)
    history = (
        days.join(priced.select(*panel.grain, "sell_price"), keys)
        .where(gap >= 1)
        .groupBy(*keys, "check_date")
        .agg(
            F.avg(F.when(gap <= 365, F.col("sell_price"))).alias("manual_moving_avg_365"),
            F.avg("sell_price").alias("manual_expanding_mean"),
        )
    )
    table = priced.withColumnRenamed(panel.date, "check_date")
    return history.join(table, [*keys, "check_date"]).select(
        *keys,
        "check_date",
        F.round("price_rel_mean", 6).alias("price_rel_mean"),
        F.round(F.try_divide("sell_price", F.col("manual_moving_avg_365")), 6).alias("recomputed"),
        F.round(F.try_divide("sell_price", F.col("manual_expanding_mean")), 6).alias("if_expanding"),
    )


def check_sample(
    sample: DataFrame, forced: DataFrame, stratum: str = "categoria_zero_rate", panel: Panel = PANEL
) -> DataFrame:
    """Per stratum: series, share of the sample, forced series asked for and present."""
    keys = list(panel.keys)
    asked = forced.groupBy(stratum).agg(F.count(F.lit(1)).alias("n_forced"))
    present = (
        sample.join(forced.select(*keys), keys, "left_semi")
        .groupBy(stratum)
        .agg(F.count(F.lit(1)).alias("n_forced_present"))
    )
    sizes = sample.groupBy(stratum).agg(F.count(F.lit(1)).alias("n_series"))
    total = F.sum("n_series").over(Window.partitionBy())
    return (
        sizes.withColumn("pct_muestra", F.round(F.col("n_series") / total, 4))
        .join(asked, stratum, "left")
        .join(present, stratum, "left")
    )


def check_forecast_range(predictions: DataFrame, folds: DataFrame, panel: Panel = PANEL) -> DataFrame:
    """First and last forecast day of each fold against its validation window."""
    seen = predictions.groupBy("fold_id").agg(
        F.min(panel.date).alias("pred_min"), F.max(panel.date).alias("pred_max")
    )
    return folds.join(seen, "fold_id", "left").select(
        "fold_id", "val_start", "val_end", "pred_min", "pred_max",
        F.coalesce(
            (F.col("pred_min") == F.col("val_start")) & (F.col("pred_max") == F.col("val_end")),
            F.lit(False),
        ).alias("ok"),
    )


def check_coverage(segments: DataFrame, predictions: DataFrame, panel: Panel = PANEL) -> DataFrame:
    """Per segment: series, series with a forecast, percent covered."""
    keys = list(panel.keys)
    covered = predictions.select(*keys).distinct().withColumn("_ok", F.lit(1))
    return (
        segments.join(covered, keys, "left")
        .groupBy("categoria_zero_rate")
        .agg(F.count(F.lit(1)).alias("n_series"), F.count("_ok").alias("n_con_modelo"))
        .withColumn("pct", F.lit(100.0) * F.col("n_con_modelo") / F.col("n_series"))
    )


def check_mapping(segments: DataFrame, column: str, expected: DataFrame) -> DataFrame:
    """Counts per label next to the expected ones. ``expected``: column, n_expected."""
    found = segments.groupBy(column).agg(F.count(F.lit(1)).alias("n_series"))
    return found.join(expected, column, "full").withColumn(
        "ok", F.col("n_series").eqNullSafe(F.col("n_expected"))
    )
