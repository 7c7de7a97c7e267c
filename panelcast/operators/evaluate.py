"""Pinball-loss fact table, its roll-ups, comparisons and the report tables built on them."""

from __future__ import annotations

from datetime import date as Date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions.numeric import bucket, exceeds, order_of, pinball
from panelcast.operators.folds import fold_days
from panelcast.operators.profile import weighted_mean
from panelcast.operators.relational import left_flag
from panelcast.operators.reshape import pivot_models, unpivot_quantiles
from panelcast.schema import (
    EVENT_LABELS,
    MODEL_ORDER,
    NEW_PRODUCT_DAYS,
    PANEL,
    QUANTILES,
    RELEASE_LABELS,
    UNSTABLE_THRESHOLD,
    ZERO_RATE_LABELS,
    Panel,
)
from panelcast.session import checkpoint


def stack_models(predictions: dict[str, DataFrame]) -> DataFrame:
    out = None
    for model, df in predictions.items():
        tagged = df.withColumn("model", F.lit(model))
        out = tagged if out is None else out.unionByName(tagged)
    return out


def is_extreme(threshold: float = UNSTABLE_THRESHOLD) -> Column:
    """Upper quantiles beyond the threshold; a NaN quantile is not extreme."""
    return exceeds(F.col("p75"), threshold) | exceeds(F.col("p95"), threshold)


def unstable_series(
    predictions: DataFrame, threshold: float = UNSTABLE_THRESHOLD, panel: Panel = PANEL
) -> DataFrame:
    """(series, fold) with any extreme day."""
    return predictions.where(is_extreme(threshold)).select(*panel.keys, "fold_id").distinct()


def level_of(name: Column) -> Column:
    table = F.create_map(*[F.lit(x) for q, v in QUANTILES.items() for x in (q, v)])
    return F.element_at(table, name)


def pinball_fact(
    predictions: dict[str, DataFrame],
    actuals: DataFrame,
    segments: DataFrame,
    sample: DataFrame,
    unstable_model: str = "bqml",
    threshold: float = UNSTABLE_THRESHOLD,
    panel: Panel = PANEL,
    releases: DataFrame | None = None,
    folds: DataFrame | None = None,
) -> DataFrame:
    """One row per model, fold, series, day and quantile with its loss and report dimensions; with ``releases``, also
    the release_age_bucket.

    ``folds``: the layout the predictions were made with. The actuals of days that no fold validates on join nothing; they are
    dropped before the shuffle (of 2,499 days of the test panel 140 are left).

    All joins happen on the wide prediction rows, a fifth of the fact's rows; the unpivot is the
    last step. The instability flag is a window on (series, fold, model) behind the segment join's
    partitioning instead of an aggregate joined back, and marks every day and quantile of an
    unstable (series, fold).
    """
    keys = list(panel.keys)
    wide = stack_models(predictions)
    truth = actuals.select(*panel.grain, F.col(panel.value).alias("y_true"))
    if folds is not None:
        scored = fold_days(folds, ("val",)).select(F.col("date").alias(panel.date))
        truth = truth.join(scored, panel.date, "left_semi")
    joined = wide.join(truth, panel.grain).join(
        segments.select(*keys, "categoria_zero_rate"), keys, "left"
    )
    flagged = left_flag(joined, sample, keys, "in_arima_sample")
    if releases is not None:
        age = release_age_bucket(F.col(panel.date), F.col("release_date"))
        flagged = flagged.join(releases.select(*keys, "release_date"), keys, "left").withColumn("release_age_bucket", age)
    fit = Window.partitionBy(*keys, "fold_id", "model")
    marked = flagged.withColumn(
        "bqml_unstable_series",
        F.max((F.col("model") == unstable_model) & is_extreme(threshold)).over(fit),
    )
    long = unpivot_quantiles(marked)
    level = level_of(F.col("quantile_name"))
    return long.select(
        "model",
        "fold_id",
        *panel.grain,
        "quantile_name",
        level.alias("quantile_level"),
        "y_pred",
        "y_true",
        "categoria_zero_rate",
        "in_arima_sample",
        "bqml_unstable_series",
        pinball(level, F.col("y_true"), F.col("y_pred")).alias("pinball_loss"),
        *(["release_age_bucket"] if releases is not None else []),
    )


def _stable(fact: DataFrame) -> DataFrame:
    return fact.where(~F.col("bqml_unstable_series"))


def roll_up(fact: DataFrame, *dims: str) -> DataFrame:
    """n_obs and mean loss per model, quantile, sample membership and ``dims``; unstable fits
    excluded. A few hundred groups at most: combined map-side, the shuffle carries partial sums."""
    return (
        _stable(fact)
        .groupBy("model", "quantile_name", "quantile_level", "in_arima_sample", *dims)
        .agg(F.count(F.lit(1)).alias("n_obs"), F.avg("pinball_loss").alias("avg_pinball_loss"))
    )


def metrics_by_fold(fact: DataFrame) -> DataFrame:
    return roll_up(fact, "fold_id")


def metrics_by_zero_rate(fact: DataFrame) -> DataFrame:
    return roll_up(fact, "categoria_zero_rate")


def metrics_overall(fact: DataFrame) -> DataFrame:
    return roll_up(fact)


def _series_losses(fact: DataFrame, panel: Panel = PANEL) -> DataFrame:
    """Loss sums per model, quantile, sample membership and series: the grain at which series
    attributes are joined, after folds and days have been combined away."""
    return (
        _stable(fact)
        .groupBy("model", "quantile_name", "quantile_level", "in_arima_sample", *panel.keys)
        .agg(F.count(F.lit(1)).alias("_n"), F.sum("pinball_loss").alias("_loss"))
    )


def _with_category(fact: DataFrame, segments: DataFrame, panel: Panel) -> DataFrame:
    keys = list(panel.keys)
    return _series_losses(fact, panel).join(segments.select(*keys, "category"), keys)


def _mean_loss() -> Column:
    return F.sum("_loss") / F.sum("_n")


def metrics_by_category(fact: DataFrame, segments: DataFrame, panel: Panel = PANEL) -> DataFrame:
    """The loss sums shrink to one row per series before the segment join."""
    return (
        _with_category(fact, segments, panel)
        .groupBy("model", "quantile_name", "quantile_level", "in_arima_sample", "category")
        .agg(F.sum("_n").alias("n_obs"), _mean_loss().alias("avg_pinball_loss"))
    )


def release_age_bucket(day: Column, release: Column) -> Column:
    age = F.datediff(day, release)
    return F.when(release.isNull(), RELEASE_LABELS[0]).otherwise(
        bucket(age, [0, NEW_PRODUCT_DAYS], RELEASE_LABELS[1:])
    )


def metrics_by_release_age(fact: DataFrame, releases: DataFrame | None = None, panel: Panel = PANEL) -> DataFrame:
    """A fact that was built with releases has the bucket already, joined to a fifth of its rows; another one is joined here."""
    if "release_age_bucket" in fact.columns:
        return roll_up(fact, "release_age_bucket")
    aged = fact.join(releases, list(panel.keys), "left").withColumn(
        "release_age_bucket", release_age_bucket(F.col(panel.date), F.col("release_date"))
    )
    return roll_up(aged, "release_age_bucket")


def metrics_by_event(fact: DataFrame, calendar_flags: DataFrame, panel: Panel = PANEL) -> DataFrame:
    """``calendar_flags``: date, is_event, is_christmas."""
    label = (
        F.when(F.col("is_christmas") == 1, EVENT_LABELS[0])
        .when(F.col("is_event") == 1, EVENT_LABELS[1])
        .otherwise(EVENT_LABELS[2])
    )
    days = calendar_flags.select(F.col("date").alias(panel.date), label.alias("event_bucket"))
    return roll_up(fact.join(days, panel.date), "event_bucket")


def rollups_in_one_pass(fact: DataFrame, dims: list[str]) -> DataFrame:
    """Every one-dimensional roll-up and the overall one from a single scan of the fact.

    ``roll_up`` names the dimension, its value is in ``bucket``; the overall rows carry NULL."""
    base = ["model", "quantile_name", "quantile_level", "in_arima_sample"]
    sets = [[*base], *[[*base, d] for d in dims]]
    grouped = (
        _stable(fact)
        .withColumns({d: F.col(d).cast("string") for d in dims})
        .groupingSets([[F.col(c) for c in s] for s in sets], *[*base, *dims])
        .agg(
            F.count(F.lit(1)).alias("n_obs"),
            F.avg("pinball_loss").alias("avg_pinball_loss"),
            *[F.grouping(d).alias(f"_g_{d}") for d in dims],
        )
    )
    name = F.lit("overall")
    value = F.lit(None).cast("string")
    for d in dims:
        name = F.when(F.col(f"_g_{d}") == 0, F.lit(d)).otherwise(name)
        value = F.when(F.col(f"_g_{d}") == 0, F.col(d)).otherwise(value)
    return grouped.select(
        name.alias("roll_up"), value.alias("bucket"), *base, "n_obs", "avg_pinball_loss"
    )


def strict_scope(fact: DataFrame, models=tuple(MODEL_ORDER), panel: Panel = PANEL) -> DataFrame:
    """Only (series, fold, day, quantile) cells that every model predicted, so that averages
    compare equal populations even where a model failed on some series."""
    cell = Window.partitionBy("fold_id", *panel.grain, "quantile_name")
    bit = F.element_at(F.create_map(*[F.lit(x) for i, m in enumerate(models) for x in (m, 1 << i)]), F.col("model"))
    return (
        fact.where(F.col("model").isin(*models))
        .withColumn("_models", F.bit_or(bit).over(cell))
        .where(F.col("_models") == (1 << len(models)) - 1)
        .drop("_models")
    )


def two_scope_compare(
    metrics: DataFrame, index: str, order: list[str] | None = None, quantile: str | None = "p50"
) -> DataFrame:
    """The fair scope (sampled series, all models) and the full scope (models that cover every
    series) side by side, one column per model, n_obs of the full scope per bucket."""
    picked = metrics if quantile is None else metrics.where(F.col("quantile_name") == quantile)
    fair = picked.where("in_arima_sample").withColumn("scope", F.lit("fair"))
    full = picked.where(F.col("model").isin("bqml", "lgbm")).withColumn("scope", F.lit("full"))
    means = weighted_mean(fair.unionByName(full), ["scope", index, "model"])
    out = (
        means.groupBy("scope", index)
        .pivot("model", MODEL_ORDER)
        .agg(F.first("avg_pinball_loss").alias("loss"), F.sum("n_obs").alias("n"))
    )
    n_obs = sum((F.coalesce(F.col(f"{m}_n"), F.lit(0)) for m in MODEL_ORDER), F.lit(0))
    out = out.select(
        "scope", index, *[F.col(f"{m}_loss").alias(m) for m in MODEL_ORDER], n_obs.alias("n_obs")
    )
    return out if order is None else out.withColumn("row_order", order_of(F.col(index), order))


def model_table(metrics: DataFrame, index: str, order: list[str] | None = None) -> DataFrame:
    """index x model table of weighted mean losses."""
    return pivot_models(weighted_mean(metrics, [index, "model"]), index, order)


def outliers_by_fold(predictions: DataFrame, threshold=UNSTABLE_THRESHOLD, panel: Panel = PANEL):
    """Extreme rows and series and the largest value per fold, with the share of all rows.

    One pass: per (fold, series) first, so distinct series are counted as rows."""
    extreme = is_extreme(threshold)
    top = F.when(extreme, F.greatest("p75", "p95"))
    by_series = predictions.groupBy("fold_id", *panel.keys).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(extreme).alias("x"), F.max(top).alias("hi")
    )
    folds = by_series.groupBy("fold_id").agg(
        F.sum("n").alias("_n"),
        F.sum("x").alias("n_filas_extremas"),
        F.count_if(F.col("x") > 0).alias("n_series_extremas"),
        F.max("hi").alias("max_valor"),
    )
    total = F.sum("_n").over(Window.partitionBy())
    return (
        folds.withColumn("pct_of_total", F.lit(100.0) * F.col("n_filas_extremas") / total)
        .where(F.col("n_filas_extremas") > 0)
        .drop("_n")
    )


def outlier_series(
    predictions: DataFrame, n: int = 30, threshold=UNSTABLE_THRESHOLD, panel: Panel = PANEL
) -> DataFrame:
    """The n most extreme (series, fold) by their largest p95."""
    return (
        predictions.where(is_extreme(threshold))
        .groupBy(*panel.keys, "fold_id")
        .agg(
            F.count(F.lit(1)).alias("n_dias_extremos"),
            F.min("p50").alias("min_p50"),
            F.max("p50").alias("max_p50"),
            F.max("p75").alias("max_p75"),
            F.max("p95").alias("max_p95"),
        )
        .orderBy(F.desc("max_p95"), *panel.keys, "fold_id")
        .limit(n)
    )


def exclusion_report(fact: DataFrame, panel: Panel = PANEL) -> DataFrame:
    """Rows and (series, fold) removed from the averages."""
    per_fit = (
        fact.where("bqml_unstable_series")
        .groupBy(*panel.keys, "fold_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return per_fit.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_filas_excluidas"),
        F.count(F.lit(1)).alias("n_series_fold_excluidas"),
    )


def convergence_summary(metadata: DataFrame, by_fold: bool = True) -> DataFrame:
    """Fitted, converged and failed series per segment (and fold) with the report order."""
    group = [*(["fold_id"] if by_fold else []), "categoria_zero_rate"]
    return (
        metadata.groupBy(*group)
        .agg(
            F.count(F.lit(1)).alias("n_series"),
            F.count_if(F.col("convergio")).alias("n_convergio"),
            F.count_if(~F.col("convergio")).alias("n_fallo"),
        )
        .withColumn("row_order", order_of(F.col("categoria_zero_rate"), ZERO_RATE_LABELS))
    )


def aggregate_predictions(predictions: DataFrame, segments: DataFrame, panel: Panel = PANEL) -> DataFrame:
    """Daily sums per category and store. A sum of series quantiles is not the quantile of the
    sum, hence the column names."""
    keys = list(panel.keys)
    return (
        predictions.join(segments.select(*keys, "category"), keys)
        .groupBy(panel.date, "category", panel.keys[1])
        .agg(*[F.sum(q).alias(f"sum_{q}") for q in QUANTILES])
    )


def aggregate_metrics(fact: DataFrame, segments: DataFrame, run_date: Date, panel: Panel = PANEL):
    """Mean loss per model, category and quantile, stamped with the run."""
    return (
        _with_category(fact, segments, panel)
        .groupBy("model", "category", F.col("quantile_name").alias("quantile"))
        .agg(_mean_loss().alias("pinball_loss"))
        .withColumn("run_date", F.lit(run_date))
    )


def error_heatmap(
    fact: DataFrame, segments: DataFrame, stores: list[str] | None = None, quantile: str = "p50", panel: Panel = PANEL
) -> DataFrame:
    """Mean loss by category (rows) and store (columns): those given, or all that the segments have, in their order."""
    store = panel.keys[1]
    if stores is None:
        stores = [r[0] for r in segments.select(store).distinct().orderBy(store).collect()]  # the columns of the result
    picked = fact.where(F.col("quantile_name") == quantile)
    return (
        _with_category(picked, segments, panel)
        .groupBy("category")
        .pivot(store, stores)
        .agg(_mean_loss())
    )


def weekly_comparison(
    predictions: DataFrame, actuals: DataFrame, segments: DataFrame, panel: Panel = PANEL
) -> DataFrame:
    """Weekly actual and predicted sums per category; weeks start on Monday."""
    keys = list(panel.keys)
    return (
        predictions.join(actuals.select(*panel.grain, panel.value), panel.grain)
        .join(segments.select(*keys, "category"), keys)
        .groupBy(F.trunc(panel.date, "week").alias("week"), "category")
        .agg(
            F.sum(panel.value).alias("actual_sales"),
            F.sum("p50").alias("pred_p50"),
            F.sum("p05").alias("pred_p05"),
            F.sum("p95").alias("pred_p95"),
        )
    )


def loss_scale(train: DataFrame, panel: Panel = PANEL) -> DataFrame:
    """Mean absolute day-to-day change of each training window."""
    w = Window.partitionBy("fold_id", *panel.keys).orderBy(panel.date)
    change = F.abs(F.col(panel.value) - F.lag(panel.value).over(w))
    return (
        train.select("fold_id", *panel.keys, change.cast("double").alias("_c"))
        .groupBy("fold_id", *panel.keys)
        .agg(F.avg("_c").alias("scale"))
    )


def weight_days(folds: DataFrame, days: int = 28, panel: Panel = PANEL) -> DataFrame:
    """(fold_id, date): the last ``days`` training days of each fold."""
    last = F.sequence(F.date_sub("train_end", days - 1), F.col("train_end"))
    return folds.select("fold_id", F.explode(last).alias(panel.date))


def revenue_weights(revenue: DataFrame, folds: DataFrame, days: int = 28, panel: Panel = PANEL) -> DataFrame:
    """Each series' share of the fold's revenue over the last training days.

    ``revenue``: panel rows with a ``revenue`` column; only those of ``weight_days`` count. The sums are written, one row
    per fold and series, because they are read twice. Fold totals are an aggregate of the
    per-series sums, joined back by fold: no window gathers a fold's series in one task."""
    sums = (
        revenue.join(weight_days(folds, days, panel), panel.date)
        .groupBy("fold_id", *panel.keys)
        .agg(F.coalesce(F.sum("revenue"), F.lit(0.0)).alias("_rev"))
    )
    sums = checkpoint(sums, "revenue-sums")
    totals = sums.groupBy("fold_id").agg(F.sum("_rev").alias("_total"))
    return sums.join(totals, "fold_id").select(
        "fold_id", *panel.keys, F.try_divide("_rev", F.col("_total")).alias("weight")
    )


def weighted_scaled_loss(
    fact: DataFrame, scales: DataFrame, weights: DataFrame, panel: Panel = PANEL
) -> DataFrame:
    """Weighted scaled pinball loss per model, fold and quantile.

    The fact shrinks to one row per model, fold, series and quantile before any join. A series
    that never changed in training has no scale and is left out; the weights of the series scored
    are scaled to sum to 1."""
    fit = ["fold_id", *panel.keys]
    losses = (
        _stable(fact)
        .groupBy("model", *fit, "quantile_name")
        .agg(F.avg("pinball_loss").alias("_loss"))
    )
    scaled = F.try_divide("_loss", F.col("scale"))
    return (
        losses.join(scales, fit)
        .join(weights, fit)
        .groupBy("model", "fold_id", "quantile_name")
        .agg(
            F.try_divide(
                F.sum(F.col("weight") * scaled), F.sum(F.when(scaled.isNotNull(), F.col("weight")))
            ).alias("wspl")
        )
    )
