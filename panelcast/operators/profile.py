"""Exploratory aggregates. Statistics that need distinct series are computed in two levels:
first one row per series (combined map-side), then the report grain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions.keys import category_by_pattern
from panelcast.functions.numeric import order_of
from panelcast.schema import PANEL, PARTIAL_YEAR_DAYS, WEEKDAY_ORDER, Panel


def panel_overview(df: DataFrame, panel: Panel = PANEL) -> DataFrame:
    """One row: date range, distinct days, series, records, mean records per series.

    Series and days are counted from one (keys)- and one (date)-grained aggregate instead of
    two exact distinct counts over every record."""
    by_series = df.groupBy(*panel.keys).agg(
        F.count(F.lit(1)).alias("n"), F.min(panel.date).alias("lo"), F.max(panel.date).alias("hi")
    )
    days = df.groupBy(panel.date).agg(F.lit(1).alias("one")).agg(F.count("one").alias("dias_totales"))
    totals = by_series.agg(
        F.min("lo").alias("fecha_inicio"),
        F.max("hi").alias("fecha_fin"),
        (F.datediff(F.max("hi"), F.min("lo")) + 1).cast("long").alias("dias_calendario"),
        F.count(F.lit(1)).alias("series_unicas"),
        F.sum("n").alias("total_registros"),
        F.round(F.sum("n") / F.count(F.lit(1)), 0).alias("filas_promedio_por_serie"),
    )
    return totals.withColumn("dias_totales", days.scalar())


def series_count(df: DataFrame, panel: Panel = PANEL, approximate: bool = False) -> Column:
    """Aggregate expression: number of distinct series."""
    keys = [F.col(k) for k in panel.keys]
    return F.approx_count_distinct(F.struct(*keys)) if approximate else F.count_distinct(*keys)


def percent_where(condition: Column) -> Column:
    """Aggregate expression: share of rows meeting the condition, in percent."""
    return F.lit(100.0) * F.count_if(condition) / F.count(F.lit(1))


def category_profile(df: DataFrame, panel: Panel = PANEL) -> DataFrame:
    """Per category: records, series, stores, items, mean, deviation, range and zeros.

    Mean and deviation come from exact sums of the per-series moments, so the report level
    only sees one row per series, and the three distinct counts are taken there too."""
    item, store = panel.keys
    v = F.col(panel.value)
    by_series = df.groupBy(*panel.keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.count(v).alias("nv"),
        F.sum(v).alias("s"),
        F.sum((v * v).cast("decimal(38,0)")).alias("ss"),
        F.min(v).alias("lo"),
        F.max(v).alias("hi"),
        F.count_if(v == 0).alias("z"),
    )
    grouped = by_series.groupBy(category_by_pattern(F.col(item)).alias("categoria")).agg(
        F.sum("n").alias("registros"),
        F.count(F.lit(1)).alias("series"),
        F.count_distinct(store).alias("tiendas"),
        F.count_distinct(item).alias("items"),
        F.sum("nv").alias("_nv"),
        F.sum(F.col("s").cast("decimal(38,0)")).alias("_s"),
        F.sum("ss").alias("_ss"),
        F.min("lo").alias("venta_min"),
        F.max("hi").alias("venta_max"),
        F.sum("z").alias("registros_cero"),
    )
    n, s, ss = F.col("_nv").cast("double"), F.col("_s").cast("double"), F.col("_ss").cast("double")
    return grouped.select(
        "categoria",
        "registros",
        "series",
        "tiendas",
        "items",
        F.round(s / n, 2).alias("venta_promedio"),
        F.round(F.sqrt((ss - s * s / n) / (n - 1)), 2).alias("venta_desv"),
        "venta_min",
        "venta_max",
        "registros_cero",
        F.round(F.lit(100.0) * F.col("registros_cero") / F.col("registros"), 2).alias("pct_ceros"),
    )


# Labels of the exploratory zero-rate buckets (cuts 100/75/50/25/0 percent).
ZERO_BUCKETS = [
    "1. Sin ventas (100% ceros)",
    "2. Muy lento (75-99% ceros)",
    "3. Lento (50-75% ceros)",
    "4. Moderado (25-50% ceros)",
    "5. Pocas faltas (1-25% ceros)",
    "6. Completo (0% ceros)",
]


def zero_rate_histogram(df: DataFrame, panel: Panel = PANEL) -> DataFrame:
    """Series per zero-rate bucket, share of all series, mean of the series' mean sales.

    These buckets (25/50/75) are not the segment cuts (20/50/80)."""
    v = F.col(panel.value)
    pct = F.round(percent_where(v == 0), 2)
    by_series = df.groupBy(*panel.keys).agg(pct.alias("pct"), F.round(F.avg(v), 2).alias("mean"))
    p = F.col("pct")
    label = (
        F.when(p == 100, ZERO_BUCKETS[0])
        .when(p >= 75, ZERO_BUCKETS[1])
        .when(p >= 50, ZERO_BUCKETS[2])
        .when(p >= 25, ZERO_BUCKETS[3])
        .when(p > 0, ZERO_BUCKETS[4])
        .otherwise(ZERO_BUCKETS[5])
    )
    counts = by_series.groupBy(label.alias("categoria_ceros")).agg(
        F.count(F.lit(1)).alias("series"), F.round(F.avg("mean"), 2).alias("venta_prom_categoria")
    )
    return share_of_total(counts, "series", "pct_series", 2)


def share_of_total(counts: DataFrame, count: str, out: str, digits: int = 2) -> DataFrame:
    """Each row's part of the column total in percent. For report-sized frames (one row per
    label): the window has no partition keys."""
    total = F.sum(count).over(Window.partitionBy())
    return counts.withColumn(out, F.round(F.lit(100.0) * F.col(count) / total, digits))


def price_profile(prices: DataFrame, item: str = "item_id", price: str = "sell_price") -> DataFrame:
    """Per category: records, mean, deviation, range and coefficient of variation."""
    sd, mean = F.stddev_samp(price), F.avg(price)
    return prices.groupBy(category_by_pattern(F.col(item)).alias("categoria")).agg(
        F.count(F.lit(1)).alias("registros_precio"),
        F.round(mean, 2).alias("precio_promedio"),
        F.round(sd, 2).alias("precio_desv"),
        F.min(price).alias("precio_min"),
        F.max(price).alias("precio_max"),
        F.round(F.lit(100.0) * F.try_divide(sd, mean), 2).alias("coef_variacion"),
    )


def event_profile(calendar: DataFrame, event_type: str = "event_type_1", date: str = "date"):
    """Occurrences and distinct days per event type."""
    return (
        calendar.where(F.col(event_type).isNotNull())
        .groupBy(F.col(event_type).alias("tipo_evento"))
        .agg(F.count(F.lit(1)).alias("ocurrencias"), F.count_distinct(date).alias("dias_unicos"))
    )


def flag_day_profile(calendar: DataFrame, flags: list[str]) -> DataFrame:
    """Per 0/1 flag column: active days, all days, percent. One pass over the calendar."""
    sums = calendar.agg(
        F.count(F.lit(1)).alias("total_dias"), *[F.sum(f).cast("long").alias(f) for f in flags]
    )
    return (
        sums.unpivot(["total_dias"], flags, "flag", "dias")
        .withColumn("pct", F.lit(100.0) * F.col("dias") / F.col("total_dias"))
    )


def weekday_profile(
    df: DataFrame, panel: Panel = PANEL, by: tuple[str, ...] = (), decimals: int | None = None, inner: tuple[str, ...] = ()
) -> DataFrame:
    """Mean sales per weekday in report order, over all series or per ``by`` columns.

    With ``decimals``, the mean of means that are rounded per weekday and ``inner`` columns, rounded again; the means in
    between are decimals, so that halves round up whatever their binary form."""
    value = F.col(panel.value)
    out = df.withColumn("weekday", F.date_format(panel.date, "EEEE"))
    if decimals is not None:
        out = out.groupBy(*by, *inner, "weekday").agg(F.round(F.avg(value), decimals).cast(f"decimal(18,{decimals})").alias("_mean"))
        value = F.col("_mean")
    mean = F.avg(value)
    out = out.groupBy(*by, "weekday").agg((mean if decimals is None else F.round(mean, decimals).cast("double")).alias("venta_promedio"))
    return out.withColumn("row_order", order_of(F.col("weekday"), WEEKDAY_ORDER))


def month_profile(df: DataFrame, panel: Panel = PANEL, by: tuple[str, ...] = ()) -> DataFrame:
    return df.groupBy(*by, F.month(panel.date).alias("mes")).agg(
        F.avg(panel.value).alias("venta_promedio")
    )


def year_profile(df: DataFrame, panel: Panel = PANEL, by: tuple[str, ...] = ()) -> DataFrame:
    """Mean per year with the days seen in it; years with few days are marked partial.

    Goes through the (by, date) grain, where days are rows and need no distinct count."""
    daily = df.groupBy(*by, panel.date).agg(
        F.sum(panel.value).alias("_s"), F.count(panel.value).alias("_n")
    )
    return (
        daily.groupBy(*by, F.year(panel.date).alias("anio"))
        .agg(
            (F.sum("_s") / F.sum("_n")).alias("venta_promedio"),
            F.count(F.lit(1)).alias("dias_en_anio"),
        )
        .withColumn("parcial", F.col("dias_en_anio") < PARTIAL_YEAR_DAYS)
    )


def daily_total(df: DataFrame, panel: Panel = PANEL, out: str = "total_sales") -> DataFrame:
    return df.groupBy(panel.date).agg(F.sum(panel.value).alias(out))


def series_stats(df: DataFrame, panel: Panel = PANEL) -> DataFrame:
    """Total, zero percentage and mean of every series in one aggregate."""
    v = F.col(panel.value)
    return df.groupBy(*panel.keys).agg(
        F.sum(v).alias("total_ventas"),
        F.count_if(v == 0).alias("dias_cero"),
        F.count(F.lit(1)).alias("total_dias"),
        F.round(percent_where(v == 0), 2).alias("pct_ceros"),
        F.avg(v).alias("venta_media"),
    )


def series_extract(df: DataFrame, key: dict[str, str], panel: Panel = PANEL) -> DataFrame:
    """All days of one named series, in order."""
    out = df
    for column, wanted in key.items():
        out = out.where(F.col(column) == F.lit(wanted))
    return out.select(*panel.grain, panel.value).orderBy(panel.date)


def weighted_mean(
    df: DataFrame, by: list[str], value: str = "avg_pinball_loss", weight: str = "n_obs"
) -> DataFrame:
    """Collapse sub-groups to the mean over the underlying observations."""
    return df.groupBy(*by).agg(
        (F.sum(F.col(value) * F.col(weight)) / F.sum(weight)).alias(value),
        F.sum(weight).alias(weight),
    )
