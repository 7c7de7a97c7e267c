"""Wide <-> long, gap filling, date spines, report pivots."""

from __future__ import annotations

import re
from datetime import date as Date
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelcast.functions.keys import parse_series_id
from panelcast.functions.numeric import missing, order_of
from panelcast.schema import MODEL_ORDER, PANEL, QUANTILES, Panel

#: Dense rows of one task.
PARTITION_ROWS = 500_000


def day_columns(df: DataFrame, prefix: str = "d_") -> list[str]:
    """The day columns present in the schema, in numeric order."""
    pattern = re.compile(re.escape(prefix) + r"(\d+)$")
    found = [(int(m.group(1)), c) for c in df.columns if (m := pattern.match(c))]
    return [c for _, c in sorted(found)]


def wide_to_long(
    wide: DataFrame,
    epoch: Date | Column,
    id_col: str = "id",
    prefix: str = "d_",
    keep_id: bool = False,
) -> DataFrame:
    """One row per series and day column -> one row per (item, store, date); NULL cells drop.

    The first day column is ``epoch`` (a date, or a date column when each row has its own).
    A narrow generator: the id is parsed once per wide row and nothing is shuffled.
    """
    days = day_columns(wide, prefix)
    numbers = [int(c[len(prefix) :]) for c in days]
    offsets = [n - numbers[0] for n in numbers]
    start = epoch if isinstance(epoch, Column) else F.lit(epoch)
    head = wide.select(
        F.col(id_col).alias("id"),
        *[c.alias(n) for n, c in parse_series_id(F.col(id_col)).items()],
        start.alias("_start"),
        F.array(*[F.col(c).cast("long") for c in days]).alias("_cells"),
    )
    long = head.select(
        "id", "item_id", "store_id", "_start", F.posexplode("_cells").alias("_pos", "sales")
    ).where(F.col("sales").isNotNull())
    gap_free = offsets == list(range(len(offsets)))
    offset = (
        F.col("_pos")
        if gap_free
        else F.element_at(F.array(*[F.lit(o) for o in offsets]), F.col("_pos") + 1)
    )
    out = long.select(
        "id", "item_id", "store_id", F.date_add("_start", offset).alias("date"), "sales"
    )
    return out if keep_id else out.drop("id")


def held_back_days(
    wide: DataFrame, epoch: Date, known: Date, id_col: str = "id", prefix: str = "d_"
) -> DataFrame:
    """The days of a wide file behind ``known``, in long form. Only their columns are read."""
    days = day_columns(wide, prefix)
    first = int(days[0][len(prefix) :]) if days else 0
    later = [c for c in days if epoch + timedelta(days=int(c[len(prefix) :]) - first) > known]
    if not later:
        return wide_to_long(wide, epoch, id_col, prefix).where(F.lit(False))
    start = epoch + timedelta(days=int(later[0][len(prefix) :]) - first)
    return wide_to_long(wide.select(id_col, *later), start, id_col, prefix)


def unpivot_quantiles(
    predictions: DataFrame, names: list[str] | None = None, value: str = "y_pred"
) -> DataFrame:
    """Quantile columns -> (quantile_name, y_pred); NULL and NaN predictions have no row.

    Generated from an array of structs: the row is widened inside one code-generated stage,
    where the expansion behind ``DataFrame.unpivot`` fell out of it next to a window."""
    names = names or list(QUANTILES)
    ids = [c for c in predictions.columns if c not in names]
    cells = F.array(
        *[F.struct(F.lit(n).alias("quantile_name"), F.col(n).alias(value)) for n in names]
    )
    return predictions.select(*ids, F.inline(cells)).where(~missing(F.col(value)))


def pivot_models(
    metrics: DataFrame,
    index: str,
    order: list[str] | None = None,
    models: list[str] | None = None,
    value: str = "avg_pinball_loss",
) -> DataFrame:
    """One row per ``index`` value, one column per model, and the row's place in the report.

    The model list is given, so the pivot needs no extra job to discover it."""
    out = metrics.groupBy(index).pivot("model", models or MODEL_ORDER).agg(F.first(value))
    return out if order is None else out.withColumn("row_order", order_of(F.col(index), order))


def pivot_convergence(metadata: DataFrame, fold: str = "fold_id") -> DataFrame:
    """Converged and failed fits per fold and the share converged in percent."""
    counts = (
        metadata.groupBy(fold)
        .pivot("convergio", [True, False])
        .count()
        .na.fill(0)
        .select(fold, F.col("true").alias("n_convergio"), F.col("false").alias("n_fallo"))
    )
    total = F.col("n_convergio") + F.col("n_fallo")
    return counts.withColumn("pct_converged", F.lit(100.0) * F.col("n_convergio") / total)


def date_spine(spark: SparkSession, start: Date, end: Date, name: str = "date") -> DataFrame:
    """All days from start to end inclusive."""
    return spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias(name))


def dense_partitions(spark: SparkSession, n_series: int, start: Date, end: Date) -> int:
    """``partitions`` for ``densify``: about PARTITION_ROWS dense rows each, whatever the number of series. Not fewer than the
    session's own, so that a join with another table by series moves that table and not the panel."""
    rows = n_series * ((end - start).days + 1)
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // PARTITION_ROWS))


def densify(
    observed: DataFrame,
    start: Date,
    end: Date,
    panel: Panel = PANEL,
    fill: int | float | None = 0,
    partitions: int | None = None,
) -> DataFrame:
    """One row per series and day of [start, end]; days without a record get ``fill``.

    Each record is stretched over the days up to the next record of its series (the first one
    also backwards to ``start``), so gaps are filled by a generator behind one shuffle on the
    series key. There is no key x day join, and the key partitioning survives for the
    windows that follow. Expects at most one record per series and day.

    ``partitions`` fixes the number of shuffle partitions. Set it for very sparse records: the
    partitions are sized by the records that go in, and every series leaves with all its days
    (``dense_partitions`` has the number for a count of series).
    """
    w = Window.partitionBy(*panel.keys).orderBy(panel.date)
    day = F.col(panel.date)
    inside = observed.where(day.between(F.lit(start), F.lit(end)))
    if partitions:
        inside = inside.repartition(partitions, *panel.keys)
    first = F.lag(day).over(w).isNull()
    spans = inside.select(
        *panel.keys,
        day.alias("_day"),
        F.col(panel.value).alias("_value"),
        F.when(first, F.lit(start)).otherwise(day).alias("_from"),
        F.coalesce(F.date_sub(F.lead(day).over(w), 1), F.lit(end)).alias("_to"),
    )
    value_type = observed.schema[panel.value].dataType
    gap = F.lit(fill).cast(value_type)
    return spans.select(
        *panel.keys, "_day", "_value", F.explode(F.sequence("_from", "_to")).alias(panel.date)
    ).select(
        *panel.grain,
        F.when(F.col(panel.date) == F.col("_day"), F.col("_value")).otherwise(gap).alias(panel.value),
    )


def gap_report(observed: DataFrame, start: Date, end: Date, panel: Panel = PANEL) -> DataFrame:
    """Days present and missing per series on a daily grid."""
    n_days = (end - start).days + 1
    return (
        observed.where(F.col(panel.date).between(F.lit(start), F.lit(end)))
        .groupBy(*panel.keys)
        .agg(F.count(F.lit(1)).alias("n_present"))
        .withColumn("n_missing", F.lit(n_days) - F.col("n_present"))
    )


def interpolate(dense: DataFrame, panel: Panel = PANEL, out: str | None = None) -> DataFrame:
    """Linear fill between the neighbouring known days; after the last known day the value is
    held, before the first it stays NULL.

    The look-ahead runs as a growing frame over the reversed order: an UNBOUNDED FOLLOWING
    frame is quadratic in the series length.
    """
    day, value = F.col(panel.date), F.col(panel.value)
    known = F.when(value.isNotNull(), F.struct(day.alias("d"), value.cast("double").alias("v")))
    ahead = (
        Window.partitionBy(*panel.keys)
        .orderBy(F.col(panel.date).desc())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    back = (
        Window.partitionBy(*panel.keys)
        .orderBy(panel.date)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    near = dense.withColumn("_next", F.last(known, ignorenulls=True).over(ahead)).withColumn(
        "_prev", F.last(known, ignorenulls=True).over(back)
    )
    span = F.datediff("_next.d", "_prev.d")
    blend = F.col("_prev.v") + (F.col("_next.v") - F.col("_prev.v")) * F.datediff(
        day, "_prev.d"
    ) / span
    filled = (
        F.when(value.isNotNull(), value.cast("double"))
        .when(F.col("_prev").isNull(), F.lit(None).cast("double"))
        .when(F.col("_next").isNull(), F.col("_prev.v"))
        .otherwise(blend)
    )
    return near.withColumn(out or panel.value, filled).drop("_next", "_prev")
