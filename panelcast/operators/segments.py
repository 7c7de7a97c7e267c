"""Series segments, release dates and reproducible samples of series."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions.keys import category_of, hash_key
from panelcast.functions.numeric import bucket
from panelcast.schema import PANEL, ZERO_RATE_CUTS, ZERO_RATE_LABELS, Panel

STRATUM = "categoria_zero_rate"


def zero_rate_segments(df: DataFrame, panel: Panel = PANEL) -> DataFrame:
    """One row per series: category, zero rate, mean, and the zero-rate segment.

    Uses all history handed in; fine for strata and reports, a leak if used as a feature."""
    v = F.col(panel.value)
    stats = df.groupBy(*panel.keys).agg(
        F.avg((v == 0).cast("double")).alias("tasa_ceros"), F.avg(v).alias("venta_promedio")
    )
    return stats.select(
        *panel.keys,
        category_of(F.col(panel.keys[0])).alias("category"),
        "tasa_ceros",
        "venta_promedio",
        bucket(F.col("tasa_ceros"), ZERO_RATE_CUTS, ZERO_RATE_LABELS).alias(STRATUM),
    )


def first_release(
    prices: DataFrame, calendar: DataFrame, panel: Panel = PANEL, week: str = "wm_yr_wk"
) -> DataFrame:
    """First day of the first week in which the series has a price."""
    release = prices.groupBy(*panel.keys).agg(F.min(week).alias(week))
    week_start = calendar.groupBy(week).agg(F.min("date").alias("release_date"))
    return release.join(week_start, week).select(*panel.keys, "release_date")


def stratified_top_n(
    series: DataFrame,
    n: int,
    salt: str,
    stratum: str = STRATUM,
    panel: Panel = PANEL,
    key: Callable[[list[Column], str], Column] = hash_key,
) -> DataFrame:
    """The n series of lowest hash per stratum: balanced and the same on every run.

    ``key`` is ``hash_key`` or, for the samples that the Farm fingerprint draws, ``farm_key``.

    A rank filter with a literal limit is planned as a per-task top-n before the shuffle, so
    a stratum with most of the series ships n rows per task, not all of them."""
    h = key([F.col(k) for k in panel.keys], salt)
    w = Window.partitionBy(stratum).orderBy("_h", *panel.keys)
    return (
        series.withColumn("_h", h)
        .withColumn("_rn", F.row_number().over(w))
        .where(F.col("_rn") <= n)
        .drop("_h", "_rn")
    )


def rank_in_stratum(
    df: DataFrame, stratum: str, hashed: Column, ties: list[str], out: str = "rn", prefix: int = 3
) -> DataFrame:
    """Exact 1-based rank by hash inside each stratum without gathering a stratum in one task.

    Rows fall into 16^prefix slices by their leading hash digits. Slice sizes are counted
    (combined map-side) and accumulated into offsets; the row number then runs inside
    (stratum, slice), which holds 1/16^prefix of the stratum.
    """
    sliced = df.withColumn("_h", hashed).withColumn("_slice", F.substring("_h", 1, prefix))
    earlier = (
        Window.partitionBy(stratum).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        sliced.groupBy(stratum, "_slice")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            stratum, "_slice", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset")
        )
    )
    local = Window.partitionBy(stratum, "_slice").orderBy("_h", *ties)
    return (
        sliced.join(offsets, [stratum, "_slice"])
        .withColumn(out, F.row_number().over(local) + F.col("_offset"))
        .drop("_h", "_slice", "_offset")
    )


def proportional_quotas(series: DataFrame, total: int, stratum: str = STRATUM) -> DataFrame:
    """round(share of the stratum x total), one row per stratum."""
    counts = series.groupBy(stratum).agg(F.count(F.lit(1)).alias("_n"))
    share = F.col("_n") / F.sum("_n").over(Window.partitionBy())
    return counts.select(stratum, F.round(share * F.lit(total)).cast("long").alias("n_objetivo"))


def proportional_sample(
    series: DataFrame,
    forced: DataFrame,
    quotas: DataFrame,
    salt: str,
    stratum: str = STRATUM,
    panel: Panel = PANEL,
    key: Callable[[list[Column], str], Column] = hash_key,
) -> DataFrame:
    """All forced series, then each stratum filled up to its quota by hash rank.

    The number already forced is counted per stratum rather than assumed equal everywhere. A
    stratum smaller than its quota is taken whole."""
    keys = list(panel.keys)
    forced_rows = series.join(forced.select(*keys), keys, "left_semi")
    rest = series.join(forced.select(*keys), keys, "left_anti")
    taken = forced_rows.groupBy(stratum).agg(F.count(F.lit(1)).alias("_taken"))
    room = quotas.join(taken, stratum, "left").select(
        stratum, (F.col("n_objetivo") - F.coalesce("_taken", F.lit(0))).alias("_room")
    )
    ranked = rank_in_stratum(rest, stratum, key([F.col(k) for k in keys], salt), keys)
    filled = ranked.join(room, stratum).where(F.col("rn") <= F.col("_room"))
    return forced_rows.unionByName(filled.select(*forced_rows.columns))


def sample_panel(df: DataFrame, sample: DataFrame, panel: Panel = PANEL) -> DataFrame:
    """The panel rows of the sampled series."""
    return df.join(sample.select(*panel.keys), list(panel.keys), "left_semi")
