"""Joins and filters whose exact semantics matter; anything a single DataFrame call already
says (inner, anti, except-columns, union) is written as that call where it is needed."""

from __future__ import annotations

from datetime import date as Date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.schema import PANEL, Panel


def half_open(d: Column, start: Date | Column, end: Date | Column) -> Column:
    """start <= d < end, so consecutive windows neither overlap nor leave a gap."""
    return (d >= start) & (d < end)


def join_weekly_price(
    sales: DataFrame, calendar: DataFrame, prices: DataFrame, week: str = "wm_yr_wk"
) -> DataFrame:
    """Price of the day's week, NULL in weeks without one.

    The calendar has one row per day and is small by nature; it is left to Spark's own size
    check. The price side is the large one and joins on all three keys."""
    weeks = calendar.select("date", week)
    return (
        sales.join(weeks, "date", "left")
        .join(prices.select("item_id", "store_id", week, "sell_price"), ["item_id", "store_id", week], "left")
    )


def attach_weekly_price(
    sales: DataFrame, prices: DataFrame, week: str = "wm_yr_wk", panel: Panel = PANEL
) -> DataFrame:
    """The same left join for a panel that is already partitioned by series.

    Prices are folded to one row per series holding its week -> price map (as many entries as
    the calendar has weeks), so the join key is the series alone: the wide panel side is not
    shuffled again on (series, week) and the windows that follow reuse its partitioning.
    ``sales`` must carry the week column. Prices must be unique per series and week.

    The folded prices of a partition are hashed, a few kB a series, so the panel is not sorted for the join: the sort
    by day of the windows that follow is the only one.
    """
    by_series = prices.groupBy(*panel.keys).agg(
        F.map_from_entries(F.collect_list(F.struct(week, "sell_price"))).alias("_prices")
    )
    return (
        sales.join(by_series.hint("shuffle_hash"), list(panel.keys), "left")
        .withColumn("sell_price", F.try_element_at("_prices", F.col(week)))
        .drop("_prices")
    )


def left_flag(df: DataFrame, members: DataFrame, on: list[str], flag: str) -> DataFrame:
    """Boolean membership of each row's key; duplicates among the members add no rows."""
    marked = members.select(*on).distinct().withColumn("_member", F.lit(True))
    return (
        df.join(marked, on, "left")
        .withColumn(flag, F.coalesce("_member", F.lit(False)))
        .drop("_member")
    )


def left_join_where(
    df: DataFrame, other: DataFrame, on: list[str], condition: Column
) -> DataFrame:
    """Left join whose ON clause also carries a condition on the left row: rows that fail it
    stay, without a match. The right side's columns must not repeat the left side's."""
    renamed = other
    for c in on:
        renamed = renamed.withColumnRenamed(c, f"_r_{c}")
    cond = condition
    for c in on:
        cond = cond & (F.col(c) == F.col(f"_r_{c}"))
    return df.join(renamed, cond, "left").drop(*[f"_r_{c}" for c in on])


def select_series(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Composite-key semi join; Spark broadcasts the key list only while it is small."""
    return df.join(keys.select(*on), on, "left_semi")


def inline_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A literal table given in the query text."""
    return spark.createDataFrame(rows, schema)


def first_row_per_key(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """``drop duplicates`` with a defined winner: the row with the smallest ``order``.

    A min_by aggregate combines map-side; no key's rows are gathered or sorted."""
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.min_by(F.struct(*rest), F.col(order)).alias("_row"))
        .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])
    )


def top_row_per_label(df: DataFrame, labels: dict[str, Column], order: list[Column]) -> DataFrame:
    """The leading row among those meeting each label's condition, one branch per label.

    ``order`` must be total. Each branch is a TakeOrdered of one row."""
    out = None
    for label, condition in labels.items():
        top = df.where(condition).orderBy(*order).limit(1).withColumn("tipo", F.lit(label))
        out = top if out is None else out.unionByName(top)
    return out
