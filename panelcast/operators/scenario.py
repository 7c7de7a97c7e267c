"""Quantiles of sums over series: joint sample paths of the forecasts, summed path by path.

A quantile of a sum is not the sum of quantiles; it depends on how the series move together. Every series draws one value per path
from its own quantiles, at a rank between 0 and 1, and the ranks carry the dependence: the same for all
series (comonotone), unrelated (independent), or those that its values had on the same days of the past (history).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions.keys import hash_key
from panelcast.schema import PANEL, QUANTILES, Panel

DEPENDENCE = ("independent", "comonotone", "history")


def quantile_at(u: Column, levels: dict[str, float] = QUANTILES) -> Column:
    """Value at rank ``u`` of the quantile columns, linear between levels and level beyond the first and last.
    NULL where a quantile is missing."""
    names, cuts = list(levels), list(levels.values())
    out = F.when(u <= cuts[0], F.col(names[0]))
    for (low, a), (high, b) in zip(zip(names, cuts), zip(names[1:], cuts[1:])):
        out = out.when(u <= b, F.col(low) + (F.col(high) - F.col(low)) * ((u - a) / (b - a)))
    whole = F.lit(True)
    for n in names:
        whole = whole & F.col(n).isNotNull() & ~F.isnan(n)
    return F.when(whole, out.otherwise(F.col(names[-1])))


def path_ranks(history: DataFrame, paths: int, panel: Panel = PANEL) -> DataFrame:
    """(fold_id, keys, path, rank): of each series' last ``paths`` training days, counted back from the fold's last, the rank of the value
    among them (ties by date). A path is the same day for every series, so series that rose together share high ranks."""
    back = F.datediff(F.max(panel.date).over(Window.partitionBy("fold_id")), F.col(panel.date))
    last = history.withColumn("path", back.cast("int")).where(F.col("path") < paths)
    mine = ["fold_id", *panel.keys]
    order = F.row_number().over(Window.partitionBy(*mine).orderBy(panel.value, panel.date))
    n = F.count("*").over(Window.partitionBy(*mine))
    return last.select(*mine, "path", ((order - 0.5) / n).alias("rank"))


def sample_paths(
    predictions: DataFrame, dependence: str, paths: int = 100, ranks: DataFrame | None = None, panel: Panel = PANEL
) -> DataFrame:
    """Prediction rows times ``paths``, with ``value``: the draw of the row's series and day on each path."""
    if dependence not in DEPENDENCE:
        raise ValueError(f"unknown dependence {dependence}")
    if dependence == "history":
        # merged: stored forecasts repeat themselves and look small enough to broadcast, whatever their number of rows
        drawn = predictions.hint("merge").join(ranks, ["fold_id", *panel.keys])
    else:
        drawn = predictions.withColumn("path", F.explode(F.sequence(F.lit(0), F.lit(paths - 1))))
        rank = (F.col("path") + 0.5) / paths
        if dependence == "independent":
            key = hash_key([F.col(k).cast("string") for k in (*panel.keys, panel.date, "path")], "path")
            rank = (F.conv(F.substring(key, 1, 8), 16, 10).cast("long") + 0.5) / float(1 << 32)
        drawn = drawn.withColumn("rank", rank)
    return drawn.withColumn("value", quantile_at(F.col("rank")))


def quantiles_of_sums(
    predictions: DataFrame, groups: DataFrame, by: list[str], dependence: str, paths: int = 100, ranks: DataFrame | None = None,
    panel: Panel = PANEL,
) -> DataFrame:
    """Quantiles of the sum over the series of each group, day and fold.

    ``groups`` brings the keys and the columns of ``by`` that are not keys. Draws are summed by path map-side, so what shuffles
    has one row for a group, day and path; ``paths`` sums make the group's quantiles."""
    keys = list(panel.keys)
    drawn = sample_paths(predictions, dependence, paths, ranks, panel).join(groups.select(*keys, *[c for c in by if c not in keys]), keys)
    sums = drawn.groupBy("fold_id", panel.date, *by, "path").agg(F.sum("value").alias("total"))
    levels = F.array(*[F.lit(v) for v in QUANTILES.values()])
    found = sums.groupBy("fold_id", panel.date, *by).agg(F.percentile("total", levels).alias("q"))
    return found.select("fold_id", panel.date, *by, *[F.col("q")[i].alias(n) for i, n in enumerate(QUANTILES)])
