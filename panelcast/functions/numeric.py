"""Numeric column expressions with the NULL and NaN behaviour the operators rely on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelcast.schema import QUANTILES, Z_SCORES


def clip_low(x: Column, low: float = 0.0) -> Column:
    """max(x, low) that keeps NULL. ``greatest`` alone skips NULL, so a missing standard
    error would quietly turn into a zero quantile."""
    return F.when(x.isNotNull(), F.greatest(x, F.lit(low)))


def normal_quantiles(mean: Column, sd: Column, z: dict[str, float] = Z_SCORES) -> dict[str, Column]:
    """Clipped normal quantiles; the median needs no spread, so it stays valid without one."""
    return {
        name: clip_low(mean.cast("double") if score == 0.0 else mean + F.lit(score) * sd)
        for name, score in z.items()
    }


def pinball(level: Column, actual: Column, predicted: Column) -> Column:
    error = actual - predicted
    return F.greatest(level * error, (level - F.lit(1.0)) * error)


def sorted_quantiles(names=tuple(QUANTILES)) -> dict[str, Column]:
    """Re-assign the row's quantile values in ascending order (removes crossings).

    NaN sorts behind all numbers and NULL behind NaN, so missing values end up as the largest levels."""
    ordered = F.array_sort(F.array(*[F.col(n) for n in names]))
    return {n: F.element_at(ordered, i + 1) for i, n in enumerate(names)}


def bucket(x: Column, cuts: list[float], labels: list[str]) -> Column:
    """Label of the first cut that ``x`` lies below; the last label above all cuts."""
    out = F.when(x < cuts[0], labels[0])
    for cut, label in zip(cuts[1:], labels[1:]):
        out = out.when(x < cut, label)
    return out.otherwise(labels[-1])


def exceeds(x: Column, threshold: float) -> Column:
    """x > threshold where NaN compares as false (Spark itself sorts NaN above everything)."""
    return F.coalesce(~F.isnan(x) & (x > F.lit(threshold)), F.lit(False))


def missing(x: Column) -> Column:
    """NULL or NaN."""
    return x.isNull() | F.isnan(x)


def tri_state_changed(current: Column, previous: Column) -> Column:
    """1 changed, 0 unchanged, NULL when either side is unknown."""
    return F.when(current.isNotNull() & previous.isNotNull(), (current != previous).cast("int"))


def rounded(x: Column, digits: int = 6) -> Column:
    """Rounded double without a negative zero."""
    return F.round(x.cast("double"), digits) + F.lit(0.0)


def order_of(label: Column, ordered: list[str]) -> Column:
    """Position of a label in a fixed report order (1-based), NULL when absent."""
    pos = F.array_position(F.array(*[F.lit(v) for v in ordered]), label)
    return F.when(pos > 0, pos)
