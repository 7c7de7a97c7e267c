"""Date-derived column expressions. All deterministic functions of the row's own date."""

from __future__ import annotations

import math
from dataclasses import dataclass
from datetime import date as Date

from pyspark.sql import Column
from pyspark.sql import functions as F


def sunday_week(d: Column) -> Column:
    """Week of the year, weeks start on Sunday, days before the first Sunday are week 0."""
    return F.floor((F.dayofyear(d) + 7 - F.dayofweek(d)) / 7).cast("int")


def date_parts(d: Column) -> dict[str, Column]:
    return {
        "day_of_week": F.dayofweek(d),
        "day_of_month": F.dayofmonth(d),
        "month": F.month(d),
        "year": F.year(d),
        "week_of_year": sunday_week(d),
    }


def days_since(d: Column, epoch: Date) -> Column:
    """Global day index: equal for all series on one date, so seasonal phases line up."""
    return F.datediff(d, F.lit(epoch))


@dataclass(frozen=True)
class Seasonality:
    name: str
    period: float
    terms: int


# Seasonal periods in days and the number of harmonics of each.
SEASONALITIES = (
    Seasonality("week", 7.0, 3),
    Seasonality("semester", 182.625, 3),
    Seasonality("year", 365.25, 5),
)


def fourier(index: Column, seasonalities=SEASONALITIES) -> dict[str, Column]:
    """sin/cos pairs of ``index`` for every harmonic of every seasonality."""
    out = {}
    for s in seasonalities:
        for k in range(1, s.terms + 1):
            angle = F.lit(2.0 * math.pi * k) * index / F.lit(float(s.period))
            out[f"fourier_{s.name}_sin_{k}"] = F.sin(angle)
            out[f"fourier_{s.name}_cos_{k}"] = F.cos(angle)
    return out


def event_flags(
    d: Column, name_1: Column, name_2: Column, type_1: Column
) -> dict[str, Column]:
    """``is_event`` looks at either name, ``is_christmas`` at the date only, and the recoded
    type at the first name: a day with just a second event is an event without a type."""
    return {
        "is_event": (name_1.isNotNull() | name_2.isNotNull()).cast("int"),
        "is_christmas": ((F.month(d) == 12) & (F.dayofmonth(d) == 25)).cast("int"),
        "event_type": F.when(name_1 == "Christmas", "Store_Closure").otherwise(type_1),
    }


def prefix_switch(key: Column, choices: dict[str, Column]) -> Column:
    """The column whose prefix matches ``key``; NULL when none does."""
    out = None
    for prefix, column in choices.items():
        cond = key.startswith(prefix)
        out = F.when(cond, column) if out is None else out.when(cond, column)
    return out
