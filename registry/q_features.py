"""Per-series windows, calendar expressions and the feature table."""

from pyspark.sql import functions as F

from panelcast.functions.calendar import date_parts, days_since, event_flags, fourier
from panelcast.functions.numeric import rounded, tri_state_changed
from panelcast.operators import windows as wn
from panelcast.operators.folds import fold_overlaps
from panelcast.operators.relational import attach_weekly_price
from registry.core import query
from registry.q_reshape import R
from registry.sql import wave_columns

KEYS = ["item_id", "store_id", "date"]
# averages of cents over 2^k days end in an exact ...5: shift both sides off the rounding tie
TIE = " + 1e-9"
_frame = "over (partition by item_id, store_id order by date rows between {n} preceding and 1 preceding)"


@query(
    "lags",
    "select item_id, store_id, date, "
    + ", ".join(
        f"lag(sales, {n}) over (partition by item_id, store_id order by date) as lag_{n}" for n in (7, 14, 28, 182)
    )
    + " from sales_long",
)
def _(q):
    return wn.add_lags(q.sales_long()).drop("sales")


@query(
    "rolling_mean",
    f"""select item_id, store_id, date, {R('avg(sales) ' + _frame.format(n=7))} as roll_mean_7,
               {R('avg(sales) ' + _frame.format(n=28))} as roll_mean_28 from sales_long""",
)
def _(q):
    out = wn.add_rolling(q.sales_long(), stds=(), zero_shares=())
    return out.select(*KEYS, *[rounded(F.col(c)).alias(c) for c in ("roll_mean_7", "roll_mean_28")])


@query(
    "rolling_std",
    f"select item_id, store_id, date, {R('stddev_samp(sales) ' + _frame.format(n=28), 4)} as roll_std_28 from sales_long",
)
def _(q):
    out = wn.add_rolling(q.sales_long(), means=(), zero_shares=())
    return out.select(*KEYS, rounded(F.col("roll_std_28"), 4).alias("roll_std_28"))


@query(
    "rolling_zero_share",
    f"""select item_id, store_id, date,
          {R('avg(case when sales = 0 then cast(1 as double) else cast(0 as double) end) ' + _frame.format(n=28))} as pct_zeros_28d
        from sales_long""",
)
def _(q):
    out = wn.add_rolling(q.sales_long(), means=(), stds=())
    return out.select(*KEYS, rounded(F.col("pct_zeros_28d")).alias("pct_zeros_28d"))


@query(
    "days_since_last_sale",
    """select item_id, store_id, date, cast(datediff('day', max(case when sales > 0 then date end) over
         (partition by item_id, store_id order by date rows between unbounded preceding and 1 preceding), date) as int) as days_since_last_sale
       from sales_long""",
)
def _(q):
    return wn.add_days_since_last_sale(q.sales_long()).drop("sales")


def _priced(q, only=None):
    """The panel with the day's price; with ``only``, of the days of that frame."""
    q.store_records()
    sales = q.sales_long() if only is None else q.sales_long().join(only, "date", "left_semi")
    days = sales.join(q.calendar().select("date", "wm_yr_wk"), "date", "left")
    return attach_weekly_price(days, q.sell_prices())


_priced_sql = """(select s.item_id, s.store_id, s.date, p.sell_price from sales_long s left join calendar c on c.date = s.date
  left join sell_prices p on p.item_id = s.item_id and p.store_id = s.store_id and p.wm_yr_wk = c.wm_yr_wk)"""


@query(
    "moving_avg_365",
    f"""select item_id, store_id, date, {R('avg(sell_price) ' + _frame.format(n=365) + TIE)} as price_moving_avg_365
        from {_priced_sql}""",
)
def _(q):
    out = wn.add_moving_average(_priced(q), "sell_price", 365, "price_moving_avg_365", decimals=2)
    return out.select(*KEYS, rounded(F.col("price_moving_avg_365") + 1e-9).alias("price_moving_avg_365"))


@query(
    "price_lags",
    f"""select item_id, store_id, date, lag(sell_price, 1) over w as prev_day_price, lag(sell_price, 28) over w as lag_price_28
        from {_priced_sql} window w as (partition by item_id, store_id order by date)""",
)
def _(q):
    w = wn.series_window()
    return _priced(q).select(
        *KEYS,
        F.lag("sell_price", 1).over(w).alias("prev_day_price"),
        F.lag("sell_price", 28).over(w).alias("lag_price_28"),
    )


_price_features = f"""select item_id, store_id, date, {{cols}} from (
  select *, lag(sell_price, 1) over w as prev, lag(sell_price, 28) over w as old,
         avg(sell_price) {_frame.format(n=365)} as mean
  from {_priced_sql} window w as (partition by item_id, store_id order by date))"""


@query("price_ratio", _price_features.format(cols=R("case when mean <> 0 then sell_price / mean end" + TIE) + " as price_rel_mean"))
def _(q):
    out = wn.add_moving_average(_priced(q), "sell_price", 365, "mean", decimals=2)
    ratio = F.try_divide("sell_price", F.col("mean"))
    return out.select(*KEYS, rounded(ratio + 1e-9).alias("price_rel_mean"))


@query(
    "price_momentum",
    _price_features.format(cols=R("case when old <> 0 then (sell_price - old) / old end") + " as price_momentum_4w"),
)
def _(q):
    old = F.lag("sell_price", 28).over(wn.series_window())
    out = _priced(q).withColumn("old", old)
    return out.select(
        *KEYS, rounded(F.try_divide(F.col("sell_price") - F.col("old"), "old")).alias("price_momentum_4w")
    )


@query(
    "price_changed",
    _price_features.format(
        cols="""case when prev is null or sell_price is null then null when sell_price <> prev then 1 else 0 end as price_changed"""
    ),
)
def _(q):
    previous = F.lag("sell_price", 1).over(wn.series_window())
    return _priced(q).withColumn("prev", previous).select(
        *KEYS, tri_state_changed(F.col("sell_price"), F.col("prev")).alias("price_changed")
    )


@query(
    "event_distance",
    """select f.date, cast(days_to_next_event as int) as days_to_next_event,
              cast(days_from_last_event as int) as days_from_last_event, count(o.item_id) as n_series
       from calendar_features f left join observed o on o.date = f.date group by 1, 2, 3""",
)
def _(q):
    named = F.col("event_name_1").isNotNull() | F.col("event_name_2").isNotNull()
    days = wn.add_event_distance(q.calendar(), named)
    sold = q.observed().groupBy("date").agg(F.count(F.lit(1)).alias("n"))
    return days.join(sold, "date", "left").select(
        "date", "days_to_next_event", "days_from_last_event", F.coalesce("n", F.lit(0)).alias("n_series")
    )


@query(
    "row_number_series",
    """select item_id, store_id, date, rn from (select *, cast(row_number() over (partition by item_id, store_id order by date) as int) as rn
       from observed) where rn in (1, 100, 500, 1000)""",
)
def _(q):
    return wn.add_row_number(q.observed()).where(F.col("rn").isin(1, 100, 500, 1000)).drop("sales")


@query(
    "calendar_parts",
    """select l_orderkey, l_linenumber, dayofweek(d) + 1 as day_of_week, day(d) as day_of_month, month(d) as month,
              year(d) as year, cast(strftime(d, '%U') as int) as week_of_year
       from (select l_orderkey, l_linenumber, cast(l_shipdate as date) as d from lineitem)""",
)
def _(q):
    lines = q.table("lineitem").select("l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("d"))
    return lines.select(
        "l_orderkey", "l_linenumber", *[c.alias(n) for n, c in date_parts(F.col("d")).items()]
    )


@query(
    "days_since_start",
    """select o_orderkey, cast(datediff('day', date '1995-01-02', cast(o_orderdate as date)) as int) as days_since_start from orders""",
)
def _(q):
    from datetime import date

    return q.table("orders").select(
        "o_orderkey", days_since(F.col("o_orderdate").cast("date"), date(1995, 1, 2)).alias("days_since_start")
    )


@query(
    "fourier",
    "select o_orderkey, "
    + ", ".join(f"{R(e)} as {n}" for n, e in wave_columns("t"))
    + " from (select o_orderkey, cast(datediff('day', date '1995-01-02', cast(o_orderdate as date)) as double) as t from orders)",
)
def _(q):
    from datetime import date

    index = days_since(F.col("o_orderdate").cast("date"), date(1995, 1, 2)).cast("double")
    return q.table("orders").select("o_orderkey", *[rounded(c).alias(n) for n, c in fourier(index).items()])


@query(
    "event_flags",
    """select date, is_event, is_christmas, event_type, count(item_id) as n_series
       from calendar_features left join observed using (date) group by 1, 2, 3, 4""",
)
def _(q):
    flags = event_flags(F.col("date"), F.col("event_name_1"), F.col("event_name_2"), F.col("event_type_1"))
    days = q.calendar().select("date", *[c.alias(n) for n, c in flags.items()])
    sold = q.observed().groupBy("date").agg(F.count(F.lit(1)).alias("n"))
    return days.join(sold, "date", "left").select(
        "date", "is_event", "is_christmas", "event_type", F.coalesce("n", F.lit(0)).alias("n_series")
    )


_exact = [
    "is_event", "is_christmas", "days_to_next_event", "days_from_last_event", "snap_active",
    "lag_7", "lag_14", "lag_28", "lag_182", "day_of_week", "day_of_month", "month", "year",
    "week_of_year", "days_since_start", "days_since_last_sale", "price_changed", "sales",
]
_double = [
    "sell_price", "roll_mean_7", "roll_mean_28", "roll_std_28", "pct_zeros_28d", "price_rel_mean",
    "price_momentum_4w", "lag_price_28", *[n for n, _ in wave_columns("t")],
]


@query(
    "build_features",
    "select item_id, store_id, year(date) as y, month(date) as m, count(event_type) as event_type_n, "
    + ", ".join(f"cast(sum({c}) as bigint) as {c}, count({c}) as {c}_n" for c in _exact)
    + ", "
    + ", ".join(f"{R(f'sum({c})', 4)} as {c}, count({c}) as {c}_n" for c in _double)
    + " from features group by 1, 2, 3, 4",
)
def _(q):
    """All feature columns, summed and counted per series and month."""
    features = q.features()
    aggs = [F.count("event_type").alias("event_type_n")]
    aggs += [F.sum(F.col(c).cast("long")).alias(c) for c in _exact]
    aggs += [rounded(F.sum(c), 4).alias(c) for c in _double]
    aggs += [F.count(c).alias(f"{c}_n") for c in _exact + _double]
    month = [F.year("date").alias("y"), F.month("date").alias("m")]
    return features.groupBy("item_id", "store_id", *month).agg(*aggs)


@query(
    "feature_rows",
    f"""select item_id, store_id, date, sales, lag_28, {R('roll_mean_28')} as roll_mean_28, {R('roll_std_28', 4)} as roll_std_28,
          cast(days_to_next_event as int) as days_to_next_event, snap_active, event_type, {R('fourier_year_cos_5')} as fourier_year_cos_5,
          {R('price_rel_mean' + TIE)} as price_rel_mean, price_changed from features where date >= (select max(date) - 27 from spine)""",
)
def _(q):
    """The validation window of the feature table, row by row."""
    from datetime import timedelta

    rows = q.features().where(F.col("date") >= F.lit(q.bounds[1] - timedelta(days=27)))
    return rows.select(
        *KEYS, "sales", "lag_28", rounded(F.col("roll_mean_28")).alias("roll_mean_28"),
        rounded(F.col("roll_std_28"), 4).alias("roll_std_28"), "days_to_next_event", "snap_active",
        "event_type", rounded(F.col("fourier_year_cos_5")).alias("fourier_year_cos_5"),
        rounded(F.col("price_rel_mean") + 1e-9).alias("price_rel_mean"), "price_changed",
    )


#: Doubles are compared to four digits; the offset keeps values that end in 5 away from the edge of a step.
_STEP = 0.3141592653


def _cell_sql(c: str) -> str:
    value = f"floor({c} * 10000 + {_STEP})" if c in _double else c
    return f"coalesce(cast(cast({value} as bigint) as varchar), '~')"


@query(
    "feature_table",
    f"""select item_id, store_id, date, sales, md5(concat_ws('|', coalesce(event_type, '~'), {", ".join(_cell_sql(c) for c in _exact + _double)})) as row_md5
        from features""",
)
def _(q):
    """All columns of all rows of the feature table: keys, target, and one hash of the other columns."""
    def cell(c):
        value = F.floor(F.col(c) * 10000 + _STEP) if c in _double else F.col(c).cast("long")
        return F.coalesce(value.cast("string"), F.lit("~"))

    rows = q.features()
    assert set(rows.columns) == {*KEYS, "event_type", *_exact, *_double}, "a column is not compared"
    text = F.concat_ws("|", F.coalesce("event_type", F.lit("~")), *[cell(c) for c in _exact + _double])
    return rows.select(*KEYS, "sales", F.md5(text.cast("binary")).alias("row_md5"))


@query(
    "fold_overlap",
    """select f.fold_id, f.val_start, f.val_end, n.val_start as next_val_start,
              coalesce(n.val_start <= f.val_end, false) as overlaps, count(o.item_id) as n_records
       from folds f left join folds n on n.fold_id = f.fold_id + 1
       left join observed o on o.date between f.val_start and f.val_end group by all""",
)
def _(q):
    from panelcast.operators.folds import split_folds

    records = (
        split_folds(q.observed(), q.folds(), roles=("val",))
        .groupBy("fold_id")
        .agg(F.count(F.lit(1)).alias("n_records"))
    )
    return fold_overlaps(q.folds()).join(records, "fold_id", "left").select(
        "fold_id", "val_start", "val_end", "next_val_start", "overlaps",
        F.coalesce("n_records", F.lit(0)).alias("n_records"),
    )
