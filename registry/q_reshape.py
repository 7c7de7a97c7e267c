"""Reshape, projections, predicates."""

from pyspark.sql import functions as F

from panelcast.functions.calendar import prefix_switch
from panelcast.functions.keys import category_by_pattern, category_of, parse_series_id
from panelcast.functions.numeric import bucket, clip_low, missing, rounded
from panelcast.operators import encode as en
from panelcast.operators import evaluate as ev
from panelcast.operators import profile as pf
from panelcast.operators import reshape as rs
from panelcast.operators.folds import split_folds
from panelcast.operators.relational import half_open
from panelcast.schema import CATEGORICAL_FEATURES, ZERO_RATE_LABELS
from panelcast.session import checkpoint
from registry.core import query
from registry.inputs import STATE_FLAGS, WIDE_DAYS


def R(x, digits=6):
    """SQL: rounded double without a negative zero."""
    return f"(round(cast({x} as double), {digits}) + 0)"


_days = ", ".join(f"d_{i}" for i in range(1, WIDE_DAYS + 1))


@query(
    "wide_to_long",
    f"""select id, array_to_string(string_split(id, '_')[1:3], '_') as item_id,
               array_to_string(string_split(id, '_')[4:5], '_') as store_id,
               month_start + cast(substr(k, 3) as int) - 1 as date, v as sales
        from (unpivot sales_wide on {_days} into name k value v)""",
)
def _(q):
    return rs.wide_to_long(q.sales_wide(), F.col("month_start"), keep_id=True)


@query(
    "wide_to_long_days",
    """select concat(item_id, '_', store_id, '_validation') as id, item_id, store_id, date, sales from sales_long
       where not (sales = 0 and day(date) % 13 = 0)
         and not (store_id like 'AS%' and date > (select max(date) - 28 from sales_long))""",
)
def _(q):
    """A column for each day of the panel."""
    return rs.wide_to_long(q.sales_wide_days(), q.bounds[0], keep_id=True)


@query(
    "parse_series_id",
    """select id, array_to_string(string_split(id, '_')[1:3], '_') as item_id,
              array_to_string(string_split(id, '_')[4:5], '_') as store_id, count(*) as n_months
       from sales_wide group by 1, 2, 3""",
)
def _(q):
    parsed = {n: c.alias(n) for n, c in parse_series_id(F.col("id")).items()}
    return (
        q.sales_wide()
        .groupBy("id")
        .agg(F.count(F.lit(1)).alias("n_months"))
        .select("id", *parsed.values(), "n_months")
    )


@query(
    "unpivot_quantiles",
    f"""select model, fold_id, item_id, store_id, date, quantile_name, {R('y_pred')} as y_pred
        from (unpivot predictions on p05, p25, p50, p75, p95 into name quantile_name value y_pred)
        where not isnan(y_pred)""",
)
def _(q):
    long = rs.unpivot_quantiles(ev.stack_models(q.predictions()))
    return long.withColumn("y_pred", rounded(F.col("y_pred")))


@query(
    "pivot_models",
    f"""select categoria_zero_rate,
          {R("sum(case when model = 'arima' then s end) / sum(case when model = 'arima' then n end)")} as arima,
          {R("sum(case when model = 'bqml' then s end) / sum(case when model = 'bqml' then n end)")} as bqml,
          {R("sum(case when model = 'lgbm' then s end) / sum(case when model = 'lgbm' then n end)")} as lgbm,
          cast(case categoria_zero_rate when 'rapido' then 1 when 'medio' then 2 when 'lento' then 3 else 4 end as bigint) as row_order
        from (select model, categoria_zero_rate, sum(pinball_loss) as s, count(*) as n from fact
              where not bqml_unstable_series group by 1, 2) group by 1""",
)
def _(q):
    fact = q.fact()
    table = ev.model_table(ev.metrics_by_zero_rate(fact), "categoria_zero_rate", ZERO_RATE_LABELS)
    return table.select(
        "categoria_zero_rate",
        *[rounded(F.col(m)).alias(m) for m in ("arima", "bqml", "lgbm")],
        F.col("row_order").cast("long"),
    )


@query(
    "pivot_convergence",
    f"""select fold_id, count(*) filter (convergio) as n_convergio,
               count(*) filter (not convergio) as n_fallo,
               {R("100.0 * count(*) filter (convergio) / count(*)")} as pct_converged
        from arima_metadata group by 1""",
)
def _(q):
    out = rs.pivot_convergence(q.arima_metadata())
    return out.withColumn("pct_converged", rounded(F.col("pct_converged")))


@query(
    "densify",
    """select item_id, store_id, date, sales from sales_long""",
)
def _(q):
    return q.sales_long()


@query(
    "gap_report",
    """select item_id, store_id, count(*) as n_present,
              (select count(*) from spine) - count(*) as n_missing
       from observed group by 1, 2""",
)
def _(q):
    report = rs.gap_report(q.observed(), *q.bounds)
    return report.withColumn("n_missing", F.col("n_missing").cast("long"))


@query(
    "date_spine",
    """select p.date, count(o.o_orderkey) as n_orders, cast(row_number() over (order by p.date) as int) as day_number
       from spine p left join orders o on cast(o.o_orderdate as date) = p.date group by p.date""",
)
def _(q):
    orders = (
        q.table("orders")
        .groupBy(F.col("o_orderdate").cast("date").alias("date"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        q.spine()
        .join(orders, "date", "left")
        .select(
            "date",
            F.coalesce("n", F.lit(0)).alias("n_orders"),
            (F.datediff("date", F.lit(q.bounds[0])) + 1).alias("day_number"),
        )
    )


@query(
    "interpolate",
    f"""select item_id, store_id, date,
          {R('''case when sales is not null then sales when prev_d is null then null when next_d is null then prev_v
               else prev_v + (next_v - prev_v) * cast(datediff('day', prev_d, date) as double) / datediff('day', prev_d, next_d) end''')} as sales
        from (select *, last_value(case when sales is not null then date end ignore nulls) over back as prev_d,
                last_value(sales ignore nulls) over back as prev_v,
                first_value(case when sales is not null then date end ignore nulls) over ahead as next_d,
                first_value(sales ignore nulls) over ahead as next_v
              from (select k.item_id, k.store_id, p.date, o.sales
                    from (select distinct item_id, store_id from observed) k cross join spine p
                    left join observed o using (item_id, store_id, date))
              window back as (partition by item_id, store_id order by date rows between unbounded preceding and current row),
                     ahead as (partition by item_id, store_id order by date rows between current row and unbounded following))""",
)
def _(q):
    gaps = rs.densify(q.observed(), *q.bounds, fill=None)
    return rs.interpolate(gaps).withColumn("sales", rounded(F.col("sales")))


@query(
    "filter_window",
    """select f.fold_id,
              count(*) filter (s.date >= f.train_start and s.date < f.val_start) as n_half_open,
              count(*) filter (s.date between f.val_start and f.val_end) as n_closed,
              cast(sum(s.sales) filter (s.date between f.val_start and f.val_end) as bigint) as val_sales
       from sales_long s join folds f on s.date between f.train_start and f.val_end group by 1""",
)
def _(q):
    both = split_folds(q.sales_long(), q.folds()).join(q.folds(), "fold_id")
    d = F.col("date")
    closed = d.between(F.col("val_start"), F.col("val_end"))
    return both.groupBy("fold_id").agg(
        F.count_if(half_open(d, F.col("train_start"), F.col("val_start"))).alias("n_half_open"),
        F.count_if(closed).alias("n_closed"),
        F.sum(F.when(closed, F.col("sales"))).alias("val_sales"),
    )


@query("project_except", "select * exclude (l_extendedprice, l_discount, l_tax, l_shipdate) from lineitem")
def _(q):
    return q.table("lineitem").drop("l_extendedprice", "l_discount", "l_tax", "l_shipdate")


@query(
    "case_bucket",
    """select item_id, store_id, case when n < 100 then 'rapido' when n < 400 then 'medio'
              when n < 1500 then 'lento' else 'muy_lento' end as label, n
       from (select item_id, store_id, count(*) as n from observed group by 1, 2)""",
)
def _(q):
    counts = q.observed().groupBy("item_id", "store_id").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("label", bucket(F.col("n"), [100, 400, 1500], ZERO_RATE_LABELS))


@query(
    "state_switch",
    """select s.store_id, s.date, case when store_id like 'AF%' then snap_AF when store_id like 'AM%' then snap_AM
              when store_id like 'AS%' then snap_AS end as snap_active, cast(sum(s.sales) as bigint) as sales
       from sales_long s join calendar c on c.date = s.date group by 1, 2, 3""",
)
def _(q):
    by_store = q.observed().groupBy("store_id", "date").agg(F.sum("sales").alias("sales"))
    stores = q.observed().select("store_id").distinct()
    days = stores.withColumn(
        "date", F.explode(F.sequence(F.lit(q.bounds[0]), F.lit(q.bounds[1])))
    ).join(by_store, ["store_id", "date"], "left")
    switch = prefix_switch(F.col("store_id"), {p: F.col(c) for p, c in STATE_FLAGS.items()})
    return days.join(q.calendar(), "date").select(
        "store_id", "date", switch.alias("snap_active"), F.coalesce("sales", F.lit(0)).alias("sales")
    )


@query(
    "null_predicates",
    """select store_id, count(*) filter (event_name_1 is null) as n_null,
              count(*) filter (event_name_2 is not null) as n_not_null,
              count(*) filter (not (sales > 0)) as n_not,
              count(*) filter (event_type_1 in ('National', 'Cultural')) as n_in,
              (select count(*) from pred_bqml b where b.store_id = s.store_id and isnan(p95)) as n_nan
       from sales_long s join calendar using (date) group by 1""",
)
def _(q):
    counts = (
        q.sales_long()
        .join(q.calendar(), "date")
        .groupBy("store_id")
        .agg(
            F.count_if(F.col("event_name_1").isNull()).alias("n_null"),
            F.count_if(F.col("event_name_2").isNotNull()).alias("n_not_null"),
            F.count_if(~(F.col("sales") > 0)).alias("n_not"),
            F.count_if(F.col("event_type_1").isin("National", "Cultural")).alias("n_in"),
        )
    )
    nan = q.predictions()["bqml"].groupBy("store_id").agg(F.count_if(missing(F.col("p95"))).alias("n_nan"))
    return counts.join(nan, "store_id")


@query(
    "clip_low",
    f"""select item_id, store_id, date, case when sales > 0 then {R('greatest(sales - 40, 0)')} end as clipped
        from sales_long""",
)
def _(q):
    x = F.when(F.col("sales") > 0, (F.col("sales") - 40).cast("double"))
    return q.sales_long().select("item_id", "store_id", "date", rounded(clip_low(x)).alias("clipped"))


@query(
    "sentinel_fill",
    """select coalesce(price_changed, -1) as price_changed, coalesce(snap_active, -1) as snap_active,
              count(*) as n_rows from features group by 1, 2""",
)
def _(q):
    filled = en.fill_sentinel(q.features())
    return filled.groupBy("price_changed", "snap_active").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "encode_categoricals",
    """with cats as (select distinct event_type from features where event_type is not null),
            weeks as (select distinct cast(week_of_year as varchar) as w from features),
            d1 as (select event_type, cast(dense_rank() over (order by event_type) - 1 as int) as code from cats),
            d2 as (select w, cast(dense_rank() over (order by w) - 1 as int) as code from weeks)
       select f.event_type, f.week_of_year, d1.code as event_type_code, d2.code as week_of_year_code,
              count(*) as n_rows
       from features f left join d1 on d1.event_type = f.event_type
       left join d2 on d2.w = cast(f.week_of_year as varchar) group by all""",
)
def _(q):
    columns = ["event_type", "week_of_year"]
    features = checkpoint(q.features().select(*columns), "categoricals")  # read by the dictionary and by the codes
    coded = en.encode(features, en.category_dictionary(features, columns), columns)
    return coded.groupBy(*columns, "event_type_code", "week_of_year_code").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


@query(
    "encode_all_categoricals",
    "with " + ", ".join(
        f"""d_{c} as (select v, cast(dense_rank() over (order by v) - 1 as int) as code
                      from (select distinct cast({c} as varchar) as v from features where {c} is not null))"""
        for c in CATEGORICAL_FEATURES
    )
    + f" select {', '.join(f'f.{c}, d_{c}.code as {c}_code' for c in CATEGORICAL_FEATURES)}, count(*) as n_rows from features f "
    + " ".join(f"left join d_{c} on d_{c}.v = cast(f.{c} as varchar)" for c in CATEGORICAL_FEATURES)
    + " group by all",
)
def _(q):
    """Codes of every categorical feature, and the rows of each combination."""
    features = checkpoint(q.features().select(*CATEGORICAL_FEATURES), "categoricals")  # read by the dictionary and by the codes
    coded = en.encode(features, en.category_dictionary(features))
    return coded.groupBy(*CATEGORICAL_FEATURES, *[f"{c}_code" for c in CATEGORICAL_FEATURES]).agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "series_extract",
    "select item_id, store_id, date, sales from sales_long where item_id = 'STANDARD_0_001' and store_id = 'AM_1'",
)
def _(q):
    return pf.series_extract(q.sales_long(), {"item_id": "STANDARD_0_001", "store_id": "AM_1"})


@query(
    "series_stats",
    f"""select item_id, store_id, cast(sum(sales) as bigint) as total_ventas,
              {R("100.0 * count(*) filter (sales = 0) / count(*)", 2)} as pct_ceros, {R("avg(sales)")} as venta_media
        from sales_long group by 1, 2""",
)
def _(q):
    return pf.series_stats(q.sales_long()).select(
        "item_id", "store_id", "total_ventas", rounded(F.col("pct_ceros"), 2).alias("pct_ceros"),
        rounded(F.col("venta_media")).alias("venta_media"),
    )


@query(
    "bind_params",
    """select l_returnflag, count(*) as n, cast(sum(l_quantity) as bigint) as qty from lineitem
       where cast(l_shipdate as date) >= date '1997-05-01' and cast(l_shipdate as date) < date '1999-05-01'
         and l_quantity >= 10 group by 1""",
)
def _(q):
    from datetime import date

    return q.spark.sql(
        """select l_returnflag, count(*) as n, cast(sum(l_quantity) as bigint) as qty from {lines}
           where l_shipdate >= :start and l_shipdate < :end_exclusive and l_quantity >= :low
           group by l_returnflag""",
        args={"start": date(1997, 5, 1), "end_exclusive": date(1999, 5, 1), "low": 10.0},
        lines=q.table("lineitem"),
    )


@query(
    "category_of",
    """select split_part(item_id, '_', 1) as by_split, regexp_extract(item_id, '^[A-Z]+') as by_pattern,
              count(*) as n_rows, cast(sum(sales) as bigint) as sales from observed group by 1, 2""",
)
def _(q):
    item = F.col("item_id")
    return (
        q.observed()
        .groupBy(category_of(item).alias("by_split"), category_by_pattern(item).alias("by_pattern"))
        .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("sales").alias("sales"))
    )


