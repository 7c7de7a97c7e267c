"""Exploratory aggregates and time-series analysis."""

from pyspark.sql import functions as F

from panelcast.functions.numeric import rounded
from panelcast.operators import profile as pf
from panelcast.operators import segments as sg
from panelcast.operators import tsa
from panelcast.schema import PANEL, Panel
from registry.core import query
from registry.q_reshape import R

TOTAL = Panel(keys=("series",), value="total_sales")


@query(
    "agg_basic",
    """select min(date) as fecha_inicio, max(date) as fecha_fin, count(distinct date) as dias_totales,
              cast(datediff('day', min(date), max(date)) + 1 as bigint) as dias_calendario,
              count(distinct concat(item_id, '_', store_id)) as series_unicas, count(*) as total_registros,
              round(count(*) / count(distinct concat(item_id, '_', store_id)), 0) as filas_promedio_por_serie
       from sales_long""",
)
def _(q):
    return pf.panel_overview(q.sales_long())


@query(
    "count_distinct_concat",
    """select date_trunc('year', date)::date as anio, count(distinct concat(item_id, '_', store_id)) as series
       from observed group by 1""",
)
def _(q):
    return (
        q.observed()
        .groupBy(F.trunc("date", "year").alias("anio"))
        .agg(pf.series_count(q.observed()).alias("series"))
    )


@query(
    "countif",
    f"""select store_id, count(*) filter (sales = 0) as n_cero, {R("100.0 * count(*) filter (sales = 0) / count(*)")} as pct_cero
        from sales_long group by 1""",
)
def _(q):
    zero = F.col("sales") == 0
    return (
        q.sales_long()
        .groupBy("store_id")
        .agg(F.count_if(zero).alias("n_cero"), rounded(pf.percent_where(zero)).alias("pct_cero"))
    )


@query(
    "category_profile",
    f"""select regexp_extract(item_id, '^[A-Z]+') as categoria, count(*) as registros,
          count(distinct concat(item_id, '_', store_id)) as series, count(distinct store_id) as tiendas,
          count(distinct item_id) as items, {R('avg(sales)', 2)} as venta_promedio, {R('stddev_samp(sales)', 2)} as venta_desv,
          min(sales) as venta_min, max(sales) as venta_max, count(*) filter (sales = 0) as registros_cero,
          {R("100.0 * count(*) filter (sales = 0) / count(*)", 2)} as pct_ceros
        from sales_long group by 1""",
)
def _(q):
    return pf.category_profile(q.sales_long())


@query(
    "zero_rate_segments",
    f"""select item_id, store_id, category, {R('tasa_ceros')} as tasa_ceros, {R('venta_promedio')} as venta_promedio,
               categoria_zero_rate from segments""",
)
def _(q):
    return q.segments().withColumns(
        {c: rounded(F.col(c)) for c in ("tasa_ceros", "venta_promedio")}
    )


@query(
    "zero_rate_histogram",
    f"""with s as (select item_id, store_id, {R("100.0 * count(*) filter (sales = 0) / count(*)", 2)} as pct,
                          {R('avg(sales)', 2)} as m from sales_long group by 1, 2)
        select case when pct = 100 then '1. Sin ventas (100% ceros)' when pct >= 75 then '2. Muy lento (75-99% ceros)'
                    when pct >= 50 then '3. Lento (50-75% ceros)' when pct >= 25 then '4. Moderado (25-50% ceros)'
                    when pct > 0 then '5. Pocas faltas (1-25% ceros)' else '6. Completo (0% ceros)' end as categoria_ceros,
               count(*) as series, {R("100.0 * count(*) / sum(count(*)) over ()", 2)} as pct_series,
               {R('avg(m)', 2)} as venta_prom_categoria
        from s group by 1""",
)
def _(q):
    return pf.zero_rate_histogram(q.sales_long())


@query(
    "price_cv",
    f"""select regexp_extract(item_id, '^[A-Z]+') as categoria, count(*) as registros_precio,
          {R('avg(sell_price)', 2)} as precio_promedio, {R('stddev_samp(sell_price)', 2)} as precio_desv,
          min(sell_price) as precio_min, max(sell_price) as precio_max,
          {R('100 * stddev_samp(sell_price) / avg(sell_price)', 2)} as coef_variacion
        from sell_prices group by 1""",
)
def _(q):
    return pf.price_profile(q.sell_prices())


@query(
    "event_profile",
    f"""select event_type_1 as tipo_evento, count(distinct date) as dias_unicos, count(*) as ocurrencias
        from calendar join observed using (date) where event_type_1 is not null group by 1""",
)
def _(q):
    return pf.event_profile(q.observed().join(q.calendar(), "date"))


@query(
    "snap_profile",
    f"""with t as (select count(*) as total_dias, sum(snap_AF) as snap_AF, sum(snap_AM) as snap_AM, sum(snap_AS) as snap_AS
                   from calendar join observed using (date))
        select total_dias, flag, cast(dias as bigint) as dias, {R('100.0 * dias / total_dias')} as pct
        from (unpivot t on snap_AF, snap_AM, snap_AS into name flag value dias)""",
)
def _(q):
    out = pf.flag_day_profile(q.observed().join(q.calendar(), "date"), ["snap_AF", "snap_AM", "snap_AS"])
    return out.withColumn("pct", rounded(F.col("pct")))


@query(
    "seasonal_profile",
    f"""select dayname(date) as weekday, {R('avg(sales)')} as venta_promedio,
               cast((dayofweek(date) + 1) % 7 + 1 as bigint) as row_order from sales_long group by 1, 3""",
)
def _(q):
    return pf.weekday_profile(q.sales_long()).select(
        "weekday", rounded(F.col("venta_promedio")).alias("venta_promedio"), F.col("row_order").cast("long")
    )


@query(
    "seasonal_profile_rounded",
    """select weekday, cast((2 * sum(cents) + count(*)) // (2 * count(*)) as double) / 100 as venta_promedio, any_value(row_order) as row_order
       from (select store_id, dayname(date) as weekday, cast(round(round(avg(sales), 2) * 100) as bigint) as cents, cast((dayofweek(date) + 1) % 7 + 1 as bigint) as row_order
             from sales_long group by 1, 2, 4) group by 1""",
)
def _(q):
    """Mean over stores of each store's rounded weekday mean."""
    out = pf.weekday_profile(q.sales_long(), decimals=2, inner=("store_id",))
    return out.withColumn("row_order", F.col("row_order").cast("long"))


@query(
    "seasonal_profile_series",
    f"""select item_id, store_id, month(date) as mes, {R('avg(sales)')} as venta_promedio from sales_long group by 1, 2, 3""",
)
def _(q):
    out = pf.month_profile(q.sales_long(), by=PANEL.keys)
    return out.withColumn("venta_promedio", rounded(F.col("venta_promedio")))


@query(
    "seasonal_profile_year",
    f"""select year(date) as anio, {R('avg(sales)')} as venta_promedio, count(distinct date) as dias_en_anio,
               count(distinct date) < 300 as parcial from sales_long group by 1""",
)
def _(q):
    out = pf.year_profile(q.sales_long())
    return out.withColumn("venta_promedio", rounded(F.col("venta_promedio")))


@query("daily_total", "select date, cast(sum(sales) as bigint) as total_sales from sales_long group by 1")
def _(q):
    return pf.daily_total(q.sales_long())


@query("first_release", "select item_id, store_id, release_date from releases")
def _(q):
    return q.releases()


@query(
    "weighted_mean",
    f"""select model, quantile_name, {R('avg(pinball_loss)')} as avg_pinball_loss, count(*) as n_obs from fact
        where not bqml_unstable_series group by 1, 2""",
)
def _(q):
    from panelcast.operators import evaluate as ev

    fact = q.fact()
    out = pf.weighted_mean(ev.metrics_by_fold(fact), ["model", "quantile_name"])
    return out.withColumn("avg_pinball_loss", rounded(F.col("avg_pinball_loss")))


@query(
    "agg_over_agg",
    f"""select categoria_zero_rate, count(*) as n_series, {R("100.0 * count(*) / sum(count(*)) over ()", 4)} as pct_muestra
        from lgbm_sample group by 1""",
)
def _(q):
    counts = q.lgbm_sample().groupBy("categoria_zero_rate").agg(F.count(F.lit(1)).alias("n_series"))
    return pf.share_of_total(counts, "n_series", "pct_muestra", 4)


@query(
    "detrend_linear",
    f"""select item_id, store_id, date, {R("sales - (i + s * datediff('day', lo, date))", 5)} as residual from sales_long
        join (select item_id, store_id, regr_slope(y, x) as s, regr_intercept(y, x) as i
              from (select item_id, store_id, cast(sales as double) as y,
                           cast(datediff('day', (select min(date) from spine), date) as double) as x from sales_long)
              group by 1, 2) using (item_id, store_id) cross join (select min(date) as lo from spine)""",
)
def _(q):
    return tsa.detrend(q.sales_long(), q.bounds[0]).select(
        "item_id", "store_id", "date", rounded(F.col("residual"), 5).alias("residual")
    )


_acf = """with x as (select {keys}, date, cast({v} as double) as v from {src}),
  m as (select {keys}, avg(v) as m from x group by {keys}),
  c as (select {keys}, date, v - m as c from x join m using ({keys})),
  d as (select {keys}, sum(c * c) as ss from c group by {keys}),
  n as (select {keys}, l.lag as lag, sum(a.c * b.c) as s from c a join c b using ({keys})
        join (select unnest({lags}) as lag) l on b.date = a.date + cast(l.lag as int) group by {keys}, l.lag)"""


@query(
    "acf",
    _acf.format(keys="item_id, store_id", v="sales", src="sales_long", lags=list(tsa.KEY_LAGS))
    + f" select item_id, store_id, cast(lag as int) as lag, {R('s / nullif(ss, 0)', 5)} as acf from n join d using (item_id, store_id)",
)
def _(q):
    return tsa.acf(q.sales_long()).withColumn("acf", rounded(F.col("acf"), 5))


_resid = """(select item_id, store_id, date, sales - (i + s * datediff('day', (select min(date) from spine), date)) as residual
   from sales_long join (select item_id, store_id, regr_slope(y, x) as s, regr_intercept(y, x) as i
     from (select item_id, store_id, cast(sales as double) as y,
                  cast(datediff('day', (select min(date) from spine), date) as double) as x from sales_long)
     group by 1, 2) using (item_id, store_id))"""


@query(
    "choose_window",
    _acf.format(keys="item_id, store_id", v="residual", src=_resid, lags=[365, 730])
    + f""", r as (select item_id, store_id, max(case when lag = 365 then s / nullif(ss, 0) end) as a,
                        max(case when lag = 730 then s / nullif(ss, 0) end) as b
                 from n join d using (item_id, store_id) group by 1, 2)
        select item_id, store_id, {R('a', 5)} as acf_short, {R('b', 5)} as acf_long,
               cast(case when a > 0 and b >= 0.5 * a then 730 else 365 end as int) as window_size from r""",
)
def _(q):
    residual = tsa.detrend(q.sales_long(), q.bounds[0])
    chosen = tsa.choose_window(tsa.acf(residual, (365, 730), value="residual"))
    return chosen.withColumns({c: rounded(F.col(c), 5) for c in ("acf_short", "acf_long")})


_curve_src = "(select 'total' as series, date, sum(sales) as total_sales from sales_long group by 2)"


@query(
    "acf_curve",
    _acf.format(keys="series", v="total_sales", src=_curve_src, lags="range(0, 801)")
    + f" select series, cast(lag as int) as lag, {R('s / ss', 5)} as acf from n join d using (series)",
)
def _(q):
    total = pf.daily_total(q.sales_long()).withColumn("series", F.lit("total"))
    return tsa.acf_curve(total, 800, TOTAL).withColumn("acf", rounded(F.col("acf"), 5))


@query(
    "zero_share_by_category",
    f"""select category, categoria_zero_rate, count(*) as n_series, {R('avg(tasa_ceros)')} as tasa_ceros
        from segments group by 1, 2""",
)
def _(q):
    return (
        q.segments()
        .groupBy("category", sg.STRATUM)
        .agg(F.count(F.lit(1)).alias("n_series"), rounded(F.avg("tasa_ceros")).alias("tasa_ceros"))
    )
