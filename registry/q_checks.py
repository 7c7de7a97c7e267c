"""Data-quality checks."""

from pyspark.sql import functions as F

from panelcast.functions.numeric import rounded
from panelcast.operators import checks as ck
from registry.core import query
from registry.inputs import STATE_FLAGS
from registry.q_reshape import R

BAD = "(isnan(p05) or isnan(p25) or isnan(p50) or isnan(p75) or isnan(p95))"
CROSS = "(p05 > p25 or p25 > p50 or p50 > p75 or p75 > p95)"


@query(
    "check_counts",
    """select count(*) as filas, count(distinct concat(item_id, '_', store_id)) as series, count(distinct date) as dias,
              count(*) = count(distinct concat(item_id, '_', store_id)) * 140 as ok from pred_bqml""",
)
def _(q):
    return ck.check_counts(q.predictions()["bqml"], days=28 * 5)


@query(
    "check_monotone",
    f"""select count(*) as filas, count(*) filter (not {BAD} and {CROSS}) as violaciones_monotonicidad,
               count(*) filter ({BAD}) as filas_nan from pred_bqml""",
)
def _(q):
    return ck.check_monotone(q.predictions()["bqml"])


@query(
    "monotone_violations",
    f"""select item_id, store_id, date, fold_id, {R('p50')} as p50 from pred_bqml where {BAD} or {CROSS}
        order by item_id, store_id, date, fold_id limit 20""",
)
def _(q):
    rows = ck.monotone_violations(q.predictions()["bqml"])
    return rows.select("item_id", "store_id", "date", "fold_id", rounded(F.col("p50")).alias("p50"))


@query(
    "check_negative",
    """select count(*) filter (p05 < 0 or p25 < 0 or p50 < 0 or p75 < 0 or p95 < 0) as valores_negativos from pred_bqml""",
)
def _(q):
    return ck.check_negative(q.predictions()["bqml"])


@query(
    "check_nan",
    """select count(distinct concat(item_id, '_', store_id)) filter (isnan(p05)) as series_afectadas,
              count(*) filter (isnan(p05)) as filas_afectadas, count(*) filter (p05 is null) as filas_null from pred_bqml""",
)
def _(q):
    return ck.check_nan(q.predictions()["bqml"])


@query(
    "nan_series",
    f"""select item_id, store_id, categoria_zero_rate, {R('tasa_ceros')} as tasa_ceros from segments
        where (item_id, store_id) in (select (item_id, store_id) from pred_bqml where isnan(p05))""",
)
def _(q):
    return ck.nan_series(q.predictions()["bqml"], q.segments()).select(
        "item_id", "store_id", "categoria_zero_rate", rounded(F.col("tasa_ceros")).alias("tasa_ceros")
    )


@query(
    "check_leakage",
    """with m as (select a.item_id, a.store_id, a.date, max(b.sales) filter (b.date = a.date - 7) as l7, avg(b.sales) as r28
              from sales_long a left join sales_long b on b.item_id = a.item_id and b.store_id = a.store_id
                   and b.date between a.date - 28 and a.date - 1 group by 1, 2, 3)
       select count(*) as filas, count(*) filter (m.l7 is distinct from f.lag_7) as lag_7_mismatches,
              count(*) filter (not coalesce(abs(m.r28 - f.roll_mean_28) < 1e-9 or (m.r28 is null and f.roll_mean_28 is null), false)) as roll_mean_28_mismatches
       from features f join m using (item_id, store_id, date)""",
)
def _(q):
    q.store_tables()
    return ck.check_leakage(q.features(), q.sales_long())


@query(
    "leakage_sample",
    f"""with t as (select store_id, item_id, sum(sales) as t from sales_long group by 1, 2),
            best as (select store_id, item_id from (select *, row_number() over (partition by store_id order by t desc, item_id) as rn from t) where rn = 1),
            s as (select x.*, row_number() over (partition by item_id, store_id order by date) as rn from sales_long x join best using (item_id, store_id)),
            d as (select item_id, store_id, date, rn from s where rn in (100, 500, 1000)),
            m as (select d.item_id, d.store_id, d.date, cast(d.rn as int) as day_index,
                         max(s.sales) filter (s.date = d.date - 7) as l7, avg(s.sales) as r28
                  from d join s on s.item_id = d.item_id and s.store_id = d.store_id and s.date between d.date - 28 and d.date - 1 group by 1, 2, 3, 4)
        select m.item_id, m.store_id, m.date as check_date, day_index, l7 as manual_lag_7, f.lag_7, l7 = f.lag_7 as lag_7_matches,
               {R('r28')} as manual_roll_mean_28, {R('f.roll_mean_28')} as roll_mean_28, abs(r28 - f.roll_mean_28) < 1e-9 as roll_mean_28_matches
        from m join features f on f.item_id = m.item_id and f.store_id = m.store_id and f.date = m.date""",
)
def _(q):
    q.store_tables()
    return ck.leakage_sample(q.features(), q.sales_long())


@query(
    "check_state_switch",
    """select case when f.store_id like 'AF%' then 'AF' when f.store_id like 'AM%' then 'AM' when f.store_id like 'AS%' then 'AS' end as state,
              count(*) as n_rows,
              count(*) filter (f.snap_active is distinct from
                (case when f.store_id like 'AF%' then c.snap_AF when f.store_id like 'AM%' then c.snap_AM when f.store_id like 'AS%' then c.snap_AS end)) as mismatches
       from features f join calendar c on c.date = f.date
       where c.snap_AF <> c.snap_AM or c.snap_AF <> c.snap_AS group by 1""",
)
def _(q):
    return ck.check_state_switch(q.features(), q.calendar(), STATE_FLAGS)


@query(
    "check_rolling_vs_expanding",
    f"""with p as (select item_id, store_id, date, sell_price, price_rel_mean from features where sell_price is not null),
            b as (select item_id, store_id, min(date) as first, max(date) as late from p group by 1, 2),
            e as (select p.item_id, p.store_id, min(p.date) as early, max(b.late) as late from p join b using (item_id, store_id)
                  where p.date >= b.first + 400 group by 1, 2),
            d as (select item_id, store_id, early as check_date from e union select item_id, store_id, late from e),
            m as (select d.item_id, d.store_id, d.check_date, avg(p.sell_price) filter (p.date >= d.check_date - 365) as mov, avg(p.sell_price) as exp
                  from d join p on p.item_id = d.item_id and p.store_id = d.store_id and p.date < d.check_date group by 1, 2, 3)
        select m.item_id, m.store_id, m.check_date, {R('p.price_rel_mean')} as price_rel_mean,
               {R('p.sell_price / mov')} as recomputed, {R('p.sell_price / exp')} as if_expanding
        from m join p on p.item_id = m.item_id and p.store_id = m.store_id and p.date = m.check_date""",
)
def _(q):
    return ck.check_rolling_vs_expanding(q.features())


@query(
    "check_sample",
    f"""select l.categoria_zero_rate, n_series, {R('n_series / (select count(*) from lgbm_sample)', 4)} as pct_muestra, n_forced, n_forced_present
        from (select categoria_zero_rate, count(*) as n_series from lgbm_sample group by 1) l
        left join (select categoria_zero_rate, count(*) as n_forced from arima_sample group by 1) a using (categoria_zero_rate)
        left join (select l.categoria_zero_rate, count(*) as n_forced_present from lgbm_sample l join arima_sample a using (item_id, store_id) group by 1) p using (categoria_zero_rate)""",
)
def _(q):
    q.store_tables()
    return ck.check_sample(q.lgbm_sample(), q.arima_sample())


@query(
    "check_forecast_range",
    """select f.fold_id, f.val_start, f.val_end, min(p.date) as pred_min, max(p.date) as pred_max,
              coalesce(min(p.date) = f.val_start and max(p.date) = f.val_end, false) as ok
       from folds f left join pred_bqml p on p.fold_id = f.fold_id group by 1, 2, 3""",
)
def _(q):
    return ck.check_forecast_range(q.predictions()["bqml"], q.folds())


@query(
    "check_coverage",
    f"""select s.categoria_zero_rate, count(*) as n_series, count(p.item_id) as n_con_modelo, {R('100.0 * count(p.item_id) / count(*)')} as pct
        from segments s left join (select distinct item_id, store_id from pred_arima) p using (item_id, store_id) group by 1""",
)
def _(q):
    out = ck.check_coverage(q.segments(), q.predictions()["arima"])
    return out.withColumn("pct", rounded(F.col("pct")))


@query(
    "check_mapping",
    """with lines as (select p_type, p_brand, s_name, r_name from lineitem join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey
                      join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey),
            expected as (select upper(p_type) as category, count(distinct r_name) + 1 as n_expected from lines group by 1
                         union all select 'BRAND', count(distinct (p_brand, r_name)) + count(distinct p_brand) from lines
                         union all select 'SUPP', count(distinct s_name) from lines),
            found as (select category, count(*) as n_series from segments group by 1)
       select coalesce(f.category, e.category) as category, n_series, n_expected, n_series is not distinct from n_expected as ok
       from found f full join expected e on e.category = f.category""",
)
def _(q):
    """Series of each category against those that the raw records call for."""
    series = q.observed().select("item_id", "store_id").distinct()
    expected = series.groupBy(F.split_part("item_id", F.lit("_"), F.lit(1)).alias("category")).agg(F.count(F.lit(1)).alias("n_expected"))
    return ck.check_mapping(q.segments(), "category", expected)
