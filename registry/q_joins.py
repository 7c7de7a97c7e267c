"""Joins, top-k, set operations, samples."""

from pyspark.sql import functions as F

from panelcast.functions.keys import farm_fingerprint, farm_key, hash_key
from panelcast.functions.numeric import order_of, rounded, sorted_quantiles
from panelcast.operators import evaluate as ev
from panelcast.operators import profile as pf
from panelcast.operators import relational as rl
from panelcast.operators import segments as sg
from panelcast.schema import QUANTILE_NAMES, ZERO_RATE_LABELS
from panelcast.session import checkpoint
from registry.core import query
from registry.inputs import SAMPLE_TOTAL
from registry.q_reshape import R


@query(
    "join_calendar",
    """select s.item_id, s.store_id, s.date, s.sales, c.wm_yr_wk, c.event_name_1 from sales_long s
       left join calendar c on c.date = s.date""",
)
def _(q):
    return q.sales_long().join(q.calendar().select("date", "wm_yr_wk", "event_name_1"), "date", "left")


_price_sql = """with weekly as materialized (
     select item_id, store_id, wm_yr_wk, max(sell_price) as sell_price from sell_prices group by all),
   days as materialized (
     select s.item_id, s.store_id, s.date, s.sales, c.wm_yr_wk from sales_long s left join calendar c using (date))
   select days.*, weekly.sell_price from days left join weekly using (item_id, store_id, wm_yr_wk)"""


@query("join_weekly_price", _price_sql)
def _(q):
    return rl.join_weekly_price(q.sales_long(), q.calendar(), q.sell_prices())


@query("attach_weekly_price", _price_sql)
def _(q):
    days = q.sales_long().join(q.calendar().select("date", "wm_yr_wk"), "date", "left")
    return rl.attach_weekly_price(days, q.sell_prices())


@query(
    "inner_equi",
    f"""select p.fold_id, s.store_id, count(*) as n, cast(sum(s.sales) as bigint) as sales, {R('sum(p.p50)')} as p50
        from pred_empirical p join sales_long s using (item_id, store_id, date) group by 1, 2""",
)
def _(q):
    lgbm = q.predictions()["lgbm"]
    return (
        lgbm.join(q.sales_long(), ["item_id", "store_id", "date"])
        .groupBy("fold_id", "store_id")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("sales").alias("sales"),
            rounded(F.sum("p50")).alias("p50"),
        )
    )


@query(
    "left_flag",
    """select s.item_id, s.store_id, s.categoria_zero_rate, (a.item_id is not null) as in_arima_sample
       from segments s left join arima_sample a on a.item_id = s.item_id and a.store_id = s.store_id""",
)
def _(q):
    flagged = rl.left_flag(q.segments(), q.arima_sample(), ["item_id", "store_id"], "in_arima_sample")
    return flagged.select("item_id", "store_id", "categoria_zero_rate", "in_arima_sample")


@query(
    "left_join_model_cond",
    """select p.model, p.fold_id, count(*) as n_rows, count(u.item_id) as n_flagged from predictions p
       left join unstable u on p.model = 'bqml' and u.item_id = p.item_id and u.store_id = p.store_id
            and u.fold_id = p.fold_id group by 1, 2""",
)
def _(q):
    predictions = q.predictions()
    unstable = ev.unstable_series(predictions["bqml"]).withColumn("hit", F.lit(1))
    joined = rl.left_join_where(
        ev.stack_models(predictions),
        unstable,
        ["item_id", "store_id", "fold_id"],
        F.col("model") == "bqml",
    )
    return joined.groupBy("model", "fold_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("hit").alias("n_flagged")
    )


@query(
    "semi_join",
    """select item_id, store_id, date, sales from observed
       where (item_id, store_id) in (select (item_id, store_id) from arima_sample)""",
)
def _(q):
    return rl.select_series(q.observed(), q.arima_sample(), ["item_id", "store_id"])


@query(
    "anti_join",
    """select s.item_id, s.store_id, s.categoria_zero_rate from segments s
       left join arima_sample a on a.item_id = s.item_id and a.store_id = s.store_id where a.item_id is null""",
)
def _(q):
    return (
        q.segments()
        .join(q.arima_sample().select("item_id", "store_id"), ["item_id", "store_id"], "left_anti")
        .select("item_id", "store_id", "categoria_zero_rate")
    )


@query(
    "cross_scalar",
    f"""select s.item_id, s.store_id, count(*) as n_train, {R('acos(-1) * sum(s.sales)')} as scaled
        from observed s cross join (select max(date) - 27 as val_start from observed) c
        where s.date < c.val_start group by 1, 2""",
)
def _(q):
    sales = q.observed()
    cutoff = sales.agg(F.date_sub(F.max("date"), 27)).scalar()
    return (
        sales.where(F.col("date") < cutoff)
        .groupBy("item_id", "store_id")
        .agg(F.count(F.lit(1)).alias("n_train"), rounded(F.pi() * F.sum("sales")).alias("scaled"))
    )


@query(
    "cross_sequence",
    f"""select o.item_id, o.store_id, n as slot, count(*) as n_rows
        from (select item_id, store_id, date from observed) o cross join range(1, 8) t(n)
        where dayofweek(o.date) + 1 <= n group by 1, 2, 3""",
)
def _(q):
    slots = F.explode(F.sequence(F.lit(1).cast("long"), F.lit(7).cast("long")))
    return (
        q.observed()
        .select("item_id", "store_id", F.dayofweek("date").alias("dow"), slots.alias("slot"))
        .where(F.col("dow") <= F.col("slot"))
        .groupBy("item_id", "store_id", "slot")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


@query(
    "using_join",
    """select s.item_id, s.store_id, categoria_zero_rate, t.n_objetivo from segments s
       join (values ('lento', 1194), ('muy_lento', 1160), ('medio', 541), ('rapido', 106)) t(categoria_zero_rate, n_objetivo)
       using (categoria_zero_rate)""",
)
def _(q):
    quotas = rl.inline_table(
        q.spark,
        [("lento", 1194), ("muy_lento", 1160), ("medio", 541), ("rapido", 106)],
        "categoria_zero_rate string, n_objetivo int",
    )
    return q.segments().join(quotas, "categoria_zero_rate").select(
        "item_id", "store_id", "categoria_zero_rate", "n_objetivo"
    )


@query(
    "merge_left",
    """select p.item_id, p.store_id, p.n, s.categoria_zero_rate from
         (select item_id, store_id, count(*) as n from observed group by 1, 2) p
       left join arima_sample s using (item_id, store_id)""",
)
def _(q):
    counts = q.observed().groupBy("item_id", "store_id").agg(F.count(F.lit(1)).alias("n"))
    sample = q.arima_sample().select("item_id", "store_id", "categoria_zero_rate")
    return counts.join(sample, ["item_id", "store_id"], "left")


@query(
    "scalar_subquery",
    f"""select item_id, store_id, cast(sum(sales) as bigint) as total,
               {R("sum(sales) / (select cast(sum(sales) as double) from observed)", 9)} as share
        from observed group by 1, 2
        having sum(sales) > (select avg(t) from (select sum(sales) as t from observed group by item_id, store_id))""",
)
def _(q):
    sales = q.observed()
    totals = sales.groupBy("item_id", "store_id").agg(F.sum("sales").alias("total"))
    mean_total = totals.agg(F.avg("total")).scalar()
    all_sales = sales.agg(F.sum("sales").cast("double")).scalar()
    return totals.where(F.col("total") > mean_total).withColumn(
        "share", rounded(F.col("total") / all_sales, 9)
    )


@query(
    "order_limit",
    """select item_id, store_id, date, sales from observed order by sales desc, item_id, store_id, date limit 30""",
)
def _(q):
    return q.observed().orderBy(F.desc("sales"), "item_id", "store_id", "date").limit(30)


@query(
    "custom_order",
    """select categoria_zero_rate, count(*) as n_series,
              cast(case categoria_zero_rate when 'rapido' then 1 when 'medio' then 2 when 'lento' then 3 else 4 end as bigint) as row_order
       from segments group by 1 order by row_order""",
)
def _(q):
    counts = q.segments().groupBy("categoria_zero_rate").agg(F.count(F.lit(1)).alias("n_series"))
    position = order_of(F.col("categoria_zero_rate"), ZERO_RATE_LABELS).cast("long")
    return counts.withColumn("row_order", position).orderBy("row_order")


@query(
    "argmax_series",
    """select store_id, item_id, total from (
         select store_id, item_id, total, row_number() over (partition by store_id order by total desc, item_id) as rn
         from (select store_id, item_id, cast(sum(sales) as bigint) as total from observed group by 1, 2)) where rn = 1""",
)
def _(q):
    totals = q.observed().groupBy("store_id", "item_id").agg(F.sum("sales").alias("total"))
    best = F.min(F.struct((-F.col("total")).alias("neg"), "item_id"))
    return totals.groupBy("store_id").agg(best.alias("b")).select(
        "store_id", F.col("b.item_id").alias("item_id"), (-F.col("b.neg")).alias("total")
    )


_stats = """(select item_id, store_id, sum(sales) as total,
   round(100.0 * count(*) filter (sales = 0) / count(*), 2) as pct from sales_long group by 1, 2)"""


@query(
    "representative_series",
    f"""(select 'Alto volumen' as tipo, item_id, store_id, cast(total as bigint) as total_ventas from {_stats}
          where pct < 5 order by total desc, item_id, store_id limit 1)
        union all
        (select 'Bajo volumen (lento)', item_id, store_id, cast(total as bigint) from {_stats}
          where pct > 50 and pct < 100 order by total desc, item_id, store_id limit 1)
        union all
        (select 'Volumen moderado', item_id, store_id, cast(total as bigint) from {_stats}
          where pct >= 0 and pct <= 30 order by total desc, item_id, store_id limit 1)""",
)
def _(q):
    pct = F.col("pct_ceros")
    labels = {
        "Alto volumen": pct < 5,
        "Bajo volumen (lento)": (pct > 50) & (pct < 100),
        "Volumen moderado": (pct >= 0) & (pct <= 30),
    }
    stats = pf.series_stats(q.sales_long())
    top = rl.top_row_per_label(stats, labels, [F.desc("total_ventas"), F.col("item_id"), F.col("store_id")])
    return top.select("tipo", "item_id", "store_id", "total_ventas")


@query(
    "union_all",
    """select model, fold_id, count(*) as n_rows, count(distinct (item_id, store_id)) as n_series
       from predictions group by 1, 2""",
)
def _(q):
    stacked = ev.stack_models(q.predictions())
    per_series = stacked.groupBy("model", "fold_id", "item_id", "store_id").agg(F.count(F.lit(1)).alias("n"))
    return per_series.groupBy("model", "fold_id").agg(
        F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_series")
    )


_shuffled = "[p75, p05, p95, p25, p50]"


@query(
    "sort_row_quantiles",
    "select item_id, store_id, date, fold_id, "
    + ", ".join(
        f"{R(f'list_sort({_shuffled})[{i}]')} as {n}" for i, n in enumerate(QUANTILE_NAMES, start=1)
    )
    + " from pred_normal",
)
def _(q):
    from panelcast.operators.forecast.baseline import normal_forecast
    from panelcast.plans.walk_forward import walk_forward

    rows = walk_forward(q.sales_long(), q.folds(), normal_forecast)
    crossed = rows.select(
        "item_id", "store_id", "date", "fold_id",
        *[F.col(src).alias(dst) for src, dst in zip(["p75", "p05", "p95", "p25", "p50"], QUANTILE_NAMES)],
    )
    fixed = sorted_quantiles()
    return crossed.select(
        "item_id", "store_id", "date", "fold_id", *[rounded(fixed[n]).alias(n) for n in QUANTILE_NAMES]
    )


@query(
    "hash_key",
    """select item_id, store_id, md5(concat(item_id, '_', store_id, '_arima_sample_v1')) as hash, n from
       (select item_id, store_id, count(*) as n from observed group by 1, 2)""",
)
def _(q):
    counts = q.observed().groupBy("item_id", "store_id").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("hash", hash_key([F.col("item_id"), F.col("store_id")], "arima_sample_v1"))


@query("farm_fingerprint", "select text, fingerprint from farm_prints")
def _(q):
    """Fingerprints of the keys with and without salts, and of parts of them: all lengths' courses up to 64 bytes."""
    item, store = F.col("item_id"), F.col("store_id")
    key = F.concat_ws("_", item, store)
    texts = F.array(
        item, store, F.substring(store, 1, 2), F.substring(item, 1, 5), F.substring(store, 4, 1), F.lit(""), key, F.concat_ws("_", key, F.lit("arima_sample_v1")),
        F.concat_ws("_", key, F.lit("lgbm_sample_v1")), F.concat_ws("_", key, key, F.lit("lgbm_sample_v1")),
    )
    rows = q.segments().select(F.explode(texts).alias("text")).distinct()
    return rows.withColumn("fingerprint", farm_fingerprint(F.col("text")))


@query(
    "samples_by_fingerprint",
    """select 'balanced' as sample, item_id, store_id, category, categoria_zero_rate from farm_balanced
       union all select 'proportional', item_id, store_id, category, categoria_zero_rate from farm_proportional""",
)
def _(q):
    """The balanced sample and the proportional one around it, drawn by the Farm fingerprint."""
    q.store_tables()
    segments = q.segments()
    balanced = checkpoint(sg.stratified_top_n(segments, 8, "arima_sample_v1", key=farm_key), "balanced")
    quotas = sg.proportional_quotas(segments, SAMPLE_TOTAL)
    proportional = sg.proportional_sample(segments, balanced, quotas, "lgbm_sample_v1", key=farm_key)
    columns = ["item_id", "store_id", "category", "categoria_zero_rate"]
    rows = [df.select(F.lit(name).alias("sample"), *columns) for name, df in (("balanced", balanced), ("proportional", proportional))]
    return rows[0].unionByName(rows[1])


@query("stratified_top_n", "select item_id, store_id, category, categoria_zero_rate from arima_sample")
def _(q):
    return q.arima_sample().select("item_id", "store_id", "category", "categoria_zero_rate")


@query("proportional_forced", "select item_id, store_id, category, categoria_zero_rate from lgbm_sample")
def _(q):
    return q.lgbm_sample().select("item_id", "store_id", "category", "categoria_zero_rate")


@query(
    "rank_in_stratum",
    """select item_id, store_id, categoria_zero_rate, row_number() over (partition by categoria_zero_rate
              order by md5(concat(item_id, '_', store_id, '_r')), item_id, store_id) as rn from segments""",
)
def _(q):
    ranked = sg.rank_in_stratum(
        q.segments(), "categoria_zero_rate", hash_key([F.col("item_id"), F.col("store_id")], "r"),
        ["item_id", "store_id"],
    )
    return ranked.select("item_id", "store_id", "categoria_zero_rate", "rn")


@query(
    "sample_panel",
    """select item_id, store_id, date, sales from sales_long
       where (item_id, store_id) in (select (item_id, store_id) from lgbm_sample)""",
)
def _(q):
    q.store_tables()
    return sg.sample_panel(q.sales_long(), q.lgbm_sample())


@query(
    "distinct_rows",
    """select p_brand, p_type, min(p_partkey) as first_part, arg_min(p_name, p_partkey) as first_name
       from part group by 1, 2""",
)
def _(q):
    rows = q.table("part").select("p_brand", "p_type", "p_partkey", "p_name").distinct()
    first = rl.first_row_per_key(rows, ["p_brand", "p_type"], "p_partkey")
    return first.withColumnsRenamed({"p_partkey": "first_part", "p_name": "first_name"})


