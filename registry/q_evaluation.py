"""Pinball losses, roll-ups, comparisons, report tables."""

from datetime import date

from pyspark.sql import functions as F

from panelcast.functions.numeric import pinball, rounded
from panelcast.operators import evaluate as ev
from panelcast.operators import folds as fo
from panelcast.operators.forecast.baseline import empirical_quantiles
from panelcast.operators.reshape import held_back_days, wide_to_long
from panelcast.operators.scenario import DEPENDENCE, path_ranks, quantiles_of_sums
from panelcast.plans.evaluation import flags_only
from panelcast.plans.walk_forward import walk_forward
from panelcast.schema import EVENT_LABELS, QUANTILES, RELEASE_LABELS, ZERO_RATE_LABELS
from panelcast.session import checkpoint
from registry.core import query
from registry.q_reshape import R, _days

STABLE = "not bqml_unstable_series"
HEAT_STORES = ["AF_1", "AL_1", "AM_1", "AS_1", "EU_1", "MI_1"]


def _loss(df):
    return df.withColumn("avg_pinball_loss", rounded(F.col("avg_pinball_loss")))


def _rollup_sql(dim, source="fact"):
    dims = f"{dim}, " if dim else ""
    return f"""select model, quantile_name, quantile_level, in_arima_sample, {dims}count(*) as n_obs,
       {R('avg(pinball_loss)')} as avg_pinball_loss from {source} where {STABLE}
       group by model, quantile_name, quantile_level, {dims}in_arima_sample"""


@query(
    "pinball_loss",
    f"""select p.item_id, p.store_id, p.date, p.fold_id,
          {", ".join(f"{R(f'greatest({v} * (s.sales - p.{n}), ({v} - 1) * (s.sales - p.{n}))')} as loss_{n}" for n, v in QUANTILES.items())}
        from pred_empirical p join sales_long s using (item_id, store_id, date)""",
)
def _(q):
    lgbm = q.predictions()["lgbm"].join(q.sales_long(), ["item_id", "store_id", "date"])
    loss = lambda name, level: rounded(pinball(F.lit(level), F.col("sales"), F.col(name)))
    return lgbm.select(
        "item_id", "store_id", "date", "fold_id", *[loss(n, v).alias(f"loss_{n}") for n, v in QUANTILES.items()]
    )


@query(
    "pinball_fact",
    f"""select model, fold_id, item_id, store_id, date, quantile_name, quantile_level, {R('y_pred')} as y_pred, y_true,
               categoria_zero_rate, in_arima_sample, bqml_unstable_series, {R('pinball_loss')} as pinball_loss
        from fact""",
)
def _(q):
    return q.fact().withColumns({c: rounded(F.col(c)) for c in ("y_pred", "pinball_loss")})


@query("metrics_by_fold", _rollup_sql("fold_id"))
def _(q):
    return _loss(ev.metrics_by_fold(q.fact()))


@query("metrics_by_zero_rate", _rollup_sql("categoria_zero_rate"))
def _(q):
    return _loss(ev.metrics_by_zero_rate(q.fact()))


@query("metrics_overall", _rollup_sql(""))
def _(q):
    return _loss(ev.metrics_overall(q.fact()))


_by_category = "(select f.*, s.category from fact f join segments s on s.item_id = f.item_id and s.store_id = f.store_id)"
_by_age = f"""(select f.*, case when r.release_date is null then 'sin_release_date'
    when datediff('day', r.release_date, f.date) < 0 then 'antes_de_release'
    when datediff('day', r.release_date, f.date) < 90 then 'nuevo_lt_90d' else 'establecido' end as release_age_bucket
  from fact f left join releases r on r.item_id = f.item_id and r.store_id = f.store_id)"""
_by_event = """(select f.*, case when is_christmas = 1 then 'navidad' when is_event = 1 then 'evento' else 'sin_evento' end as event_bucket
  from fact f join calendar_flags c on c.date = f.date)"""


@query("metrics_by_category", _rollup_sql("category", _by_category))
def _(q):
    return _loss(ev.metrics_by_category(q.fact(), q.segments()))


@query("metrics_by_release_age", _rollup_sql("release_age_bucket", _by_age))
def _(q):
    return _loss(ev.metrics_by_release_age(q.fact(with_releases=True)))


@query("metrics_by_event", _rollup_sql("event_bucket", _by_event))
def _(q):
    return _loss(ev.metrics_by_event(q.fact(), flags_only(q.calendar())))


@query(
    "rollups_in_one_pass",
    " union all ".join(
        f"""select '{name}' as roll_up, {value} as bucket, model, quantile_name, quantile_level, in_arima_sample,
            count(*) as n_obs, {R('avg(pinball_loss)')} as avg_pinball_loss from fact where {STABLE}
            group by model, quantile_name, quantile_level, in_arima_sample {group}"""
        for name, value, group in [
            ("overall", "cast(null as varchar)", ""),
            ("fold_id", "cast(fold_id as varchar)", ", fold_id"),
            ("categoria_zero_rate", "categoria_zero_rate", ", categoria_zero_rate"),
        ]
    ),
)
def _(q):
    return _loss(ev.rollups_in_one_pass(q.fact(), ["fold_id", "categoria_zero_rate"]))


def _scope_sql(source, index, order):
    rank = " ".join(f"when '{v}' then {i}" for i, v in enumerate(order, start=1))
    model = lambda m: R(f"avg(pinball_loss) filter (model = '{m}')") + f" as {m}"
    cols = ", ".join(model(m) for m in ("arima", "bqml", "lgbm"))
    rank = f"cast(case {index} {rank} end as bigint) as row_order"
    base = f"from {source} where {STABLE} and quantile_name = 'p50'"
    return f"""select 'fair' as scope, {index}, {cols}, count(*) as n_obs, {rank} {base} and in_arima_sample group by {index}
      union all select 'full', {index}, {cols.replace(model('arima'), 'null as arima')}, count(*), {rank} {base} and model <> 'arima' group by {index}"""


def _scope(df, index):
    return df.select(
        "scope", index, *[rounded(F.col(m)).alias(m) for m in ("arima", "bqml", "lgbm")],
        "n_obs", F.col("row_order").cast("long"),
    )


@query("two_scope_compare", _scope_sql("fact", "categoria_zero_rate", ZERO_RATE_LABELS))
def _(q):
    metrics = ev.metrics_by_zero_rate(q.fact())
    out = ev.two_scope_compare(metrics, "categoria_zero_rate", ZERO_RATE_LABELS)
    return _scope(out, "categoria_zero_rate")


@query("two_scope_release_age", _scope_sql(_by_age, "release_age_bucket", RELEASE_LABELS))
def _(q):
    q.store_records()
    metrics = ev.metrics_by_release_age(q.fact(), q.releases())
    return _scope(ev.two_scope_compare(metrics, "release_age_bucket", RELEASE_LABELS), "release_age_bucket")


@query("two_scope_event", _scope_sql(_by_event, "event_bucket", EVENT_LABELS))
def _(q):
    metrics = ev.metrics_by_event(q.fact(), flags_only(q.calendar()))
    return _scope(ev.two_scope_compare(metrics, "event_bucket", EVENT_LABELS), "event_bucket")


@query(
    "strict_scope",
    f"""with cells as (select fold_id, item_id, store_id, date, quantile_name from fact
                      group by all having count(distinct model) = 3)
        select model, quantile_name, count(*) as n_obs, {R('avg(pinball_loss)')} as avg_pinball_loss
        from fact join cells using (fold_id, item_id, store_id, date, quantile_name) where {STABLE} group by 1, 2""",
)
def _(q):
    fact = ev.strict_scope(q.fact()).where("not bqml_unstable_series")
    return fact.groupBy("model", "quantile_name").agg(
        F.count(F.lit(1)).alias("n_obs"), rounded(F.avg("pinball_loss")).alias("avg_pinball_loss")
    )


@query("unstable_series", "select item_id, store_id, fold_id from unstable")
def _(q):
    return ev.unstable_series(q.predictions()["bqml"])


_extreme = "((not isnan(p75) and p75 > {t}) or (not isnan(p95) and p95 > {t}))"


@query(
    "outlier_report",
    f"""select fold_id, count(*) as n_filas_extremas, count(distinct (item_id, store_id)) as n_series_extremas,
          {R('max(greatest(p75, p95))')} as max_valor,
          {R('100.0 * count(*) / (select count(*) from pred_bqml)')} as pct_of_total
        from pred_bqml where {_extreme.format(t=300)} group by 1""",
)
def _(q):
    out = ev.outliers_by_fold(q.predictions()["bqml"], threshold=300.0)
    return out.withColumns({c: rounded(F.col(c)) for c in ("max_valor", "pct_of_total")})


@query(
    "outlier_series",
    f"""select item_id, store_id, fold_id, count(*) as n_dias_extremos, {R('min(p50)')} as min_p50, {R('max(p50)')} as max_p50,
               {R('max(p75)')} as max_p75, {R('max(p95)')} as max_p95
        from pred_bqml where {_extreme.format(t=100)} group by 1, 2, 3 order by max(p95) desc, item_id, store_id, fold_id limit 30""",
)
def _(q):
    out = ev.outlier_series(q.predictions()["bqml"], 30, threshold=100.0)
    return out.withColumns({c: rounded(F.col(c)) for c in ("min_p50", "max_p50", "max_p75", "max_p95")})


@query(
    "exclusion_report",
    """select count(*) as n_filas_excluidas, count(distinct (item_id, store_id, fold_id)) as n_series_fold_excluidas
       from fact where bqml_unstable_series""",
)
def _(q):
    return ev.exclusion_report(q.fact())


@query(
    "convergence_summary",
    """select fold_id, categoria_zero_rate, count(*) as n_series, count(*) filter (convergio) as n_convergio,
              count(*) filter (not convergio) as n_fallo,
              cast(case categoria_zero_rate when 'rapido' then 1 when 'medio' then 2 when 'lento' then 3 else 4 end as bigint) as row_order
       from arima_metadata group by 1, 2""",
)
def _(q):
    return ev.convergence_summary(q.arima_metadata()).withColumn("row_order", F.col("row_order").cast("long"))


@query(
    "test_labels",
    f"""with long as (select array_to_string(string_split(id, '_')[1:3], '_') as item_id,
               array_to_string(string_split(id, '_')[4:5], '_') as store_id,
               month_start + cast(substr(k, 3) as int) - 1 as date, v as sales
             from (unpivot sales_wide on {_days} into name k value v))
        select * from long where date > (select max(date) - 28 from long)""",
)
def _(q):
    """The last 28 days of the wide file, held back as labels."""
    long = wide_to_long(q.sales_wide(), F.col("month_start"))
    last = F.lit(q.bounds[1])
    return long.where(F.col("date") > F.date_sub(last, 28))


@query(
    "labels_of_second_file",
    """select item_id, store_id, date, sales from sales_long
       where date > (select max(date) - 28 from sales_long) and not (sales = 0 and day(date) % 13 = 0) and store_id not like 'AS%'""",
)
def _(q):
    """The days of the wide file of the whole panel behind the training panel's last day."""
    known = q.sales_long().where(F.col("date") <= F.date_sub(F.lit(q.bounds[1]), 28)).agg(F.max("date")).first()[0]
    return held_back_days(q.sales_wide_days(), q.bounds[0], known)


def _quantile_at_sql(rank: str) -> str:
    names, cuts = list(QUANTILES), list(QUANTILES.values())
    cases = [f"when {rank} <= cast({cuts[0]} as double) then {names[0]}"]
    for (low, a), (high, b) in zip(zip(names, cuts), zip(names[1:], cuts[1:])):
        cases.append(f"when {rank} <= cast({b} as double) then {low} + ({high} - {low}) * (({rank} - cast({a} as double)) / cast({b - a!r} as double))")
    return f"case {' '.join(cases)} else {names[-1]} end"


PATHS = 40


@query(
    "quantiles_of_sums",
    f"""with paths as (select unnest(range({PATHS})) as path),
            hist as (select t.fold_id, item_id, store_id, cast(datediff('day', t.date, f.train_end) as bigint) as path, t.sales, t.date
                     from train t join folds f using (fold_id) where datediff('day', t.date, f.train_end) < {PATHS}),
            ranks as (select fold_id, item_id, store_id, path, (row_number() over (partition by fold_id, item_id, store_id order by sales, date) - 0.5)
                             / cast(count(*) over (partition by fold_id, item_id, store_id) as double) as u from hist),
            drawn as (
              select 'comonotone' as dependence, p.*, path, (path + 0.5) / cast({PATHS} as double) as u from pred_empirical p cross join paths
              union all
              select 'independent', p.*, path,
                     (cast('0x' || substr(md5(concat_ws('_', item_id, store_id, cast(date as varchar), cast(path as varchar), 'path')), 1, 8) as bigint) + 0.5) / cast(4294967296 as double)
              from pred_empirical p cross join paths
              union all select 'history', p.*, path, u from pred_empirical p join ranks using (fold_id, item_id, store_id)),
            sums as (select dependence, fold_id, d.date, s.category, d.store_id, path, sum({_quantile_at_sql('u')}) as total
                     from drawn d join segments s on s.item_id = d.item_id and s.store_id = d.store_id group by 1, 2, 3, 4, 5, 6)
        select dependence, fold_id, date, category, store_id, {", ".join(f"{R(f'quantile_cont(total, {v}) + cast(1e-9 as double)', 5)} as {n}" for n, v in QUANTILES.items())}
        from sums group by 1, 2, 3, 4, 5""",
)
def _(q):
    """Quantiles of the daily sum of each category and store, under three kinds of dependence between its series."""
    q.store_tables()
    predictions = checkpoint(q.predictions()["lgbm"], "predictions")
    train = fo.split_folds(q.sales_long(), q.folds(), roles=("train",))
    ranks = path_ranks(train, PATHS)
    parts = [
        quantiles_of_sums(predictions, q.segments(), ["category", "store_id"], how, PATHS, ranks).withColumn("dependence", F.lit(how))
        for how in DEPENDENCE
    ]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    # a hair above: halves of the last digit are common, and round alike in both engines then
    return out.withColumns({n: rounded(F.col(n) + 1e-9, 5) for n in QUANTILES})


@query(
    "agg_predictions",
    "select p.date, s.category, p.store_id, "
    + ", ".join(f"{R(f'sum({n})')} as sum_{n}" for n in ("p05", "p25", "p50", "p75", "p95"))
    + " from pred_empirical p join segments s using (item_id, store_id) group by 1, 2, 3",
)
def _(q):
    out = ev.aggregate_predictions(q.predictions()["lgbm"], q.segments())
    return out.withColumns({c: rounded(F.col(c)) for c in out.columns if c.startswith("sum_")})


@query(
    "agg_metrics",
    f"""select model, category, quantile_name as quantile, {R('avg(pinball_loss)')} as pinball_loss, date '2002-01-01' as run_date
        from {_by_category} where {STABLE} group by 1, 2, 3""",
)
def _(q):
    out = ev.aggregate_metrics(q.fact(), q.segments(), date(2002, 1, 1))
    return out.withColumn("pinball_loss", rounded(F.col("pinball_loss")))


@query(
    "error_heatmap",
    "select category, "
    + ", ".join(f"""{R(f"avg(pinball_loss) filter (store_id = '{s}')")} as {s}""" for s in HEAT_STORES)
    + f" from {_by_category} where {STABLE} and quantile_name = 'p50' group by 1",
)
def _(q):
    out = ev.error_heatmap(q.fact(), q.segments())  # a column for each store there is
    return out.withColumns({s: rounded(F.col(s)) for s in out.columns if s != "category"})


@query(
    "agg_weekly",
    f"""select cast(date_trunc('week', p.date) as date) as week, s.category, cast(sum(t.sales) as bigint) as actual_sales,
               {R('sum(p50)')} as pred_p50, {R('sum(p05)')} as pred_p05, {R('sum(p95)')} as pred_p95
        from pred_empirical p join sales_long t using (item_id, store_id, date)
        join segments s using (item_id, store_id) group by 1, 2""",
)
def _(q):
    out = ev.weekly_comparison(q.predictions()["lgbm"], q.sales_long(), q.segments())
    return out.withColumns({c: rounded(F.col(c)) for c in ("pred_p50", "pred_p05", "pred_p95")})


@query(
    "wspl",
    f"""with sc as (select fold_id, item_id, store_id, avg(abs(sales - prev)) as scale from
               (select *, lag(sales) over (partition by fold_id, item_id, store_id order by date) as prev from train) group by 1, 2, 3),
            rev as (select f.fold_id, s.item_id, s.store_id, coalesce(sum(s.sales * p.sell_price), 0) as rev from sales_long s
               join calendar c on c.date = s.date join folds f on s.date between f.train_end - 27 and f.train_end
               left join sell_prices p on p.item_id = s.item_id and p.store_id = s.store_id and p.wm_yr_wk = c.wm_yr_wk group by 1, 2, 3),
            w as (select *, rev / sum(rev) over (partition by fold_id) as weight from rev),
            l as (select model, fold_id, item_id, store_id, quantile_name, avg(pinball_loss) as loss from fact where {STABLE} group by 1, 2, 3, 4, 5)
        select model, fold_id, quantile_name, {R('sum(weight * loss / nullif(scale, 0)) / nullif(sum(weight) filter (scale <> 0), 0)')} as wspl
        from l join sc using (fold_id, item_id, store_id) join w using (fold_id, item_id, store_id) group by 1, 2, 3""",
)
def _(q):
    from registry.q_features import _priced

    q.store_records()
    q.store_tables()
    folds = q.folds()
    train = fo.split_folds(q.sales_long(), folds, roles=("train",))
    revenue = _priced(q, only=ev.weight_days(folds).select("date")).withColumn("revenue", F.col("sales") * F.col("sell_price"))
    out = ev.weighted_scaled_loss(q.fact(), ev.loss_scale(train), ev.revenue_weights(revenue, folds))
    return out.withColumn("wspl", rounded(F.col("wspl")))


@query(
    "walk_forward_loss",
    f"""select quantile_name, count(*) as n_obs, {R('avg(pinball_loss)')} as avg_pinball_loss from fact
        where model = 'lgbm' group by 1""",
)
def _(q):
    """Folds, forecast and loss in one chain."""
    q.store_tables()
    sales, folds = q.sales_long(), q.folds()
    predictions = walk_forward(sales, folds, empirical_quantiles)
    fact = ev.pinball_fact({"lgbm": predictions}, sales, q.segments(), q.arima_sample())
    return fact.groupBy("quantile_name").agg(
        F.count(F.lit(1)).alias("n_obs"), rounded(F.avg("pinball_loss")).alias("avg_pinball_loss")
    )
