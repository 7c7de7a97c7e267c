"""Folds and forecasters. Fitted models have no SQL twin: they are registered without one and
covered by property tests."""

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from panelcast.functions.numeric import missing, normal_quantiles, pinball, rounded
from panelcast.operators import checks as ck
from panelcast.operators import evaluate as ev
from panelcast.operators import folds as fo
from panelcast.operators.forecast import arima as ar
from panelcast.operators.forecast import boost as bo
from panelcast.operators.forecast import decomposed as de
from panelcast.operators.forecast import stl
from panelcast.operators.forecast.baseline import empirical_quantiles
from panelcast.operators.forecast.common import forecast_metadata
from panelcast.operators.regress import least_squares
from panelcast.operators.reshape import pivot_convergence
from panelcast.plans.evaluation import flags_only
from panelcast.plans.walk_forward import arima_forecaster, boost_walk_forward, decomposed_forecaster, walk_forward
from panelcast.schema import QUANTILE_NAMES, QUANTILES, Z_SCORES
from panelcast.session import checkpoint
from registry.core import query
from registry.q_reshape import R


@query(
    "make_folds",
    """select f.*, count(o.item_id) as n_records from folds f
       left join observed o on o.date between f.train_start and f.val_end group by all""",
)
def _(q):
    folds = fo.make_folds(q.observed())
    records = fo.split_folds(q.observed(), folds).groupBy("fold_id").agg(F.count(F.lit(1)).alias("n_records"))
    return folds.join(records, "fold_id")


@query(
    "single_fold",
    """select train_start, train_end, val_start, val_end, count(*) as n_records
       from (select max(date) - 27 - 365 as train_start, max(date) - 28 as train_end, max(date) - 27 as val_start,
                    max(date) as val_end from observed) f join observed o on o.date between f.train_start and f.val_end
       group by all""",
)
def _(q):
    fold = fo.single_fold(q.spark, fo.date_bounds(q.observed())[1])
    rows = fo.split_folds(q.observed(), fold).groupBy("fold_id").agg(F.count(F.lit(1)).alias("n_records"))
    return fold.join(rows, "fold_id").drop("fold_id")


@query(
    "split_folds",
    """select f.fold_id, 'train' as role, item_id, store_id, date, sales from sales_long
       join folds f on date between f.train_start and f.train_end
       union all
       select f.fold_id, 'val' as role, item_id, store_id, date, sales from sales_long
       join folds f on date between f.val_start and f.val_end""",
)
def _(q):
    return fo.split_folds(q.sales_long(), q.folds())


@query(
    "normal_quantiles",
    f"""select fold_id, item_id, store_id, {", ".join(
        f"{R('greatest(m, 0)' if n == 'p50' else f'greatest(m + cast({z} as double) * sd, 0)')} as {n}" for n, z in Z_SCORES.items())}
        from (select fold_id, item_id, store_id, avg(sales) as m, stddev_samp(sales) as sd from train group by 1, 2, 3)""",
)
def _(q):
    train = fo.split_folds(q.sales_long(), q.folds(), roles=("train",))
    stats = train.groupBy("fold_id", "item_id", "store_id").agg(
        F.avg("sales").alias("m"), F.stddev_samp("sales").alias("sd")
    )
    cols = normal_quantiles(F.col("m"), F.col("sd"))
    return stats.select("fold_id", "item_id", "store_id", *[rounded(c).alias(n) for n, c in cols.items()])


@query(
    "empirical_quantiles",
    "select item_id, store_id, date, fold_id, "
    + ", ".join(f"{R(n)} as {n}" for n in QUANTILE_NAMES)
    + " from pred_empirical",
)
def _(q):
    rows = walk_forward(q.sales_long(), q.folds(), empirical_quantiles)
    return rows.withColumns({n: rounded(F.col(n)) for n in QUANTILE_NAMES})


@query(
    "forecast_metadata",
    f"""select p.item_id, p.store_id, p.fold_id, s.categoria_zero_rate, {R('s.tasa_ceros')} as tasa_ceros,
               max(case when isnan(p.p05) or p.p05 is null then 1 else 0 end) = 1 as fallo_incertidumbre
        from pred_bqml p left join segments s using (item_id, store_id) group by 1, 2, 3, 4, 5""",
)
def _(q):
    out = forecast_metadata(q.predictions()["bqml"], q.segments())
    return out.withColumn("tasa_ceros", rounded(F.col("tasa_ceros")))


_days = "(partition by fold_id, item_id, store_id order by date)"


def _mean(x: str) -> str:
    return f"avg({x}) over (partition by fold_id, item_id, store_id)"


def _kpss_sql(j: int) -> str:
    """The statistic of a window of 365 days (364 steps), with four lags in its variance."""
    products = " + ".join(f"{2 * (5 - k)} / cast(5 as double) * coalesce(sum(e{j} * e{j}_{k}), 0)" for k in range(1, 5))
    return f"sum(w{j} * w{j}) / nullif(count(e{j}) * (sum(e{j} * e{j}) + {products}), 0) as k{j}"


_group = "partition by fold_id, item_id, store_id"


@query(
    "decompose",
    f"""with a as (select t.*, cast(t.sales as double) as v, c.is_event, dayofweek(t.date) as dow, month(t.date) as mon
                   from train t left join calendar_flags c on c.date = t.date),
            b as (select *, quantile_cont(v, 0.5) over ({_group}) as med from a),
            c as (select *, quantile_cont(abs(v - med), 0.5) over ({_group}) as mad from b),
            d as (select *, case when mad > 0 then least(greatest(v, med - cast(5 * 1.4826 as double) * mad), med + cast(5 * 1.4826 as double) * mad) else v end as clean from c),
            e as (select *, avg(clean) over ({_group}) as lev, avg(clean) over ({_group}, dow) - avg(clean) over ({_group}) as wd from d),
            f as (select *, avg(clean - lev - wd) over ({_group}, mon) as me from e),
            g as (select *, clean - wd - me as rest from f),
            h as (select *, coalesce(avg(case when is_event = 1 then rest - lev end) over ({_group}), 0) as ev from g)
        select fold_id, item_id, store_id, date, {R('clean', 5)} as clean, {R('wd', 5)} as weekday_effect,
               {R('me', 5)} as month_effect, {R('ev', 5)} as event_effect,
               {R('rest - case when is_event = 1 then ev else 0 end', 5)} as remainder from h""",
)
def _(q):
    train = fo.split_folds(q.sales_long(), q.folds(), roles=("train",))
    parts = de.decompose(train, flags_only(q.calendar()))
    names = ["clean", "weekday_effect", "month_effect", "event_effect", "remainder"]
    return parts.select(
        "fold_id", "item_id", "store_id", "date", *[rounded(F.col(c), 5).alias(c) for c in names]
    )


def _loess_sql(source: str, value: str, offsets, unit: int, band: float, at: float = 0, key: str = "n") -> str:
    """Value of a tricube-weighted line at ``at``, for every row of ``source`` (s, n, value): its neighbours by number."""
    points = ", ".join(f"({k}, cast({max(0.0, 1 - abs((k / unit - at) / band) ** 3) ** 3!r} as double), cast({k / unit - at!r} as double))" for k in offsets)
    return f"""select s, n, case when s0 * s2 - s1 * s1 > 1e-9 * s0 * s0 then (s2 * y0 - s1 * y1) / (s0 * s2 - s1 * s1) else y0 / s0 end as v
        from (select a.s, a.n, sum(w) as s0, sum(w * x) as s1, sum(w * x * x) as s2, sum(w * b.{value}) as y0, sum(w * x * b.{value}) as y1
              from {source} a cross join (values {points}) p(k, w, x) join {source} b on b.s = a.s and b.n = a.n + k group by 1, 2)"""


def _low_pass_sql() -> str:
    weights = np.convolve(np.convolve(np.ones(7) / 7, np.ones(7) / 7), np.ones(3) / 3)
    return ", ".join(f"({k - 7}, cast({float(w)!r} as double))" for k, w in enumerate(weights))


@query(
    "stl_pass",
    f"""with y as (select dense_rank() over (order by fold_id, item_id, store_id) as s, row_number() over (partition by fold_id, item_id, store_id order by date) as n,
                      fold_id, item_id, store_id, date, cast(sales as double) as v from train),
            size as (select s, max(n) as most from y group by 1),
            mid as ({_loess_sql("y", "v", range(-21, 22, 7), 7, 4.0)}),
            low as ({_loess_sql("y", "v", range(0, 22, 7), 7, 4.0, -1)}),
            high as ({_loess_sql("y", "v", range(-21, 1, 7), 7, 4.0, 1)}),
            cycles as (select s, n, v from mid union all select s, n - 7, v from low where n <= 7
                       union all select s, n + 7, h.v from high h join size using (s) where n > most - 7),
            passed as (select a.s, a.n, sum(w * b.v) as v from mid a cross join (values {_low_pass_sql()}) p(k, w) join cycles b on b.s = a.s and b.n = a.n + k group by 1, 2),
            flat as ({_loess_sql("passed", "v", range(-3, 4), 1, 4.0)}),
            season as (select m.s, m.n, m.v - f.v as seasonal, y.v - m.v + f.v as v from mid m join flat f using (s, n) join y using (s, n)),
            line as ({_loess_sql("season", "v", range(-7, 8), 1, 8.0)})
       select fold_id, item_id, store_id, date, {R('seasonal', 5)} as seasonal, {R('l.v', 5)} as trend
       from y join season using (s, n) join line l using (s, n)""",
)
def _(q):
    """Seasonal and trend after one inner pass, from a trend of 0 and equal weights."""
    train = fo.split_folds(q.sales_long(), q.folds(), roles=("train",))
    group = ["fold_id", "item_id", "store_id"]
    rows = train.withColumns({"y": F.col("sales").cast("double"), "trend": F.lit(0.0), "rho": F.lit(1.0)})
    out = stl.inner_pass(rows, group, "date", "y")
    return out.select(*group, "date", rounded(F.col("seasonal"), 5).alias("seasonal"), rounded(F.col("trend"), 5).alias("trend"))


@query(
    "calendar_effects",
    f"""with a as (select fold_id, item_id, store_id, cast(sales as double) as y, cast(is_event as double) as e,
                          cast(datediff('day', min(date) over (partition by fold_id, item_id, store_id), date) as double) as x
                   from train join calendar_flags using (date)),
            m as (select fold_id, item_id, store_id, var_pop(x) as xx, var_pop(e) as ee, covar_pop(x, e) as xe, covar_pop(x, y) as xy, covar_pop(e, y) as ey
                  from a group by 1, 2, 3)
       select fold_id, item_id, store_id, {R('(xy * ee - ey * xe) / (xx * ee - xe * xe)', 6)} as slope, {R('(ey * xx - xy * xe) / (xx * ee - xe * xe)', 6)} as event
       from m""",
)
def _(q):
    """Line and event effect of every training window, fitted together."""
    train = fo.split_folds(q.sales_long(), q.folds(), roles=("train",)).join(flags_only(q.calendar()), "date")
    first = F.min("date").over(Window.partitionBy("fold_id", "item_id", "store_id"))
    rows = train.withColumn("x", F.datediff("date", first))
    regressors = {"level": F.lit(1.0), "slope": F.col("x"), "event": F.col("is_event")}
    found = least_squares(rows, ["fold_id", "item_id", "store_id"], regressors, F.col("sales"))
    return found.select("fold_id", "item_id", "store_id", rounded(F.col("slope")).alias("slope"), rounded(F.col("event")).alias("event"))


@query("arima_per_series")
def _(q):
    return walk_forward(q.sales_long(), q.folds(), arima_forecaster())


@query("fit_metadata")
def _(q):
    train = fo.split_folds(q.sales_long(), q.folds(), roles=("train",))
    return ar.arima_metadata(ar.fit_arima(ar.training_arrays(train)), q.segments())


@query("arima_plus")
def _(q):
    return walk_forward(q.sales_long(), q.folds(), decomposed_forecaster(flags_only(q.calendar())))


@query(
    "arima_plus_contract",
    """select f.fold_id, count(*) as n_rows, count(distinct (item_id, store_id)) as n_series, min(cast(p.date as date)) as first_day,
              max(cast(p.date as date)) as last_day, cast(0 as bigint) as n_negative, cast(0 as bigint) as n_crossed, cast(0 as bigint) as n_without_p50
       from folds f join (select item_id, store_id, unnest(generate_series(val_start, val_end, interval 1 day)) as date, fold_id
                          from (select distinct item_id, store_id from sales_long) cross join folds) p on p.fold_id = f.fold_id
       group by 1""",
)
def _(q):
    """What must hold for the decomposition forecasts of every series and fold, whatever their values."""
    rows = walk_forward(q.sales_long(), q.folds(), decomposed_forecaster(flags_only(q.calendar())))
    crossed = F.lit(False)
    for low, high in zip(QUANTILE_NAMES, QUANTILE_NAMES[1:]):
        crossed = crossed | (F.col(low) > F.col(high))
    return rows.groupBy("fold_id").agg(
        F.count("*").alias("n_rows"),
        F.count_distinct(F.struct("item_id", "store_id")).alias("n_series"),
        F.min("date").alias("first_day"),
        F.max("date").alias("last_day"),
        F.count_if(F.least(*QUANTILE_NAMES) < 0).alias("n_negative"),
        F.count_if(crossed).alias("n_crossed"),
        F.count_if(missing(F.col("p50"))).alias("n_without_p50"),
    )


#: Every series of a sample and fold has one verdict; a converged fit has its 28 days, a failed one none.
_fit_contract_sql = """
  select fold_id, count(*) as n_fits, cast(0 as bigint) as n_inconsistent, cast(0 as bigint) as n_wrong_days,
         cast(0 as bigint) as n_bad_quantiles, true as some_converged
  from (select distinct item_id, store_id from sales_long) cross join folds group by 1"""


@query("arima_contract", _fit_contract_sql)
def _(q):
    """Metadata and forecasts of one fitting run against each other, over all series and folds."""
    folds = q.folds()
    train = fo.split_folds(q.sales_long(), folds, roles=("train",))
    fits = checkpoint(ar.fit_arima(ar.training_arrays(train)), "arima-fits")
    rising = F.forall(F.sequence(F.lit(1), F.lit(4)), lambda i: F.element_at("q", i) <= F.element_at("q", i + 1))
    fine = rising & (F.element_at("q", 1) >= 0)
    rows = (
        ar.arima_predictions(fits, folds)
        .withColumn("q", F.array(*QUANTILE_NAMES))
        .join(folds.select("fold_id", "val_start", "val_end"), "fold_id")
        .groupBy("fold_id", "item_id", "store_id")
        .agg(
            F.count_distinct(F.when(F.col("date").between(F.col("val_start"), F.col("val_end")), F.col("date"))).alias("days"),
            F.count("*").alias("n"),
            F.count_if(~F.coalesce(fine, F.lit(False))).alias("bad"),
        )
    )
    verdicts = ar.arima_metadata(fits, q.segments())
    reasons = F.col("razon_fallo").isNull() & F.col("aic").isNotNull() & F.col("p").isNotNull()
    due = F.when(F.col("convergio"), 28).otherwise(0)
    return (
        verdicts.join(rows, ["fold_id", "item_id", "store_id"], "left")
        .groupBy("fold_id")
        .agg(
            F.count("*").alias("n_fits"),
            F.count_if(F.col("convergio") != reasons).alias("n_inconsistent"),
            F.count_if((F.coalesce("days", F.lit(0)) != due) | (F.coalesce("n", F.lit(0)) != due)).alias("n_wrong_days"),
            F.coalesce(F.sum("bad"), F.lit(0)).alias("n_bad_quantiles"),
            F.bool_or("convergio").alias("some_converged"),
        )
    )


@query(
    "differencing_order",
    f"""with e as (select *, {_mean('sales')} as m0, sales - lag(sales) over {_days} as step from train),
            f as (select *, {_mean('step')} as m1 from e),
            s as (select fold_id, item_id, store_id, date, sales - m0 as e0, step - m1 as e1 from f),
            t as (select *, sum(e0) over {_days} as w0, sum(e1) over {_days} as w1,
                         {", ".join(f"lag(e{j}, {k}) over {_days} as e{j}_{k}" for j in (0, 1) for k in range(1, 5))} from s),
            k as (select fold_id, item_id, store_id, {", ".join(_kpss_sql(j) for j in (0, 1))} from t group by 1, 2, 3)
        select fold_id, item_id, store_id, {R('k0', 6)} as kpss_level, {R('k1', 6)} as kpss_step,
               case when k0 > 0.463 then case when k1 > 0.463 then 2 else 1 end else 0 end as d from k""",
)
def _(q):
    train = fo.split_folds(q.sales_long(), q.folds(), roles=("train",))
    y = F.col("y")
    return ar.training_arrays(train).select(
        "fold_id",
        "item_id",
        "store_id",
        rounded(ar.kpss(y), 6).alias("kpss_level"),
        rounded(ar.kpss(ar.steps(y)), 6).alias("kpss_step"),
        ar.differencing_order(y).alias("d"),
    )


#: For queries on what holds after any number of rounds: fewer than the study's 1,000, at a higher rate; README has the time of a round.
BOOST = bo.BoostParams(rounds=8, learning_rate=0.3)


@query("quantile_boost")
def _(q):
    """A model of its own for every fold and level, of the study's full size, fitted on the fold's training window, and its
    forecast of the validation days."""
    return boost_walk_forward(q.features(), q.folds(), bo.BoostParams())


@query(
    "quantile_boost_contract",
    """select s.item_id, s.store_id, v.fold_id, count(*) as n_rows, min(v.date) as first_day, max(v.date) as last_day,
              cast(0 as bigint) as n_bad_quantiles
       from (select distinct item_id, store_id from sales_long) s cross join val_days v
       group by 1, 2, 3""",
)
def _(q):
    """What must hold for the boosted forecasts of every series and fold, whatever their values."""
    crossed = F.lit(False)
    for low, high in zip(QUANTILE_NAMES, QUANTILE_NAMES[1:]):
        crossed = crossed | (F.col(low) > F.col(high))
    bad = crossed | (F.col(QUANTILE_NAMES[0]) < 0) | missing(F.col("p50"))
    return (
        boost_walk_forward(q.features(), q.folds(), BOOST)
        .groupBy("item_id", "store_id", "fold_id")
        .agg(
            F.count("*").alias("n_rows"),
            F.min("date").alias("first_day"),
            F.max("date").alias("last_day"),
            F.count_if(bad).alias("n_bad_quantiles"),
        )
    )


@query(
    "predict_quantiles",
    """select fold_id, count(*) as n_rows, cast(0 as bigint) as n_different, true as some_moved
       from (select distinct item_id, store_id from sales_long) cross join val_days group by 1""",
)
def _(q):
    """Quantiles (scored, clipped at zero, sorted) in one pass over the stored ensemble against one pass for each of its
    rounds, added up before they are clipped and sorted, for all validation rows."""
    tagged = checkpoint(fo.split_folds(q.features(), q.folds()), "fold-features")
    params = bo.BoostParams(rounds=3, learning_rate=0.3)
    model = bo.fit_quantile_boost(tagged.where("role = 'train'"), params=params)
    nodes = checkpoint(model.table(q.spark), "ensemble")
    rounds = [f"round_{r}" for r in range(params.rounds)]
    passes = {"start": nodes.where("round < 0")} | {c: nodes.where(F.col("round") == r) for r, c in enumerate(rounds)}
    scores = {c: bo.score_quantiles(model.with_table(part), tagged) for c, part in passes.items()}
    rows = tagged.where("role = 'val'").withColumns(scores)
    whole = bo.predict_quantile_boost(model.with_table(nodes), rows, keep=("start", *rounds))
    summed = F.col("start")
    for c in rounds:
        summed = F.zip_with(summed, F.zip_with(c, "start", lambda x, y: x - y), lambda x, y: x + y)
    ordered = lambda x: F.array_sort(F.transform(x, lambda v: F.when(v < 0, 0.0).otherwise(v)))
    got = F.array(*QUANTILE_NAMES)
    gap = F.array_max(F.zip_with(got, ordered(summed), lambda x, y: F.abs(x - y)))
    return whole.groupBy("fold_id").agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.coalesce(gap > 1e-9, F.lit(True))).alias("n_different"),
        F.bool_or(got != ordered(F.col("start"))).alias("some_moved"),
    )


@query(
    "boost_histogram",
    """with rows as (select f.fold_id, s.sales, dayofweek(s.date) + 1 as day_of_week, month(s.date) as month
                     from sales_long s join folds f on s.date between f.train_start and f.train_end),
            starts as (select fold_id, unnest(['p05', 'p25', 'p50', 'p75', 'p95']) as level, unnest(quantile_disc(sales, [0.05, 0.25, 0.5, 0.75, 0.95])) as start
                       from rows group by fold_id),
            cells as (select fold_id, 'day_of_week' as feature, day_of_week as category, sales from rows
                      union all select fold_id, 'month', month, sales from rows)
       select fold_id, level, feature, cast(category as varchar) as category, count(*) as n_rows, count(*) filter (sales < start) as n_below
       from cells join starts using (fold_id) group by all""",
)
def _(q):
    """The counts from which a first tree is grown: rows and rows below the start, by fold, level, feature and category."""
    features = ["day_of_week", "month"]
    train = fo.split_folds(q.sales_long(), q.folds(), roles=("train",))
    train = train.withColumns({"day_of_week": F.dayofweek("date"), "month": F.month("date"), "fold_id": F.col("fold_id").cast("int")})
    disc = ", ".join(f"percentile_disc({a}) within group (order by sales)" for a in QUANTILES.values())
    exact = train.groupBy("fold_id").agg(F.expr(f"array({disc})").alias("starts")).collect()
    starts = {r["fold_id"]: [float(x) for x in r["starts"]] for r in exact}
    bins = bo.fit_bins(train, [], features)
    chunks = bo.pack(train, "sales", bins, starts, [], features)
    root = bo.Growth(bo.BoostParams(), 0.5, np.array([True, True])).tree()
    counts = bo.count_nodes(chunks, {f: {i: (root, [0]) for i in range(len(QUANTILES))} for f in starts}, len(features), 64)
    rows = [
        (f, QUANTILE_NAMES[i], features[j], category, int(table[0, j, code].sum()), int(table[0, j, code, 1]))
        for (f, i), table in counts.items() for j in range(len(features)) for category, code in bins[f].codes[j].items()
    ]
    return q.spark.createDataFrame(rows, "fold_id int, level string, feature string, category string, n_rows long, n_below long")


@query(
    "convergence_of_fits",
    """select fold_id, categoria_zero_rate, count(*) as n_series, count(*) as n_verdicts, true as pivot_agrees, true as coverage_agrees
       from segments cross join (select fold_id from folds) group by 1, 2""",
)
def _(q):
    """The convergence reports on the verdicts of real fits: summary by fold and segment, against the pivot by fold and the
    coverage of the forecasts by segment."""
    q.store_tables()
    segments, folds = q.segments(), q.folds()
    train = fo.split_folds(q.sales_long(), folds, roles=("train",))
    fits = checkpoint(ar.fit_arima(ar.training_arrays(train)), "report-fits")
    verdicts = ar.arima_metadata(fits, segments)
    summary = ev.convergence_summary(verdicts)
    by_fold = summary.groupBy("fold_id").agg(F.sum("n_convergio").alias("yes"), F.sum("n_fallo").alias("no"))
    pivot = pivot_convergence(verdicts).join(by_fold, "fold_id").select(
        "fold_id", ((F.col("yes") == F.col("n_convergio")) & (F.col("no") == F.col("n_fallo"))).alias("pivot_agrees")
    )
    fitted = verdicts.groupBy("categoria_zero_rate").agg(F.count_distinct(F.when(F.col("convergio"), F.struct("item_id", "store_id"))).alias("fitted"))
    coverage = ck.check_coverage(segments, ar.arima_predictions(fits, folds)).join(fitted, "categoria_zero_rate").select(
        "categoria_zero_rate", (F.col("fitted") == F.col("n_con_modelo")).alias("coverage_agrees")
    )
    return (
        summary.join(pivot, "fold_id")
        .join(coverage, "categoria_zero_rate")
        .select("fold_id", "categoria_zero_rate", "n_series", (F.col("n_convergio") + F.col("n_fallo")).alias("n_verdicts"), "pivot_agrees", "coverage_agrees")
    )


@query(
    "fitted_models_evaluated",
    """select model, fold_id, n_series, cast(0 as bigint) as n_wrong_series, cast(0 as bigint) as n_wrong_losses, true as rollup_agrees
       from (select unnest(['arima', 'bqml', 'lgbm']) as model) cross join (select fold_id from folds)
       cross join (select count(distinct (item_id, store_id)) as n_series from sales_long)""",
)
def _(q):
    """Folds, the three fitted forecasters, loss fact and roll-up in one chain, over all series.

    By model and fold: series whose rows of the fact are not those that the fit owes (ARIMA: 28 days of five levels if its
    fit converged, else none; boosting: all; decomposition: every median), losses that do not follow from their row, and
    whether the roll-up by fold holds the same rows and total loss as the fact.
    """
    q.store_tables()
    sales, folds, segments = q.sales_long(), q.folds(), q.segments()
    fits = checkpoint(ar.fit_arima(ar.training_arrays(fo.split_folds(sales, folds, roles=("train",)))), "evaluated-fits")
    models = {
        "arima": ar.arima_predictions(fits, folds),
        "bqml": walk_forward(sales, folds, decomposed_forecaster(flags_only(q.calendar()))),
        "lgbm": boost_walk_forward(q.features(), folds, BOOST),
    }
    fact = checkpoint(ev.pinball_fact(models, sales, segments, q.arima_sample()), "evaluated-fact")
    keys = ["model", "fold_id", "item_id", "store_id"]
    found = fact.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.count_if(F.col("quantile_name") == "p50").alias("medians"),
        F.count_if(~F.coalesce(F.col("pinball_loss") == pinball(F.col("quantile_level"), F.col("y_true"), F.col("y_pred")), F.lit(False))).alias("wrong"),
    )
    verdicts = ar.arima_metadata(fits, segments).select("item_id", "store_id", "fold_id", "convergio")
    owed = verdicts.withColumn("model", F.explode(F.array(*map(F.lit, models))))
    joined = owed.join(found, keys, "left").na.fill(0, ["n", "medians", "wrong"])
    full = 28 * len(QUANTILE_NAMES)
    due = (
        F.when(F.col("model") == "arima", F.col("n") == F.when(F.col("convergio"), full).otherwise(0))
        .when(F.col("model") == "bqml", F.col("medians") == 28)
        .otherwise(F.col("n") == full)
    )
    by_fit = joined.groupBy("model", "fold_id").agg(
        F.count("*").alias("n_series"), F.count_if(~due).alias("n_wrong_series"), F.sum("wrong").alias("n_wrong_losses")
    )
    stable = fact.where(~F.col("bqml_unstable_series")).groupBy("model", "fold_id").agg(F.count("*").alias("n"), F.sum("pinball_loss").alias("loss"))
    rolled = ev.metrics_by_fold(fact).groupBy("model", "fold_id").agg(
        F.sum("n_obs").alias("rolled_n"), F.sum(F.col("n_obs") * F.col("avg_pinball_loss")).alias("rolled_loss")
    )
    agrees = (F.col("n") == F.col("rolled_n")) & (F.abs(F.col("loss") - F.col("rolled_loss")) <= 1e-9 * F.abs(F.col("loss")))
    rollup = stable.join(rolled, ["model", "fold_id"]).select("model", "fold_id", agrees.alias("rollup_agrees"))
    return by_fit.join(rollup, ["model", "fold_id"])
