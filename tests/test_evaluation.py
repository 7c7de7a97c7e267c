from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import days
from panelcast.functions import numeric as nm
from panelcast.operators import checks as ck
from panelcast.operators import evaluate as ev
from panelcast.operators.forecast import baseline as bl
from panelcast.plans.evaluation import evaluate_all, flags_only
from panelcast.schema import QUANTILE_NAMES, ZERO_RATE_LABELS

START = date(2020, 1, 1)
NAN = float("nan")
WIDE = "item_id string, store_id string, date date, p05 double, p25 double, p50 double, p75 double, p95 double, fold_id int"


def test_pinball_hand_values(spark):
    df = spark.createDataFrame([(0.0, 1.0, 0.05), (0.0, 1.0, 0.5), (0.0, 1.0, 0.95), (3.0, 1.0, 0.05), (3.0, 1.0, 0.5), (3.0, 1.0, 0.95)], "y double, p double, q double")
    got = [r[0] for r in df.select(nm.pinball(F.col("q"), F.col("y"), F.col("p"))).collect()]
    assert got == pytest.approx([0.95, 0.5, 0.05, 0.1, 1.0, 1.9])


def test_null_spread_gives_null_quantiles_not_zero(spark):
    df = spark.createDataFrame([(2.0, None), (2.0, NAN), (-2.0, 1.0)], "m double, s double")
    q = nm.normal_quantiles(F.col("m"), F.col("s"))
    rows = df.select(*[c.alias(n) for n, c in q.items()]).collect()
    assert rows[0]["p05"] is None and rows[0]["p50"] == 2.0
    assert rows[1]["p95"] != rows[1]["p95"] and rows[1]["p50"] == 2.0
    assert rows[2]["p50"] == 0.0


def test_sorted_quantiles(spark):
    df = spark.createDataFrame([(3.0, 1.0, 2.0, 5.0, 4.0), (NAN, 1.0, 2.0, 0.0, 4.0), (None, 3.0, 1.0, 2.0, 0.0)], ", ".join(f"{q} double" for q in QUANTILE_NAMES))
    out = [list(r) for r in df.select(*[c.alias(n) for n, c in nm.sorted_quantiles().items()]).collect()]
    assert out[0] == [1.0, 2.0, 3.0, 4.0, 5.0]
    assert out[1][:4] == [0.0, 1.0, 2.0, 4.0] and out[1][4] != out[1][4]
    assert out[2] == [0.0, 1.0, 2.0, 3.0, None]


def test_exceeds_treats_nan_as_false(spark):
    df = spark.createDataFrame([(NAN,), (None,), (1001.0,), (1000.0,)], "x double")
    assert [r[0] for r in df.select(nm.exceeds(F.col("x"), 1000.0)).collect()] == [False, False, True, False]


def test_tri_state(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.2, 1.0), (None, 1.0), (1.0, None)], "a double, b double")
    assert [r[0] for r in df.select(nm.tri_state_changed(F.col("a"), F.col("b"))).collect()] == [0, 1, None, None]


@pytest.fixture(scope="module")
def world(spark):
    """Two series, two folds of three days; the second model explodes on one fit."""
    actual = spark.createDataFrame([(i, "CA_1", d, 2) for i in ("A_1_1", "B_1_1") for d in days(START, 6)], "item_id string, store_id string, date date, sales bigint")

    def model(shift, items=("A_1_1", "B_1_1"), boom=False):
        rows = []
        for i in items:
            for k, d in enumerate(days(START, 6)):
                fold = 1 if k < 3 else 2
                base = [0.0 + shift, 1.0 + shift, 2.0 + shift, 3.0 + shift, 4.0 + shift]
                if boom and i == "B_1_1" and k == 4:
                    base[4] = 1e9
                rows.append((i, "CA_1", d, *base, fold))
        return spark.createDataFrame(rows, WIDE)

    segments = spark.createDataFrame([("A_1_1", "CA_1", "A", 0.1, "rapido"), ("B_1_1", "CA_1", "B", 0.9, "muy_lento")], "item_id string, store_id string, category string, tasa_ceros double, categoria_zero_rate string")
    sample = segments.where("item_id = 'A_1_1'")
    predictions = {"arima": model(0.0, ("A_1_1",)), "bqml": model(1.0, boom=True), "lgbm": model(0.5)}
    return predictions, actual, segments, sample


def test_fact_shape_and_exclusion_grain(spark, world):
    predictions, actual, segments, sample = world
    fact = ev.pinball_fact(predictions, actual, segments, sample)
    assert fact.count() == (6 + 12 + 12) * 5
    bad = fact.where("bqml_unstable_series")
    assert bad.count() == 15 and bad.select("model", "fold_id", "item_id").distinct().count() == 1
    assert tuple(ev.exclusion_report(fact).first()) == (15, 1)
    assert fact.where("in_arima_sample").select("item_id").distinct().collect()[0][0] == "A_1_1"
    p50 = fact.where("model = 'lgbm' and quantile_name = 'p50'").agg(F.avg("pinball_loss")).first()[0]
    assert p50 == pytest.approx(0.25)
    overall = {(r["model"], r["quantile_name"], r["in_arima_sample"]): r["n_obs"] for r in ev.metrics_overall(fact).collect()}
    assert overall["bqml", "p50", False] == 3 and overall["lgbm", "p50", False] == 6


def test_unstable_ignores_nan(spark):
    df = spark.createDataFrame([("a", "s", START, NAN, NAN, 1.0, NAN, NAN, 1), ("b", "s", START, 0.0, 0.0, 1.0, 1.0, 1001.0, 1)], WIDE)
    assert [r["item_id"] for r in ev.unstable_series(df).collect()] == ["b"]


def test_rollups_agree_with_single_rollups(spark, world):
    fact = ev.pinball_fact(*world)
    one = ev.rollups_in_one_pass(fact, ["fold_id", "categoria_zero_rate"])
    pick = lambda df: sorted((*r,) for r in df.collect())
    cols = ["model", "quantile_name", "in_arima_sample", "n_obs", "avg_pinball_loss"]
    assert pick(one.where("roll_up = 'overall'").select(cols)) == pick(ev.metrics_overall(fact).select(cols))
    assert pick(one.where("roll_up = 'fold_id'").select("bucket", *cols)) == pick(ev.metrics_by_fold(fact).select(F.col("fold_id").cast("string"), *cols))


def test_two_scopes_and_strict(spark, world):
    fact = ev.pinball_fact(*world)
    out = {(r["scope"], r["categoria_zero_rate"]): r for r in ev.two_scope_compare(ev.metrics_by_zero_rate(fact), "categoria_zero_rate", ZERO_RATE_LABELS).collect()}
    assert set(out) == {("fair", "rapido"), ("full", "rapido"), ("full", "muy_lento")}
    assert out["fair", "rapido"]["arima"] == pytest.approx(0.0) and out["full", "rapido"]["arima"] is None
    assert out["full", "muy_lento"]["n_obs"] == 9
    strict = ev.strict_scope(fact)
    assert strict.select("item_id").distinct().count() == 1 and strict.count() == 90


def test_evaluate_all_tables(spark, world, tmp_path):
    predictions, actual, segments, sample = world
    calendar = spark.createDataFrame([(d, "X" if d.day == 2 else None, None, None) for d in days(START, 6)], "date date, event_name_1 string, event_name_2 string, event_type_1 string")
    releases = spark.createDataFrame([("A_1_1", "CA_1", START)], "item_id string, store_id string, release_date date")
    tables = evaluate_all(spark, str(tmp_path), predictions, actual, segments, sample, releases, flags_only(calendar))
    n = tables["cv_pinball_loss"].where("not bqml_unstable_series").count()
    for name in ("cv_metrics_overall", "cv_metrics_by_event", "cv_metrics_by_release_age", "cv_metrics_by_product_category"):
        assert tables[name].agg(F.sum("n_obs")).first()[0] == n
    ages = {r[0] for r in tables["cv_metrics_by_release_age"].select("release_age_bucket").distinct().collect()}
    assert ages == {"nuevo_lt_90d", "sin_release_date"}


def test_release_age_buckets(spark):
    rows = [(START, None), (START, date(2020, 1, 2)), (START, START), (date(2020, 3, 30), START), (date(2020, 3, 31), START)]
    df = spark.createDataFrame(rows, "d date, r date")
    got = [x[0] for x in df.select(ev.release_age_bucket(F.col("d"), F.col("r"))).collect()]
    assert got == ["sin_release_date", "antes_de_release", "nuevo_lt_90d", "nuevo_lt_90d", "establecido"]


def test_wspl_hand_value(spark, world):
    predictions, actual, segments, sample = world
    fact = ev.pinball_fact({"lgbm": predictions["lgbm"]}, actual, segments, sample)
    scales = spark.createDataFrame([(f, i, "CA_1", s) for f in (1, 2) for i, s in (("A_1_1", 0.5), ("B_1_1", 2.0))], "fold_id int, item_id string, store_id string, scale double")
    weights = spark.createDataFrame([(f, i, "CA_1", w) for f in (1, 2) for i, w in (("A_1_1", 0.25), ("B_1_1", 0.75))], "fold_id int, item_id string, store_id string, weight double")
    out = {(r["fold_id"], r["quantile_name"]): r["wspl"] for r in ev.weighted_scaled_loss(fact, scales, weights).collect()}
    assert out[1, "p50"] == pytest.approx(0.25 * 0.25 / 0.5 + 0.75 * 0.25 / 2.0)


def test_checks_separate_nan_from_crossing(spark):
    rows = [
        ("a", "s", START, 0.0, 1.0, 2.0, 3.0, 4.0, 1),
        ("b", "s", START, 0.0, 3.0, 2.0, 3.0, 4.0, 1),
        ("c", "s", START, NAN, NAN, 2.0, NAN, NAN, 1),
        ("d", "s", START, -1.0, 1.0, 2.0, 3.0, 4.0, 1),
    ]
    p = spark.createDataFrame(rows, WIDE)
    assert tuple(ck.check_monotone(p).first()) == (4, 1, 1)
    assert ck.check_negative(p).first()[0] == 1
    assert tuple(ck.check_nan(p).first()) == (1, 1, 0)
    assert {r["item_id"] for r in ck.monotone_violations(p).collect()} == {"b", "c"}
    assert tuple(ck.check_counts(p, 1).first()) == (4, 4, 1, True)


def test_check_mapping_and_forecast_range(spark):
    seg = spark.createDataFrame([("x",), ("x",), ("y",)], "c string")
    exp = spark.createDataFrame([("x", 2), ("z", 1)], "c string, n_expected bigint")
    assert {r["c"]: r["ok"] for r in ck.check_mapping(seg, "c", exp).collect()} == {"x": True, "y": False, "z": False}
    folds = spark.createDataFrame([(1, START, date(2020, 1, 2)), (2, START, date(2020, 1, 3))], "fold_id int, val_start date, val_end date")
    p = spark.createDataFrame([(f, d) for f in (1, 2) for d in days(START, 2)], "fold_id int, date date")
    assert {r["fold_id"]: r["ok"] for r in ck.check_forecast_range(p, folds).collect()} == {1: True, 2: False}


def test_fact_joins_only_validated_days(spark, world):
    """Actuals of days outside the folds do not reach the join; the fact is the same."""
    predictions, actual, segments, sample = world
    more = actual.unionByName(actual.withColumn("date", F.date_add("date", 30)))
    folds = spark.createDataFrame([(1, START, date(2020, 1, 3)), (2, date(2020, 1, 4), date(2020, 1, 6))], "fold_id int, val_start date, val_end date")
    plain, cut = ev.pinball_fact(*world), ev.pinball_fact(predictions, more, segments, sample, folds=folds)
    assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, plain.collect()))
    assert "LeftSemi" in cut._jdf.queryExecution().optimizedPlan().toString()


def test_window_stats_serve_both_baselines(spark, panel_of):
    panel = panel_of({("a", "s"): [0, 1, 5, 2, 7, 1], ("b", "s"): [3] * 6})
    train = panel.withColumn("fold_id", F.lit(1))
    folds = spark.createDataFrame([(1, date(2020, 1, 7), date(2020, 1, 8))], "fold_id int, val_start date, val_end date")
    stats = bl.window_stats(train)
    for forecast in (bl.empirical_quantiles, bl.normal_forecast):
        assert sorted(map(tuple, forecast(train, folds, stats=stats).collect())) == sorted(map(tuple, forecast(train, folds).collect()))


def test_strict_scope_counts_models_not_rows(spark, world):
    """A model that has a cell twice does not stand for another one, and no set is gathered for a cell."""
    fact = ev.pinball_fact(*world)
    doubled = fact.where("model <> 'arima'").unionByName(fact.where("model = 'lgbm'"))
    assert ev.strict_scope(doubled).isEmpty()
    assert ev.strict_scope(fact.unionByName(fact.where("model = 'lgbm'"))).count() == 120
    assert "collect_set" not in ev.strict_scope(fact)._jdf.queryExecution().optimizedPlan().toString()


def test_revenue_weights_need_only_their_days(spark, panel_of):
    folds = spark.createDataFrame([(1, date(2020, 2, 10)), (2, date(2020, 2, 20))], "fold_id int, train_end date")
    revenue = panel_of({("a", "s"): list(range(60)), ("b", "s"): [7] * 60}).withColumn("revenue", F.col("sales") * 1.5)
    days_used = ev.weight_days(folds)
    assert days_used.count() == 56
    assert tuple(days_used.where("fold_id = 1").agg(F.min("date"), F.max("date")).first()) == (date(2020, 1, 14), date(2020, 2, 10))
    few = revenue.join(days_used.select("date"), "date", "left_semi")
    rows = lambda df: sorted(map(tuple, ev.revenue_weights(df, folds).collect()))
    assert rows(few) == rows(revenue)
