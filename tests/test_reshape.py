from datetime import date

from pyspark.sql import functions as F

from panelcast.operators import reshape as rs

START = date(2020, 1, 1)


def test_wide_to_long_published_shape(spark):
    """1,913 day columns from one literal epoch; NULL cells drop, zeros stay."""
    n = 1913
    row = {"id": "FOODS_1_001_CA_1_validation"}
    row |= {f"d_{i}": (None if i == 5 else i % 3) for i in range(1, n + 1)}
    schema = "id string, " + ", ".join(f"d_{i} int" for i in range(1, n + 1))
    wide = spark.createDataFrame([tuple(row.values())], schema)
    long = rs.wide_to_long(wide, date(2011, 1, 29))
    out = {r["date"]: r["sales"] for r in long.collect()}
    assert len(out) == n - 1
    assert min(out) == date(2011, 1, 29) and max(out) == date(2016, 4, 24)
    assert date(2011, 2, 2) not in out
    first = long.first()
    assert (first["item_id"], first["store_id"]) == ("FOODS_1_001", "CA_1")


def test_wide_to_long_missing_day_column_keeps_dates(spark):
    wide = spark.createDataFrame([("A_1_2_B_3", 7, 8, 9)], "id string, d_10 int, d_2 int, d_1 int")
    got = {(r["date"], r["sales"]) for r in rs.wide_to_long(wide, START).collect()}
    assert got == {(date(2020, 1, 1), 9), (date(2020, 1, 2), 8), (date(2020, 1, 10), 7)}


def test_day_columns_sorted_by_number(spark):
    df = spark.createDataFrame([(1, 1, 1, 1)], "d_10 int, d_9 int, d_x int, other int")
    assert rs.day_columns(df) == ["d_9", "d_10"]


def test_unpivot_drops_null_and_nan(spark):
    df = spark.createDataFrame(
        [(1, None, 1.0, float("nan"), 2.0, 3.0)], "k int, p05 double, p25 double, p50 double, p75 double, p95 double"
    )
    assert rs.unpivot_quantiles(df).count() == 3


def test_densify_gap_head_and_tail(spark):
    obs = spark.createDataFrame(
        [("a", "s", date(2020, 1, 3), 5), ("a", "s", date(2020, 1, 6), 7), ("b", "s", date(2020, 1, 1), 1),
         ("c", "s", date(2020, 1, 8), 2)],
        "item_id string, store_id string, date date, sales bigint",
    )
    out = rs.densify(obs, START, date(2020, 1, 8))
    got = {(r["item_id"], r["date"].day): r["sales"] for r in out.collect()}
    assert out.count() == 24 and len(got) == 24
    assert [got["a", d] for d in range(1, 9)] == [0, 0, 5, 0, 0, 7, 0, 0]
    assert [got["b", d] for d in range(1, 9)] == [1] + [0] * 7
    assert [got["c", d] for d in range(1, 9)] == [0] * 7 + [2]


def test_densify_ignores_records_outside_and_can_leave_null(spark):
    obs = spark.createDataFrame(
        [("a", "s", date(2019, 12, 1), 5), ("a", "s", date(2020, 1, 2), 7)],
        "item_id string, store_id string, date date, sales bigint",
    )
    out = rs.densify(obs, START, date(2020, 1, 3), fill=None, partitions=3).orderBy("date").collect()
    assert [r["sales"] for r in out] == [None, 7, None]


def test_densify_plan_has_one_shuffle_and_no_join(spark, panel_of):
    obs = panel_of({("a", "s"): [1, 2, 3]})
    plan = rs.densify(obs, START, date(2020, 3, 1))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_interpolate_matches_linear_fill(spark):
    vals = [None, 1, None, None, 4, None]
    rows = [("a", "s", date(2020, 1, i + 1), v) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "item_id string, store_id string, date date, sales bigint")
    out = [r["sales"] for r in rs.interpolate(df).orderBy("date").collect()]
    assert out == [None, 1.0, 2.0, 3.0, 4.0, 4.0]


def test_pivot_models_drops_missing_buckets_and_orders(spark):
    df = spark.createDataFrame(
        [("lento", "bqml", 1.0), ("rapido", "bqml", 2.0), ("rapido", "lgbm", 3.0)],
        "b string, model string, avg_pinball_loss double",
    )
    out = rs.pivot_models(df, "b", ["rapido", "medio", "lento"]).orderBy("row_order").collect()
    assert [(r["b"], r["arima"], r["bqml"], r["lgbm"]) for r in out] == [
        ("rapido", None, 2.0, 3.0), ("lento", None, 1.0, None)]


def test_pivot_convergence_fills_zero(spark):
    df = spark.createDataFrame([(1, True), (1, True), (2, False)], "fold_id int, convergio boolean")
    out = {r["fold_id"]: (r["n_convergio"], r["n_fallo"], r["pct_converged"]) for r in rs.pivot_convergence(df).collect()}
    assert out == {1: (2, 0, 100.0), 2: (0, 1, 0.0)}


def test_gap_report(spark):
    obs = spark.createDataFrame(
        [("a", "s", date(2020, 1, d), 1) for d in range(1, 11) if d != 4],
        "item_id string, store_id string, date date, sales bigint",
    )
    r = rs.gap_report(obs, START, date(2020, 1, 10)).first()
    assert (r["n_present"], r["n_missing"]) == (9, 1)
    assert rs.date_spine(spark, START, date(2020, 1, 10)).agg(F.count("date")).first()[0] == 10
