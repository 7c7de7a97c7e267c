import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import days
from panelcast.functions.calendar import event_flags, prefix_switch, sunday_week
from panelcast.functions.numeric import rounded
from panelcast.operators import encode as en
from panelcast.operators import checks as ck
from panelcast.operators import windows as wn
from panelcast.plans.features import build_features

START = date(2020, 1, 1)


def test_sunday_week(spark):
    ds = [date(2011, 1, 1), date(2011, 1, 2), date(2012, 1, 1), date(2016, 12, 31)]
    df = spark.createDataFrame([(d,) for d in ds], "d date")
    assert [r[0] for r in df.select(sunday_week(F.col("d"))).collect()] == [0, 1, 1, 52]


def test_event_flags_second_name_without_type(spark):
    rows = [(date(2020, 2, 1), None, "SuperBowl", None), (date(2020, 12, 25), "Christmas", None, "National"),
            (date(2020, 12, 25), None, None, None), (date(2020, 7, 4), "IndependenceDay", None, "National")]
    df = spark.createDataFrame(rows, "d date, n1 string, n2 string, t1 string")
    f = event_flags(F.col("d"), F.col("n1"), F.col("n2"), F.col("t1"))
    got = [tuple(r) for r in df.select(*f.values()).collect()]
    assert got == [(1, 0, None), (1, 1, "Store_Closure"), (0, 1, None), (1, 0, "National")]


def test_prefix_switch_without_match_is_null(spark):
    df = spark.createDataFrame([("CA_1",), ("TX_2",), ("NY_1",)], "s string")
    col = prefix_switch(F.col("s"), {"CA": F.lit(1), "TX": F.lit(2)})
    assert [r[0] for r in df.select(col).collect()] == [1, 2, None]


def test_event_distance_excludes_today(spark):
    cal = spark.createDataFrame([(d, d.day in (3, 6)) for d in days(START, 7)], "date date, e boolean")
    out = wn.add_event_distance(cal, F.col("e")).orderBy("date").collect()
    assert [r["days_to_next_event"] for r in out] == [2, 1, 3, 2, 1, None, None]
    assert [r["days_from_last_event"] for r in out] == [None, None, None, 1, 2, 3, 1]


def test_days_since_last_sale_null_before_first(spark, panel_of):
    df = panel_of({("a", "s"): [0, 0, 0, 2, 0, 0, 1, 0]})
    out = [r["days_since_last_sale"] for r in wn.add_days_since_last_sale(df).orderBy("date").collect()]
    assert out == [None, None, None, None, 1, 2, 3, 1]


@pytest.mark.parametrize("kind", ["bigint", "double"])
def test_rolling_against_direct_computation(spark, kind):
    import numpy as np

    rng = random.Random(3)
    vals = [rng.choice([0, 0, 1, 5, 40]) for _ in range(60)]
    df = spark.createDataFrame(
        [("a", "s", d, v) for d, v in zip(days(START, 60), vals)],
        "item_id string, store_id string, date date, sales bigint",
    ).withColumn("sales", F.col("sales").cast(kind))
    out = wn.add_rolling(df).orderBy("date").collect()
    for t, r in enumerate(out):
        w7, w28 = vals[max(0, t - 7) : t], vals[max(0, t - 28) : t]
        assert r["roll_mean_7"] == (pytest.approx(np.mean(w7)) if w7 else None)
        assert r["roll_mean_28"] == (pytest.approx(np.mean(w28)) if w28 else None)
        assert r["roll_std_28"] == (pytest.approx(np.std(w28, ddof=1)) if len(w28) > 1 else None)
        assert r["pct_zeros_28d"] == (pytest.approx(np.mean([v == 0 for v in w28])) if w28 else None)


def test_moving_average_skips_null_and_needs_no_sliding_frame(spark):
    vals = [1.00, None, 1.20, None, 3.10, 2.00]
    df = spark.createDataFrame(
        [("a", "s", d, v) for d, v in zip(days(START, 6), vals)],
        "item_id string, store_id string, date date, price double",
    )
    exact = wn.add_moving_average(df, "price", 3, "m", decimals=2).orderBy("date")
    slide = wn.add_moving_average(df, "price", 3, "m").orderBy("date")
    a = [r["m"] for r in exact.select(rounded(F.col("m"), 9).alias("m")).collect()]
    b = [r["m"] for r in slide.select(rounded(F.col("m"), 9).alias("m")).collect()]
    assert a == b == [None, 1.0, 1.0, 1.1, 1.2, 2.15]


def _inputs(spark, sales):
    ds = days(START, 430)
    cal = spark.createDataFrame(
        [(d, 100 + i // 7, "Christmas" if (d.month, d.day) == (12, 25) else None,
          "National" if (d.month, d.day) == (12, 25) else None, None, int(d.day < 5), int(d.day > 20))
         for i, d in enumerate(ds)],
        "date date, wm_yr_wk bigint, event_name_1 string, event_type_1 string, event_name_2 string, snap_CA int, snap_TX int",
    )
    prices = spark.createDataFrame(
        [("CA_1", "A_1_1", w, 1.0 + (w % 3) / 10) for w in range(103, 162)],
        "store_id string, item_id string, wm_yr_wk bigint, sell_price double",
    )
    rows = [(i, s, d, v) for (i, s), vs in sales.items() for d, v in zip(ds, vs)]
    panel = spark.createDataFrame(rows, "item_id string, store_id string, date date, sales bigint")
    return panel, cal, prices


def _features(spark, sales):
    panel, cal, prices = _inputs(spark, sales)
    return build_features(panel, cal, prices, START, {"CA": "snap_CA", "TX": "snap_TX"})


def test_feature_table_shape_and_single_panel_shuffle(spark):
    f = _features(spark, {("A_1_1", "CA_1"): [1] * 430, ("B_1_1", "NY_1"): [0] * 430})
    assert len(f.columns) == 52
    rows = f.orderBy("item_id", "date").collect()
    assert len(rows) == 860
    a = [r for r in rows if r["item_id"] == "A_1_1"]
    assert a[0]["sell_price"] is None and a[21]["sell_price"] == pytest.approx(1.1)
    assert a[21]["price_changed"] is None and a[22]["price_changed"] == 0 and a[28]["price_changed"] == 1
    assert a[21]["price_rel_mean"] is None and a[22]["price_rel_mean"] == pytest.approx(1.0)
    b = [r for r in rows if r["item_id"] == "B_1_1"]
    assert all(r["snap_active"] is None and r["sell_price"] is None for r in b)
    plan = f._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") <= 6  # two for the panel, the rest on the calendar


def test_no_leakage(spark):
    """Changing values on and after a day leaves that day's features unchanged."""
    rng = random.Random(1)
    base = [rng.randrange(5) for _ in range(430)]
    cut = 300
    changed = base[:cut] + [v + 50 for v in base[cut:]]
    keep = lambda vs: {
        r["date"]: tuple(v for k, v in r.asDict().items() if k != "sales")
        for r in _features(spark, {("A_1_1", "CA_1"): vs}).collect()
    }
    a, b = keep(base), keep(changed)
    horizon = days(START, 430)[cut]
    assert all(a[d] == b[d] for d in a if d <= horizon)
    assert any(a[d] != b[d] for d in a if d > horizon)


def test_check_leakage_finds_a_shifted_window(spark, panel_of):
    panel = panel_of({("a", "s"): [i % 7 + i % 3 for i in range(60)]})
    w = wn.series_window()
    good = wn.add_rolling(wn.add_lags(panel))
    bad = wn.add_lags(panel).withColumn("roll_mean_28", F.avg("sales").over(w.rowsBetween(-27, 0)))
    assert tuple(ck.check_leakage(good, panel).first()) == (60, 0, 0)
    assert ck.check_leakage(bad, panel).first()["roll_mean_28_mismatches"] > 0


def test_tasks_of_the_panel_are_bounded(spark, monkeypatch):
    """The dense panel is dealt by its own size, not by that of the records it is made from."""
    from panelcast.operators import reshape
    from registry.inputs import Inputs

    monkeypatch.setattr(reshape, "PARTITION_ROWS", 20_000)
    sales = Inputs(spark, "/root/testdata/sf0.001").sales_long()
    found = sales.withColumn("part", F.spark_partition_id()).groupBy("item_id", "store_id", "part").agg(F.count("*").alias("n")).toPandas()
    sizes = found.groupby("part")["n"].sum()
    assert len(sizes) > 8 and sizes.max() < 5 * 20_000
    assert not found.duplicated(["item_id", "store_id"]).any()


def test_dictionary_takes_distinct_combinations_before_it_spells_them_out(spark):
    df = spark.createDataFrame([(2, "x", -0.0), (10, None, 0.0), (2, "x", 0.0)], "k int, c string, z double")
    found = en.category_dictionary(df, ["k", "c", "z"])
    assert {(r["feature"], r["category"]): r["code"] for r in found.collect()} == {
        ("k", "10"): 0, ("k", "2"): 1, ("c", "x"): 0, ("z", "-0.0"): 0, ("z", "0.0"): 1}
    coded = en.encode(df, found, ["k", "c", "z"])
    assert coded.where("z_code is null").isEmpty() and coded.where("c is null and c_code is not null").isEmpty()
