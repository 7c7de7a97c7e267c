from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.functions.keys import farm_fingerprint, farm_key, hash_key, signed, wrapping_add, wrapping_multiply
from panelcast.operators import encode as en
from panelcast.operators import folds as fo
from panelcast.operators import relational as rl
from panelcast.operators import segments as sg
from panelcast.operators import tsa


def _series(spark, sizes):
    rows = [(f"I{s}{i}", "st", s, 0.5) for s, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(rows, "item_id string, store_id string, categoria_zero_rate string, tasa_ceros double")


SIZES = {"rapido": 3, "medio": 8, "lento": 20, "muy_lento": 100}


def test_stratified_top_n_small_stratum_taken_whole_and_repeatable(spark):
    series = _series(spark, SIZES)
    pick = lambda df: sorted(r["item_id"] for r in sg.stratified_top_n(df, 8, "x").collect())
    first = pick(series)
    assert first == pick(series.repartition(7).orderBy(F.rand(1)))
    counts = {s: sum(i.startswith(f"I{s}") for i in first) for s in ("rapido", "medio")}
    assert counts == {"rapido": 3, "medio": 8} and len(first) == 27


def test_stratified_top_n_limits_before_the_shuffle(spark):
    plan = sg.stratified_top_n(_series(spark, SIZES), 8, "x")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_rank_in_stratum_equals_plain_rank(spark):
    series = _series(spark, {"a": 500, "b": 7})
    h = hash_key([F.col("item_id"), F.col("store_id")], "z")
    ranked = sg.rank_in_stratum(series, "categoria_zero_rate", h, ["item_id"], prefix=2)
    got = {(r["categoria_zero_rate"], r["item_id"]): r["rn"] for r in ranked.collect()}
    keyed = series.withColumn("h", h).collect()
    for s in ("a", "b"):
        order = sorted((r["h"], r["item_id"]) for r in keyed if r["categoria_zero_rate"] == s)
        assert [got[s, i] for _, i in order] == list(range(1, len(order) + 1))


def test_proportional_sample_forced_and_quotas(spark):
    series = _series(spark, SIZES)
    forced = series.where(F.col("item_id").isin("Ilento3", "Imuy_lento99"))
    quotas = sg.proportional_quotas(series, 40)
    q = {r["categoria_zero_rate"]: r["n_objetivo"] for r in quotas.collect()}
    assert q == {"rapido": 1, "medio": 2, "lento": 6, "muy_lento": 31}
    sample = sg.proportional_sample(series, forced, quotas, "s").collect()
    ids = [r["item_id"] for r in sample]
    assert len(ids) == len(set(ids)) == 40 and {"Ilento3", "Imuy_lento99"} <= set(ids)
    wide = spark.createDataFrame([("rapido", 50)], "categoria_zero_rate string, n_objetivo bigint")
    assert len(sg.proportional_sample(series, forced, wide, "s").collect()) == 2 + 3


def test_published_folds(spark):
    f = fo.generate_folds(spark, date(2011, 1, 29), date(2016, 4, 24)).orderBy("fold_id").collect()
    starts = [r["val_start"] for r in f]
    assert starts[0] == date(2012, 1, 29) and starts[-1] == date(2016, 3, 28)
    assert {(b - a).days for a, b in zip(starts, starts[1:])} == {380}
    assert all((r["val_end"] - r["val_start"]).days == 27 and (r["val_start"] - r["train_start"]).days == 365 for r in f)


def test_folds_half_even_step(spark):
    f = fo.generate_folds(spark, date(1995, 1, 2), date(2001, 11, 4)).orderBy("fold_id").collect()
    assert [str(r["val_start"]) for r in f] == ["1996-01-02", "1997-06-11", "1998-11-20", "2000-04-30", "2001-10-08"]


def test_fold_range_error_and_overlap(spark):
    with pytest.raises(ValueError):
        fo.generate_folds(spark, date(2020, 1, 1), date(2021, 1, 26))  # 391 days apart
    f = fo.generate_folds(spark, date(2020, 1, 1), date(2021, 1, 27))  # one possible start
    assert f.select("val_start").distinct().count() == 1
    assert fo.fold_overlaps(f).where("overlaps").count() == 4
    with pytest.raises(ValueError):
        fo.select_fold(f, 9)


def test_split_folds_is_an_equi_join(spark, panel_of):
    panel = panel_of({("a", "s"): list(range(450))})
    folds = fo.make_folds(panel, n_folds=2)
    out = fo.split_folds(panel, folds)
    counts = {(r["fold_id"], r["role"]): r["count"] for r in out.groupBy("fold_id", "role").count().collect()}
    assert counts == {(f, r): n for f in (1, 2) for r, n in (("train", 365), ("val", 28))}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    assert fo.split_folds(panel, folds, fold_id=2).select("fold_id").distinct().count() == 1


def test_acf_matches_fft_and_closed_form(spark, panel_of):
    rng = np.random.default_rng(0)
    x = rng.integers(0, 20, 200)
    df = panel_of({("a", "s"): [int(v) for v in x], ("b", "s"): [3] * 200})
    got = {(r["item_id"], r["lag"]): r["acf"] for r in tsa.acf(df, (0, 7, 28, 250)).collect()}
    c = x - x.mean()
    want = lambda k: (c[k:] * c[: len(c) - k]).sum() / (c * c).sum()
    assert got["a", 0] == pytest.approx(1.0) and got["a", 7] == pytest.approx(want(7))
    assert got["a", 250] == 0.0 and got["b", 7] is None
    curve = {(r["item_id"], r["lag"]): r["acf"] for r in tsa.acf_curve(df, 30).collect()}
    assert all(curve["a", k] == pytest.approx(want(k), abs=1e-9) for k in range(31))


def test_detrend_removes_a_line(spark, panel_of):
    df = panel_of({("a", "s"): [3 + 2 * i for i in range(50)]})
    worst = tsa.detrend(df, date(2020, 1, 1)).agg(F.max(F.abs("residual"))).first()[0]
    assert worst < 1e-9


def test_choose_window(spark):
    rows = [("a", "s", 365, 0.4), ("a", "s", 730, 0.3), ("b", "s", 365, 0.4), ("b", "s", 730, 0.05), ("c", "s", 365, -0.1), ("c", "s", 730, 0.2)]
    df = spark.createDataFrame(rows, "item_id string, store_id string, lag int, acf double")
    assert {r["item_id"]: r["window_size"] for r in tsa.choose_window(df).collect()} == {"a": 730, "b": 365, "c": 365}


def test_encode_same_codes_in_validation(spark):
    train = spark.createDataFrame([("x",), ("y",), (None,)], "event_type string")
    val = spark.createDataFrame([("y",), ("z",), (None,)], "event_type string")
    codes = en.category_dictionary(train, ["event_type"])
    got = {r["event_type"]: r["event_type_code"] for r in en.encode(val, codes, ["event_type"]).collect()}
    assert got == {"y": 1, "z": None, None: None}


def test_left_flag_ignores_duplicate_members(spark):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    members = spark.createDataFrame([(1,), (1,)], "k int")
    assert sorted(map(tuple, rl.left_flag(df, members, ["k"], "f").collect())) == [(1, True), (2, False)]


def test_left_join_where_keeps_rows_that_fail_the_condition(spark):
    df = spark.createDataFrame([("bqml", 1), ("lgbm", 1)], "model string, k int")
    other = spark.createDataFrame([(1, "hit")], "k int, h string")
    got = {r["model"]: r["h"] for r in rl.left_join_where(df, other, ["k"], F.col("model") == "bqml").collect()}
    assert got == {"bqml": "hit", "lgbm": None}


def test_attach_weekly_price_equals_plain_join(spark, panel_of):
    panel = panel_of({("a", "s"): [1] * 20, ("b", "s"): [1] * 20})
    cal = panel.select("date").distinct().withColumn("wm_yr_wk", (F.dayofyear("date") / 7).cast("bigint"))
    prices = spark.createDataFrame([("s", "a", 0, 1.5), ("s", "a", 2, 2.5)], "store_id string, item_id string, wm_yr_wk bigint, sell_price double")
    plain = rl.join_weekly_price(panel, cal, prices)
    by_map = rl.attach_weekly_price(panel.join(cal, "date", "left"), prices)
    cols = ["item_id", "store_id", "date", "sell_price"]
    assert sorted(map(tuple, plain.select(cols).collect()), key=str) == sorted(map(tuple, by_map.select(cols).collect()), key=str)


def test_first_row_per_key(spark):
    df = spark.createDataFrame([("a", 3, "x"), ("a", 1, "y"), ("b", 2, "z")], "k string, o int, v string")
    got = {r["k"]: (r["o"], r["v"]) for r in rl.first_row_per_key(df, ["k"], "o").collect()}
    assert got == {"a": (1, "y"), "b": (2, "z")}


def test_wrapping_arithmetic(spark):
    edge = [0, 1, 3, (1 << 16) - 1, 1 << 16, (1 << 32) - 1, 1 << 32, (1 << 63) - 1, 1 << 63, (1 << 64) - 1, 0x9AE16A3B2F90404F]
    rows = spark.createDataFrame([(signed(a), signed(b)) for a in edge for b in edge], "a long, b long")
    a, b = F.col("a"), F.col("b")
    for r in rows.select("a", "b", wrapping_add(a, b).alias("sum"), wrapping_multiply(a, b).alias("product")).collect():
        assert r["sum"] == signed((r["a"] + r["b"]) % (1 << 64)) and r["product"] == signed(r["a"] * r["b"] % (1 << 64))


def test_farm_fingerprint(spark):
    """The published examples; NULL, empty and too long texts; an order that is that of the signed numbers."""
    texts = ["1footrue", "2applefalse", "3true", "", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[0] for r in rows.orderBy("i").select(farm_fingerprint(F.col("t"))).collect()]
    assert got == [-1541654101129638711, 2794438866806483259, -4880158226897771312, signed(0x9AE16A3B2F90404F), None]
    with pytest.raises(Exception, match="64 bytes"):
        rows.select(farm_fingerprint(F.lit("é" * 33))).collect()
    keyed = spark.range(200).select(
        farm_fingerprint(F.concat_ws("_", F.col("id"), F.lit("s"))).alias("n"), farm_key([F.col("id")], "s").alias("h")
    ).collect()
    assert sorted(keyed, key=lambda r: r["n"]) == sorted(keyed, key=lambda r: r["h"]) and {len(r["h"]) for r in keyed} == {16}


def test_attach_weekly_price_does_not_sort_the_panel(spark, panel_of):
    panel = panel_of({("a", "s"): [1] * 20, ("b", "s"): [1] * 20}).withColumn("wm_yr_wk", F.lit(0).cast("bigint"))
    prices = spark.createDataFrame([("s", "a", 0, 1.5)], "store_id string, item_id string, wm_yr_wk bigint, sell_price double")
    plan = rl.attach_weekly_price(panel, prices)._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
