"""Loess decomposition, least squares by group, quantiles of sums, keyed reuse, held-back labels."""

from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.operators import encode as en
from panelcast.operators import scenario as sc
from panelcast.operators.forecast import stl
from panelcast.operators.regress import least_squares
from panelcast.operators.reshape import held_back_days, wide_to_long
from panelcast.schema import QUANTILE_NAMES
from panelcast.session import checkpoint
from panelcast.sources import writers as wr

START = date(2020, 1, 1)
WEEK = np.array([3.0, -2.0, 0.5, -1.0, 4.0, -3.5, -1.0])


@pytest.fixture(scope="module")
def seasonal(spark):
    """Two series: a line and a weekly season, and the same with three wild days."""
    n = 140
    y = 20 + 0.1 * np.arange(n) + WEEK[np.arange(n) % 7]
    wild = y.copy()
    wild[[30, 71, 100]] += 400
    rows = [(s, START + timedelta(days=i), float(v)) for s, values in (("plain", y), ("wild", wild)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "s string, date date, y double")


def test_known_season_is_found(seasonal):
    """Lines and periodic seasons pass a loess of lines unchanged, at the ends too; robustness weights do away with outliers."""
    out = stl.decompose(seasonal, ["s"], "y", outer=3).orderBy("s", "date").toPandas()
    for name in ("plain", "wild"):
        part = out[out["s"] == name]
        if name == "plain":
            assert np.abs(part["seasonal"].to_numpy() - WEEK[np.arange(140) % 7]).max() < 0.35
            assert np.abs(part["trend"].to_numpy() - (20 + 0.1 * np.arange(140)))[10:-10].max() < 0.35
        else:
            inside = [i for i in range(14, 126) if min(abs(i - k) for k in (30, 71, 100)) > 1]
            off = np.abs(part["seasonal"].to_numpy() - WEEK[np.arange(140) % 7])[inside]
            assert np.median(off) < 1.0
            assert part["rho"].to_numpy()[[30, 71, 100]].max() < 0.01


def test_low_pass_weights():
    weights = stl.low_pass(7)
    want = np.convolve(np.convolve(np.ones(7) / 7, np.ones(7) / 7), np.ones(3) / 3)
    assert weights == pytest.approx(want) and len(weights) == 15


def test_least_squares_by_group(spark):
    rng = np.random.default_rng(3)
    rows, want = [], {}
    for g in range(3):
        x = rng.normal(size=(60, 3))
        x[:, 2] = 0 if g == 1 else x[:, 2]  # a regressor that is always 0 keeps no coefficient
        y = x @ np.array([1.5, -2.0, 0.7]) + 4 + rng.normal(size=60) * 0.1
        rows += [(g, *map(float, r), float(v)) for r, v in zip(x, y)]
        a = np.column_stack([np.ones(60), x])
        keep = [0, 1, 2] if g == 1 else [0, 1, 2, 3]
        solved = np.zeros(4)
        solved[keep] = np.linalg.lstsq(a[:, keep], y, rcond=None)[0]
        want[g] = solved
    rows += [(2, None, 1.0, 1.0, 5.0), (2, 1.0, 1.0, 1.0, None)]  # take no part
    df = spark.createDataFrame(rows, "g int, a double, b double, c double, y double")
    out = least_squares(df, ["g"], {"one": F.lit(1.0), "a": F.col("a"), "b": F.col("b"), "c": F.col("c"), "again": F.col("a") * 2}, F.col("y")).collect()
    for r in out:
        assert [r["one"], r["a"], r["b"], r["c"]] == pytest.approx(list(want[r["g"]]), abs=1e-6)
        assert r["again"] == 0.0


def test_quantiles_of_sums(spark):
    """Comonotone series: sums of quantiles. Independent ones: a narrower sum. Ranks of the past: series that rise together add up."""
    names = ["p05", "p25", "p50", "p75", "p95"]
    rows = [(f"i{k}", "s", START, *[10.0 * k + 4 * q for q in (1, 2, 3, 4, 5)], 1) for k in range(1, 9)]
    predictions = spark.createDataFrame(rows, "item_id string, store_id string, date date, " + ", ".join(f"{n} double" for n in names) + ", fold_id int")
    groups = spark.createDataFrame([(f"i{k}", "s", "c") for k in range(1, 9)], "item_id string, store_id string, category string")
    found = {}
    past = [(1, f"i{k}", "s", START - timedelta(days=d + 1), d * (1 if k % 2 else -1)) for k in range(1, 9) for d in range(400)]
    ranks = sc.path_ranks(spark.createDataFrame(past, "fold_id int, item_id string, store_id string, date date, sales int"), 400)
    for how in sc.DEPENDENCE:
        found[how] = sc.quantiles_of_sums(predictions, groups, ["category", "store_id"], how, 400, ranks).first()
    sums = [sum(r[3 + i] for r in rows) for i in range(5)]
    assert [found["comonotone"][n] for n in names] == pytest.approx(sums, abs=0.5)
    middle = found["independent"]
    assert middle["p50"] == pytest.approx(sums[2], abs=4) and middle["p95"] - middle["p05"] < 0.6 * (sums[4] - sums[0])
    # half of the series mirror the others: what some gain the others lose
    assert found["history"]["p95"] - found["history"]["p05"] < 0.05 * (sums[4] - sums[0])
    with pytest.raises(ValueError):
        sc.sample_paths(predictions, "other")


def test_reuse_ends_when_inputs_or_parameters_change(spark, tmp_path):
    source, path, calls = str(tmp_path / "source"), str(tmp_path / "built"), []
    spark.range(5).write.parquet(source)

    def build():
        calls.append(1)
        return spark.read.parquet(source)

    get = lambda **params: wr.materialise_once(spark, path, build, inputs=[source], params=params).count()
    assert get(sample="a") == 5 and get(sample="a") == 5 and len(calls) == 1
    assert get(sample="b") == 5 and len(calls) == 2  # another sample
    spark.range(7).write.mode("overwrite").parquet(source)
    assert get(sample="b") == 7 and len(calls) == 3  # other input files
    assert get(sample="b") == 7 and len(calls) == 3
    # a table without a manifest is not known to be current
    plain = str(tmp_path / "plain")
    spark.range(2).write.parquet(plain)
    assert wr.materialise_once(spark, plain, build, inputs=[source]).count() == 7


def test_codes_of_many_categories(spark):
    df = spark.range(5000).select(F.lit("f").alias("feature"), F.concat(F.lit("c"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("category"))
    df = df.unionByName(spark.createDataFrame([("g", "x"), ("g", "a")], "feature string, category string"))
    out = en.numbered(df, "feature", "category", "code")
    assert out.where("feature = 'f' and category <> concat('c', lpad(cast(code as string), 5, '0'))").count() == 0
    assert {(r[1], r[2]) for r in out.where("feature = 'g'").select("feature", "category", "code").collect()} == {("a", 0), ("x", 1)}


def test_held_back_days(spark):
    rows = [("A_B_1_CA_1_evaluation", *range(10, 16))]
    wide = spark.createDataFrame(rows, "id string, " + ", ".join(f"d_{i}" + " long" for i in range(3, 9)))
    later = held_back_days(wide, START, START + timedelta(days=3))
    assert [(r["date"], r["sales"]) for r in later.orderBy("date").collect()] == [(START + timedelta(days=4), 14), (START + timedelta(days=5), 15)]
    assert held_back_days(wide, START, START + timedelta(days=30)).count() == 0
    assert wide_to_long(wide, START).count() == 6


def test_paths_of_stored_forecasts_are_not_broadcast(spark):
    """Forecasts that repeat themselves make a small file of many rows: its size does not say that the driver can hold them."""
    level = [F.lit(float(i)).alias(n) for i, n in enumerate(QUANTILE_NAMES)]
    keys = [F.lit(1).alias("fold_id"), F.lit("a").alias("item_id"), F.lit("b").alias("store_id")]
    stored = checkpoint(spark.range(1000).select(*keys, F.lit(date(2020, 1, 1)).alias("date"), *level))
    ranks = spark.range(3).select(*keys, F.col("id").cast("int").alias("path"), F.lit(0.5).alias("rank"))
    drawn = sc.sample_paths(stored, "history", 3, ranks)
    assert "BroadcastHashJoin" not in drawn._jdf.queryExecution().executedPlan().toString()
    assert drawn.where("value = 2").count() == 3000
