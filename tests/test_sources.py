from datetime import date

import pytest
from pyspark.errors import PythonException  # noqa: F401
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import days
from panelcast.schema import PREDICTIONS, SALES_LONG, SELL_PRICES
from panelcast.session import bounded_broadcast, checkpoint, shared_dir
from panelcast.sources import readers as rd
from panelcast.sources import writers as wr

START = date(2020, 1, 1)


def _preds(spark, fold, value):
    return spark.createDataFrame([("a", "s", START, *[value] * 5, fold)], PREDICTIONS)


def test_write_fold_twice_then_empty(spark, tmp_path):
    path = str(tmp_path / "p")
    assert wr.write_fold(_preds(spark, 1, 1.0), path, 1, PREDICTIONS) == 1
    assert wr.write_fold(_preds(spark, 2, 2.0), path, 2, PREDICTIONS) == 1
    assert wr.write_fold(_preds(spark, 1, 9.0), path, 1, PREDICTIONS) == 1
    read = lambda: {r["fold_id"]: r["p50"] for r in spark.read.schema(PREDICTIONS).parquet(path).collect()}
    assert read() == {1: 9.0, 2: 2.0}
    assert wr.write_fold(_preds(spark, 1, 1.0).limit(0), path, 1, PREDICTIONS) == 0
    assert read() == {2: 2.0}


def test_write_fold_empty_without_table(spark, tmp_path):
    assert wr.write_fold(_preds(spark, 1, 1.0).limit(0), str(tmp_path / "none"), 1, PREDICTIONS) == 0


def test_append_counts_and_skips_empty(spark, tmp_path):
    path = str(tmp_path / "a")
    rows = spark.createDataFrame([("a", "s", START, 1)], SALES_LONG)
    assert wr.write_append(rows, path, SALES_LONG) == 1
    assert wr.write_append(rows.limit(0), path, SALES_LONG) == 0
    assert wr.write_append(rows, path, SALES_LONG) == 1
    assert spark.read.parquet(path).count() == 2


def test_partitioned_layout_prunes_months(spark, tmp_path, panel_of):
    path = str(tmp_path / "t")
    wr.write_partitioned(panel_of({("a", "s"): list(range(100)), ("b", "s"): list(range(100))}), path, files=4)
    df = rd.read_table(spark, path, ["item_id", "date", "sales"], date(2020, 2, 10), date(2020, 2, 20))
    assert df.count() == 22 and df.columns == ["item_id", "date", "sales"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "month_key" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert spark.read.parquet(path).select("month_key").distinct().count() == 4


def test_materialise_once(spark, tmp_path):
    path, calls = str(tmp_path / "m"), []

    def build():
        calls.append(1)
        return spark.range(3)

    wr.materialise_once(spark, path, build)
    assert wr.materialise_once(spark, path, build).count() == 3 and len(calls) == 1
    wr.materialise_once(spark, path, build, force=True)
    assert len(calls) == 2


def test_csv_missing_and_bad_rows(spark, tmp_path):
    assert rd.read_panel_csv(spark, str(tmp_path / "no.csv")) is None
    good = tmp_path / "g.csv"
    good.write_text("store_id,item_id,wm_yr_wk,sell_price\nCA_1,A_1_1,11101,1.25\n")
    assert rd.read_panel_csv(spark, str(good), SELL_PRICES).first()["sell_price"] == 1.25
    bad = tmp_path / "b.csv"
    bad.write_text("store_id,item_id,wm_yr_wk,sell_price\nCA_1,A_1_1,week,1.25\n")
    with pytest.raises(Exception):
        rd.read_panel_csv(spark, str(bad), SELL_PRICES).collect()
    assert set(rd.read_panel_csvs(spark, {"g": str(good), "x": str(tmp_path / "x.csv")}, {"g": SELL_PRICES})) == {"g"}


def test_profile(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).write.parquet(path)
    r = rd.table_profile(spark, {"t": path}).first()
    assert (r["n_rows"], r["n_columns"], r["column_types"]) == (5, 1, {"id": "bigint"}) and r["size_bytes"] > 0


def test_conform_casts_and_orders(spark):
    df = spark.createDataFrame([(1, "x")], "b int, a string")
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.LongType())])
    assert wr.conform(df, schema).dtypes == [("a", "string"), ("b", "bigint")]


def test_checkpoint_uses_the_shared_folder(spark):
    out = checkpoint(spark.range(10).withColumn("x", F.rand(1)))
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert out.count() == 10 and all(shared_dir(spark) in f for f in out.inputFiles())


def test_bounded_broadcast(spark):
    small, large = bounded_broadcast(spark.range(5), 5), bounded_broadcast(spark.range(6), 5)
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    assert hinted(small) and not hinted(large)


def test_days_helper():
    assert days(START, 2)[1] == date(2020, 1, 2)
