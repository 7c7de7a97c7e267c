"""A cross-section of the registered queries against their SQL on the smallest tables; the full set
is compared by tools/check_oracle.py."""

import os
from datetime import date

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from registry import QUERIES
from registry.inputs import Inputs
from tools.check_oracle import TABLES, rows_of

SF = "/root/testdata/sf0.001"
SAMPLE = [
    "parse_series_id", "gap_report", "filter_window", "null_predicates", "encode_categoricals",
    "scalar_subquery", "proportional_forced", "representative_series", "category_profile",
    "zero_rate_histogram", "choose_window", "fold_overlap", "build_features", "make_folds",
    "forecast_metadata", "metrics_by_event", "wspl", "wide_to_long_days", "differencing_order", "check_leakage", "check_sample", "write_fold", "farm_fingerprint", "samples_by_fingerprint",
]
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert {"arima_per_series", "fit_metadata", "arima_plus", "quantile_boost"} == {
        q for q in entry.queries() if q in QUERIES and q not in entry.oracle_sql()}


def test_entry(spark):
    assert entry.entry(spark).count() == 5


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(entry.oracle_sql()[name])
    want = rows_of([d[0] for d in cur.description], cur.fetchall())
    assert got == want


@pytest.mark.parametrize("name", ["price_momentum", "encode_all_categoricals"])
def test_lines_are_read_once(spark, name):
    """Panel and prices come from one written table of observed sales, the dictionary and the codes from one of features."""
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "lineitem" not in plan


def test_observed_sales_of_suppliers_that_share_a_name(spark, tmp_path):
    """Lines are summed by the smallest key of a name, and a line without a part counts nowhere."""
    tables = {
        "region": [("AFRICA", 0)], "nation": [(0, 0)], "part": [(1, "STEEL", "Brand#1")],
        "supplier": [(7, "Supplier#000000001", 0), (8, "Supplier#000000001", 0)],
        "lineitem": [(1, 7, date(2020, 1, 1), 2.0), (1, 8, date(2020, 1, 1), 3.0), (9, 7, date(2020, 1, 1), 50.0)],
    }
    schemas = {
        "region": "r_name string, r_regionkey int", "nation": "n_nationkey int, n_regionkey int",
        "part": "p_partkey long, p_type string, p_brand string", "supplier": "s_suppkey long, s_name string, s_nationkey int",
        "lineitem": "l_partkey long, l_suppkey long, l_shipdate date, l_quantity double",
    }
    for t, rows in tables.items():
        spark.createDataFrame(rows, schemas[t]).write.parquet(f"{tmp_path}/{t}.parquet")
    got = {(r["item_id"], r["store_id"]): r["sales"] for r in Inputs(spark, str(tmp_path)).observed().collect()}
    items = ["STEEL_0_001", "BRAND_1_001"]
    assert got == {("SUPP_0_000000001", "AL_1"): 5} | {(i, s): 5 for i in items for s in ("AF_1", "AL_1")}


def test_sums_are_carried_by_numbers(spark):
    plan = Inputs(spark, SF).observed()._jdf.queryExecution().executedPlan().toString()
    assert "keys=[supplier" in plan  # not by five names a line


def test_predict_quantiles_compares_what_is_predicted(spark, monkeypatch):
    """The rows compared are those of the forecast, clipped and sorted, not its raw scores."""
    from panelcast.operators.forecast import boost

    predict = boost.predict_quantile_boost
    monkeypatch.setattr(boost, "predict_quantile_boost", lambda *a, **k: predict(*a, **k).withColumn("p05", F.lit(-1.0)))
    rows = entry.queries()["predict_quantiles"](spark, SF).collect()
    assert len(rows) == 5 and all(r["n_different"] == r["n_rows"] for r in rows)


def test_quantile_boost_has_the_size_of_the_study(spark, monkeypatch):
    from registry import q_forecast

    asked = []
    monkeypatch.setattr(q_forecast, "boost_walk_forward", lambda features, folds, params: asked.append(params))
    entry.queries()["quantile_boost"](spark, SF)
    assert [(p.rounds, p.learning_rate, p.max_leaves) for p in asked] == [(1000, 0.05, 127)]
