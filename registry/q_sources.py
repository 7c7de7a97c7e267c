"""Readers and writers: each query writes a derived table and reads it back."""

from datetime import date

from pyspark.sql import functions as F

from panelcast.operators.forecast.baseline import empirical_quantiles
from panelcast.operators.segments import sample_panel
from panelcast.plans.walk_forward import walk_forward
from panelcast.schema import PREDICTIONS, SALES_LONG, SELL_PRICES
from panelcast.session import checkpoint, scratch_path
from panelcast.sources.readers import read_panel_csv, read_table, table_profile
from panelcast.sources.writers import (
    materialise_once,
    write_append,
    write_fold,
    write_partitioned,
    write_truncate,
)
from registry.core import query

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


@query("read_panel_csv", "select item_id, store_id, wm_yr_wk, sell_price from sell_prices")
def _(q):
    path = scratch_path(q.spark, "csv")
    q.sell_prices().select("store_id", "item_id", "wm_yr_wk", "sell_price").write.option(
        "header", True
    ).csv(path)
    return read_panel_csv(q.spark, path, SELL_PRICES)


@query(
    "read_table",
    """select l_orderkey, l_linenumber, l_quantity, cast(l_shipdate as date) as ship_day from lineitem
       where l_shipdate between timestamp '1996-01-01' and timestamp '2000-12-31'""",
)
def _(q):
    rows = read_table(
        q.spark,
        q.path("lineitem"),
        ["l_orderkey", "l_linenumber", "l_quantity", "l_shipdate"],
        date(1996, 1, 1),
        date(2000, 12, 31),
        "l_shipdate",
    )
    return rows.withColumn("ship_day", F.col("l_shipdate").cast("date")).drop("l_shipdate")


@query("write_partitioned", "select item_id, store_id, date, sales from sales_long")
def _(q):
    path = scratch_path(q.spark, "partitioned")
    write_partitioned(q.sales_long(), path)
    return read_table(q.spark, path)


@query(
    "read_partitioned",
    """select item_id, store_id, date, sales from sales_long
       where date between date '1997-03-10' and date '1999-08-20'""",
)
def _(q):
    """A range of days of a table in month directories."""
    path = scratch_path(q.spark, "partitioned")
    write_partitioned(q.sales_long(), path)
    return read_table(q.spark, path, None, date(1997, 3, 10), date(1999, 8, 20))


@query("write_truncate", "select item_id, store_id, date, sales from observed")
def _(q):
    path = scratch_path(q.spark, "truncate")
    rows = checkpoint(q.observed(), "observed")
    write_truncate(rows.limit(10), path, SALES_LONG)
    write_truncate(rows, path, SALES_LONG)
    return q.spark.read.schema(SALES_LONG).parquet(path)


@query("write_append", "select item_id, store_id, date, sales from observed")
def _(q):
    path = scratch_path(q.spark, "append")
    rows = checkpoint(q.observed(), "observed")
    cut = F.lit(date(1998, 1, 1))
    write_append(rows.where(F.col("date") < cut), path, SALES_LONG)
    write_append(rows.where(F.lit(False)), path, SALES_LONG)
    write_append(rows.where(F.col("date") >= cut), path, SALES_LONG)
    return q.spark.read.schema(SALES_LONG).parquet(path)


@query(
    "write_fold",
    "select item_id, store_id, date, p05, p25, p50, p75, p95, fold_id from pred_empirical where fold_id < 5",
)
def _(q):
    path = scratch_path(q.spark, "folds")
    rows = checkpoint(walk_forward(q.sales_long(), q.folds(), empirical_quantiles), "predictions")
    for fold in (1, 2, 3, 4, 5, 2):
        write_fold(rows, path, fold, PREDICTIONS)
    write_fold(rows.where(F.lit(False)), path, 5, PREDICTIONS)
    return q.spark.read.schema(PREDICTIONS).parquet(path)


@query(
    "materialise_once",
    """select s.item_id, s.store_id, s.date, s.sales from sales_long s
       join lgbm_sample using (item_id, store_id)""",
)
def _(q):
    """Built for another sample first, then for this one, then reused."""
    path = scratch_path(q.spark, "source")
    q.store_tables()
    build = lambda: sample_panel(q.sales_long(), q.lgbm_sample())
    inputs = [q.path("lineitem"), q.path("supplier"), q.path("part")]
    materialise_once(q.spark, path, lambda: sample_panel(q.sales_long(), q.arima_sample()), inputs=inputs, params={"sample": "arima"})
    materialise_once(q.spark, path, build, inputs=inputs, params={"sample": "lgbm"})
    return materialise_once(q.spark, path, lambda: q.sales_long().where("false"), inputs=inputs, params={"sample": "lgbm"})


_SPARK_TYPE = """case column_type when 'BIGINT' then 'bigint' when 'INTEGER' then 'int' when 'VARCHAR' then 'string' when 'DOUBLE' then 'double'
    when 'TIMESTAMP' then 'timestamp_ntz' when 'DATE' then 'date' when 'FLOAT[]' then 'array<float>' when 'BOOLEAN' then 'boolean' when 'FLOAT' then 'float'
    else column_type end"""


@query(
    "table_profile",
    " union all ".join(
        f"select '{t}' as table_name, count(*) as n_rows, (select count(*) from (describe {t})) as n_columns, true as has_bytes, "
        f"(select string_agg(column_name || ':' || {_SPARK_TYPE}, ',' order by column_name) from (describe {t})) as column_types from {t}"
        for t in TABLES
    ),
)
def _(q):
    """Rows, columns and the name and type of each; SQL cannot see file sizes, so only that there are bytes is compared."""
    profile = table_profile(q.spark, {t: q.path(t) for t in TABLES})
    pairs = F.array_sort(F.transform(F.map_entries("column_types"), lambda e: F.concat_ws(":", e["key"], e["value"])))
    return profile.select(
        "table_name", "n_rows", "n_columns", (F.col("size_bytes") > 0).alias("has_bytes"), F.array_join(pairs, ",").alias("column_types")
    )
