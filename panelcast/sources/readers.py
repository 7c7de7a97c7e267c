"""Readers: raw CSV files, pruned table scans, table profiles."""

from __future__ import annotations

import logging
from collections.abc import Callable
from datetime import date as Date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.session import path_bytes, path_exists

log = logging.getLogger(__name__)


def read_panel_csv(
    spark: SparkSession, path: str, schema: T.StructType | Callable[[str], T.DataType] | None = None
) -> DataFrame | None:
    """Header CSV without tolerance for bad rows; a missing file is reported and skipped.

    Give a schema, or the type of a column by its name: inference reads the file a second time."""
    if not path_exists(spark, path):
        log.warning("file not found, skipped: %s", path)
        return None
    reader = spark.read.option("header", True).option("mode", "FAILFAST")
    if callable(schema):
        names = reader.csv(path).columns  # the header line alone
        schema = T.StructType([T.StructField(n, schema(n)) for n in names])
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_panel_csvs(
    spark: SparkSession, files: dict[str, str], schemas: dict[str, T.StructType | Callable[[str], T.DataType]] | None = None
) -> dict[str, DataFrame]:
    """Load several named files, leaving out those that do not exist."""
    schemas = schemas or {}
    loaded = {name: read_panel_csv(spark, p, schemas.get(name)) for name, p in files.items()}
    return {name: df for name, df in loaded.items() if df is not None}


def month_of(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM")


def read_table(
    spark: SparkSession,
    path: str,
    columns: list[str] | None = None,
    start: Date | None = None,
    end: Date | None = None,
    date: str = "date",
) -> DataFrame:
    """Closed date range scan. On a table laid out by ``write_partitioned`` the date bounds
    also become month bounds, so whole directories are skipped before row groups are."""
    df = spark.read.parquet(path)
    if start is not None:
        df = df.where(F.col(date) >= F.lit(start))
        if "month_key" in df.columns:
            df = df.where(F.col("month_key") >= F.lit(f"{start:%Y-%m}"))
    if end is not None:
        df = df.where(F.col(date) <= F.lit(end))
        if "month_key" in df.columns:
            df = df.where(F.col("month_key") <= F.lit(f"{end:%Y-%m}"))
    return df.select(*columns) if columns else df.drop("month_key")


def table_profile(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Per table: rows, columns, bytes on disk and name -> type."""
    frames = []
    for name, path in paths.items():
        df = spark.read.parquet(path)
        types = F.create_map(
            *[F.lit(x) for f in df.schema.fields for x in (f.name, f.dataType.simpleString())]
        )
        frames.append(
            df.agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(name).alias("table_name"),
                "n_rows",
                F.lit(len(df.columns)).cast("long").alias("n_columns"),
                F.lit(path_bytes(spark, path)).cast("long").alias("size_bytes"),
                types.alias("column_types"),
            )
        )
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out
