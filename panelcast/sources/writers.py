"""Writers: partitioned tables, truncate / append, idempotent fold writes."""

from __future__ import annotations

import hashlib
import json
import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.schema import PANEL, Panel
from panelcast.session import delete_path, join_path, path_exists, path_files, read_text, write_text
from panelcast.sources.readers import month_of

log = logging.getLogger(__name__)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the schema's columns, in order, cast to its types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def write_partitioned(
    df: DataFrame, path: str, panel: Panel = PANEL, files: int | None = None
) -> None:
    """Create or replace a table in month directories, clustered by series inside.

    Rows are range-partitioned by (month, keys, date): a month of any size is split over as
    many files as its share of the rows asks for, and every file covers a narrow key range,
    so both directory pruning and row-group statistics work. Month, not day: a directory
    per day would leave thousands of tiny files.
    """
    order = ["month_key", *panel.keys, panel.date]
    keyed = df.withColumn("month_key", month_of(F.col(panel.date)))
    ranged = (
        keyed.repartitionByRange(files, *order) if files else keyed.repartitionByRange(*order)
    )
    ranged.sortWithinPartitions(*order).write.mode("overwrite").partitionBy("month_key").parquet(
        path
    )


def write_truncate(df: DataFrame, path: str, schema: T.StructType) -> None:
    conform(df, schema).write.mode("overwrite").parquet(path)


def write_append(df: DataFrame, path: str, schema: T.StructType) -> int:
    """Append with an explicit schema and return the number of rows written. The count is
    taken while writing, so an empty frame is noticed without running the plan twice."""
    seen = Observation()
    out = conform(df, schema).observe(seen, F.count(F.lit(1)).alias("n"))
    out.write.mode("append").parquet(path)
    n = int(seen.get["n"])
    if n == 0:
        log.warning("%s: empty frame, nothing appended", path)
    return n


def write_fold(
    df: DataFrame, path: str, fold_id: int, schema: T.StructType, fold: str = "fold_id"
) -> int:
    """Replace one fold's rows and leave the other folds alone; safe to repeat.

    Dynamic overwrite swaps the partition at commit, so a failed job keeps the old rows. It
    does not touch the partition when the frame is empty, hence the explicit delete.
    """
    seen = Observation()
    rows = conform(df, schema).where(F.col(fold) == fold_id)
    (
        rows.observe(seen, F.count(F.lit(1)).alias("n"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(fold)
        .parquet(path)
    )
    n = int(seen.get["n"])
    if n == 0:
        delete_path(df.sparkSession, join_path(path, f"{fold}={fold_id}"))
        log.warning("%s: fold %s is empty, earlier rows removed", path, fold_id)
    return n


def write_folds(
    df: DataFrame, path: str, fold_ids: list[int], schema: T.StructType, fold: str = "fold_id"
) -> dict[int, int]:
    """Replace the rows of the folds named in one pass, and return rows per fold; see ``write_fold``."""
    counts = {i: F.count_if(F.col(fold) == i).alias(f"n{i}") for i in fold_ids}
    if not counts:
        return {}
    seen = Observation()
    rows = conform(df, schema).where(F.col(fold).isin(fold_ids))
    (
        rows.observe(seen, *counts.values())
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(fold)
        .parquet(path)
    )
    written = {i: int(seen.get[f"n{i}"]) for i in fold_ids}
    for i in [i for i, n in written.items() if not n]:
        delete_path(df.sparkSession, join_path(path, f"{fold}={i}"))
        log.warning("%s: fold %s is empty, earlier rows removed", path, i)
    return written


def build_key(spark: SparkSession, inputs: list[str], params: dict) -> str:
    """One hash for the files below ``inputs`` (their paths, sizes and times of change) and ``params``. A table that is
    written anew has other files, so its key changes; a missing input counts as having none."""
    digest = hashlib.sha256(json.dumps(params, sort_keys=True, default=str).encode())
    for root in inputs:
        digest.update(f"\n{root}".encode())
        for name, size, changed in path_files(spark, root):
            digest.update(f"\n{name} {size} {changed}".encode())
    return digest.hexdigest()


def materialise_once(
    spark: SparkSession, path: str, build: Callable[[], DataFrame], force: bool = False,
    inputs: list[str] | None = None, params: dict | None = None,
) -> DataFrame:
    """Build a table the first time, reuse it while it is current; ``force`` rebuilds.

    Only a committed table (``_SUCCESS``) counts as present. With ``inputs`` (paths of the tables it is made of) or ``params``,
    a manifest beside its files holds the key it was built for: other input files or parameters, or no
    manifest, have it rebuilt. The manifest is removed before and written after the table, so a build that fails leaves none."""
    key = build_key(spark, inputs or [], params or {}) if inputs is not None or params is not None else None
    manifest = join_path(path, "_manifest.json")
    current = path_exists(spark, join_path(path, "_SUCCESS"))
    if current and key is not None:
        current = path_exists(spark, manifest) and json.loads(read_text(spark, manifest)).get("key") == key
    if force or not current:
        if path_exists(spark, manifest):
            delete_path(spark, manifest)
        build().write.mode("overwrite").parquet(path)
        if key is not None:
            write_text(spark, manifest, json.dumps({"key": key, "inputs": inputs or [], "params": params or {}}, default=str))
    return spark.read.parquet(path)
