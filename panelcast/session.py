"""Session defaults, durable lineage cuts, scratch locations."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Java's compiler leaves methods of more bytes than this to its interpreter.
JIT_BYTES = 8000


def build_session(app: str = "panelcast", master: str | None = None, **conf) -> SparkSession:
    """Session with the settings the operators are tuned for; every one can be overridden."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.codegen.hugeMethodLimit": str(JIT_BYTES),
        **{k.replace("__", "."): str(v) for k, v in conf.items()},
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session, where the
    driver is the sole executor, may fall back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    local = tempfile.mkdtemp(prefix="panelcast-")
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused location below the shared folder."""
    return f"{shared_dir(spark)}/scratch/{name}-{uuid.uuid4().hex}"


def compiled_methods(spark: SparkSession) -> None:
    """Have stages whose generated method would be too long for Java's compiler run as one operator after another,
    each in methods of its own: wide projections (the feature table, loess sums) are interpreted otherwise."""
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", str(JIT_BYTES))


def checkpoint(df: DataFrame, name: str = "step", file_rows: int = 0) -> DataFrame:
    """Cut lineage by writing to the shared folder and reading back.

    A written table survives the loss of any executor, keeps its column statistics
    and can be pruned by the next scan. Rows of megabytes need ``file_rows``, at most as many in a file: a scan decodes up to
    4,096 rows of a file at once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("errorifexists").option("maxRecordsPerFile", file_rows).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stored(df: DataFrame) -> None:
    """Delete the table that ``checkpoint`` wrote for ``df``; nothing may read it any more."""
    for folder in {path.rsplit("/", 1)[0] for path in df.inputFiles()}:
        delete_path(df.sparkSession, folder)


def bounded_broadcast(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Broadcast hint for a side whose size was just checked; beyond the bound the
    frame comes back unhinted and Spark shuffles it like any other side."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def spread(df: DataFrame) -> DataFrame:
    """Redistribute a scan that has fewer splits than the session has cores (a file of one row
    group is one split, whatever its size). A scan that is already split is left alone."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath)


def delete_path(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def path_bytes(spark: SparkSession, path: str) -> int:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(hpath).getLength())


def path_files(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path, bytes, time of change) of the data files below ``path``, sorted; none if it does not exist. Names that begin
    with _ or . hold no data."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return []
    out, listed = [], fs.listFiles(hpath, True)
    while listed.hasNext():
        status = listed.next()
        name = status.getPath().toString()
        if not name.rsplit("/", 1)[-1].startswith(("_", ".")):
            out.append((name, int(status.getLen()), int(status.getModificationTime())))
    return sorted(out)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file, whole."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    stream = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(hpath)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    stream = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(hpath, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def join_path(base: str, *parts: str) -> str:
    return "/".join([base.rstrip("/"), *parts]) if "://" in base else os.path.join(base, *parts)
