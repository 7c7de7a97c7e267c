"""Sharding by vector bin packing: bytes, tokens and rows are balanced together."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from panelcast.llm.common import bounded_batches, col, stored, word_count

#: What is balanced, in the order of the vectors.
MEASURES = ("size", "tokens", "rows")


def _sums():
    return [F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")]


def pack(vectors: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Vector bin packing of the rows of ``vectors`` (scaled so that each column sums to 1).

    Items go in order of their largest coordinate, each to the shard where the dot product with the
    residual capacity is highest; the first of equals wins. Returns shard numbers and final loads.
    """
    residual = np.full((shards, vectors.shape[1]), 1.0 / shards)
    where = np.zeros(len(vectors), dtype=np.int32)
    for i in np.argsort(-vectors.max(axis=1), kind="stable"):
        where[i] = s = int(np.argmax(residual @ vectors[i]))
        residual[s] -= vectors[i]
    return where, 1.0 / shards - residual


def _cells(rows: DataFrame, cells: int) -> tuple[DataFrame, np.ndarray]:
    """``rows`` with ``bundle`` and ``piece``, and the totals of the table.

    Groups of equal texts are dealt into ``cells`` bundles by their hash, whole. A group with more than
    1/cells of the bytes, tokens or rows makes a bundle of its own; for ranking, such a group is cut by its rows' numbers into
    pieces of about that share, so that rows that share id and text are dealt out too. At most 3 x cells groups can be that large, so their list is broadcast.
    """
    bundles = stored(rows.groupBy("bundle").agg(*_sums()), "bundles")
    total = bundles.agg(*[F.sum(m).alias(m) for m in MEASURES]).first()
    totals = np.array([float(x or 0) for x in total])
    share = F.greatest(*[F.col(m) * (cells / max(t, 1.0)) for m, t in zip(MEASURES, totals)])
    full = bundles.where(share > 1).select("bundle")
    large = (
        rows.join(F.broadcast(full), "bundle", "left_semi")
        .groupBy("group")
        .agg(*_sums())
        .where(share > 1)
        .select("group", F.ceil(share).cast("long").alias("pieces"))
    )
    out = rows.join(F.broadcast(stored(large, "large")), "group", "left")
    return (
        out.withColumn("bundle", F.when(F.col("pieces").isNull(), F.col("bundle")).otherwise(F.lit(-1)))
        .withColumn("owner", F.when(F.col("pieces").isNotNull(), F.col("group")).otherwise(F.lit(0)))
        .withColumn(
            "piece",
            F.when(F.col("pieces").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("row", F.lit("piece")), F.col("pieces"))),
        )
        .drop("pieces", "row"),
        totals,
    )


def assign_shards(
    docs: DataFrame,
    shards: int = 24,
    id_col: str = "doc_id",
    text_col: str = "text",
    bundles_per_shard: int = 256,
) -> DataFrame:
    """One row per row of ``docs``: id, size, tokens, text_crc32, shard, slot.

    Size is the text's UTF-8 bytes plus 8 (null: 8, with the crc32 of the empty text), tokens its runs of
    non-blank characters. Equal texts form a group; null and empty texts form one group. A group stays on
    one shard unless it has more bytes, tokens or rows than a shard's equal part; such a group is dealt
    over several shards row by row, whether or not its rows share ids. Slots number each shard's rows from 0 without gaps, by bundle and id;
    repeated rows get slots of their own. An empty table gives an empty result. Other columns are not read.

    The driver packs bundles of groups, not groups: at most ``shards * bundles_per_shard`` bundles and
    some times as many pieces of large groups, at any input size. Texts are read once and never shuffled.
    """
    cells = shards * bundles_per_shard
    text = col(text_col)
    raw = text.cast("binary")
    rows = bounded_batches(docs).select(
        F.monotonically_increasing_id().alias("row"),
        col(id_col).alias("id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
        word_count(raw).alias("tokens"),
        F.crc32(F.coalesce(raw, F.lit(b""))).alias("text_crc32"),
        F.xxhash64(F.coalesce(text, F.lit("")), F.lit("group")).alias("group"),
    )
    rows = stored(rows.withColumn("bundle", F.pmod("group", F.lit(cells))), "sizes")
    rows, totals = _cells(rows, cells)
    table = rows.groupBy("bundle", "owner", "piece").agg(*_sums()).orderBy("bundle", "owner", "piece").toPandas()
    plan = _plan(table, totals, shards)
    spark = docs.sparkSession
    fields = [T.StructField(n, T.LongType()) for n in ("bundle", "owner", "piece", "shard", "first")]
    cells_df = spark.createDataFrame([tuple(map(int, r)) for r in plan], T.StructType(fields))
    rank = F.row_number().over(Window.partitionBy("bundle", "owner", "piece").orderBy("id", "text_crc32", "size"))
    out = rows.withColumn("rank", rank).join(F.broadcast(cells_df), ["bundle", "owner", "piece"])
    return out.select(
        F.col("id").alias(id_col),
        "size",
        "tokens",
        "text_crc32",
        F.col("shard").cast("int").alias("shard"),
        (F.col("first") + F.col("rank") - 1).cast("long").alias("slot"),
    )


def _plan(table, totals: np.ndarray, shards: int) -> np.ndarray:
    """Rows (bundle, owner, piece, shard, first slot) for the cells of ``table``."""
    if not len(table):
        return np.zeros((0, 5), dtype=np.int64)
    vectors = table[list(MEASURES)].to_numpy(dtype=float) / np.maximum(totals, 1.0)
    keys = table[["bundle", "owner", "piece"]].to_numpy(dtype=np.int64)
    _, item = np.unique(keys[:, :2], axis=0, return_inverse=True)
    item = item.reshape(-1)
    whole = np.zeros((item.max() + 1, vectors.shape[1]))
    np.add.at(whole, item, vectors)
    # a group beyond a shard's part is no longer one item: each of its pieces is
    split = (whole.max(axis=1) > 1.0 / shards)[item]
    _, item = np.unique(np.column_stack([item, np.where(split, keys[:, 2], 0)]), axis=0, return_inverse=True)
    item = item.reshape(-1)
    items = np.zeros((item.max() + 1, vectors.shape[1]))
    np.add.at(items, item, vectors)
    shard = pack(items, shards)[0][item]
    rows = table["rows"].to_numpy(dtype=np.int64)
    order = np.lexsort((np.arange(len(shard)), shard))
    before = np.cumsum(rows[order]) - rows[order]
    start = np.searchsorted(shard[order], np.arange(shards))
    first = np.empty(len(shard), dtype=np.int64)
    first[order] = before - before[np.minimum(start, len(before) - 1)][shard[order]]
    return np.column_stack([keys, shard, first])
