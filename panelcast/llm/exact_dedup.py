"""Exact deduplication by two passes over a Bloom filter."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.llm.common import bounded_batches, col, join_groups, stored

#: Bits of one built-in bitmap (its fixed width of 4 KiB).
BITMAP_BITS = 32768


@F.pandas_udf(T.StructType([T.StructField("text_sha256", T.StringType()), T.StructField("hash", T.LongType())]))
def _fingerprint(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for raw in parts:
        digests = [hashlib.sha256((b or b"").lower()).digest() for b in raw]  # bytes.lower touches A-Z only
        yield pd.DataFrame(
            {
                "text_sha256": [d.hex() for d in digests],
                "hash": [int.from_bytes(d[:8], "little", signed=True) for d in digests],
            },
            columns=["text_sha256", "hash"],
        )


def _positions(bits: int, hashes: int) -> list[Column]:
    """The filter's bit numbers of a row: double hashing over the two halves of its 64-bit hash."""
    low, high = F.col("hash").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("hash", 32)
    return [F.pmod(low + high * i, F.lit(bits)) for i in range(1, hashes + 1)]


def repeated_bits(rows: DataFrame, bits: int, hashes: int) -> DataFrame:
    """First pass: the Bloom filter of bits that more than one row sets, as bitmaps of 4 KiB.

    Bits are counted with map-side combination, so a hash of any number of copies leaves each task
    as one record. A row that sets one bit twice counts once.
    """
    bit = F.explode(F.array_distinct(F.array(*_positions(bits, hashes)))).alias("bit")
    counts = rows.select(bit).groupBy("bit").agg(F.count("*").alias("n"))
    return (
        counts.where("n > 1")
        .groupBy(F.floor(F.col("bit") / BITMAP_BITS).alias("block"))
        .agg(F.bitmap_construct_agg(F.col("bit") % BITMAP_BITS).alias("bitmap"))
    )


def _is_set(bitmap: Column, bit: Column) -> Column:
    at = (bit % BITMAP_BITS).cast("int")
    byte = F.conv(F.hex(F.substring(bitmap, F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.floor(byte / F.pow(F.lit(2), at % 8)) % 2 == 1, F.lit(False))


def possibly_repeated(rows: DataFrame, filter_: DataFrame, bits: int, hashes: int, broadcast: bool) -> DataFrame:
    """Second pass: ``rows`` with ``maybe``, false where some bit of the row belongs to it alone."""
    out = rows
    for i, position in enumerate(_positions(bits, hashes)):
        side = filter_.select(F.col("block").alias(f"block_{i}"), F.col("bitmap").alias(f"bitmap_{i}"))
        if broadcast:
            side = F.broadcast(side)
        out = out.withColumn(f"bit_{i}", position)
        out = out.join(side, F.floor(F.col(f"bit_{i}") / BITMAP_BITS) == F.col(f"block_{i}"), "left")
        out = out.withColumn(f"set_{i}", _is_set(F.col(f"bitmap_{i}"), F.col(f"bit_{i}"))).drop(f"bitmap_{i}", f"block_{i}")
    every = F.lit(True)
    for i in range(hashes):
        every = every & F.col(f"set_{i}")
    return out.select(*rows.columns, every.alias("maybe"))


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    bits_per_row: int = 16,
    hashes: int = 2,
    max_filter_bytes: int = 64 << 20,
) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. Of equal texts the
    row with the largest id stays; null ids lose against any other, and of repeated rows with the
    winning id one stays. An empty table gives an empty result; other columns are not read.

    Whole texts are read once, for their hashes. The filter has ``bits_per_row`` bits a row and at
    most ``max_filter_bytes``. Within that bound it is broadcast; rows it clears are finished where they are,
    and only the others shuffle, as fixed-width hashes. A larger corpus keeps the full number of
    bits, and the filter is joined by a shuffle of hashes instead.
    """
    rows = bounded_batches(docs).select(col(id_col).alias("id"), _fingerprint(col(text_col).cast("binary")).alias("f"))
    rows = stored(rows.select("id", "f.text_sha256", "f.hash"), "hashes")
    total = rows.count()
    bits = BITMAP_BITS
    while bits < total * bits_per_row:
        bits *= 2
    filter_ = stored(repeated_bits(rows, bits, hashes), "bloom")
    marked = possibly_repeated(rows, filter_, bits, hashes, broadcast=bits // 8 <= max_filter_bytes)
    marked = stored(marked.drop("hash"), "marked")

    alone = marked.where("not maybe").select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256"
    )
    same = marked.where("maybe").groupBy("text_sha256", "id").agg(F.count("*").alias("times"))
    groups = stored(
        same.groupBy("text_sha256").agg(
            F.max("id").alias("keep_id"), F.sum("times").alias("group_size"), F.count("*").alias("ids")
        ),
        "groups",
    )
    met = join_groups(same, groups, "text_sha256", "ids", total)
    met = met.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("nth"))
    met = met.select(
        "id",
        "keep_id",
        "group_size",
        (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"),
        "text_sha256",
    )
    return alone.unionByName(met).withColumnRenamed("id", id_col)
