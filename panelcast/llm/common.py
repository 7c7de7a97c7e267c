"""Column names, sizes and joins shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.session import checkpoint

#: Joins broadcast at most this many rows of fixed width; beyond it they shuffle.
BROADCAST_ROWS = 1_000_000


def col(name: str) -> Column:
    """A column by its literal name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a longer one if the frame already has such a column in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def fold(id_col: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % folds


def unit(key: Column) -> Column:
    """A number in [0, 1) that depends on the key alone."""
    return F.pmod(F.xxhash64(key, F.lit("unit")), F.lit(1 << 52)) / float(1 << 52)


@F.pandas_udf(T.LongType())
def word_count(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Runs of characters other than space and x09-x0D in a text given as binary; null has none."""
    for raw in parts:
        yield raw.map(lambda b: len(b.split()) if b is not None else 0).astype("int64")


def bounded_batches(df: DataFrame, rows: int = 500, size: str = "32m") -> DataFrame:
    """``df``; its session from now on hands texts to Python in batches of at most ``rows`` rows and about
    ``size``. Spark's default of 10,000 rows would hold as many whole texts at once in each Python worker."""
    conf = df.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)
    return df


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame, written to the shared folder and read again: computed once, safe when executors go."""
    return checkpoint(df, f"llm-{name}")


def join_groups(rows: DataFrame, groups: DataFrame, key: str, weight: str, total: int, most: int = 1000) -> DataFrame:
    """Inner join of ``rows`` with one row per ``key`` in ``groups``, whatever share of the rows a key has.

    Keys with more than ``total / most`` rows by ``weight`` number fewer than ``most``; they are
    broadcast, so that their rows stay where they are. The others shuffle in groups below that size.
    """
    limit = max(1, total // most)
    heavy = F.broadcast(groups.where(F.col(weight) > limit))
    light = groups.where(F.col(weight) <= limit)
    stay = rows.join(heavy, key)
    move = rows.join(F.broadcast(heavy.select(key)), key, "left_anti").join(light, key)
    return stay.unionByName(move)


def without(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` without the rows whose id is in ``ids`` (one column, stored); null ids stay.

    The ids are counted: up to BROADCAST_ROWS they are broadcast, beyond that both sides shuffle.
    """
    gone = fresh(docs, "gone")
    listed = ids.select(col(ids.columns[0]).alias(gone)).where(F.col(gone).isNotNull()).distinct()
    if ids.count() <= BROADCAST_ROWS:
        listed = F.broadcast(listed)
    return docs.join(listed, col(id_col) == F.col(gone), "left_anti")
