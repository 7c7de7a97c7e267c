"""Category codes that mean the same in training and validation data."""

from __future__ import annotations

from pyspark.ml.feature import StringIndexer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.schema import CATEGORICAL_FEATURES, SENTINEL, SENTINEL_FEATURES
from panelcast.session import checkpoint


def fill_sentinel(df: DataFrame, columns=tuple(SENTINEL_FEATURES), value: int = SENTINEL) -> DataFrame:
    """NULL -> sentinel for nullable 0/1 categoricals."""
    return df.na.fill(value, list(columns))


def category_dictionary(train: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(feature, category, code): codes 0.. in the order of the category text.

    Rows are reduced to distinct combinations first, as they are, and only these are spelled out as text, a row for each
    column; a feature may have any number of categories. (0.0 and -0.0 are one value but two texts: such columns are text at once.)"""
    columns = columns or CATEGORICAL_FEATURES
    fractions = {f.name for f in train.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    values = (
        train.select(*[F.col(c).cast("string").alias(c) if c in fractions else c for c in columns])
        .distinct()
        .select(*[F.col(c).cast("string").alias(c) for c in columns])
        .unpivot([], columns, "feature", "category")
        .where(F.col("category").isNotNull())
        .distinct()
    )
    return numbered(values, "feature", "category", "code")


def numbered(df: DataFrame, group: str, order: str, out: str) -> DataFrame:
    """``df`` with ``out``: 0, 1, .. within ``group`` in the order of ``order`` (both without NULLs, pairs distinct).

    Rows are range-partitioned by both and written; each part numbers its own rows, and the rows of the parts before are added
    from one count for each part and group. No group has to fit into one task."""
    ranged = checkpoint(df.repartitionByRange(group, order).withColumn("_part", F.spark_partition_id()), "numbered")
    counts = ranged.groupBy(group, "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select(group, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    nth = F.row_number().over(Window.partitionBy(group, "_part").orderBy(order))
    out_rows = ranged.withColumn("_nth", nth).join(firsts, [group, "_part"])
    return out_rows.withColumn(out, (F.col("_first") + F.col("_nth") - 1).cast("int")).drop("_first", "_nth", "_part")


def encode(df: DataFrame, dictionary: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Add <column>_code; categories unknown to the dictionary stay NULL."""
    out = df
    for c in columns or CATEGORICAL_FEATURES:
        codes = dictionary.where(F.col("feature") == c).select(
            F.col("category").alias(f"_{c}"), F.col("code").alias(f"{c}_code")
        )
        out = out.join(codes, F.col(c).cast("string") == F.col(f"_{c}"), "left").drop(f"_{c}")
    return out


def indexer(columns: list[str], suffix: str = "_idx") -> StringIndexer:
    """Model-side variant: unseen and missing categories share one extra index."""
    return StringIndexer(
        inputCols=columns,
        outputCols=[f"{c}{suffix}" for c in columns],
        handleInvalid="keep",
        stringOrderType="alphabetAsc",
    )
