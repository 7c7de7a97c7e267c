"""Evaluation end to end: the fact is written once, every roll-up reads the written table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.operators import evaluate as ev
from panelcast.schema import EVENT_LABELS, PANEL, RELEASE_LABELS, ZERO_RATE_LABELS, Panel
from panelcast.session import join_path


def write_fact(fact: DataFrame, path: str) -> DataFrame:
    """Store the fact by model and fold, so that comparisons of two models or one fold skip the
    rest; rows of one directory are spread over as many files as they need."""
    order = ["model", "fold_id", *PANEL.keys, "date"]
    fact.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").partitionBy(
        "model", "fold_id"
    ).parquet(path)
    return fact.sparkSession.read.parquet(path)


def evaluate_all(
    spark: SparkSession,
    base: str,
    predictions: dict[str, DataFrame],
    actuals: DataFrame,
    segments: DataFrame,
    sample: DataFrame,
    releases: DataFrame,
    calendar_flags: DataFrame,
    panel: Panel = PANEL,
) -> dict[str, DataFrame]:
    """Fact, roll-ups and the two-scope comparisons, keyed by table name."""
    fact = write_fact(
        ev.pinball_fact(predictions, actuals, segments, sample, panel=panel, releases=releases),
        join_path(base, "cv_pinball_loss"),
    )
    tables = {
        "cv_metrics_by_fold_quantile": ev.metrics_by_fold(fact),
        "cv_metrics_by_category": ev.metrics_by_zero_rate(fact),
        "cv_metrics_overall": ev.metrics_overall(fact),
        "cv_metrics_by_product_category": ev.metrics_by_category(fact, segments, panel),
        "cv_metrics_by_release_age": ev.metrics_by_release_age(fact),
        "cv_metrics_by_event": ev.metrics_by_event(fact, calendar_flags, panel),
    }
    stored = {}
    for name, df in tables.items():
        path = join_path(base, name)
        df.coalesce(1).write.mode("overwrite").parquet(path)  # a few hundred aggregate rows
        stored[name] = spark.read.parquet(path)
    stored["compare_zero_rate"] = ev.two_scope_compare(
        stored["cv_metrics_by_category"], "categoria_zero_rate", ZERO_RATE_LABELS
    )
    stored["compare_category"] = ev.two_scope_compare(
        stored["cv_metrics_by_product_category"], "category"
    )
    stored["compare_release_age"] = ev.two_scope_compare(
        stored["cv_metrics_by_release_age"], "release_age_bucket", RELEASE_LABELS
    )
    stored["compare_event"] = ev.two_scope_compare(
        stored["cv_metrics_by_event"], "event_bucket", EVENT_LABELS
    )
    stored["exclusions"] = ev.exclusion_report(fact, panel)
    stored["cv_pinball_loss"] = fact.drop("release_age_bucket")
    return stored


def flags_only(calendar: DataFrame) -> DataFrame:
    """date, is_event, is_christmas of a raw calendar."""
    from panelcast.functions.calendar import event_flags

    flags = event_flags(
        F.col("date"), F.col("event_name_1"), F.col("event_name_2"), F.col("event_type_1")
    )
    return calendar.select("date", flags["is_event"].alias("is_event"), flags["is_christmas"].alias("is_christmas"))
