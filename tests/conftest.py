import os
import sys
from datetime import date, timedelta

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def days(start: date, n: int) -> list[date]:
    return [start + timedelta(days=i) for i in range(n)]


@pytest.fixture(scope="session")
def panel_of(spark):
    """Build a dense panel from {(item, store): [values]}."""

    def build(series: dict, start=date(2020, 1, 1)):
        rows = [
            (item, store, d, v)
            for (item, store), values in series.items()
            for d, v in zip(days(start, len(values)), values)
        ]
        return spark.createDataFrame(rows, "item_id string, store_id string, date date, sales bigint")

    return build
