"""The whole study on stored tables, one step per command.

    python -m panelcast.jobs load      --base DIR --data CSV_DIR
    python -m panelcast.jobs reshape   --base DIR --epoch 2011-01-29
    python -m panelcast.jobs segments  --base DIR [--sample-size 3000]
    python -m panelcast.jobs features  --base DIR --epoch 2011-01-29
    python -m panelcast.jobs folds     --base DIR [--write]
    python -m panelcast.jobs cv        --base DIR --model arima|bqml|lgbm [--fold N] [--rebuild]
                                       [--rounds N --learning-rate X --max-depth N]
    python -m panelcast.jobs last      --base DIR --model ...   (the last fold alone, in tables of its own)
    python -m panelcast.jobs labels    --base DIR --epoch 2011-01-29
    python -m panelcast.jobs evaluate  --base DIR
    python -m panelcast.jobs diagnose  --base DIR

Steps read and write tables below ``--base``; every write can be repeated.
"""

from __future__ import annotations

import argparse
import logging
import re
from datetime import date as Date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.functions.keys import farm_key
from panelcast.operators import evaluate as ev
from panelcast.operators import folds as fo
from panelcast.operators import segments as sg
from panelcast.operators.checks import check_forecast_range
from panelcast.operators.forecast import arima as ar
from panelcast.operators.forecast import decomposed as de
from panelcast.operators.forecast.boost import BoostParams
from panelcast.operators.forecast.common import forecast_metadata
from panelcast.operators.reshape import held_back_days, wide_to_long
from panelcast.plans.evaluation import evaluate_all, flags_only
from panelcast.plans.features import build_features
from panelcast.plans.walk_forward import boost_walk_forward
from panelcast.schema import ARIMA_METADATA, FOLDS, PREDICTIONS, UNCERTAINTY_METADATA
from panelcast.session import build_session, checkpoint, join_path
from panelcast.sources.readers import read_panel_csvs, read_table
from panelcast.sources.writers import (
    conform,
    materialise_once,
    write_folds,
    write_partitioned,
    write_truncate,
)

log = logging.getLogger(__name__)

# Raw file of each table.
RAW_FILES = {
    "sales_wide": "sales_train_validation.csv",
    "sales_wide_evaluation": "sales_train_evaluation.csv",
    "sell_prices": "sell_prices.csv",
    "calendar": "calendar.csv",
}


def raw_type(column: str) -> T.DataType:
    """Type of a raw file's column."""
    if column == "date":
        return T.DateType()
    if column == "sell_price":
        return T.DoubleType()
    if column == "wm_yr_wk" or re.fullmatch(r"d_\d+", column):
        return T.LongType()
    if column in ("wday", "month", "year") or column.startswith("snap_"):
        return T.IntegerType()
    return T.StringType()


class Study:
    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base

    def path(self, table: str) -> str:
        return join_path(self.base, table)

    def read(self, table: str) -> DataFrame:
        return read_table(self.spark, self.path(table))

    def load(self, data_dir: str) -> list[str]:
        """CSV files to tables; files that are missing are skipped."""
        files = {table: join_path(data_dir, name) for table, name in RAW_FILES.items()}
        loaded = read_panel_csvs(self.spark, files, dict.fromkeys(files, raw_type))
        for table, df in loaded.items():
            df.write.mode("overwrite").parquet(self.path(table))
        return sorted(loaded)

    def reshape(self, epoch: Date) -> None:
        write_partitioned(wide_to_long(self.read("sales_wide"), epoch), self.path("sales_long"))

    def labels(self, epoch: Date) -> None:
        """The days of the second wide file behind the last day of the first, in a table of their own."""
        known = self.read("sales_long").agg(F.max("date")).first()[0]
        write_partitioned(held_back_days(self.read("sales_wide_evaluation"), epoch, known), self.path("test_labels"))

    def segments(self, per_stratum: int = 8, sample_size: int = 3000) -> None:
        """Segments, the balanced sample and the proportional sample that contains it."""
        write = lambda df, table: df.write.mode("overwrite").parquet(self.path(table))
        write(sg.zero_rate_segments(self.read("sales_long")), "series_segments")
        segments = self.read("series_segments")
        write(sg.stratified_top_n(segments, per_stratum, "arima_sample_v1", key=farm_key), "arima_sample")
        quotas = sg.proportional_quotas(segments, sample_size)
        write(
            sg.proportional_sample(segments, self.read("arima_sample"), quotas, "lgbm_sample_v1", key=farm_key),
            "lgbm_sample",
        )
        write(sg.first_release(self.read("sell_prices"), self.read("calendar")), "series_release_dates")

    def features(self, epoch: Date) -> None:
        calendar = self.read("calendar")
        flags = {c.removeprefix("snap_"): c for c in calendar.columns if c.startswith("snap_")}
        table = build_features(
            self.read("sales_long"), calendar, self.read("sell_prices"), epoch, flags
        )
        write_partitioned(table, self.path("features_train"))

    def folds(self, write: bool = False, **layout) -> DataFrame:
        folds = fo.make_folds(self.read("sales_long"), **layout)
        if write:
            write_truncate(folds, self.path("cv_folds"), FOLDS)
        return folds

    def _series(self, sample: str) -> DataFrame:
        return self.read(sample).select("item_id", "store_id")

    def _sampled_sales(self, rebuild: bool) -> DataFrame:
        """The sampled series' sales, filtered once: a join with the sample inside every fold
        would scan the whole panel every time."""
        return materialise_once(
            self.spark,
            self.path("sales_long_lgbm_sample"),
            lambda: sg.sample_panel(self.read("sales_long"), self.read("lgbm_sample")),
            force=rebuild,
            inputs=[self.path("sales_long"), self.path("lgbm_sample")],
        )

    def _store(self, rows: DataFrame, table: str, schema, ids: list[int]) -> None:
        kept = checkpoint(conform(rows, schema), table)
        write_folds(kept, self.path(table), ids, schema)

    def cv(
        self, model: str, fold: int | None = None, rebuild: bool = False,
        params: BoostParams = BoostParams(), **layout,
    ) -> None:
        """Fit and predict every fold (or one) and store predictions and metadata by fold."""
        folds = self.folds(**layout)
        folds = folds if fold is None else fo.select_fold(folds, fold)
        self._forecast(model, folds, "_cv", rebuild, params)
        wrong = check_forecast_range(self.predictions(model), folds).where("not ok")
        for r in wrong.collect():  # at most one row per fold
            log.warning("fold %s: forecast %s..%s", r["fold_id"], r["pred_min"], r["pred_max"])

    def last(self, model: str, rebuild: bool = False, params: BoostParams = BoostParams(), **layout) -> None:
        """Fit on the days before the last validation window and forecast that window, in tables of its own."""
        end = self.read("sales_long").agg(F.max("date")).first()[0]
        self._forecast(model, fo.single_fold(self.spark, end, **layout), "", rebuild, params)

    def _forecast(self, model: str, folds: DataFrame, suffix: str, rebuild: bool, params: BoostParams) -> None:
        ids = [r["fold_id"] for r in folds.select("fold_id").orderBy("fold_id").collect()]
        segments = self.read("series_segments")
        if model == "arima":
            sales = sg.sample_panel(self.read("sales_long"), self.read("arima_sample"))
            train = fo.split_folds(sales, folds, roles=("train",))
            fits = checkpoint(ar.fit_arima(ar.training_arrays(train)), "arima-fits")
            predictions = ar.arima_predictions(fits, folds)
            self._store(ar.arima_metadata(fits, segments), f"arima_metadata{suffix}", ARIMA_METADATA, ids)
        elif model == "bqml":
            calendar = flags_only(self.read("calendar"))
            train = fo.split_folds(self._sampled_sales(rebuild), folds, roles=("train",))
            fits = checkpoint(de.fit_decomposed(train, calendar), "decomposed-fits")
            predictions = de.decomposed_predictions(fits, folds, calendar)
            self._store(
                forecast_metadata(predictions, segments), f"bqml_metadata{suffix}", UNCERTAINTY_METADATA, ids
            )
        elif model == "lgbm":
            rows = self.read("features_train").join(
                self._series("lgbm_sample"), ["item_id", "store_id"], "left_semi"
            )
            predictions = boost_walk_forward(rows, folds, params)
        else:
            raise ValueError(f"unknown model {model}")
        self._store(predictions, f"{model}_predictions{suffix}", PREDICTIONS, ids)

    def predictions(self, model: str) -> DataFrame:
        return self.spark.read.schema(PREDICTIONS).parquet(self.path(f"{model}_predictions_cv"))

    def evaluate(self) -> dict[str, DataFrame]:
        return evaluate_all(
            self.spark,
            self.path("evaluation"),
            {m: self.predictions(m) for m in ("arima", "bqml", "lgbm")},
            self.read("sales_long"),
            self.read("series_segments"),
            self.read("arima_sample"),
            self.read("series_release_dates"),
            flags_only(self.read("calendar")),
        )

    def diagnose(self) -> tuple[DataFrame, DataFrame]:
        bqml = self.predictions("bqml")
        return ev.outliers_by_fold(bqml), ev.outlier_series(bqml)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="panelcast.jobs")
    ap.add_argument("step", choices=["load", "reshape", "segments", "features", "folds", "cv", "last", "labels", "evaluate", "diagnose"])
    ap.add_argument("--base", required=True)
    ap.add_argument("--data")
    ap.add_argument("--epoch", type=Date.fromisoformat, default=Date(2011, 1, 29))
    ap.add_argument("--sample-size", type=int, default=3000)
    ap.add_argument("--write", action="store_true")
    ap.add_argument("--model", choices=["arima", "bqml", "lgbm"])
    ap.add_argument("--fold", type=int)
    ap.add_argument("--rebuild", action="store_true")
    ap.add_argument("--rounds", type=int, default=BoostParams.rounds)
    ap.add_argument("--learning-rate", type=float, default=BoostParams.learning_rate)
    ap.add_argument("--max-depth", type=int, default=BoostParams.max_depth)
    ap.add_argument("--max-leaves", type=int, default=BoostParams.max_leaves)
    args = ap.parse_args(argv)
    study = Study(build_session(), args.base)
    params = BoostParams(
        rounds=args.rounds, learning_rate=args.learning_rate, max_depth=args.max_depth, max_leaves=args.max_leaves
    )
    if args.step == "load":
        study.load(args.data)
    elif args.step == "reshape":
        study.reshape(args.epoch)
    elif args.step == "segments":
        study.segments(sample_size=args.sample_size)
    elif args.step == "features":
        study.features(args.epoch)
    elif args.step == "folds":
        study.folds(args.write).show()
    elif args.step == "cv":
        study.cv(args.model, args.fold, args.rebuild, params)
    elif args.step == "last":
        study.last(args.model, args.rebuild, params)
    elif args.step == "labels":
        study.labels(args.epoch)
    elif args.step == "evaluate":
        for name, df in study.evaluate().items():
            if name.startswith("compare") or name == "exclusions":
                print(name)
                df.show(50, truncate=False)
    else:
        for df in study.diagnose():
            df.show(30, truncate=False)


if __name__ == "__main__":
    main()
