"""The stored-table study end to end on a small panel written as raw CSV files."""

import random
from datetime import date, timedelta

from pyspark.sql import functions as F

from panelcast.jobs import Study
from panelcast.operators.forecast.boost import BoostParams
from panelcast.schema import QUANTILE_NAMES

EPOCH = date(2011, 1, 29)
N_DAYS = 460


def _write_raw(folder):
    rng = random.Random(11)
    rates = {"FOODS_1_001": 0.95, "FOODS_1_002": 0.65, "HOBBIES_1_001": 0.35, "HOUSEHOLD_1_001": 0.1}
    lines = ["id,item_id,store_id," + ",".join(f"d_{i + 1}" for i in range(N_DAYS))]
    keys = [(item, store) for item in rates for store in ("CA_1", "TX_1", "WI_1")]
    for item, store in keys:
        cells = [str(rng.randint(1, 9)) if rng.random() < rates[item] else "0" for _ in range(N_DAYS)]
        lines.append(f"{item}_{store}_validation,{item},{store}," + ",".join(cells))
    (folder / "sales_train_validation.csv").write_text("\n".join(lines) + "\n")
    cal = ["date,wm_yr_wk,event_name_1,event_type_1,event_name_2,snap_CA,snap_TX,snap_WI"]
    for i in range(N_DAYS):
        d = EPOCH + timedelta(days=i)
        event = "Christmas,National" if (d.month, d.day) == (12, 25) else ","
        cal.append(f"{d},{11101 + i // 7},{event},,{int(d.day < 11)},{int(d.day > 20)},0")
    more = [",".join([lines[0], "d_461", "d_462"])] + [f"{line},{i},".replace("_validation", "_evaluation") for i, line in enumerate(lines[1:])]
    (folder / "sales_train_evaluation.csv").write_text("\n".join(more) + "\n")
    (folder / "calendar.csv").write_text("\n".join(cal) + "\n")
    prices = ["store_id,item_id,wm_yr_wk,sell_price"]
    for item, store in keys:
        prices += [f"{store},{item},{11101 + w},{1 + (w % 5) / 10:.2f}" for w in range(2, N_DAYS // 7 + 1)]
    (folder / "sell_prices.csv").write_text("\n".join(prices) + "\n")


def test_study_from_csv_to_comparison(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    _write_raw(raw)
    study = Study(spark, str(tmp_path / "tables"))
    assert study.load(str(raw)) == ["calendar", "sales_wide", "sales_wide_evaluation", "sell_prices"]
    assert dict(study.read("sales_wide").dtypes)["d_460"] == "bigint" and dict(study.read("calendar").dtypes)["date"] == "date"
    study.reshape(EPOCH)
    assert study.read("sales_long").count() == 12 * N_DAYS
    study.labels(EPOCH)
    labels = study.read("test_labels").collect()  # the second file's empty last day has no row
    assert {(r["date"], r["sales"]) for r in labels} == {(EPOCH + timedelta(days=N_DAYS), i) for i in range(12)} and len(labels) == 12
    study.segments(per_stratum=1, sample_size=10)
    assert study.read("arima_sample").count() == study.read("series_segments").select("categoria_zero_rate").distinct().count()
    study.features(EPOCH)
    assert len(study.read("features_train").columns) == 52
    layout = {"n_folds": 2}
    assert study.folds(write=True, **layout).count() == 2
    study.cv("arima", **layout)
    study.cv("bqml", **layout)
    study.cv("bqml", fold=2, **layout)  # repeating a fold changes nothing
    study.cv("lgbm", params=BoostParams(rounds=2, learning_rate=0.5, max_depth=3, min_rows=5), **layout)
    sample = study.read("lgbm_sample").count()
    for model in ("bqml", "lgbm"):
        p = study.predictions(model)
        assert p.count() == sample * 28 * 2
        assert p.where(" or ".join(f"{a} > {b}" for a, b in zip(QUANTILE_NAMES, QUANTILE_NAMES[1:]))).count() == 0
    assert study.read("arima_metadata_cv").count() == 2 * study.read("arima_sample").count()
    study.last("bqml")
    assert study.read("bqml_predictions").count() == sample * 28 == 28 * study.read("bqml_metadata").count()
    tables = study.evaluate()
    total = tables["cv_pinball_loss"].where("not bqml_unstable_series").count()
    assert tables["cv_metrics_overall"].agg(F.sum("n_obs")).first()[0] == total
    assert {r["scope"] for r in tables["compare_zero_rate"].collect()} == {"fair", "full"}
    assert study.diagnose()[1].count() == 0
