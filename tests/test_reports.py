"""The model run, the diagnosis and the forecast plans end to end at the smallest scale."""

import os

import pytest
from pyspark.sql import functions as F

from checks import standin
from checks.features import features
from tidemark import schemas as s
from tidemark.plans import reports
from tidemark.session import stage_table

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test data not there")


def test_boosted_run_and_diagnosis(spark):
    raw = stage_table(features(spark, SF_DIR), "features")
    used = ["is_net_margin", "bs_debt_to_equity", "econ_cpi", "fin_days_since_release"]
    _, out = reports.boosted_run(raw, used, trees=1, depth=2, folds=2)
    rows = {name: df.count() for name, df in out.items()}
    assert rows["predictions"] == raw.filter(F.col(s.TARGET).isNotNull()).count()
    assert (rows["cv_folds"], rows["cv_summary"], rows["metrics"], rows["residuals"]) == (2, 1, 2, 50)
    assert rows["null_profile"] == len(used)
    predicted = out["predictions"].join(raw.select(*s.KEY_COLUMNS, *used), s.KEY_COLUMNS)
    diagnosis = {n: d.count() for n, d in reports.prediction_diagnosis(predicted, raw, used, 0.02).items()}
    assert diagnosis["profile"] == raw.select("symbol").distinct().count()
    assert (diagnosis["extremes"], diagnosis["cohorts"]) == (2, 5)


def test_forecast_plans(spark):
    bars = standin.stored_bars(spark, SF_DIR)
    made = reports.forecast_dataset(bars, "2000-07-01", ["sma_5", "rsi_14"], fit_on_train=True)
    row = made.select(F.size("sequence").alias("n"), F.size(F.col("sequence")[0]).alias("w")).first()
    assert (row["n"], row["w"]) == (40, 2)
    assert made.filter((F.col("split") == "train") != (F.col("target_date") < "2000-07-01")).count() == 0
    tables = {n: d.count() for n, d in reports.forecast_tables(standin.preds(spark, SF_DIR)).items()}
    assert tables["top_bottom"] == 10 and tables["mean_accuracy"] == 1


def test_forecast_dataset_reads_its_stage_twice_and_joins_no_arrays(spark):
    made = reports.forecast_dataset(standin.stored_bars(spark, SF_DIR), "2000-07-01")
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2  # the ordered rows: for the aggregate per key, and as rows
    assert plan.count("Exchange") <= 5
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert len(joins) == 1 and "sequence" not in joins[0]
