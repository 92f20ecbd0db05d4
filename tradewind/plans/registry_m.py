"""Binding M: a model registry derived from the price features.

Two formula "models" per series (ModelA_Naive predicts today's close,
ModelB_Mean7 the 7-day mean), each with an older, deliberately worse run
(prediction x 1.05) and a newer run.  Predictions are stored at 4 places.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..numerics import rnd

# Fixed values of the M binding.
MODELS = [("ModelA_Naive", 1, "close_price"), ("ModelB_Mean7", 2, "rolling_mean_7d")]
OLD_RUN_FACTOR = 1.05
RUN_FINISHED = {  # (model index, version) -> finished_at
    (1, 1): "2001-08-01 00:00:00", (1, 2): "2001-09-01 06:00:00",
    (2, 1): "2001-08-01 00:00:00", (2, 2): "2001-08-31 00:00:00"}
AS_OF = "2001-09-02 00:00:00"


def _series_digit():
    return F.substring("benchmark_code", 1, 1).cast("int")


def model_runs(features: DataFrame) -> DataFrame:
    series = features.select("benchmark_code").distinct()
    parts = []
    for name, idx, _ in MODELS:
        for ver in (1, 2):
            parts.append(series.select(
                (_series_digit() * 100 + idx * 10 + ver).cast("long").alias("model_run_id"),
                "benchmark_code", F.lit(name).alias("model_name"),
                F.lit(f"v{ver}").alias("model_version"),
                F.lit(RUN_FINISHED[(idx, ver)]).cast("timestamp").alias("finished_at")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def predictions(features: DataFrame) -> DataFrame:
    labelled = features.filter(F.col("target_close_next_day").isNotNull())
    parts = []
    for name, idx, col in MODELS:
        for ver in (1, 2):
            factor = OLD_RUN_FACTOR if ver == 1 else 1.0
            run_id = (_series_digit() * 100 + idx * 10 + ver).cast("long")
            parts.append(labelled.filter(F.col(col).isNotNull()).select(
                (run_id * 100000 + F.datediff("feature_date", F.lit("1995-01-01")))
                .cast("long").alias("prediction_id"),
                run_id.alias("model_run_id"), "benchmark_code", "feature_date",
                F.col("target_date").alias("prediction_for_date"),
                rnd(F.col(col) * F.lit(factor), 4).alias("predicted_close"),
                F.col("target_close_next_day").alias("actual_close"),
                F.lit(True).alias("is_backtest")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
