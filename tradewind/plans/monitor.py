"""Drift monitoring and retraining decisions.

Vectorised over every (series, model) at once: the latest run per model is a
``max_by`` aggregate, the recent / previous windows come from one
``row_number`` over (series, model) ordered by prediction date, and the
decision is a ``when`` chain on conditional aggregates.  Thresholds are
doubles (``1.30D``), as the reference compares floats.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Drift window and thresholds, retraining groups and cooldown.
RECENT_WINDOW = 30
WARNING_RATIO = 1.15
ERROR_RATIO = 1.30
GROUP_PREFIXES = ("ModelA_", "ModelB_")
COOLDOWN_HOURS = 24
RETRAINER = "AutoRetrainer"


def latest_runs(runs: DataFrame, keys=("benchmark_code", "model_name")) -> DataFrame:
    """the newest run (highest id) per model; an aggregate, so a model with
    many runs combines map-side."""
    cols = [c for c in runs.columns if c not in keys]
    best = F.max_by(F.struct(*cols), F.col("model_run_id"))
    return runs.groupBy(*keys).agg(best.alias("_r")).select(*keys, "_r.*")


def scored_predictions(runs: DataFrame, predictions: DataFrame) -> DataFrame:
    """Predictions with actuals of each model's latest run."""
    lr = latest_runs(runs).select("model_run_id", "model_name")
    return (predictions.filter(F.col("actual_close").isNotNull())
            .join(lr, "model_run_id")
            .withColumn("abs_error_e4", F.abs(
                F.round(F.col("predicted_close") * 10000).cast("long")
                - F.round(F.col("actual_close") * 10000).cast("long"))))


@F.pandas_udf(T.StringType())
def _fmt4(s: pd.Series) -> pd.Series:
    """'%.4f' on the exact binary value (Java's formatter rounds the shortest
    decimal string instead, which differs on decimal ties).  One row per
    model, so this Arrow-batched helper is never on a hot path."""
    return s.map(lambda v: None if v is None or pd.isna(v) else f"{v:.4f}")


def _mae(sum_e4: Column, n: Column) -> Column:
    """Exact decimal mean of 4-place errors, as the nearest double."""
    return sum_e4.cast("double") / (n.cast("double") * F.lit(10000.0))


def drift_decisions(runs: DataFrame, predictions: DataFrame,
                    recent_window: int = RECENT_WINDOW) -> DataFrame:
    """L1/L2: one decision per (series, model)."""
    p = scored_predictions(runs, predictions)
    keys = ["benchmark_code", "model_name", "model_run_id"]
    rw = recent_window
    # the row count is a plain hash aggregate; the windows need only the newest
    # 2 * rw rows per model, so the rank filter lets Spark keep a top-k per task
    # before the shuffle (a model with a third of all predictions is never
    # sorted whole in one task).  Under rw rows, all of them are in the top 2 * rw.
    totals = p.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_available"))
    w = Window.partitionBy("benchmark_code", "model_name").orderBy(
        F.col("prediction_for_date").desc(), F.col("prediction_id").desc())
    top = p.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= 2 * rw)
    windows = top.groupBy(*keys).agg(
        F.sum("abs_error_e4").alias("_all_s"),
        F.sum(F.when(F.col("rn") <= rw, F.col("abs_error_e4"))).alias("_rec_s"),
        F.count_if(F.col("rn") <= rw).alias("_rec_n"),
        F.sum(F.when(F.col("rn") > rw, F.col("abs_error_e4"))).alias("_prev_s"),
        F.count_if(F.col("rn") > rw).alias("_prev_n"))
    agg = totals.join(windows, keys)
    short = F.col("rows_available") < rw
    recent = F.when(short, _mae(F.col("_all_s"), F.col("rows_available"))).otherwise(
        _mae(F.col("_rec_s"), F.col("_rec_n")))
    prev = F.when(~short & (F.col("_prev_n") > 0), _mae(F.col("_prev_s"), F.col("_prev_n")))
    d = agg.select("benchmark_code", "model_name", "model_run_id", "rows_available",
                   recent.alias("recent_mae"), prev.alias("previous_mae"))
    r, pv = F.col("recent_mae"), F.col("previous_mae")
    rel = F.when(pv.isNull(), F.lit(None).cast("double")).when(pv != 0, (r - pv) / pv) \
        .otherwise(F.lit(0.0))
    err = pv.isNotNull() & (r > pv * F.lit(ERROR_RATIO))
    warn = pv.isNotNull() & ~err & (r > pv * F.lit(WARNING_RATIO))
    f4 = _fmt4
    name = F.col("model_name")
    message = (F.when(short, F.concat(F.lit("Not enough predictions yet for robust retraining "
                                            "decision on "), name, F.lit(".")))
               .when(pv.isNull(), F.concat(name, F.lit(" is stable. No retraining needed.")))
               .when(err, F.concat(name, F.lit(" degraded sharply. Recent MAE="), f4(r),
                                   F.lit(", previous MAE="), f4(pv),
                                   F.lit(". Retraining strongly recommended.")))
               .when(warn, F.concat(name, F.lit(" degraded. Recent MAE="), f4(r),
                                    F.lit(", previous MAE="), f4(pv),
                                    F.lit(". Retraining recommended.")))
               .otherwise(F.concat(name, F.lit(" stable. Recent MAE="), f4(r),
                                   F.lit(", previous MAE="), f4(pv), F.lit("."))))
    return d.select(
        "*", rel.alias("relative_change"),
        F.when(err, "error").when(warn, "warning").otherwise("info").alias("severity"),
        (err | warn).alias("should_retrain"),
        F.when(short, "insufficient_history").when(pv.isNull(), "no_previous_window")
        .alias("reason"),
        message.alias("message"),
        F.lit(rw).alias("recent_window"))


def decision_details(decisions: DataFrame) -> Column:
    """L2 details JSON; key set per branch as in the reference (the
    insufficient branch has no should_retrain key)."""
    base = [F.col("rows_available"), F.col("recent_window")]
    short = F.col("reason") == "insufficient_history"
    noprev = F.col("reason") == "no_previous_window"
    j_short = F.to_json(F.struct(*base, F.col("reason")))
    j_noprev = F.to_json(F.struct(*base, F.col("recent_mae"),
                                  F.lit(None).cast("double").alias("previous_mae"),
                                  F.lit(False).alias("should_retrain"), F.col("reason")),
                         {"ignoreNullFields": "false"})
    j_full = F.to_json(F.struct(*base, F.col("recent_mae"), F.col("previous_mae"),
                                F.col("relative_change"), F.col("should_retrain")))
    return F.when(short, j_short).when(noprev, j_noprev).otherwise(j_full)


def drift_logs(decisions: DataFrame, id_base: int = 0) -> DataFrame:
    """Monitoring-log rows for the decisions; ids derive from the run
    id (``id_base + model_run_id``), so no global numbering is needed."""
    return decisions.select(
        (F.lit(id_base) + F.col("model_run_id")).cast("long").alias("monitoring_id"),
        F.lit("model_drift").alias("log_type"), "severity",
        F.concat(F.col("model_name"), F.lit("@"), F.col("benchmark_code")).alias("component_name"),
        "message", F.lit("recent_mae").alias("metric_name"),
        F.col("recent_mae").alias("metric_value"), decision_details(decisions).alias("details"))


def pipeline_logs(spark: SparkSession, steps: list[tuple[str, str, dict]]) -> DataFrame:
    """Log rows of the retrainer's steps (severity, message, details) in order."""
    return spark.createDataFrame(
        [(i, sev, msg, json.dumps(details)) for i, (sev, msg, details) in enumerate(steps)],
        "step int, severity string, message string, details string").select(
        "step", F.lit("pipeline").alias("log_type"), "severity",
        F.lit(RETRAINER).alias("component_name"), "message",
        F.lit(None).cast("string").alias("metric_name"),
        F.lit(None).cast("double").alias("metric_value"), "details")


def latest_flags(logs: DataFrame, prefixes=GROUP_PREFIXES) -> DataFrame:
    """Newest drift log per component of the retrainable groups,
    with ``should_retrain`` read from the JSON details (missing -> false)."""
    like = None
    for p in prefixes:
        c = F.col("component_name").like(p + "%")
        like = c if like is None else (like | c)
    rel = logs.filter((F.col("log_type") == "model_drift") & like)
    best = F.max_by(F.struct("severity", "message", "details"), F.col("monitoring_id"))
    latest = rel.groupBy("component_name").agg(best.alias("_l")).select("component_name", "_l.*")
    flag = F.coalesce(F.get_json_object("details", "$.should_retrain").cast("boolean"),
                      F.lit(False))
    return latest.withColumn("should_retrain", flag)


def _group_of(col: Column, prefixes, like: bool) -> Column:
    """The group prefix of a name: SQL LIKE (``_`` is a wildcard, as in the
    run lookup) or literal ``startswith`` (as in the flag grouping)."""
    expr = None
    for p in prefixes:
        cond = col.like(p + "%") if like else col.startswith(p)
        expr = F.when(cond, F.lit(p)) if expr is None else expr.when(cond, F.lit(p))
    return expr


def cooldown_state(runs: DataFrame, as_of: Column, prefixes=GROUP_PREFIXES,
                   cooldown_hours: int = COOLDOWN_HOURS) -> DataFrame:
    """Per group, the newest finished run and whether it lies within the
    cooldown window before ``as_of`` (inclusive); a group without runs has no
    cooldown.  One partial aggregate per task, a handful of groups after it."""
    spark = runs.sparkSession
    groups = spark.createDataFrame([(p,) for p in prefixes], "group_prefix string")
    last = (runs.withColumn("group_prefix", _group_of(F.col("model_name"), prefixes, True))
            .filter(F.col("group_prefix").isNotNull())
            .groupBy("group_prefix").agg(F.max("finished_at").alias("last_finished_at")))
    cutoff = as_of - F.make_interval(hours=F.lit(cooldown_hours))
    ends = F.col("last_finished_at") + F.make_interval(hours=F.lit(cooldown_hours))
    return groups.join(last, "group_prefix", "left").select(
        "group_prefix", "last_finished_at", ends.alias("cooldown_ends_at"),
        F.coalesce(F.col("last_finished_at") >= cutoff, F.lit(False)).alias("cooldown_active"))


def retrain_actions(flags: DataFrame, runs: DataFrame, as_of: Column,
                    prefixes=GROUP_PREFIXES, cooldown_hours: int = COOLDOWN_HOURS) -> DataFrame:
    """One action per group: none / skipped / cooldown / retrain."""
    spark = flags.sparkSession
    groups = spark.createDataFrame([(p,) for p in prefixes], "group_prefix string")
    per = (flags.withColumn("group_prefix", _group_of(F.col("component_name"), prefixes, False))
           .filter(F.col("group_prefix").isNotNull())
           .groupBy("group_prefix").agg(F.bool_or("should_retrain").alias("_any")))
    last = cooldown_state(runs, as_of, prefixes, cooldown_hours)
    flag_count = flags.select(F.count(F.lit(1))).scalar()   # scalar subquery, not a join
    out = groups.join(per, "group_prefix", "left").join(last, "group_prefix", "left")
    retrain = F.coalesce(F.col("_any"), F.lit(False))
    cooldown = F.col("cooldown_active")
    action = (F.when(flag_count == 0, "none")
              .when(~retrain, "skipped")
              .when(cooldown, "cooldown").otherwise("retrain"))
    return out.select("group_prefix", retrain.alias("retrain_flag"),
                      cooldown.alias("cooldown_active"), "last_finished_at",
                      flag_count.alias("flag_count"), action.alias("action"))
