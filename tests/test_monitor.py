"""Drift decisions, flags and cooldown at their boundaries."""

import datetime as dt

from pyspark.sql import functions as F

from tradewind.plans.monitor import cooldown_state, drift_decisions, latest_flags, retrain_actions


def _preds(spark, n_prev, prev_err, n_recent, recent_err, model="ModelA_X"):
    rows, d0 = [], dt.date(2020, 1, 1)
    for i in range(n_prev + n_recent):
        err = prev_err if i < n_prev else recent_err
        rows.append((i + 1, 1, "S", d0 + dt.timedelta(days=i), 100.0 + err, 100.0))
    p = spark.createDataFrame(rows, "prediction_id long, model_run_id long, benchmark_code string,"
                                    " prediction_for_date date, predicted_close double,"
                                    " actual_close double")
    r = spark.createDataFrame([(1, "S", model)], "model_run_id long, benchmark_code string,"
                                                 " model_name string")
    return r, p


def _decide(spark, *a):
    return drift_decisions(*_preds(spark, *a)).first()


def test_drift_boundaries(spark):
    assert _decide(spark, 0, 20.0, 29, 20.0).reason == "insufficient_history"
    d30 = _decide(spark, 0, 20.0, 30, 20.0)
    assert (d30.reason, d30.severity, d30.previous_mae) == ("no_previous_window", "info", None)
    d31 = _decide(spark, 1, 20.0, 30, 26.2)            # one previous row is enough
    assert d31.previous_mae == 20.0 and d31.severity == "error"
    # ratios 1.15, 1.16, 1.30, 1.31 with float thresholds, as the reference compares
    sev = [_decide(spark, 30, 20.0, 30, e).severity for e in (23.0, 23.2, 26.0, 26.2)]
    assert sev == ["warning" if 23.0 > 20.0 * 1.15 else "info", "warning", "warning", "error"]
    zero = _decide(spark, 30, 0.0, 30, 1.0)            # previous MAE 0: error, change reads 0
    assert zero.severity == "error" and zero.relative_change == 0.0


def test_flags_and_cooldown(spark):
    logs = spark.createDataFrame(
        [(1, "model_drift", "info", "ModelA_X@S", "m", '{"should_retrain": true}'),
         (2, "model_drift", "info", "ModelA_X@S", "m", '{"should_retrain": false}'),
         (3, "model_drift", "info", "ModelB_Y@S", "m", '{"reason": "insufficient_history"}'),
         (4, "model_drift", "error", "NextDay@S", "m", '{"should_retrain": true}')],
        "monitoring_id long, log_type string, severity string, component_name string,"
        " message string, details string")
    flags = {r.component_name: r.should_retrain for r in latest_flags(logs).collect()}
    assert flags == {"ModelA_X@S": False, "ModelB_Y@S": False}   # newest wins; missing key
    as_of = dt.datetime(2024, 1, 2, 0, 0, 0)
    runs = spark.createDataFrame(
        [("ModelA_X", as_of - dt.timedelta(hours=24)), ("ModelB_Y", as_of - dt.timedelta(hours=24,
                                                                                          seconds=1))],
        "model_name string, finished_at timestamp")
    flags_true = latest_flags(logs.filter("monitoring_id != 2"))
    acts = {r.group_prefix: (r.action, r.cooldown_active)
            for r in retrain_actions(flags_true, runs, F.lit(as_of)).collect()}
    assert acts["ModelA_"] == ("cooldown", True)                  # exactly 24 h: active
    assert acts["ModelB_"] == ("skipped", False)


def test_cooldown_state(spark):
    as_of = dt.datetime(2024, 1, 2, 0, 0, 0)
    runs = spark.createDataFrame(
        [("ModelA_X", as_of - dt.timedelta(hours=30)), ("ModelA_Y", as_of - dt.timedelta(hours=24)),
         ("ModelAxZ", as_of), ("Other", as_of)],
        "model_name string, finished_at timestamp")
    got = {r.group_prefix: (r.last_finished_at, r.cooldown_ends_at, r.cooldown_active)
           for r in cooldown_state(runs, F.lit(as_of)).collect()}
    # LIKE treats '_' as a wildcard, so ModelAxZ belongs to ModelA_ (newest run wins).
    assert got["ModelA_"] == (as_of, as_of + dt.timedelta(hours=24), True)
    assert got["ModelB_"] == (None, None, False)                  # no run: no cooldown
    only_old = cooldown_state(runs.filter("model_name = 'ModelA_Y'"), F.lit(as_of))
    assert {r.group_prefix: r.cooldown_active for r in only_old.collect()}["ModelA_"] is True
