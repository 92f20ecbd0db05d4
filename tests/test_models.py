"""Split, folds and the linear solvers against plain numpy."""

import datetime as dt

import numpy as np
import pandas as pd

from tradewind.plans import grouped as G
from tradewind.plans import models as M


def _series(spark, n, code="A", seed=0):
    rng = np.random.RandomState(seed)
    x1, x2 = rng.normal(size=n), rng.normal(size=n)
    y = 3.0 + 2.0 * x1 - 1.0 * x2 + rng.standard_t(3, size=n) * 0.3
    rows = [(code, dt.date(2020, 1, 1) + dt.timedelta(days=i), float(x1[i]), float(x2[i]),
             float(y[i])) for i in range(n)]
    return spark.createDataFrame(rows, "benchmark_code string, feature_date date, x1 double, "
                                       "x2 double, target_close_next_day double"), x1, x2, y


def test_split_sizes(spark):
    # split_tiny: int(n * 0.7) in binary floating point
    for n, train in [(10, 7), (90, 62), (170, 118), (180, 125)]:
        df, *_ = _series(spark, n)
        s = M.chronological_split(df)
        assert s.filter("split = 'train'").count() == train == int(n * 0.7)
        assert s.filter("split != 'test'").count() == int(n * 0.8)


def test_folds_tiny(spark):
    df, *_ = _series(spark, 10)
    f = M.time_series_folds(df)
    sizes = {(r.fold, r.role): r["count"] for r in f.groupBy("fold", "role").count().collect()}
    assert [sizes[(k, "train")] for k in range(3)] == [4, 6, 8]
    assert [sizes[(k, "test")] for k in range(3)] == [2, 2, 2]


def test_ols_matches_numpy(spark):
    df, x1, x2, y = _series(spark, 200, seed=1)
    coefs = M.fit_ols(df, ["benchmark_code"], ["x1", "x2"]).first()["beta"]
    X = np.column_stack([np.ones_like(x1), x1, x2])
    ref = np.linalg.lstsq(X, y, rcond=None)[0]
    assert np.allclose(coefs, ref, atol=1e-8)


def _objective(x, y, beta, alpha):
    return np.abs(y - beta[0] - x @ beta[1:]).mean() / 2 + alpha * np.abs(beta[1:]).sum()


def test_median_regression_is_optimal():
    """Collinear columns of very different size: no line search from the fit
    finds a better point, and the fit passes through as many rows as it has
    coefficients (a vertex of the linear program)."""
    rng = np.random.RandomState(2)
    base = np.cumsum(rng.normal(size=300)) + 200
    x = np.column_stack([base, base + rng.normal(size=300) * 0.5, base * 1e3,
                         rng.normal(size=300) * 1e-2])
    y = base * 3 + x[:, 3] * 50 + rng.standard_t(2, size=300)
    for alpha in (0.0, 0.01, 1.0):
        beta, value, converged, _ = G.median_l1(x, y, alpha)
        assert converged and abs(value - _objective(x, y, beta, alpha)) < 1e-9 * value
        for _ in range(400):
            d = rng.normal(size=5) / np.append(1, x.std(0))
            for step in (1e-4, 1e-2, 1.0):
                assert _objective(x, y, beta + step * d, alpha) >= value * (1 - 1e-6)
    resid = np.abs(y - G.median_l1(x[:, :1], y, 0.0)[0][0] - x[:, 0] * G.median_l1(
        x[:, :1], y, 0.0)[0][1])
    assert (resid < 1e-3).sum() >= 2


def test_median_search_reports_convergence(spark):
    df, x1, x2, y = _series(spark, 150, seed=2)
    s = M.chronological_split(df)
    r = M.median_fits(s, ["x1", "x2"]).first()
    assert r.converged and r.alpha in M.QUANTILE_ALPHAS and r.cv_mae > 0
    assert abs(r.beta[1] - 2) < 0.3 and abs(r.beta[2] + 1) < 0.3


def test_trees_of_many_series(spark):
    """100 series: every one gets its own search with a measured CV error that
    beats the constant forecast on a learnable target."""
    rows = []
    for c in range(100):
        rng = np.random.RandomState(c)
        x = rng.normal(size=(60, 2))
        for i in range(60):
            rows.append((f"S{c}", dt.date(2020, 1, 1) + dt.timedelta(days=i), float(x[i, 0]),
                         float(x[i, 1]), float(c + 4 * (x[i, 0] > 0) + 0.1 * rng.normal())))
    df = spark.createDataFrame(rows, "benchmark_code string, feature_date date, x1 double, "
                                     "x2 double, target_close_next_day double")
    s = M.chronological_split(df)
    for kind, grid in (("rf", {"n_estimators": 20, "max_depth": 3, "min_samples_leaf": 2,
                               "min_samples_split": 2}),
                       ("gbt", {"n_estimators": 30, "max_depth": 2, "learning_rate": 0.15,
                                "subsample": 1.0, "colsample_bytree": 1.0})):
        pred, best = M.tree_search(s, kind, ["x1", "x2"], candidates=[grid])
        b = best.collect()
        assert len(b) == 100 and all(0 < r.cv_mae < 1.9 for r in b)
        assert M.metrics(pred.filter("split = 'test'"), ["benchmark_code"]).where(
            "mae < 1.5").count() > 95


def test_boosting_equals_a_plain_loop():
    """Rounds of all problems together give each problem's own result."""
    rng = np.random.RandomState(0)
    x = rng.normal(size=(80, 3))
    y = x[:, 0] * 2 + (x[:, 1] > 0)
    p = {"n_estimators": 12, "max_depth": 3, "learning_rate": 0.1, "subsample": 1.0,
         "colsample_bytree": 1.0}
    alone = G.boosted([(x, y, x[:10], p)], 1)[0]
    both = G.boosted([(x[:50], y[:50], x[50:], {**p, "n_estimators": 5}), (x, y, x[:10], p)], 1)
    assert np.allclose(alone, both[1]) and len(both[0]) == 30
    assert np.abs(alone - y[:10]).mean() < np.abs(y.mean() - y[:10]).mean()


def test_search_jobs_fitted_apart_equal_the_search():
    """A job of the search has the same error in whatever group it is fitted."""
    rng = np.random.RandomState(3)
    pdf = pd.DataFrame(rng.normal(size=(60, 2)), columns=["x1", "x2"])
    pdf["y"] = pdf["x1"] * 2 + rng.normal(size=60) * 0.1
    pdf["s"], pdf["feature_date"] = "A", np.arange(60)
    grids = {"rf": M.grid_draws({**M.RF_GRID, "n_estimators": [5, 9]}, 4),
             "gbt": M.grid_draws({**M.GBT_GRID, "n_estimators": [5, 9]}, 4)}
    for kind, cands in grids.items():
        args = (pdf, "s", ["x1", "x2"], "y", kind, cands, 3, 42)
        whole = G.tree_errors(*args, list(range(12)))
        apart = pd.concat([G.tree_errors(*args, [j]) for j in range(12)])
        assert list(whole["job"]) == list(range(12))
        assert list(whole["mae"]) == list(apart["mae"])


def test_few_small_series_are_fitted_in_several_tasks(spark):
    """Five series of few bytes are not put into one task, nor a search's jobs."""
    rows = [(f"S{c}", dt.date(2020, 1, 1) + dt.timedelta(days=i), float(i * c % 7), float(i))
            for c in range(5) for i in range(40)]
    s = M.chronological_split(spark.createDataFrame(
        rows, "benchmark_code string, feature_date date, x1 double, target_close_next_day double"))

    def where(pdf):
        from pyspark import TaskContext
        return pd.DataFrame({"benchmark_code": pdf["benchmark_code"].iloc[:1],
                             "task": [TaskContext.get().partitionId()]})
    got = M.per_series(s, ["x1"], "task int", where)
    assert got.count() == 5 and got.select("task").distinct().count() > 1


def test_grid_draws_deterministic():
    a = M.grid_draws(M.RF_GRID, 12)
    assert a == M.grid_draws(M.RF_GRID, 12) and len({str(x) for x in a}) == 12


def test_ensemble_is_row_mean(spark):
    base = [("A", dt.date(2020, 1, d), dt.date(2020, 1, d + 1), float(d)) for d in range(1, 6)]
    schema = "benchmark_code string, feature_date date, target_date date, " \
             "target_close_next_day double, prediction double"
    preds = {n: spark.createDataFrame([(*r, r[3] + k) for r in base], schema)
             for k, n in enumerate(["LinearRegression", "QuantileRegression", "RandomForest",
                                    "XGBoost"])}
    out = M.ensemble(preds).collect()
    assert len(out) == 5
    for r in out:
        assert abs(r.prediction - (r.target_close_next_day + 1.5)) < 1e-12
