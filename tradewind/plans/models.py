"""Chronological splits, time-series folds and the forecasting models.

The feature table has one row per (series, trading day), so a series' history
is bounded by the calendar; the data volume grows with the number of series.
So every model is fitted per series:

* OLS: one distributed aggregation builds the Gram matrix X'X and X'y of every
  fit (map-side partial sums); the tiny system (13 x 13 at most) is solved in
  ``mapInPandas`` over one row per fit.
* Median regression and the direction classifier fit one series per
  ``applyInPandas`` group (``plans/grouped.py``).  The searches over forests and
  boosted trees deal the jobs of a series (candidate and fold) to groups of their
  own, then refit the best candidate per series.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from . import grouped as G

# Feature sets, split ratios, folds and search grids.
PRICE_FEATURES = ["lag_close_1d", "lag_close_3d", "lag_return_1d", "lag_return_3d",
                  "rolling_mean_3d", "rolling_mean_7d", "rolling_volatility_7d"]
NEWS_FEATURES = ["news_article_count_1d", "news_avg_sentiment_1d", "news_weighted_sentiment_1d",
                 "news_avg_sentiment_3d", "news_weighted_sentiment_3d"]
TARGET = "target_close_next_day"
TARGETS = ["target_close_next_day", "target_return_next_day", "target_direction_next_day"]
TRAIN_RATIO, VALIDATION_RATIO = 0.70, 0.80
N_SPLITS = 3
QUANTILE_ALPHAS = [0.0, 0.01, 0.1, 1.0]
RF_GRID = {"n_estimators": [100, 200, 400, 600], "max_depth": [4, 6, 8, None],
           "min_samples_leaf": [1, 2, 4], "min_samples_split": [2, 5, 10]}
RF_DRAWS = 12
GBT_GRID = {"n_estimators": [100, 200, 400, 600], "max_depth": [2, 3, 5, 7],
            "learning_rate": [0.03, 0.05, 0.1, 0.15], "subsample": [0.7, 0.8, 1.0],
            "colsample_bytree": [0.7, 0.8, 1.0]}
GBT_DRAWS = 15
SEARCH_SEED = 42
DIRECTION_FOREST = {"trees": 400, "depth": 6, "min_leaf": 3, "seed": 42}
MIN_LABELLED_ROWS = 50
SERIES = "benchmark_code"


# ---------------------------------------------------------------------------
# Loading, cleaning, splitting
# ---------------------------------------------------------------------------
def coerce(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Numeric coercion, bad values and NaN to NULL."""
    out = df
    for c in cols:
        v = F.col(c).try_cast("double")
        out = out.withColumn(c, F.when(F.isnan(v), None).otherwise(v))
    return out


def with_news_filled(df: DataFrame) -> DataFrame:
    """Missing news becomes 0, only at model load (after the 3-day means)."""
    return df.fillna(0, subset=NEWS_FEATURES)


def complete_cases(df: DataFrame, features: Sequence[str], targets: Sequence[str] = (TARGET,)
                   ) -> DataFrame:
    """Rows with every feature and target present."""
    return df.dropna(subset=list(features) + list(targets))


def live_candidates(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Rows usable for a live forecast (targets may be missing)."""
    return df.dropna(subset=list(features) + ["close_price"])


def chronological_split(df: DataFrame, date: str = "feature_date") -> DataFrame:
    """Per series, first 70 % train, next 10 % validation, rest test.

    ``int(n * 0.7)`` is evaluated in binary floating point as the reference
    does (a double literal, not Spark's exact decimal).
    """
    w_all = Window.partitionBy(SERIES)
    w = Window.partitionBy(SERIES).orderBy(date)
    n = F.count(F.lit(1)).over(w_all)
    rn = F.row_number().over(w)
    out = df.select("*", n.alias("_n"), rn.alias("rn"))
    tr = F.floor(F.col("_n") * F.lit(TRAIN_RATIO))
    va = F.floor(F.col("_n") * F.lit(VALIDATION_RATIO))
    return out.withColumn("split", F.when(F.col("rn") <= tr, "train")
                          .when(F.col("rn") <= va, "validation").otherwise("test")).drop("_n")


def split_summary(split: DataFrame, date: str = "feature_date") -> DataFrame:
    """Rows and date bounds per (series, split)."""
    return (split.groupBy(SERIES, "split")
            .agg(F.count(F.lit(1)).alias("rows"), F.min(date).alias("start_date"),
                 F.max(date).alias("end_date")))


def time_series_folds(train: DataFrame, n_splits: int = N_SPLITS) -> DataFrame:
    """K2: expanding-window folds over each series' train rows.

    test size = n // (n_splits + 1); fold k tests rows
    (n - (n_splits - k) * size, n - (n_splits - k - 1) * size] and trains on
    everything before.  Output: the rows with ``fold`` and ``role`` (fan-out
    at most ``n_splits``, a constant).
    """
    w_all = Window.partitionBy(SERIES)
    w = Window.partitionBy(SERIES).orderBy("feature_date")
    t = train.select("*", F.count(F.lit(1)).over(w_all).alias("_nt"),
                     F.row_number().over(w).alias("_ti"))
    size = F.floor(F.col("_nt") / F.lit(n_splits + 1))
    f = t.select("*", F.explode(F.sequence(F.lit(0), F.lit(n_splits - 1))).alias("fold"))
    start = F.col("_nt") - (F.lit(n_splits) - F.col("fold")) * size
    role = (F.when(F.col("_ti") <= start, "train")
            .when(F.col("_ti") <= start + size, "test"))
    return (f.withColumn("role", role).filter(F.col("role").isNotNull())
            .drop("_nt", "_ti"))


def fold_summary(folds: DataFrame) -> DataFrame:
    return (folds.groupBy(SERIES, "fold", "role")
            .agg(F.count(F.lit(1)).alias("rows"), F.min("feature_date").alias("start_date"),
                 F.max("feature_date").alias("end_date")))


# ---------------------------------------------------------------------------
# Linear models from sufficient statistics
# ---------------------------------------------------------------------------
def _terms(xcols: Sequence[str]) -> list[Column]:
    return [F.lit(1.0)] + [F.col(c).cast("double") for c in xcols]


def gram_stats(rows: DataFrame, keys: Sequence[str], xcols: Sequence[str], y: str,
               weight: Column | None = None, extra: Sequence[Column] = ()) -> DataFrame:
    """Per fit key: n, sum|r|-free Gram entries (upper triangle, intercept
    first), X'Wy and sum(w).  One hash aggregate over all fits."""
    t = _terms(xcols)
    w = weight if weight is not None else F.lit(1.0)
    p = len(t)
    ut = [F.sum(w * t[i] * t[j]) for i in range(p) for j in range(i, p)]
    xy = [F.sum(w * t[i] * F.col(y)) for i in range(p)]
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*ut).alias("gram"), F.array(*xy).alias("xty"), *extra)


def _unpack(gram: np.ndarray, p: int) -> np.ndarray:
    a = np.zeros((p, p))
    k = 0
    for i in range(p):
        for j in range(i, p):
            a[i, j] = a[j, i] = gram[k]
            k += 1
    return a


def _solve_ls(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least squares from normal equations, solved in standardised form."""
    d = np.sqrt(np.clip(np.diag(a), 1e-300, None))
    s = a / np.outer(d, d)
    beta_s = np.linalg.lstsq(s, b / d, rcond=1e-12)[0]
    return beta_s / d


def solve_ols(stats: DataFrame, keys: Sequence[str], p: int) -> DataFrame:
    """K3: ordinary least squares per fit key (mapInPandas, one row per fit)."""
    schema = T.StructType([stats.schema[k] for k in keys]
                          + [T.StructField("beta", T.ArrayType(T.DoubleType()))])

    def run(it):
        for pdf in it:
            betas = []
            for g, xy in zip(pdf["gram"], pdf["xty"]):
                betas.append(_solve_ls(_unpack(np.asarray(g), p), np.asarray(xy)).tolist())
            out = pdf[list(keys)].copy()
            out["beta"] = betas
            yield out
    return stats.select(*keys, "gram", "xty").mapInPandas(run, schema)


def predict(rows: DataFrame, coefs: DataFrame, keys: Sequence[str], xcols: Sequence[str],
            out: str = "prediction") -> DataFrame:
    """Linear prediction with per-key coefficients, joined on the key (one row
    per fit; Spark broadcasts it only while it is small)."""
    terms = _terms(xcols)
    j = rows.join(coefs, list(keys))
    pred = None
    for i, t in enumerate(terms):
        term = F.element_at("beta", i + 1) * t
        pred = term if pred is None else pred + term
    return j.withColumn(out, pred).drop("beta")


def fit_ols(train: DataFrame, keys: Sequence[str], xcols: Sequence[str], y: str = TARGET
            ) -> DataFrame:
    return solve_ols(gram_stats(train, keys, xcols, y), keys, len(xcols) + 1)


# ---------------------------------------------------------------------------
# Backtests and metrics
# ---------------------------------------------------------------------------
def metrics(pred: DataFrame, keys: Sequence[str], y: str = TARGET, p: str = "prediction"
            ) -> DataFrame:
    """MAE and RMSE per key."""
    e = F.col(p) - F.col(y)
    return pred.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"),
                                   F.avg(F.abs(e)).alias("mae"),
                                   F.sqrt(F.avg(e * e)).alias("rmse"))


def prepared(features: DataFrame, xcols: Sequence[str], news: bool) -> DataFrame:
    """A10/A11 + C4: the modelling frame with the split column."""
    df = coerce(features, list(xcols) + [TARGET])
    if news:
        df = with_news_filled(df)
    return chronological_split(complete_cases(df, xcols))


def ols_backtest(features: DataFrame, xcols: Sequence[str] = PRICE_FEATURES,
                 news: bool = False) -> DataFrame:
    """K3/K8: OLS per series on train, scored on test."""
    s = prepared(features, xcols, news)
    coefs = fit_ols(s.filter("split = 'train'"), [SERIES], xcols)
    return predict(s.filter("split = 'test'"), coefs, [SERIES], xcols)


def spread(rows: DataFrame, *keys: str, times: int = 1) -> DataFrame:
    """Rows dealt by the keys.  The number of partitions is given: a group holds few
    bytes but much work, and groups must not be put together by their bytes.  One more
    than an ordinary shuffle has, or Spark would take the (merged) one before it;
    ``times`` as many if the groups are unlike, so that few share a task."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n * times + 1, *keys)


def per_series(rows: DataFrame, columns: Sequence[str], schema: str, fit) -> DataFrame:
    """``fit(pdf)`` on the rows of each series (bounded by the calendar)."""
    return spread(rows.select(SERIES, "feature_date", "split", *columns), SERIES).groupBy(
        SERIES).applyInPandas(fit, f"{SERIES} string, {schema}")


def median_fits(s: DataFrame, xcols: Sequence[str], alphas: Sequence[float] = QUANTILE_ALPHAS
                ) -> DataFrame:
    """Per series the best alpha by expanding-window CV (MAE), its
    coefficients on the full train part and whether the solver converged."""
    xcols, alphas = list(xcols), [float(a) for a in alphas]
    return per_series(
        s, [*xcols, TARGET], "alpha double, cv_mae double, beta array<double>, "
        "objective double, converged boolean, iterations long",
        lambda pdf: G.median_series(pdf, SERIES, xcols, TARGET, alphas, N_SPLITS))


def median_backtest(features: DataFrame, xcols: Sequence[str] = PRICE_FEATURES,
                    news: bool = False, alphas: Sequence[float] = QUANTILE_ALPHAS
                    ) -> tuple[DataFrame, DataFrame]:
    """Test predictions and best parameters (with coefficients) per series."""
    s = cut_lineage(prepared(features, xcols, news))
    fits = cut_lineage(median_fits(s, xcols, alphas))
    pred = predict(s.filter("split = 'test'"), fits.select(SERIES, "beta"), [SERIES], xcols)
    return pred, fits.withColumn("model_name", F.lit("QuantileRegression"))


# ---------------------------------------------------------------------------
# Tree models, random search over the grids
# ---------------------------------------------------------------------------
def grid_draws(grid: dict, draws: int, seed: int = SEARCH_SEED) -> list[dict]:
    """Random candidates without replacement from the full grid (keys in
    sorted order); deterministic for a seed.  Property parity with the
    reference's sampler, not the same draw sequence."""
    keys = sorted(grid)
    sizes = [len(grid[k]) for k in keys]
    total = int(np.prod(sizes))
    rng = np.random.RandomState(seed)
    picks = rng.choice(total, size=min(draws, total), replace=False)
    out = []
    for idx in picks:
        cand, rest = {}, int(idx)
        for k, s in zip(reversed(keys), reversed(sizes)):
            cand[k] = grid[k][rest % s]
            rest //= s
        out.append(cand)
    return out


def tree_search(s: DataFrame, kind: str, xcols: Sequence[str], draws: int | None = None,
                candidates: list[dict] | None = None) -> tuple[DataFrame, DataFrame]:
    """Random search with expanding-window CV (MAE) per series,
    refit of the best candidate on its train part.  Returns (predictions of all
    later rows, best parameters with their measured CV MAE)."""
    grid, n = (RF_GRID, RF_DRAWS) if kind == "rf" else (GBT_GRID, GBT_DRAWS)
    cands = candidates or grid_draws(grid, n if draws is None else draws)
    xcols = list(xcols)
    # a forest's jobs stand alone; boosting draws for all, so it takes a candidate's folds at once
    each = 1 if kind == "rf" else N_SPLITS
    jobs = len(cands) * N_SPLITS
    parts = s.where("split = 'train'").select(SERIES, "feature_date", *xcols, TARGET, F.explode(
        F.sequence(F.lit(0), F.lit(jobs // each - 1))).alias("part"))

    def errors(pdf: pd.DataFrame) -> pd.DataFrame:
        lo = int(pdf["part"].iloc[0]) * each
        return G.tree_errors(pdf, SERIES, xcols, TARGET, kind, cands, N_SPLITS, SEARCH_SEED,
                             list(range(lo, lo + each)))
    maes = cut_lineage(spread(parts, SERIES, "part", times=4).groupBy(SERIES, "part").applyInPandas(
        errors, f"{SERIES} string, job int, mae double")).groupBy(F.col(SERIES).alias("_s")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("job", "mae"))), lambda x: x["mae"])
        .alias("maes"))
    judged = s.join(maes, F.col(SERIES).eqNullSafe(F.col("_s")), "left").drop("_s")
    out = cut_lineage(per_series(
        judged, [*xcols, TARGET, "maes"],
        "feature_date date, prediction double, cv_mae double, params string",
        lambda pdf: G.tree_series(pdf, SERIES, xcols, TARGET, kind, cands, SEARCH_SEED)))
    pred = s.join(out.select(SERIES, "feature_date", "prediction"), [SERIES, "feature_date"])
    best = out.groupBy(SERIES).agg(F.first("params").alias("params"), F.first("cv_mae").alias("cv_mae"))
    return pred, best.withColumn(
        "model_name", F.lit("RandomForest" if kind == "rf" else "XGBoost"))


def ensemble(preds: dict[str, DataFrame], keys=(SERIES, "feature_date")) -> DataFrame:
    """K7: equal-weight mean of the models' predictions, joined on the row key."""
    out = None
    for name, p in preds.items():
        s = p.select(*keys, "target_date", TARGET, F.col("prediction").alias(f"pred_{name}"))
        out = s if out is None else out.join(s.drop("target_date", TARGET), list(keys))
    cols = [F.col(f"pred_{n}") for n in preds]
    total = cols[0]
    for c in cols[1:]:
        total = total + c
    return out.withColumn("prediction", total / F.lit(float(len(cols))))


MODELS = ["LinearRegression", "QuantileRegression", "RandomForest", "XGBoost"]


def fit_all(features: DataFrame, news: bool, rf_draws: int | None = None,
            gbt_draws: int | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """Predictions of the four models for all rows after train
    (with their ``split``) and the best parameters found per series."""
    xcols = PRICE_FEATURES + (NEWS_FEATURES if news else [])
    s = cut_lineage(prepared(features, xcols, news))
    later = s.filter("split <> 'train'")
    ols = fit_ols(s.filter("split = 'train'"), [SERIES], xcols)
    qr = cut_lineage(median_fits(s, xcols))
    rf, rf_best = tree_search(s, "rf", xcols, rf_draws)
    gb, gb_best = tree_search(s, "gbt", xcols, gbt_draws)
    preds = dict(zip(MODELS, (
        predict(later, ols, [SERIES], xcols),
        predict(later, qr.select(SERIES, "beta"), [SERIES], xcols), rf, gb)))
    best = qr.select(SERIES, F.lit(MODELS[1]).alias("model_name"), F.to_json(F.struct(
        "alpha", "converged")).alias("params"), "cv_mae")
    for b in (rf_best, gb_best):
        best = best.unionByName(b)
    return preds, best


def experiment_metrics(preds: dict[str, DataFrame]) -> DataFrame:
    """The four models and their ensemble on one feature set; long
    metrics table (series, model_name, n, mae, rmse)."""
    parts = [metrics(p, [SERIES]).withColumn("model_name", F.lit(n))
             for n, p in {**preds, "Ensemble": ensemble(preds)}.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def newest_forecast(preds: dict[str, DataFrame]) -> DataFrame:
    """Each series' newest complete row scored by the four models and
    their equal-weight mean."""
    rows = ensemble(preds)
    newest = rows.groupBy(SERIES).agg(F.max("feature_date").alias("feature_date"))
    return rows.join(newest, [SERIES, "feature_date"]).select(
        SERIES, "feature_date", "target_date", *[f"pred_{n}" for n in MODELS],
        F.col("prediction").alias("pred_Ensemble"))


def compare_experiments(a: DataFrame, b: DataFrame) -> DataFrame:
    """Price-only against price + news, per series and model."""
    k = [SERIES, "model_name"]
    return (a.select(*k, F.col("mae").alias("mae_a"), F.col("rmse").alias("rmse_a"))
            .join(b.select(*k, F.col("mae").alias("mae_b"), F.col("rmse").alias("rmse_b")), k)
            .withColumn("mae_change", F.col("mae_b") - F.col("mae_a")))


# ---------------------------------------------------------------------------
# Direction classifier and live forecast
# ---------------------------------------------------------------------------
def direction_label(col: Column) -> Column:
    """C17."""
    return F.when(col == 1, "UP").when(col == -1, "DOWN").otherwise("FLAT")


def direction_and_live(features: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Price model (median regression) + direction classifier, backtest
    on test and a live forecast from each series' latest complete row.

    Returns (backtest rows, metrics per series, live forecast per series).
    Series with fewer than ``MIN_LABELLED_ROWS`` labelled rows are left out;
    it is an error if none has enough, or none has a row to forecast from (C7).
    """
    xcols = PRICE_FEATURES + NEWS_FEATURES
    df = with_news_filled(coerce(features, xcols + TARGETS + ["close_price"]))
    labelled = complete_cases(df, xcols, TARGETS)
    enough = labelled.groupBy(SERIES).agg(F.count(F.lit(1)).alias("_n")).where(
        F.col("_n") >= MIN_LABELLED_ROWS).select(SERIES)
    s = cut_lineage(chronological_split(labelled.join(enough, SERIES, "left_semi")))
    if s.isEmpty():
        raise ValueError(f"no series has {MIN_LABELLED_ROWS} labelled rows or more")
    # newest complete row per series (G2), scored by both models
    live = live_candidates(df, xcols).join(enough, SERIES, "left_semi")
    live = live.groupBy(SERIES).agg(F.max_by(F.struct(*[c for c in live.columns if c != SERIES]),
                                             "feature_date").alias("r")).select(SERIES, "r.*")
    live = cut_lineage(live.withColumn("split", F.lit("live")))
    if live.isEmpty():
        raise ValueError("no series has a complete row to forecast from")
    label = "target_direction_next_day"
    both = s.select(SERIES, "feature_date", "split", *xcols, label).unionByName(
        live.select(SERIES, "feature_date", "split", *xcols, label))
    clf = dict(DIRECTION_FOREST)
    direction = cut_lineage(spread(both, SERIES).groupBy(SERIES).applyInPandas(
        lambda pdf: G.direction_rows(pdf, SERIES, xcols, label, **clf),
        f"{SERIES} string, feature_date date, split string, predicted_direction int, "
        "confidence double"))
    fits = cut_lineage(median_fits(s, xcols))
    keys = [SERIES, "feature_date"]
    test = predict(s.filter("split = 'test'"), fits.select(SERIES, "beta"), [SERIES], xcols,
                   "predicted_close")
    bt = test.join(direction.filter("split = 'test'").drop("split"), keys).select(
        *keys, "target_date", "close_price", TARGET, label, "predicted_close",
        "predicted_direction", F.col("confidence").alias("direction_confidence"),
        (F.try_divide(F.col("predicted_close"), F.col("close_price")) - 1)
        .alias("predicted_return_1d"))
    e = F.col("predicted_close") - F.col(TARGET)
    met = bt.groupBy(SERIES).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg((F.col("predicted_direction") == F.col(label)).cast("double"))
        .alias("directional_accuracy"))
    lv = predict(live, fits.select(SERIES, "beta"), [SERIES], xcols, "predicted_close").join(
        direction.filter("split = 'live'").select(
            *keys, "predicted_direction", F.col("confidence").alias("confidence_score")), keys)
    return bt, met, lv


def live_forecast(features: DataFrame) -> DataFrame:
    """K14 live part: price from the median model refit, direction with its
    confidence, the implied return (I18) and the forecast date (I17: next
    business day when the row has no next trading day)."""
    from ..operators.windows import next_business_day
    _, _, lv = direction_and_live(features)
    return lv.select(
        SERIES, "feature_date",
        F.coalesce("target_date", next_business_day(F.col("feature_date")))
        .alias("prediction_for_date"),
        "close_price", "predicted_close",
        (F.try_divide(F.col("predicted_close"), F.col("close_price")) - 1)
        .alias("predicted_return_1d"),
        "predicted_direction", direction_label(F.col("predicted_direction")).alias("direction"),
        "confidence_score")
