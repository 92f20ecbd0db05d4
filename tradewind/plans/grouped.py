"""Fits of one series: median regression and tree ensembles.

A series' history is bounded by the calendar (one row per trading day), so one
series is one group of ``applyInPandas`` and Spark spreads the series; any
number of series works.  A tree search also spreads its jobs (candidate and fold)
over groups, so that few series use all cores.  The trees of a job grow together,
level by level, on binned features.
"""

from __future__ import annotations

import json
import zlib

import numpy as np
import pandas as pd

BINS = 64
#: Cells (or rows) of the histograms that are filled together.
CELLS = 1 << 15


# ---------------------------------------------------------------------------
# Chronology
# ---------------------------------------------------------------------------
def fold_bounds(n: int, n_splits: int) -> list[tuple[int, int]]:
    """(train end = test start, test end) of the expanding-window folds."""
    size = n // (n_splits + 1)
    starts = [n - (n_splits - k) * size for k in range(n_splits)]
    return [(s, s + size) for s in starts if size]


def seed_of(series: str, seed: int) -> int:
    return zlib.crc32(f"{seed}:{series}".encode())


# ---------------------------------------------------------------------------
# Median regression
# ---------------------------------------------------------------------------
def median_l1(x: np.ndarray, y: np.ndarray, alpha: float, max_iter: int = 3000,
              tol: float = 1e-9) -> tuple[np.ndarray, float, bool, int]:
    """Minimises mean |y - b0 - x b| / 2 + alpha |b|_1, intercept free.

    Reweighted least squares on standardised columns; both absolute values are
    majorised by parabolas whose floor shrinks from pass to pass.  Returns
    (b0 and b, objective, converged, passes).
    """
    mu, sd = x.mean(0), x.std(0)
    sd = np.where(sd > 0, sd, 1.0)
    z = np.column_stack([np.ones(len(y)), (x - mu) / sd])
    penalty = np.append(0.0, alpha / sd)

    def objective(v):
        return np.abs(y - z @ v).mean() / 2 + (penalty * np.abs(v)).sum()
    v = np.linalg.lstsq(z, y, rcond=None)[0]
    scale = max(float(np.abs(y - z @ v).mean()), 1e-12)
    best, best_v, floor, still = objective(v), v, scale, 0
    for it in range(1, max_iter + 1):
        floor = max(floor * 0.8, scale * 1e-8)
        w = 1 / np.maximum(np.abs(y - z @ v), floor)
        a = (z * w[:, None]).T @ z / (2 * len(y))
        b = z.T @ (w * y) / (2 * len(y))
        a[np.diag_indices_from(a)] += penalty / np.maximum(np.abs(v), floor / scale * 1e-2)
        a[np.diag_indices_from(a)] += 1e-13 * np.trace(a)
        v = np.linalg.solve(a, b)
        now = objective(v)
        still = still + 1 if now > best * (1 - tol) else 0
        if now < best:
            best, best_v = now, v
        if still >= 10 and floor <= scale * 1e-8:
            break
    beta = best_v[1:] / sd
    return np.append(best_v[0] - mu @ beta, beta), float(best), still >= 10, it


def median_series(pdf: pd.DataFrame, series: str, xcols: list[str], y: str,
                  alphas: list[float], n_splits: int) -> pd.DataFrame:
    """K4/K16 for one series: alpha by cross-validated MAE, refit on train."""
    train = pdf[pdf["split"] == "train"].sort_values("feature_date")
    x, t = train[xcols].to_numpy(float), train[y].to_numpy(float)
    if not len(t):
        return pd.DataFrame()
    scores = []
    for alpha in alphas:
        maes = []
        for a, b in fold_bounds(len(t), n_splits):
            beta = median_l1(x[:a], t[:a], alpha)[0]
            maes.append(np.abs(t[a:b] - beta[0] - x[a:b] @ beta[1:]).mean())
        scores.append(float(np.mean(maes)) if maes else np.nan)
    k = int(np.nanargmin(scores)) if not np.isnan(scores).all() else 0
    beta, objective, converged, passes = median_l1(x, t, alphas[k])
    return pd.DataFrame([{series: pdf[series].iloc[0], "alpha": float(alphas[k]),
                          "cv_mae": scores[k], "beta": beta.tolist(), "objective": objective,
                          "converged": bool(converged), "iterations": int(passes)}])


# ---------------------------------------------------------------------------
# Trees
# ---------------------------------------------------------------------------
def binned(train: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Quantile bins of the train columns, applied to the rows."""
    out = np.empty(rows.shape, np.int64)
    for f in range(train.shape[1]):
        cuts = np.unique(np.quantile(train[:, f], np.arange(1, BINS) / BINS))
        out[:, f] = np.searchsorted(cuts, rows[:, f], side="left")
    return out


def leaf_means(bins: np.ndarray, tree: np.ndarray, y: np.ndarray, w: np.ndarray,
               depth: np.ndarray, min_leaf: np.ndarray, min_split: np.ndarray,
               allowed: np.ndarray, ridge: float = 0.0) -> np.ndarray:
    """Grows one tree per id in ``tree`` (all together) and returns the value of
    every row's leaf.

    ``y`` has one column per output, ``w`` counts a row (0: only scored);
    ``depth``, ``min_leaf``, ``min_split``, ``allowed`` (features) are per tree.
    """
    value = np.zeros(y.shape)
    rows, node = np.arange(len(tree)), tree.copy()
    owner, level, counted = np.arange(len(depth)), 0, w > 0
    columns = np.ascontiguousarray(bins.T)
    while len(rows):
        m = len(owner)
        count = np.bincount(node, w[rows], m)
        sums = np.stack([np.bincount(node, w[rows] * c[rows], m) for c in y.T], 1)
        mean = sums / np.maximum(count + ridge, 1e-12)[:, None]
        best, feature, cut = np.full(m, 1e-9), np.zeros(m, np.int64), np.zeros(m, np.int64)
        grow = (level < depth[owner]) & (count >= np.maximum(min_split[owner], 2 * min_leaf[owner]))
        here = grow[node] & counted[rows]       # rows without weight change no sum
        sub, sub_node = rows[here], (np.cumsum(grow) - 1)[node[here]]
        g = np.flatnonzero(grow)
        if len(g):
            whole = (sums[g] ** 2).sum(1) / (count[g] + ridge)
            sub_w = w[sub]
            sub_wy = [sub_w * c[sub] for c in y.T]
            base, least = sub_node * BINS, min_leaf[owner[g]]
            size = len(g) * BINS
            step = max(1, CELLS // max(size, len(sub)))
            for lo in range(0, bins.shape[1], step):
                # the histograms of some features, one behind the other
                here = columns[lo:lo + step]
                k = len(here)
                key = (here[:, sub] + base + size * np.arange(k)[:, None]).ravel()
                # cuts behind empty bins part the rows as the cut before them does
                each = lambda v: v if k == 1 else np.tile(v, k)  # noqa: B023, E731
                hist = np.bincount(key, each(sub_w), k * size)
                cell = np.flatnonzero(hist)
                at = cell // BINS                   # feature and node
                of, at_node = (lo, at) if k == 1 else (lo + at // len(g), at % len(g))
                hw = hist.reshape(-1, BINS).cumsum(1).ravel()[cell]
                rest = count[g][at_node] - hw
                gain = -whole[at_node]
                for c in range(y.shape[1]):
                    hs = np.bincount(key, each(sub_wy[c]), k * size).reshape(
                        -1, BINS).cumsum(1).ravel()[cell]
                    gain = gain + hs ** 2 / np.maximum(hw + ridge, 1e-12) + (
                        sums[g, c][at_node] - hs) ** 2 / np.maximum(rest + ridge, 1e-12)
                limit = least[at_node]
                gain[(hw < limit) | (rest < limit) | ~allowed[owner[g][at_node], of]] = -1
                # the first of the best cells of every feature and node
                starts = np.flatnonzero(np.diff(at, prepend=-1))
                top = np.maximum.reduceat(gain, starts) if len(cell) else gain
                first = np.flatnonzero(gain == np.repeat(top, np.diff(starts, append=len(cell))))
                first = first[np.diff(at[first], prepend=-1) > 0]
                # of a node's features the first of the best; without a number none is
                held = ~np.isnan(top)
                tops, cuts = np.full(k * len(g), -1.0), np.zeros(k * len(g), np.int64)
                tops[at[starts[held]]], cuts[at[first]] = top[held], cell[first] % BINS
                tops, cuts = tops.reshape(k, -1), cuts.reshape(k, -1)
                f, all_g = tops.argmax(0), np.arange(len(g))
                now = np.flatnonzero(tops[f, all_g] > best[g])
                best[g[now]], feature[g[now]], cut[g[now]] = (
                    tops[f, all_g][now], lo + f[now], cuts[f, all_g][now])
        split = grow & (best > 1e-9)
        done = ~split[node]
        value[rows[done]] = mean[node[done]]
        rows, node = rows[~done], node[~done]
        number = np.cumsum(split) - 1
        right = bins[rows, feature[node]] > cut[node]
        owner = np.repeat(owner[split], 2)
        node = number[node] * 2 + right
        level += 1
    return value


def forest(x: np.ndarray, y: np.ndarray, score: np.ndarray, trees: int, depth: int | None,
           min_leaf: int, min_split: int, seed: int, weight: np.ndarray | None = None,
           at_once: int = 25) -> np.ndarray:
    """Mean prediction of a bootstrap forest for the rows of ``score``."""
    rng = np.random.default_rng(seed)
    n, s = len(x), len(score)
    both = binned(x, np.vstack([x, score]))
    out = np.zeros((s, y.shape[1]))
    for lo in range(0, trees, at_once):
        k = min(at_once, trees - lo)
        w = rng.multinomial(n, np.full(n, 1 / n), k).astype(float)
        if weight is not None:
            w *= weight
        w = np.hstack([w, np.zeros((k, s))])
        value = leaf_means(
            np.tile(both, (k, 1)), np.repeat(np.arange(k), n + s),
            np.tile(np.vstack([y, np.zeros((s, y.shape[1]))]), (k, 1)), w.ravel(),
            np.full(k, depth or n), np.full(k, min_leaf), np.full(k, min_split),
            np.ones((k, x.shape[1]), bool))
        out += value.reshape(k, n + s, -1)[:, n:].sum(0)
    return out / trees


def _own_draws(rng: np.random.Generator, spans: list[tuple[int, int]], total: int) -> np.ndarray:
    """Those of the next ``total`` random numbers that lie in the (ascending) spans."""
    out, at = [], 0
    for lo, hi in spans:
        rng.bit_generator.advance(int(lo - at))
        out.append(rng.random(int(hi - lo)))
        at = hi
    rng.bit_generator.advance(int(total - at))
    return np.concatenate(out)


def boosted(problems: list[tuple[np.ndarray, np.ndarray, np.ndarray, dict]], seed: int,
            only: list[int] | None = None) -> list[np.ndarray]:
    """Predictions of squared-error boosting for the score rows of every
    (x, y, score, parameters); all problems advance one tree per round.

    ``only`` names the problems to fit: they get the random numbers that they have
    among all problems, so each has the same result wherever it is fitted."""
    rng = np.random.default_rng(seed)
    mine = np.arange(len(problems)) if only is None else np.asarray(only)
    par = {k: np.array([p[3][k] for p in problems]) for k in (
        "n_estimators", "max_depth", "learning_rate", "subsample", "colsample_bytree")}
    rows = np.array([len(x) + len(score) for x, _, score, _ in problems])
    f = problems[0][0].shape[1]
    bins, target, train, tree = [], [], [], []
    for i in mine:
        x, y, score, _ = problems[i]
        bins.append(binned(x, np.vstack([x, score])))
        target.append(np.append(y - y.mean(), np.zeros(len(score))))
        train.append(np.append(np.ones(len(x)), np.zeros(len(score))))
        tree.append(np.full(rows[i], i))
    bins, target, train, tree = map(np.concatenate, (bins, target, train, tree))
    fit = np.zeros(len(tree))
    for r in range(int(par["n_estimators"][mine].max())):
        live = par["n_estimators"] > r
        ends = np.cumsum(np.where(live, rows, 0))
        place = np.cumsum(live)                   # among all live problems
        now = mine[live[mine]]
        drawn = _own_draws(rng, [(ends[i] - rows[i], ends[i]) for i in now], ends[-1])
        picked = _own_draws(rng, [(f * (place[i] - 1), f * place[i]) for i in now],
                            f * place[-1]).reshape(-1, f)
        number = np.zeros(len(problems), np.int64)
        number[now] = np.arange(len(now))
        on = live[tree]
        w = train[on] * (drawn < par["subsample"][tree[on]])
        keep = np.maximum(1, np.round(par["colsample_bytree"][now] * f)).astype(int)
        allowed = picked.argsort(1).argsort(1) < keep[:, None]
        value = leaf_means(
            bins[on], number[tree[on]], (target[on] - fit[on])[:, None], w,
            par["max_depth"][now], np.ones(len(keep)), np.full(len(keep), 2), allowed, ridge=1.0)
        fit[on] += par["learning_rate"][tree[on]] * value[:, 0]
    return [fit[tree == i][len(problems[i][0]):] + problems[i][1].mean() for i in mine]


def _forest_of(x, y, score, c: dict, seed: int) -> np.ndarray:
    return forest(x, y[:, None], score, c["n_estimators"], c["max_depth"],
                  c["min_samples_leaf"], c["min_samples_split"], seed)[:, 0]


def tree_errors(pdf: pd.DataFrame, series: str, xcols: list[str], y: str, kind: str,
                candidates: list[dict], n_splits: int, seed: int, jobs: list[int]) -> pd.DataFrame:
    """MAE of some of one series' search jobs: job ``i`` is candidate ``i // n_splits``
    on fold ``i % n_splits`` of the train rows."""
    train = pdf.sort_values("feature_date")
    x, t = train[xcols].to_numpy(float), train[y].to_numpy(float)
    folds = fold_bounds(len(t), n_splits)
    if not folds:
        return pd.DataFrame()
    seed = seed_of(str(pdf[series].iloc[0]), seed)
    every = [(x[:a], t[:a], x[a:b], c) for c in candidates for a, b in folds]
    preds = boosted(every, seed, jobs) if kind == "gbt" else [
        _forest_of(*every[i], seed) for i in jobs]
    actual = [t[a:b] for a, b in folds]
    return pd.DataFrame({series: pdf[series].iloc[0], "job": jobs, "mae": [
        np.abs(p - actual[i % n_splits]).mean() for i, p in zip(jobs, preds)]})


def tree_series(pdf: pd.DataFrame, series: str, xcols: list[str], y: str, kind: str,
                candidates: list[dict], seed: int) -> pd.DataFrame:
    """K5/K6 for one series: the best candidate by mean MAE over the folds (``maes``,
    by job; null without folds) refitted on train, predictions of all rows after it."""
    pdf = pdf.sort_values("feature_date")
    is_train = (pdf["split"] == "train").to_numpy()
    x, t = pdf[xcols].to_numpy(float), pdf[y].to_numpy(float)
    xt, yt = x[is_train], t[is_train]
    if not len(yt):
        return pd.DataFrame()
    seed = seed_of(str(pdf[series].iloc[0]), seed)
    maes = pdf["maes"].iloc[0]
    scores = np.full(len(candidates), np.nan) if maes is None else \
        np.array(maes, float).reshape(len(candidates), -1).mean(1)
    k = 0 if maes is None else int(np.nanargmin(scores))
    rest = x[~is_train]
    if len(rest):
        last = boosted([(xt, yt, rest, candidates[k])], seed)[0] if kind == "gbt" else \
            _forest_of(xt, yt, rest, candidates[k], seed)
    else:
        last = np.empty(0)
    return pd.DataFrame({
        series: pdf[series].iloc[0], "feature_date": pdf["feature_date"].to_numpy()[~is_train],
        "prediction": last, "cv_mae": float(scores[k]),
        "params": json.dumps(candidates[k], sort_keys=True)})


def direction_rows(pdf: pd.DataFrame, series: str, xcols: list[str], label: str,
                   trees: int, depth: int, min_leaf: int, seed: int) -> pd.DataFrame:
    """K12/K13 for one series: balanced forest over the classes seen in train,
    predicted class and its probability for all other rows."""
    pdf = pdf.sort_values(["feature_date", "split"])
    is_train = (pdf["split"] == "train").to_numpy()
    x, t = pdf[xcols].to_numpy(float), pdf[label].to_numpy(float)
    if not is_train.any() or is_train.all():
        return pd.DataFrame()
    classes, code = np.unique(t[is_train], return_inverse=True)
    count = np.bincount(code)
    balance = len(code) / (len(classes) * count[code])
    p = forest(x[is_train], np.eye(len(classes))[code], x[~is_train], trees, depth, min_leaf, 2,
               seed_of(str(pdf[series].iloc[0]), seed), weight=balance)
    best = p.argmax(1)
    rest = pdf[~is_train]
    return pd.DataFrame({
        series: rest[series].to_numpy(), "feature_date": rest["feature_date"].to_numpy(),
        "split": rest["split"].to_numpy(), "predicted_direction": classes[best].astype("int32"),
        "confidence": p[np.arange(len(p)), best] / np.maximum(p.sum(1), 1e-12)})
