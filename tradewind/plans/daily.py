"""The daily run (L7): every stage as a DataFrame job on the tables the previous
stages wrote, in the reference's stage order.  Returns one row per stage.

Tables live under ``root`` (shared storage):

* articles, queue entries, processed rows, model runs, predictions, logs and
  actions are appended, one folder per run (``operators/tables.py``); a retried run
  replaces its own folders and no run touches those of another;
* prices and features are stored by month, and only months with changed rows are
  rewritten;
* the daily aggregates are refreshed as a whole (that is their contract), as a new
  numbered version.

The queue is a view: an article waits until a run has processed it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import bindings as B
from ..io import table
from ..numerics import rnd
from ..operators import aggregates as AG
from ..operators import tables as TB
from ..operators.dedup import first_wins_two_keys
from ..operators.sinks import pending_rows, stamped
from ..operators.topics import topic_rows
from ..operators.windows import next_business_day
from ..session import child_names, cut_lineage, path_exists, scratch_path
from ..sources.dimensions import Lexicon, Taxonomy
from ..sources.feeds import accepted, judged
from ..sources.prices import validate_price_history
from . import articles as AR
from . import features as FE
from . import models as MD
from . import monitor as MO

LIVE_MODEL = "NextDayForecast"
#: Row ids that may be broadcast (16 MB).
BROADCAST_IDS = 1_000_000
#: Run that holds what the registry had before the first run in this folder.
IMPORTED = "0000"
RUN_COLUMNS = ["model_run_id", "benchmark_code", "model_name", "model_version", "run_status",
               "test_start_date", "test_end_date", "mae", "rmse", "finished_at"]
PREDICTION_COLUMNS = ["prediction_id", "model_run_id", "benchmark_code", "feature_date",
                      "prediction_for_date", "predicted_close", "actual_close", "is_backtest"]
LOG_COLUMNS = ["monitoring_id", "log_type", "severity", "component_name", "message",
               "metric_name", "metric_value", "details"]

#: (predictions of a model's rows by model name, parameters) of an experiment.
Trained = tuple[dict[str, DataFrame], DataFrame]


# ---- versions of refreshed tables -------------------------------------------
def newest_version(spark: SparkSession, path: str) -> int:
    """Number of the newest complete version of a table, 0 if there is none."""
    done = [int(n[2:]) for n in child_names(spark, path) if n.startswith("v=")
            and path_exists(spark, f"{path}/{n}/_SUCCESS")]
    return max(done, default=0)


def current(spark: SparkSession, path: str) -> DataFrame | None:
    n = newest_version(spark, path)
    return spark.read.parquet(f"{path}/v={n}") if n else None


def commit(df: DataFrame, path: str) -> DataFrame:
    spark = df.sparkSession
    n = newest_version(spark, path) + 1
    df.write.mode("overwrite").parquet(f"{path}/v={n}")
    return spark.read.parquet(f"{path}/v={n}")


def _by_month(path: str, updates: DataFrame, day: str, keys: list[str]) -> DataFrame:
    month = (F.year(day) * 100 + F.month(day)).alias("month")
    return TB.upsert_partitioned(path, updates.select("*", month), keys, "month",
                                 only_changed=True).drop("month")


def _stamp(as_of: str) -> Column:
    """Second of the run above 32 free bits: ids of later runs are larger."""
    return F.shiftleft(F.unix_timestamp(F.lit(as_of).cast("timestamp")), 32)


def numbered(rows: DataFrame, as_of: str, id_col: str, *names: str) -> DataFrame:
    """Adds an id per row, from the run's time and a hash of the names, that are
    unique in ``rows``; hashes of another seed if two names share one."""
    for seed in range(8):
        out = rows.withColumn(id_col, _stamp(as_of) + F.xxhash64(*names, F.lit(seed)).bitwiseAND(
            F.lit(0xFFFFFFFF)))
        if out.groupBy(id_col).count().where("count > 1").isEmpty():
            return out
    raise ValueError(f"{names} do not tell the rows apart")


# ---- articles ---------------------------------------------------------------
def rows_of(rows: DataFrame, ids: DataFrame, key: str, aside: str) -> DataFrame:
    """The rows whose (unique) key is in ``ids``.  They are met by the smaller of the
    keys in it and of those not in it, which is broadcast if it is short: wide rows are
    then filtered where they lie."""
    n, kept = rows.count(), ids.count()
    how = "left_semi"
    if kept > n - kept:
        rows.select(key).join(ids, key, "left_anti").write.parquet(aside)
        ids, how = rows.sparkSession.read.parquet(aside), "left_anti"
    return rows.join(F.broadcast(ids) if min(kept, n - kept) <= BROADCAST_IDS else ids, key, how)


def insert_articles(spark: SparkSession, root: str, run: str, items: DataFrame) -> DataFrame:
    """B1/B2: the offered items that are not rejected and that neither key has seen, first
    wins; each gets its url key as id and a pending entry in the processing queue."""
    path = f"{root}/articles_raw"
    # parsed once (the reject reason too); the rules see keys, the texts stay where they lie
    aside = scratch_path(spark, f"items-{uuid.uuid4().hex}")
    items.withColumn("_row", F.monotonically_increasing_id()).write.parquet(f"{aside}/items")
    items = accepted(spark.read.parquet(f"{aside}/items"))
    keyed = items.select("_row", "url_hash", F.when(
        F.col("external_guid").isNotNull(),
        F.concat_ws("\u0001", "source_id", "external_guid")).alias("_gk"),
        F.struct("source_id", "feed_file", "position").alias("_ord"))
    held = TB.read_runs(spark, path, other_than=run)
    if held is not None:
        seen = held.select(F.concat_ws("\u0001", "source_id", "external_guid").alias("_gk")) \
            .where("external_guid is not null")
        keyed = keyed.join(held.select("url_hash"), "url_hash", "left_anti").join(
            seen, "_gk", "left_anti")
    first_wins_two_keys(keyed, "_ord", "url_hash", "_gk").select("_row").write.parquet(f"{aside}/won")
    new = rows_of(items, spark.read.parquet(f"{aside}/won"), "_row", f"{aside}/lost").drop(
        "_row").withColumn("article_id", F.col("url_hash"))
    raw = TB.append_run(stamped(new, "created_at"), path, run)
    mine = spark.read.parquet(f"{path}/run={TB.run_name(run)}")
    TB.append_run(pending_rows(mine), f"{root}/processing_queue", run)
    return raw


def queue(spark: SparkSession, root: str, other_than: str | None = None) -> DataFrame:
    """Status and notes of every queued article (``other_than``: before that run
    processed any)."""
    entries = TB.read_runs(spark, f"{root}/processing_queue").select("article_id")
    done = TB.read_runs(spark, f"{root}/articles_processed", other_than)
    if done is None:
        return entries.withColumn("processing_status", F.lit("pending")).withColumn(
            "notes", F.lit(None).cast("string"))
    return entries.join(done.select("article_id", "processing_status"), "article_id", "left").select(
        "article_id", F.coalesce("processing_status", F.lit("pending")).alias("processing_status"),
        F.when(F.col("processing_status") == "failed", F.lit(AR.FAILED_NOTE)).alias("notes"))


def process_pending(spark: SparkSession, root: str, run: str, raw: DataFrame, taxonomy: Taxonomy,
                    lexicon: Lexicon) -> DataFrame:
    """Scores the pending articles and appends their rows, which moves
    their queue entries to processed or failed."""
    todo = AR.pending(raw, queue(spark, root, other_than=run))
    scored = AR.score_articles(todo, taxonomy, lexicon)
    return TB.append_run(AR.persisted_scores(scored, taxonomy), f"{root}/articles_processed", run)


# ---- registry ---------------------------------------------------------------
def _register(root: str, run: str, runs: DataFrame, predictions: DataFrame) -> None:
    TB.append_run(runs.select(
        *[F.col(c) if c in runs.columns else F.lit(None).cast(
            "date" if c.endswith("date") else "double" if c in ("mae", "rmse") else "string").alias(c)
          for c in RUN_COLUMNS]), f"{root}/model_runs", run)
    TB.append_run(predictions.select(PREDICTION_COLUMNS), f"{root}/predictions", run)


def registry(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    return (TB.read_runs(spark, f"{root}/model_runs").select(RUN_COLUMNS),
            TB.read_runs(spark, f"{root}/predictions").select(PREDICTION_COLUMNS))


def _prediction_rows(rows: DataFrame, runs: DataFrame, as_of: str) -> DataFrame:
    """Rows of (series, model_name, feature_date, prediction_for_date, predicted_close,
    actual_close, is_backtest) under their run's id."""
    return rows.join(runs.select("model_run_id", "benchmark_code", "model_name"),
                     ["benchmark_code", "model_name"]).select(
        F.xxhash64("model_run_id", "feature_date", "is_backtest").alias("prediction_id"),
        "model_run_id", "benchmark_code", "feature_date", "prediction_for_date",
        rnd(F.col("predicted_close"), 4).alias("predicted_close"), "actual_close", "is_backtest")


def _finished(runs: DataFrame, as_of: str) -> DataFrame:
    return numbered(runs, as_of, "model_run_id", "benchmark_code", "model_name").withColumns({
        "model_version": F.lit(as_of), "run_status": F.lit("completed"),
        "finished_at": F.lit(as_of).cast("timestamp")})


def register_forecasts(spark: SparkSession, root: str, feats: DataFrame, as_of: str) -> None:
    """Fits the next-day models, registers one run per series, its
    backtest predictions, and the live row (flag false, no actual yet)."""
    bt, met, live = MD.direction_and_live(feats)
    bounds = bt.groupBy("benchmark_code").agg(F.min("feature_date").alias("test_start_date"),
                                              F.max("feature_date").alias("test_end_date"))
    runs = _finished(met.join(bounds, "benchmark_code").withColumn(
        "model_name", F.lit(LIVE_MODEL)), as_of)
    shape = lambda df, target, actual, flag: df.select(
        "benchmark_code", F.lit(LIVE_MODEL).alias("model_name"), "feature_date",
        target.alias("prediction_for_date"), "predicted_close", actual.alias("actual_close"),
        F.lit(flag).alias("is_backtest"))
    rows = shape(bt, F.col("target_date"), F.col(MD.TARGET), True).unionByName(shape(
        live, F.coalesce("target_date", next_business_day(F.col("feature_date"))),
        F.lit(None).cast("double"), False))
    _register(root, f"{as_of}.forecast", runs, _prediction_rows(rows, runs, as_of))


def register_experiment(root: str, prefix: str, trained: Trained, as_of: str) -> None:
    """B9/B10 of a retrained group: a run per series, model and the models' mean, with
    its errors on the test part, the test predictions, and the chosen parameters."""
    preds, parameters = trained
    test = {n: p.filter("split = 'test'") for n, p in preds.items()}
    if len(test) > 1:
        test["Ensemble"] = MD.ensemble(test)
    rows = None
    for name, p in test.items():
        part = p.select("benchmark_code", F.lit(prefix + name).alias("model_name"), "feature_date",
                        F.col("target_date").alias("prediction_for_date"),
                        F.col("prediction").alias("predicted_close"),
                        F.col(MD.TARGET).alias("actual_close"), F.lit(True).alias("is_backtest"))
        rows = part if rows is None else rows.unionByName(part)
    rows = cut_lineage(rows)
    keys = ["benchmark_code", "model_name"]
    runs = _finished(MD.metrics(rows, keys, "actual_close", "predicted_close").join(
        rows.groupBy(*keys).agg(F.min("feature_date").alias("test_start_date"),
                                F.max("feature_date").alias("test_end_date")), keys), as_of)
    run = f"{as_of}.{prefix.rstrip('_')}"
    _register(root, run, runs, _prediction_rows(rows, runs, as_of))
    TB.append_run(parameters, f"{root}/parameters", run)


# ---- retraining (L6) --------------------------------------------------------
def retrain(spark: SparkSession, root: str, feats: DataFrame, as_of: str,
            train: Callable[[DataFrame, bool], Trained]) -> DataFrame:
    """Decides per model group, trains and registers the groups due, and logs every
    step; returns the actions of all runs."""
    logs = TB.read_runs(spark, f"{root}/monitoring_logs").select(LOG_COLUMNS)
    # runs of this very time were made by an earlier try of this run
    before = registry(spark, root)[0].where(F.col("model_version") != as_of)
    now = MO.retrain_actions(MO.latest_flags(logs), before, F.lit(as_of).cast("timestamp"))
    path = f"{root}/retrain_actions"
    actions = TB.append_run(now, path, as_of)
    # one row per model group: two
    due = spark.read.parquet(f"{path}/run={TB.run_name(as_of)}").orderBy("group_prefix").collect()
    steps = [("info", "Retraining decided.", {r.group_prefix: r.action for r in due})]
    for r in due:
        group = {"group": r.group_prefix.rstrip("_")}
        if r.action == "retrain":
            steps.append(("warning", "Retraining started: its models drifted.", group))
            register_experiment(root, r.group_prefix, train(
                feats, r.group_prefix == MO.GROUP_PREFIXES[1]), as_of)
            steps.append(("info", "Retraining finished.", group))
        elif r.action == "cooldown":
            steps.append(("info", "Retraining skipped: cooldown.", {
                **group, "cooldown_hours": MO.COOLDOWN_HOURS}))
    TB.append_run(numbered(MO.pipeline_logs(spark, steps), as_of, "monitoring_id", "step", "details").select(LOG_COLUMNS),
                  f"{root}/monitoring_logs", f"{as_of}.pipeline")
    return actions


def run_daily(spark: SparkSession, sf_dir: str, root: str, landing: str,
              taxonomy: Taxonomy, lexicon: Lexicon, as_of: str,
              imported: tuple[DataFrame, DataFrame] | None = None,
              train: Callable[[DataFrame, bool], Trained] = MD.fit_all) -> DataFrame:
    """One run as of a time, which names it: a run of the same time is a retry.

    ``imported`` are model runs and predictions that an earlier registry held;
    ``train(features, news)`` fits a group that the monitoring sends to retraining."""
    out = []
    # 1 prices: upsert the day's price history (B3), grouped once from the orders
    prices = _by_month(f"{root}/prices", validate_price_history(cut_lineage(B.price_series(table(
        spark, sf_dir, "orders")))), "price_date", ["benchmark_code", "price_date"])
    out.append(("prices", prices.count()))
    # 2 articles: landed feeds, two-key first-wins insertion, queue (A1-A4, B1, B2)
    sources = B.source_registry(table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages"))
    raw = insert_articles(spark, root, as_of, judged(spark, sources, landing))
    out.append(("articles_raw", raw.count()))
    # 3 scoring of what was ingested and still waits
    scored = process_pending(spark, root, as_of, raw, taxonomy, lexicon)
    out.append(("articles_processed", scored.count()))
    # 4 daily aggregates: full refresh
    daily = commit(AG.daily_news(scored), f"{root}/daily_news_features")
    topics = commit(AG.daily_topics(scored, topic_rows(scored.filter("_ok"), taxonomy)),
                    f"{root}/daily_topic_features")
    out.append(("daily_news_features", daily.count()))
    out.append(("daily_topic_features", topics.count()))
    # 5 features: upsert
    feats = _by_month(f"{root}/model_features", FE.model_features(prices, daily), "feature_date",
                      ["benchmark_code", "feature_date"])
    out.append(("model_features", feats.count()))
    # 6 forecasts: today's models beside the earlier runs of the registry
    if imported is not None and not TB.runs(spark, f"{root}/model_runs"):
        _register(root, IMPORTED, *imported)
    register_forecasts(spark, root, feats, as_of)
    # 7 drift check: decisions appended to the monitoring log
    runs, preds = registry(spark, root)
    # what an earlier try of this run retrained comes after its drift check
    runs = runs.where((F.col("model_version") != as_of) | (F.col("model_name") == LIVE_MODEL))
    logs = numbered(MO.drift_logs(MO.drift_decisions(runs, preds)).drop("monitoring_id"), as_of,
                    "monitoring_id", "component_name").select(LOG_COLUMNS)
    TB.append_run(logs, f"{root}/monitoring_logs", f"{as_of}.drift")
    # 8 retraining: decided per group, trained, registered, logged
    actions = retrain(spark, root, feats, as_of, train)
    runs, preds = registry(spark, root)
    out.append(("model_runs", runs.count()))
    out.append(("predictions", preds.count()))
    out.append(("monitoring_logs", TB.read_runs(spark, f"{root}/monitoring_logs").count()))
    out.append(("retrain_actions", actions.count()))
    return spark.createDataFrame([(i + 1, s, int(n)) for i, (s, n) in enumerate(out)],
                                 "stage int, table_name string, rows long")
