"""Dashboard queries (M1-M10) and top-k reports.

Each panel is a projection of an existing table; ``write_report`` writes a result
in its order.  Top-k per series is a ``row_number`` window per key (the limit
is the feature), never a global sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .monitor import latest_runs


def price_trend(prices: DataFrame, start: str, end: str) -> DataFrame:
    """M1: prices in a date range (pushed into the scan as a date filter)."""
    return (prices.filter(F.col("price_date").between(F.lit(start).cast("date"),
                                                      F.lit(end).cast("date")))
            .select("benchmark_code", "price_date", "open_price", "high_price", "low_price",
                    "close_price", "volume"))


def daily_counts(daily: DataFrame) -> DataFrame:
    """M2."""
    return daily.select("feature_date", "article_count", "distinct_source_count")


def sentiment(daily: DataFrame, mode: str = "weighted") -> DataFrame:
    """M3: plain or relevance-weighted daily sentiment."""
    col = "weighted_avg_sentiment" if mode == "weighted" else "avg_sentiment"
    return daily.select("feature_date", F.lit(mode).alias("mode"), F.col(col).alias("sentiment"))


def label_counts(daily: DataFrame) -> DataFrame:
    """M4."""
    return daily.select("feature_date", "positive_article_count", "neutral_article_count",
                        "negative_article_count")


def pred_vs_actual(runs: DataFrame, predictions: DataFrame) -> DataFrame:
    """M5: latest run per model, its predictions against the actual close."""
    lr = latest_runs(runs).select("model_run_id", "model_name")
    return (predictions.join(lr, "model_run_id")
            .select("benchmark_code", "model_name", "prediction_for_date", "predicted_close",
                    "actual_close"))


def prediction_error(runs: DataFrame, predictions: DataFrame) -> DataFrame:
    """M6: M5 plus absolute and relative error."""
    p = pred_vs_actual(runs, predictions)
    err = F.abs(F.col("predicted_close") - F.col("actual_close"))
    return p.select("*", err.alias("abs_error"),
                    F.try_divide(err, F.col("actual_close")).alias("pct_error"))


def model_comparison(runs: DataFrame, predictions: DataFrame) -> DataFrame:
    """MAE and RMSE of each model's latest run, exact sums of
    4-place errors (decimal(38,0) squares cannot overflow)."""
    lr = latest_runs(runs).select("model_run_id", "model_name", "benchmark_code")
    e = (F.round(F.col("predicted_close") * 10000).cast("long")
         - F.round(F.col("actual_close") * 10000).cast("long")).cast("decimal(38,0)")
    agg = (predictions.filter(F.col("actual_close").isNotNull())
           .join(lr.drop("benchmark_code"), "model_run_id")
           .groupBy("benchmark_code", "model_name", "model_run_id")
           .agg(F.count(F.lit(1)).alias("n"), F.sum(F.abs(e)).alias("_sa"),
                F.sum(e * e).alias("_ss")))
    return agg.select(
        "benchmark_code", "model_name", "model_run_id", "n",
        (F.col("_sa").cast("double") / (F.col("n").cast("double") * F.lit(10000.0))).alias("mae"),
        (F.sqrt(F.col("_ss").cast("double") / F.col("n").cast("double")) / F.lit(10000.0))
        .alias("rmse"))


def monitoring_panel(logs: DataFrame) -> DataFrame:
    """M8: newest log per component (any log type)."""
    best = F.max_by(F.struct("log_type", "severity", "message"), F.col("monitoring_id"))
    return logs.groupBy("component_name").agg(best.alias("_l")).select("component_name", "_l.*")


def by_source(scored: DataFrame) -> DataFrame:
    """M9: the daily aggregate re-keyed by source (re-aggregated from items,
    since the daily table has no source column)."""
    from ..numerics import ratio_half_up
    from ..operators.aggregates import eligible_articles
    agg = (eligible_articles(scored)
           .groupBy(F.col("published_date").alias("feature_date"), "source_id")
           .agg(F.count(F.lit(1)).alias("article_count"), F.sum("sentiment_e4").alias("_s")))
    return agg.select("feature_date", "source_id", "article_count",
                      ratio_half_up("_s", "article_count").alias("avg_sentiment"))


def health(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table, one aggregate per table, unioned."""
    out = None
    for name, df in tables.items():
        c = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"),
                                                                "row_count")
        out = c if out is None else out.unionByName(c)
    return out


def latest_rows(df: DataFrame, key: str, order: str, k: int) -> DataFrame:
    """The newest ``k`` rows per key (the limit is the report), ties by the
    other columns."""
    w = Window.partitionBy(key).orderBy(F.col(order).desc(), *[
        c for c in df.columns if c not in (key, order)])
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k).drop("_rn")


#: The order in which the reference returns a result.
REPORT_ORDER = {
    "daily_news_features": ["feature_date"],
    "daily_topic_features": ["feature_date", "topic_id"],
    "predictions": ["model_name", "prediction_for_date"],
    "latest_flags": ["component_name"],
}


def write_report(df: DataFrame, path: str, order: Sequence[str], rows_per_file: int = 1_000_000) -> None:
    """Writes a result whose order is that of its files and of the rows in them: rows
    are dealt by ranges of the order and sorted inside, so no task holds all of them."""
    files = max(1, -(-df.count() // rows_per_file))
    df.repartitionByRange(files, *order).sortWithinPartitions(*order).write.parquet(path)
