"""Per-series window features: lags, leads, rolling statistics.

Every window is ``PARTITION BY series ORDER BY date`` over rows (trading
days), so the whole block needs one exchange on the series key and one sort;
dependent windows reuse that partitioning.  Parallelism comes from the number
of series; each series is one date-ordered run of rows (one row per trading
day, so its size is bounded by the calendar, not by the raw data volume).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def series_window(series: str, order: str) -> Window:
    return Window.partitionBy(series).orderBy(order)


def trailing(series: str, order: str, rows: int) -> Window:
    """Frame of ``rows`` rows ending at the current one (partial at the start)."""
    return series_window(series, order).rowsBetween(-(rows - 1), Window.currentRow)


def next_business_day(d: Column) -> Column:
    """Weekend-only business calendar: Fri -> Mon (+3), Sat -> Mon (+2), else +1."""
    dow = F.dayofweek(d)  # 1 = Sunday ... 6 = Friday, 7 = Saturday
    return F.date_add(d, F.when(dow == 6, 3).when(dow == 7, 2).otherwise(1))


def guarded_return(num: Column, den: Column) -> Column:
    """num / den - 1, null when den is null or zero (no ANSI divide error)."""
    return F.when(den.isNull() | (den == 0), F.lit(None).cast("double")).otherwise(
        F.try_divide(num, den) - F.lit(1.0))


def price_window_block(prices: DataFrame, series: str = "benchmark_code",
                       date: str = "price_date", close: str = "close_price") -> DataFrame:
    """F1-F9 unrounded: one row per (series, date) with lag/lead/rolling columns."""
    w = series_window(series, date)
    lag1 = F.lag(close, 1).over(w)
    stage1 = prices.select(
        F.col(series).alias("benchmark_code"),
        F.col(date).alias("feature_date"),
        F.col(close).cast("double").alias("close_price"),
        lag1.alias("lag_close_1d"),
        F.lag(close, 3).over(w).alias("lag_close_3d"),
        guarded_return(F.col(close), lag1).alias("return_1d"),
        F.avg(close).over(trailing(series, date, 3)).alias("rolling_mean_3d"),
        F.avg(close).over(trailing(series, date, 7)).alias("rolling_mean_7d"),
        F.stddev_samp(close).over(trailing(series, date, 7)).alias("rolling_volatility_7d"),
        F.coalesce(F.lead(date, 1).over(w), next_business_day(F.col(date))).alias("target_date"),
        F.lead(close, 1).over(w).alias("target_close_next_day"),
    )
    w2 = series_window("benchmark_code", "feature_date")
    target_ret = guarded_return(F.col("target_close_next_day"), F.col("close_price"))
    return stage1.select(
        "*",
        # lags of the unrounded return; same window spec, so no new exchange
        F.lag("return_1d", 1).over(w2).alias("lag_return_1d"),
        F.lag("return_1d", 3).over(w2).alias("lag_return_3d"),
        target_ret.alias("target_return_next_day"),
        F.signum(target_ret).cast("int").alias("target_direction_next_day"),
    )
