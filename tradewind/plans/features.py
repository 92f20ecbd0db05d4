"""Model feature table (F15): price windows + news mapped onto trading days.

Rounding follows the storage scales of the feature table: prices 4 places,
returns / rolling statistics 6 places, news means 4 places.  Values stay
unrounded through the intermediate steps and are rounded once here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..numerics import ratio_half_up, rnd
from ..operators.aggregates import trading_day_news
from ..operators.asof import forward_asof
from ..operators.windows import price_window_block

FEATURE_COLUMNS = [
    "benchmark_code", "feature_date", "target_date", "close_price", "return_1d",
    "lag_close_1d", "lag_close_3d", "lag_return_1d", "lag_return_3d",
    "rolling_mean_3d", "rolling_mean_7d", "rolling_volatility_7d",
    "news_article_count_1d", "news_avg_sentiment_1d", "news_weighted_sentiment_1d",
    "news_avg_sentiment_3d", "news_weighted_sentiment_3d",
    "target_close_next_day", "target_return_next_day", "target_direction_next_day",
]

PRICE_FEATURE_COLUMNS = [c for c in FEATURE_COLUMNS if not c.startswith("news_")]

_SCALE = {"close_price": 4, "lag_close_1d": 4, "lag_close_3d": 4,
          "target_close_next_day": 4, "return_1d": 6, "lag_return_1d": 6,
          "lag_return_3d": 6, "rolling_mean_3d": 6, "rolling_mean_7d": 6,
          "rolling_volatility_7d": 6, "target_return_next_day": 6}


def store_prices(block: DataFrame) -> DataFrame:
    """Round the price block to its storage scales."""
    return block.select(*[rnd(c, _SCALE[c]).alias(c) if c in _SCALE else F.col(c)
                          for c in PRICE_FEATURE_COLUMNS])


def price_features(prices: DataFrame) -> DataFrame:
    """F1-F9, C13 generalised to every series, C14, C16, C18."""
    return store_prices(price_window_block(prices))


def stored(prices: DataFrame, daily: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The daily price and daily news tables, written once (the reference
    stores both).  The feature job reads each twice (window block and as-of
    calendar; join and earliest date), and both are small (one row per series
    and day / per day), so writing them once saves a second scan and
    aggregation of the raw tables."""
    from ..session import cut_lineage
    return cut_lineage(prices), cut_lineage(daily)


def news_on_trading_days(prices: DataFrame, daily: DataFrame) -> DataFrame:
    """D5 + E7: (benchmark_code, feature_date, news_n, news_a, news_w)."""
    mapped = forward_asof(prices.select("benchmark_code", "price_date"),
                          daily.select("feature_date", "article_count", "avg_sentiment",
                                       "weighted_avg_sentiment"))
    return trading_day_news(mapped)


def forward_asof_news(prices: DataFrame, daily: DataFrame) -> DataFrame:
    """Trading-day news, rounded as stored in the feature table."""
    prices, daily = stored(prices, daily)
    t = news_on_trading_days(prices, daily)
    return t.select(
        "benchmark_code", "feature_date",
        F.col("news_n").cast("int").alias("news_article_count_1d"),
        ratio_half_up("news_a", "news_n").alias("news_avg_sentiment_1d"),
        ratio_half_up("news_w", "news_n").alias("news_weighted_sentiment_1d"))


def _mean3_expr(a: str, b: str) -> str:
    """Exact mean of the non-null rationals a_i / b_i over this row and the
    two before it, rounded half away from zero to 10^-4 (decimal(38,0))."""
    xs, ys, ks = [], [], []
    for i in range(3):
        ai, bi = f"{a}{i}", f"{b}{i}"
        xs.append(f"CAST(coalesce({ai}, 0) AS DECIMAL(38,0))")
        ys.append(f"CAST(CASE WHEN {ai} IS NULL THEN 1 ELSE {bi} END AS DECIMAL(38,0))")
        ks.append(f"CASE WHEN {ai} IS NULL THEN 0 ELSE 1 END")
    num = " + ".join(f"{xs[i]} * {ys[(i + 1) % 3]} * {ys[(i + 2) % 3]}" for i in range(3))
    k = " + ".join(ks)
    den = f"CAST(({k}) AS DECIMAL(38,0)) * {ys[0]} * {ys[1]} * {ys[2]}"
    return (f"CASE WHEN ({k}) = 0 THEN NULL ELSE CAST(signum({num}) * "
            f"((2 * abs({num}) + {den}) div (2 * {den})) AS DOUBLE) / 10000.0 END")


def model_features(prices: DataFrame, daily: DataFrame) -> DataFrame:
    """the full feature row per (series, trading day)."""
    prices, daily = stored(prices, daily)
    block = price_window_block(prices)
    news = news_on_trading_days(prices, daily)
    j = block.join(news, ["benchmark_code", "feature_date"], "left")
    w = Window.partitionBy("benchmark_code").orderBy("feature_date")
    lagged = j.select(
        "*",
        F.col("news_a").alias("a0"), F.col("news_n").alias("b0"),
        F.lag("news_a", 1).over(w).alias("a1"), F.lag("news_n", 1).over(w).alias("b1"),
        F.lag("news_a", 2).over(w).alias("a2"), F.lag("news_n", 2).over(w).alias("b2"),
        F.col("news_w").alias("w0"), F.lag("news_w", 1).over(w).alias("w1"),
        F.lag("news_w", 2).over(w).alias("w2"))
    out = lagged.select(
        *[c for c in PRICE_FEATURE_COLUMNS],
        F.coalesce(F.col("news_n"), F.lit(0)).cast("int").alias("news_article_count_1d"),
        F.when(F.col("news_n").isNotNull(), ratio_half_up("news_a", "news_n"))
        .alias("news_avg_sentiment_1d"),
        F.when(F.col("news_w").isNotNull(), ratio_half_up("news_w", "news_n"))
        .alias("news_weighted_sentiment_1d"),
        F.expr(_mean3_expr("a", "b")).alias("news_avg_sentiment_3d"),
        F.expr(_mean3_expr("w", "b")).alias("news_weighted_sentiment_3d"))
    return out.select(*[rnd(c, _SCALE[c]).alias(c) if c in _SCALE else F.col(c)
                        for c in FEATURE_COLUMNS])
