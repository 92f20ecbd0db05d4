"""Daily news aggregates.

Scores are held as longs in 10^-4 units, so sums are exact and every mean is
rounded once, in integers (see ``numerics``).  All aggregates are hash
aggregates with a map-side partial step; a hot date only grows the partial
buffers, never one reducer's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..numerics import ratio_half_up, to_e4


def eligible_articles(scored: DataFrame) -> DataFrame:
    """Processed, dated, relevance > 0 (null relevance counts as 0)."""
    return scored.filter((F.col("processing_status") == "processed")
                         & F.col("published_date").isNotNull()
                         & (F.coalesce(F.col("relevance_e4"), F.lit(0)) > 0))


def daily_news(scored: DataFrame) -> DataFrame:
    """One row per published date.

    ``scored`` carries article_id, source_id, published_date, sentiment_e4,
    relevance_e4, sentiment_label, processing_status.

    Two-level aggregation: per (date, source) first, then per date.  The
    distinct-source count is the number of first-level groups, so there is no
    ``Expand`` (which would copy every input row once per distinct aggregate),
    and both levels combine map-side before their shuffle.
    """
    lvl1 = (eligible_articles(scored)
            .groupBy(F.col("published_date").alias("feature_date"), "source_id")
            .agg(F.count(F.lit(1)).alias("n"),
                 F.sum("sentiment_e4").alias("s"),
                 F.count("sentiment_e4").alias("ns"),
                 F.sum(F.col("sentiment_e4") * F.col("relevance_e4")).alias("sr"),
                 F.sum(F.coalesce("relevance_e4", F.lit(0))).alias("r"),
                 F.count("relevance_e4").alias("nr"),
                 F.count_if(F.col("sentiment_label") == "positive").alias("pos"),
                 F.count_if(F.col("sentiment_label") == "neutral").alias("neu"),
                 F.count_if(F.col("sentiment_label") == "negative").alias("neg")))
    agg = (lvl1.groupBy("feature_date")
           .agg(F.sum("n").alias("article_count"),
                F.count("source_id").alias("distinct_source_count"),
                F.sum("s").alias("_s"), F.sum("ns").alias("_ns"),
                F.sum("sr").alias("_sr"), F.sum("r").alias("_r"), F.sum("nr").alias("_nr"),
                F.sum("pos").alias("positive_article_count"),
                F.sum("neu").alias("neutral_article_count"),
                F.sum("neg").alias("negative_article_count")))
    return agg.select(
        "feature_date", "article_count", "distinct_source_count",
        F.when(F.col("_ns") > 0, ratio_half_up("_s", "_ns")).alias("avg_sentiment"),
        # sum(s*r)/sum(r): both sums scaled, the quotient lands in 10^-4 units
        F.when(F.col("_r") > 0, ratio_half_up("_sr", "_r")).alias("weighted_avg_sentiment"),
        F.when(F.col("_nr") > 0, ratio_half_up("_r", "_nr")).alias("avg_relevance"),
        "positive_article_count", "neutral_article_count", "negative_article_count")


def daily_topics(scored: DataFrame, topic_rows: DataFrame) -> DataFrame:
    """Per (date, topic), topic-score weighted; C3 has no relevance test.

    ``topic_rows`` is (article_id, topic_id, topic_score_e4); the join fans out
    one row per topic of an article (D2).
    """
    base = (scored.filter((F.col("processing_status") == "processed")
                          & F.col("published_date").isNotNull())
            .select("article_id", "published_date", "sentiment_e4"))
    j = base.join(topic_rows.select("article_id", "topic_id", "topic_score_e4"), "article_id")
    agg = (j.groupBy(F.col("published_date").alias("feature_date"), "topic_id")
           .agg(F.count(F.lit(1)).alias("article_count"),
                F.sum("sentiment_e4").alias("_s"),
                F.count("sentiment_e4").alias("_ns"),
                F.sum(F.col("sentiment_e4") * F.col("topic_score_e4")).alias("_st"),
                F.sum(F.coalesce("topic_score_e4", F.lit(0))).alias("_t"),
                F.count("topic_score_e4").alias("_nt")))
    return agg.select(
        "feature_date", "topic_id", "article_count",
        F.when(F.col("_ns") > 0, ratio_half_up("_s", "_ns")).alias("avg_sentiment"),
        F.when(F.col("_t") > 0, ratio_half_up("_st", "_t")).alias("weighted_avg_sentiment"),
        F.when(F.col("_nt") > 0, ratio_half_up("_t", "_nt")).alias("avg_relevance"))


def trading_day_news(mapped: DataFrame, series: str = "benchmark_code") -> DataFrame:
    """Re-aggregate stored daily means onto trading days.

    ``mapped`` is daily news with ``series`` and ``mapped_date`` attached (D5).
    Means are count-weighted; a day whose weighted mean is null still adds
    its count to the denominator.  Output keeps the exact numerators (10^-4
    units) so later window means stay exact.
    """
    m = mapped.select(series, "mapped_date", "article_count",
                      to_e4("avg_sentiment").alias("_a"),
                      to_e4("weighted_avg_sentiment").alias("_w"))
    return (m.groupBy(series, F.col("mapped_date").alias("feature_date"))
            .agg(F.sum("article_count").alias("news_n"),
                 F.sum(F.col("_a") * F.col("article_count")).alias("news_a"),
                 F.sum(F.col("_w") * F.col("article_count")).alias("news_w")))
