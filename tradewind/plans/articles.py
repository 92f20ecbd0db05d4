"""Article processing job (J7): clean, score topics, relevance, sentiment.

One narrow plan over the pending articles produces two outputs: the
processed row per article and the long topic-score rows.  Nothing shuffles
except the final writes; the taxonomy and lexicon are inlined parameters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_text, combined_text, has_text
from ..operators import sentiment as SE
from ..operators import topics as TP
from ..sources.dimensions import Lexicon, Taxonomy

FAILED_NOTE = "No usable text found in title/summary/content."


def pending(articles: DataFrame, processed: DataFrame | None) -> DataFrame:
    """Articles whose processing row is pending (or missing)."""
    if processed is None:
        return articles
    done = processed.filter(F.col("processing_status") != "pending").select("article_id")
    return articles.join(done, "article_id", "left_anti")


def cleaned(articles: DataFrame) -> DataFrame:
    """I12/I13 for every text field of the articles.

    The combined text is cleaned once per part: unless a tag can open in the
    title or summary and close in a later part (a ``<`` in either), cleaning
    the space-joined parts equals joining the cleaned non-empty parts, so the
    (large) content is scanned once, not twice.
    """
    # feeds often have one text for both summary and content: it is cleaned once
    texts = articles.select(
        "article_id", "source_id", "published_date", "title", "summary", "content",
        clean_text("title").alias("c_title"), clean_text("summary").alias("c_summary"),
        F.col("summary").eqNullSafe(F.col("content")).alias("_same"),
        (has_text("title") | has_text("summary") | has_text("content")).alias("_ok"))
    parts = texts.select(
        "article_id", "source_id", "published_date", "c_title", "c_summary",
        F.when(F.col("_same"), F.col("c_summary")).otherwise(clean_text("content")).alias("c_content"),
        "_ok",
        (F.coalesce(F.instr("title", "<"), F.lit(0))
         + F.coalesce(F.instr("summary", "<"), F.lit(0)) > 0).alias("_lt"),
        "title", "summary", "content")
    joined = F.concat_ws(" ", *[F.nullif(F.col(c), F.lit(""))
                                for c in ("c_title", "c_summary", "c_content")])
    return parts.select(
        "article_id", "source_id", "published_date", "c_title", "c_summary", "c_content", "_ok",
        F.when(F.col("_lt"), clean_text(combined_text("title", "summary", "content")))
        .otherwise(joined).alias("c_combined"))


def score_articles(articles: DataFrame, taxonomy: Taxonomy, lexicon: Lexicon) -> DataFrame:
    """All per-article scores; keeps helper topic columns for ``topic_rows``."""
    scored = TP.score_topics(cleaned(articles), taxonomy)
    return SE.with_compound(scored, "c_combined", lexicon, out="_compound")


def processed_rows(scored: DataFrame, taxonomy: Taxonomy, keep: tuple[str, ...] = ()
                   ) -> DataFrame:
    """The articles_processed row per article (stamps excluded)."""
    ok = F.col("_ok")
    sent_e4 = F.when(ok, F.round(F.col("_compound") * 10000).cast("long")).otherwise(F.lit(0))
    names = F.create_map(*[x for t, n in taxonomy.topic_ids for x in (F.lit(t), F.lit(n))])
    primary = F.coalesce(F.element_at(names, F.col("primary_topic_id")), F.lit("None"))
    note = F.concat(
        F.when(F.col("published_date").isNotNull(),
               F.concat(F.lit("Processed from published_date="),
                        F.date_format("published_date", "yyyy-MM-dd")))
        .otherwise(F.lit("Processed with missing published_date")),
        F.lit("; primary_topic="), primary, F.lit("; keyword_hits="), TP.hits_json(taxonomy))
    return scored.select(
        "article_id", *keep,
        F.when(ok, F.col("c_combined")).alias("cleaned_text"),
        (F.when(ok, F.col("relevance_e4")).otherwise(0) / F.lit(10000.0)).alias("relevance_score"),
        (sent_e4 / F.lit(10000.0)).alias("sentiment_score"),
        SE.label(sent_e4).alias("sentiment_label"),
        F.when(ok, "processed").otherwise("failed").alias("processing_status"),
        F.when(ok, note).otherwise(F.lit(FAILED_NOTE)).alias("notes"))


def topic_score_rows(scored: DataFrame, taxonomy: Taxonomy) -> DataFrame:
    """Only processed articles get topic rows."""
    rows = TP.topic_rows(scored.filter("_ok"), taxonomy)
    return rows.select("article_id", "topic_id",
                       (F.col("topic_score_e4") / F.lit(10000.0)).alias("topic_score"),
                       "is_primary_topic", "topic_score_e4")


def scored_items(scored: DataFrame, taxonomy: Taxonomy) -> DataFrame:
    """Processed rows in the scored-item shape the daily aggregates read
    (same projection, no join back to the articles)."""
    p = processed_rows(scored, taxonomy, keep=("source_id", "published_date"))
    return p.select("article_id", "source_id", "published_date", "processing_status",
                    "sentiment_label",
                    F.round(F.col("sentiment_score") * 10000).cast("long").alias("sentiment_e4"),
                    F.round(F.col("relevance_score") * 10000).cast("long").alias("relevance_e4"))


def persisted_scores(scored: DataFrame, taxonomy: Taxonomy) -> DataFrame:
    """The narrow per-article result, written once to the shared checkpoint
    folder (what the reference stores as its processed table).

    Both daily aggregates and the topic rows read this instead of re-running
    the text scoring; it also stops the optimizer from pushing filters into
    (and so duplicating) the regular-expression projection.
    """
    from ..session import cut_lineage
    ids = [t for t, _ in taxonomy.topic_ids]
    ok = F.col("_ok")
    sent_e4 = F.when(ok, F.round(F.col("_compound") * 10000).cast("long")).otherwise(F.lit(0))
    narrow = scored.select(
        "article_id", "source_id", "published_date", "_ok", "primary_topic_id",
        *[f"_ts{t}" for t in ids],
        F.when(ok, "processed").otherwise("failed").alias("processing_status"),
        SE.label(sent_e4).alias("sentiment_label"),
        sent_e4.alias("sentiment_e4"),
        F.when(ok, F.col("relevance_e4")).otherwise(F.lit(0)).cast("long").alias("relevance_e4"))
    return cut_lineage(narrow)
