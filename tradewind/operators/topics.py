"""Keyword topic scoring (J1-J3, G6, G7, H2) as one narrow projection.

Per distinct keyword and field one ``rlike`` predicate is evaluated in the
JVM; weights are integers in tenths (title 5, summary 3, content 2) so the
sums are exact.  No shuffle: the taxonomy is a small parameter inlined into
the plan, and every article is scored where it lies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import phrase_in_cleaned, word_marked
from ..numerics import ratio_half_up
from ..sources.dimensions import (FIELD_WEIGHTS_TENTHS, RELEVANCE_WEIGHTS_TENTHS,
                                  TOPIC_SATURATION_TENTHS, Taxonomy)

SCORE_CAP_E4 = 10_000


def _kw_col(i: int) -> str:
    return f"_kw{i}"


def keyword_weights(df: DataFrame, taxonomy: Taxonomy, title: str = "c_title",
                    summary: str = "c_summary", content: str = "c_content") -> DataFrame:
    """One int column per distinct keyword: capped field-weight sum in tenths.

    The fields are cleaned text; each gets one word-marked copy, and every
    alphanumeric keyword is a substring test on it.
    """
    wt, ws, wc = (FIELD_WEIGHTS_TENTHS[k] for k in ("title", "summary", "content"))
    # a content that is the summary again is neither marked nor searched again
    same = F.col(summary).eqNullSafe(F.col(content))
    marked = df.select("*", word_marked(title).alias("_mt"), word_marked(summary).alias("_ms"),
                       F.when(~same, word_marked(content)).alias("_mc"), same.alias("_same"))
    in_summary = marked.select("*", *[phrase_in_cleaned("_ms", summary, kw).alias(f"_in{i}")
                                      for i, kw in enumerate(taxonomy.keywords)])
    cols = []
    for i, kw in enumerate(taxonomy.keywords):
        w = (F.when(phrase_in_cleaned("_mt", title, kw), wt).otherwise(0)
             + F.when(F.col(f"_in{i}"), ws).otherwise(0)
             + F.when(F.when(F.col("_same"), F.col(f"_in{i}")).otherwise(
                 phrase_in_cleaned("_mc", content, kw)), wc).otherwise(0))
        cols.append(F.least(w, F.lit(10)).alias(_kw_col(i)))
    return in_summary.select(*df.columns, *cols)


def score_topics(df: DataFrame, taxonomy: Taxonomy) -> DataFrame:
    """Adds per-topic ``_ts{id}`` scores (10^-4 units), ``_hits{id}`` keyword
    arrays, ``relevance_e4`` and ``primary_topic_id``; drops the helpers."""
    kw_index = {k: i for i, k in enumerate(taxonomy.keywords)}
    weighted = keyword_weights(df, taxonomy)
    k_cols, hit_cols = [], []
    for tid, (name, kws) in zip([t for t, _ in taxonomy.topic_ids], taxonomy.topics):
        total: Column = F.lit(0)
        for k in kws:
            total = total + F.col(_kw_col(kw_index[k.strip().lower()]))
        k_cols.append(total.alias(f"_k{tid}"))
        hits = F.array(*[F.when(F.col(_kw_col(kw_index[k])) > 0, F.lit(k))
                         for k in taxonomy.sorted_keywords(name)])
        hit_cols.append(F.filter(hits, lambda x: x.isNotNull()).alias(f"_hits{tid}"))
    stage = weighted.select("*", *k_cols, *hit_cols)
    ids = [t for t, _ in taxonomy.topic_ids]
    # K tenths of a hit over the saturation (30 tenths), in 10^-4 units, capped
    score_cols = [F.least(ratio_half_up(f"_k{t} * 10000", str(TOPIC_SATURATION_TENTHS),
                                        scale=1).cast("long"),
                          F.lit(SCORE_CAP_E4)).alias(f"_ts{t}") for t in ids]
    scored = stage.select(*[c for c in df.columns], *[f"_hits{t}" for t in ids], *score_cols)
    ranked = F.sort_array(F.array(*[F.col(f"_ts{t}") for t in ids]), asc=False)
    a, b = RELEVANCE_WEIGHTS_TENTHS
    top1 = F.element_at(ranked, 1)
    top2 = F.coalesce(F.element_at(ranked, 2), F.lit(0)) if len(ids) > 1 else F.lit(0)
    best = F.array_max(F.array(*[F.struct(F.col(f"_ts{t}").alias("s"), F.lit(-t).alias("neg_id"))
                                 for t in ids]))
    return (scored
            .withColumn("_top", F.struct(top1.alias("t1"), top2.alias("t2")))
            .withColumn("relevance_e4", F.least(
                ratio_half_up(f"({a} * _top.t1 + {b} * _top.t2)", "10", scale=1).cast("long"),
                F.lit(SCORE_CAP_E4)))
            .withColumn("primary_topic_id",
                        F.when(best["s"] > 0, (-best["neg_id"]).cast("int")))
            .drop("_top"))


def topic_rows(scored: DataFrame, taxonomy: Taxonomy, key: str = "article_id") -> DataFrame:
    """Long rows (key, topic_id, topic_score_e4, is_primary_topic), score > 0."""
    ids = [t for t, _ in taxonomy.topic_ids]
    arr = F.array(*[F.struct(F.lit(t).alias("topic_id"), F.col(f"_ts{t}").alias("s"))
                    for t in ids])
    return (scored.select(key, "primary_topic_id", F.explode(arr).alias("_t"))
            .filter(F.col("_t.s") > 0)
            .select(key, F.col("_t.topic_id").alias("topic_id"),
                    F.col("_t.s").alias("topic_score_e4"),
                    (F.col("_t.topic_id") == F.col("primary_topic_id")).alias("is_primary_topic")))


def hits_json(taxonomy: Taxonomy) -> Column:
    """Non-empty keyword hits as JSON text, in taxonomy order, formatted as
    Python's ``json.dumps`` does (", " and ": " separators)."""
    for _, kws in taxonomy.topics:
        for k in kws:
            if any(c in k for c in '"\\') or any(ord(c) < 32 for c in k):
                raise ValueError(f"keyword needs JSON escaping: {k!r}")
    parts = []
    for t, name in taxonomy.topic_ids:
        h = F.col(f"_hits{t}")
        inner = F.array_join(F.transform(h, lambda x: F.concat(F.lit('"'), x, F.lit('"'))), ", ")
        parts.append(F.when(F.size(h) > 0, F.concat(F.lit(f'"{name}": ['), inner, F.lit("]"))))
    return F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))
