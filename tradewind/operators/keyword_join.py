"""Topic scores and lexicon sentiment for tables of any size.

``topics.py`` and ``sentiment.py`` unroll a small taxonomy or lexicon into the plan,
which costs a test per keyword and row.  Here the keywords and the lexicon are tables:
the words of a text, as n-grams up to the longest keyword, are joined to them, so the
cost depends on the text and not on the table.

The tables are parameters; one of at most ``BROADCAST_ROWS`` rows (counted) is
broadcast, so the exploded words never leave their task and only hits are shuffled, by
article.  A larger one is joined by a shuffle of the distinct n-grams of every text.
Both results equal those of the unrolled forms.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..numerics import ratio_half_up, rnd
from ..sources.dimensions import (BOOSTER_DAMPING, CONTRAST_AFTER, CONTRAST_BEFORE,
                                  CONTRAST_WORD, FIELD_WEIGHTS_TENTHS, NEGATION_SCALAR,
                                  NORMALIZATION_ALPHA, RELEVANCE_WEIGHTS_TENTHS,
                                  TOPIC_SATURATION_TENTHS, Lexicon)
from .sentiment import edge_free
from .topics import SCORE_CAP_E4

BROADCAST_ROWS = 200_000
#: A word or a single mark, with the blank before it.
ATOM = r" ?(?:[a-z0-9_]+|[^a-z0-9_ ])"
MARKS = ("-", "+", ".", "/")          # the marks that cleaning leaves


def _sized(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else table


# ---- keywords ---------------------------------------------------------------
def keyword_table(keywords: DataFrame) -> DataFrame:
    """Distinct (topic_id, keyword, atoms) with the keywords as cleaned text has them."""
    plain = F.regexp_replace(F.trim(F.lower("keyword")), r"\s+", " ")
    return keywords.select("topic_id", plain.alias("keyword")).where("keyword <> ''").distinct().withColumn(
        "atoms", F.size(F.regexp_extract_all("keyword", F.lit(ATOM), F.lit(0))))


def _beside(words: Column, before: int, after: int) -> Column:
    """Rows of every place of an array: c0 is the word there, b1, b2, ... the words before
    it and a1, a2, ... those after it (null beyond the ends)."""
    none = F.lit(None).cast("string")
    n = F.size(words)
    return F.arrays_zip(
        words.alias("c0"),
        *[F.slice(F.concat(F.array_repeat(none, d), words), 1, n).alias(f"b{d}")
          for d in range(1, before + 1)],
        *[F.slice(words, d + 1, n).alias(f"a{d}") for d in range(1, after + 1)])


def keyword_hits(cleaned: DataFrame, keywords: DataFrame, key: str = "article_id") -> DataFrame:
    """(key, topic_id, keyword, weight): the keywords that a text holds, with the capped
    sum of their fields' weights in tenths.  ``cleaned`` has c_title, c_summary, c_content
    and a unique ``key``.

    Every atom of a text meets the atoms that begin a keyword first, and only from those
    places the n-grams are built.
    """
    table = keyword_table(keywords)
    longest = table.agg(F.max("atoms")).first()[0] or 1
    atoms = F.regexp_extract_all("f.text", F.lit(ATOM), F.lit(0))
    fields = ("title", "summary", "content")
    words = cleaned.select(key, F.explode(F.array(*[
        F.struct(F.lit(1 << i).alias("field"), F.col(f"c_{f}").alias("text"))
        for i, f in enumerate(fields)])).alias("f")).select(
        key, "f.field", atoms.alias("atoms")).select(
        key, "field", F.inline(_beside(F.col("atoms"), 1, longest)))
    begins = table.select(F.regexp_extract("keyword", ATOM, 0).alias("first")).distinct()
    words = words.join(_sized(begins), F.ltrim("c0") == F.col("first"), "left_semi")
    grams = []
    for n in range(1, longest + 1):
        # null where the text ends before
        text = F.ltrim(reduce(lambda x, d: F.concat(x, F.col(f"a{d}")), range(1, n), F.col("c0")))
        after = F.col(f"a{n}")
        # a mark at either end has no word glued to its outer side
        left = (~F.substring(text, 1, 1).isin(*MARKS) | F.col("b1").isNull()
                | F.startswith("c0", F.lit(" ")) | F.substring("b1", -1, 1).isin(*MARKS))
        right = (~F.substring(text, -1, 1).isin(*MARKS) | after.isNull()
                 | F.substring(after, 1, 1).isin(" ", *MARKS))
        grams.append(F.when(left & right, text))
    spoken = words.select(key, "field", F.explode(F.array(*grams)).alias("keyword")).where(
        "keyword is not null")
    # a keyword of several topics meets the words once, and its topics after the grouping
    named = table.select("keyword").distinct()
    weight = reduce(lambda x, y: x + y, [
        F.when(F.col("found").bitwiseAND(1 << i) > 0, FIELD_WEIGHTS_TENTHS[f]).otherwise(0)
        for i, f in enumerate(fields)])
    found = spoken.join(_sized(named), "keyword", "left_semi").groupBy(key, "keyword").agg(
        F.bit_or("field").alias("found"))
    return found.join(_sized(table.select("keyword", "topic_id")), "keyword").select(
        key, "topic_id", "keyword", F.least(weight, F.lit(10)).alias("weight"))


def topic_scores(cleaned: DataFrame, keywords: DataFrame, key: str = "article_id") -> DataFrame:
    """(key, topic_id, topic_score_e4, hits, is_primary_topic), score > 0."""
    score = F.least(ratio_half_up("k * 10000", str(TOPIC_SATURATION_TENTHS), scale=1).cast("long"),
                    F.lit(SCORE_CAP_E4))
    per = keyword_hits(cleaned, keywords, key).groupBy(key, "topic_id").agg(
        F.sum("weight").alias("k"), F.array_sort(F.collect_set("keyword")).alias("hits")).withColumn(
        "topic_score_e4", score).where("topic_score_e4 > 0")
    # the scores of one article: at most one per topic
    best = per.groupBy(key).agg(
        F.max(F.struct("topic_score_e4", (-F.col("topic_id")).alias("t"))).alias("best"))
    return per.join(best, key).select(
        key, "topic_id", "topic_score_e4", "hits",
        (F.col("topic_id") == -F.col("best.t")).alias("is_primary_topic"))


def relevance(scores: DataFrame, articles: DataFrame, key: str = "article_id") -> DataFrame:
    """(key, relevance_e4, primary_topic_id) of every article."""
    a, b = RELEVANCE_WEIGHTS_TENTHS
    top = scores.groupBy(key).agg(
        F.slice(F.sort_array(F.collect_list("topic_score_e4"), asc=False), 1, 2).alias("top"),
        F.max(F.when(F.col("is_primary_topic"), F.col("topic_id"))).alias("primary_topic_id"))
    value = top.withColumn("t1", F.get("top", F.lit(0))).withColumn(
        "t2", F.coalesce(F.get("top", F.lit(1)), F.lit(0))).select(
        key, F.least(ratio_half_up(f"({a} * t1 + {b} * t2)", "10", scale=1).cast("long"),
                     F.lit(SCORE_CAP_E4)).alias("relevance_e4"), "primary_topic_id")
    return articles.select(key).join(value, key, "left").select(
        key, F.coalesce("relevance_e4", F.lit(0)).alias("relevance_e4"), "primary_topic_id")


# ---- sentiment --------------------------------------------------------------
LEXICON_SCHEMA = "token string, valence double, boost double, negates boolean"
PHRASE_SCHEMA = "phrase string, valence double, boost double"


def lexicon_table(spark: SparkSession, lex: Lexicon) -> DataFrame:
    """A small ``Lexicon`` as a table; larger ones are read as one."""
    words = sorted({*lex.valence, *lex.boosters, *lex.negators})
    return spark.createDataFrame(
        [(w, lex.valence.get(w), lex.boosters.get(w), w in lex.negators) for w in words],
        LEXICON_SCHEMA)


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """A 'token<TAB>mean[<TAB>...]' lexicon file as a table; later lines win."""
    part = F.split("value", "\t")
    lines = spark.read.text(path).select(
        F.monotonically_increasing_id().alias("at"), F.lower(part[0]).alias("token"),
        F.get(part, F.lit(1)).try_cast("double").alias("mean"))
    return lines.where("token <> '' and mean is not null").groupBy("token").agg(
        F.max_by("mean", "at").alias("valence")).select(
        "token", "valence", F.lit(None).cast("double").alias("boost"), F.lit(False).alias("negates"))


def compound(cleaned: DataFrame, text: str, lexicon: DataFrame, phrases: DataFrame | None = None,
             key: str = "article_id") -> DataFrame:
    """(key, sentiment_score) of every row of ``cleaned`` (unique ``key``).

    ``lexicon``: token, valence (null: none), boost, negates.  ``phrases``: idioms of two
    or three words with a valence that replaces that of a word in or behind them, and
    boosters of several words ("kind of").
    """
    spark = cleaned.sparkSession
    places = cleaned.select(key, F.split(text, " ").alias("tok")).select(
        key, F.posexplode(_beside(F.col("tok"), 3, 2)).alias("i", "w"))
    # the contrast word counts whether it has a valence or not
    lexicon = _sized(lexicon.where(F.col("token").isNotNull()))
    known = lexicon.where("valence is not null and boost is null").select(
        "token", F.col("valence").alias("v")).unionByName(spark.createDataFrame(
            [(CONTRAST_WORD, None)], "token string, v double")).groupBy("token").agg(F.max("v").alias("v"))
    hits = places.withColumn("token", edge_free(F.col("w.c0"))).join(_sized(known), "token").select(
        key, "i", "token", "v", *[edge_free(F.col(f"w.b{d}")).alias(f"p{d}") for d in (1, 2, 3)],
        *[edge_free(F.col(f"w.a{d}")).alias(f"n{d}") for d in (1, 2)])
    for d, damp in zip((1, 2, 3), BOOSTER_DAMPING):
        # the token before: a lexicon word ends the rule, else it boosts, then negates
        before = lexicon.select(
            F.col("token").alias(f"p{d}"), F.col("valence").isNotNull().alias("word"),
            F.coalesce("boost", F.lit(0.0)).alias("b"), "negates")
        v = F.col("v")
        boosted = v + (F.when(v < 0, F.lit(-1.0)).otherwise(F.lit(1.0)) * F.col("b")) * F.lit(damp)
        changed = F.when(F.col("negates"), boosted * F.lit(NEGATION_SCALAR)).otherwise(boosted)
        hits = hits.join(before, f"p{d}", "left").withColumn(
            "v", F.when(F.col("word") | F.col("word").isNull(), v).otherwise(changed)).withColumn(
            f"word{d}", F.coalesce("word", F.lit(False))).drop("word", "b", "negates")
    if phrases is not None:
        hits = _with_phrases(hits, phrases, key)
    # the hits of one text, added up in their order
    but, i, v = F.col("but"), lambda h: h["i"], lambda h: h["v"]
    weighted = lambda h: F.when(but > i(h), v(h) * F.lit(CONTRAST_BEFORE)).when(
        but < i(h), v(h) * F.lit(CONTRAST_AFTER)).otherwise(v(h))
    total = F.aggregate(F.array_sort("hits"), F.lit(0.0), lambda s, h: s + weighted(h))
    scored = hits.groupBy(key).agg(
        F.min(F.when(F.col("token") == CONTRAST_WORD, F.col("i"))).alias("but"),
        F.collect_list(F.when(F.col("v").isNotNull(), F.struct("i", "v"))).alias("hits")).select(
        key, total.alias("s"))
    s = F.col("s")
    value = F.least(F.greatest(s / F.sqrt(s * s + F.lit(NORMALIZATION_ALPHA)), F.lit(-1.0)), F.lit(1.0))
    return cleaned.select(key).join(scored.select(key, rnd(value, 4).alias("c")), key, "left").select(
        key, F.coalesce("c", F.lit(0.0)).alias("sentiment_score"))


def _with_phrases(hits: DataFrame, phrases: DataFrame, key: str) -> DataFrame:
    """Applies idioms and boosters of several words to the hits whose third word back
    is no lexicon word."""
    said = lambda *ws: F.when(
        F.forall(F.array(*ws), lambda w: w.isNotNull()), F.concat_ws(" ", *ws))
    # the first that is an idiom counts
    order = [("token", "n1", "n2"), ("token", "n1"), ("p1", "token"), ("p2", "p1", "token"),
             ("p2", "p1"), ("p3", "p2", "p1"), ("p3", "p2")]
    boosts = [("p3", "p2", "p1"), ("p3", "p2"), ("p2", "p1")]
    spoken = F.array(*[F.struct(F.lit(n).alias("rank"), said(*ws).alias("phrase"),
                                F.lit(ws in boosts).alias("may_boost")) for n, ws in enumerate(order)])
    met = hits.where("p3 is not null and not word3").select(key, "i", F.explode(spoken).alias("s")).select(
        key, "i", "s.*").join(_sized(phrases), "phrase").groupBy(key, "i").agg(
        F.min(F.when(F.col("valence").isNotNull(), F.struct("rank", "valence"))).alias("idiom"),
        F.sum(F.when(F.col("may_boost"), F.col("boost"))).alias("more"))
    return hits.join(met, [key, "i"], "left").withColumn(
        "v", F.coalesce("idiom.valence", "v") + F.coalesce("more", F.lit(0.0))).drop("idiom", "more")
