"""Lexicon sentiment (J4, J5): the rule set of the published lexicon method
(Hutto and Gilbert 2014) over the cleaned text, as array expressions.

Per token: lexicon valence; for each of the three preceding tokens that is
not itself a lexicon word, a booster adds +-0.293 (damped 1 / .95 / .9 by
distance) and a negator multiplies by -0.74; tokens before the first
contrast word ("but") count half, after it 1.5x.  Sum S, compound
S / sqrt(S^2 + 15), clamped to [-1, 1], rounded to 4 places.

Everything is a higher-order function on the row's token array (``transform``
/ ``filter`` / ``aggregate``), so scoring is a narrow projection: no explode,
no shuffle.
Capital-letter and punctuation rules cannot fire on cleaned (lower-case,
no ``!?'``) text and are not modelled.  The lexicon is a small parameter map.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..numerics import rnd
from ..sources.dimensions import (BOOSTER_DAMPING, CONTRAST_AFTER, CONTRAST_BEFORE,
                                  CONTRAST_WORD, NEGATION_SCALAR, NORMALIZATION_ALPHA,
                                  Lexicon)

_EDGE_PUNCT = r"^[-+./]+|[-+./]+$"   # only these punctuation marks survive cleaning


def _map(d: dict[str, float]) -> Column:
    if not d:
        return F.create_map().cast("map<string,double>")
    return F.create_map(*[x for k, v in d.items() for x in (F.lit(k), F.lit(float(v)))])


def edge_free(token: Column) -> Column:
    """A token without edge punctuation unless <= 2 chars remain."""
    s = F.btrim(token, F.lit("-+./"))
    return F.when(F.length(s) > 2, s).otherwise(token)


def tokens(cleaned: Column) -> Column:
    """Whitespace tokens without edge punctuation: ``edge_free`` of every token by one
    scan of the text (a function over the token array would be interpreted)."""
    at_edge = r"(?<![^ ])(?=[\-+./]|[^ ]*+(?<=[\-+./]))"
    return F.split(F.regexp_replace(
        cleaned, at_edge + r"[\-+./]*([^\-+./ ][^ ]+[^\-+./ ])[\-+./]*(?![^ ])", "$1"), " ")


def _context_step(d: int, damp: float, bstmap: Column, negs: Column):
    """Booster then negation from the token ``d`` places back, when that
    token is not itself a lexicon word; ``h`` is one lexicon hit (i, v)."""
    def step(h):
        i, v = h["i"], h["v"]
        prev_tok = F.get(F.col("_tok"), i - d)
        applies = (i >= d) & F.get(F.col("_lex"), i - d).isNull()
        sign = F.when(v < 0, F.lit(-1.0)).otherwise(F.lit(1.0))
        boost = F.coalesce(F.try_element_at(bstmap, prev_tok), F.lit(0.0))
        boosted = v + (sign * boost) * F.lit(damp)
        negated = F.when(F.array_contains(negs, prev_tok),
                         boosted * F.lit(NEGATION_SCALAR)).otherwise(boosted)
        return F.struct(i.alias("i"), F.when(applies, negated).otherwise(v).alias("v"))
    return step


def with_compound(df: DataFrame, cleaned: str, lex: Lexicon, out: str = "sentiment_score"
                  ) -> DataFrame:
    """Adds ``out`` (double, 4 places) computed from the ``cleaned`` text column.

    Only lexicon-word positions carry a valence, and adding zeros does not
    change an ordered floating-point sum, so the context rules run on the
    (few) hits only; the token array itself is scanned once for lookups.
    """
    lexmap, bstmap = _map(lex.valence), _map(lex.boosters)
    negs = F.array(*[F.lit(w) for w in lex.negators]) if lex.negators else \
        F.array().cast("array<string>")
    s1 = df.withColumn("_tok", tokens(F.col(cleaned)))
    s2 = s1.select("*", F.transform("_tok", lambda t: F.try_element_at(lexmap, t)).alias("_lex"),
                   F.array_position("_tok", CONTRAST_WORD).alias("_but"))
    idx = F.sequence(F.lit(0), F.size("_tok") - 1)
    hits = F.filter(idx, lambda i: F.get(F.col("_lex"), i).isNotNull()
                    & ~F.map_contains_key(bstmap, F.get(F.col("_tok"), i)))
    cur = s2.withColumn("_h", F.transform(hits, lambda i: F.struct(
        i.alias("i"), F.get(F.col("_lex"), i).alias("v"))))
    for d, damp in zip((1, 2, 3), BOOSTER_DAMPING):
        cur = cur.withColumn("_h", F.transform("_h", _context_step(d, damp, bstmap, negs)))
    but = F.col("_but")
    weighted = F.transform("_h", lambda h: F.when(
        (but > 0) & (h["i"] < but - 1), h["v"] * F.lit(CONTRAST_BEFORE))
        .when((but > 0) & (h["i"] > but - 1), h["v"] * F.lit(CONTRAST_AFTER))
        .otherwise(h["v"]))
    total = F.aggregate(weighted, F.lit(0.0), lambda acc, x: acc + x)
    comp = total / F.sqrt(total * total + F.lit(NORMALIZATION_ALPHA))
    comp = F.least(F.greatest(comp, F.lit(-1.0)), F.lit(1.0))
    return cur.withColumn(out, rnd(comp, 4)).drop("_tok", "_lex", "_but", "_h")


def label(score_e4: Column) -> Column:
    """>= .05 positive, <= -.05 negative, else neutral (on 4-place scores)."""
    return (F.when(score_e4 >= 500, "positive").when(score_e4 <= -500, "negative")
            .otherwise("neutral"))
