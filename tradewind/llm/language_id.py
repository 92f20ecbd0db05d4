"""Operator 6: language identification of web pages by Bayesian evidence fusion.

1. *Text likelihood.*  Byte trigrams of a bounded sample of labelled documents
   (by hash, ``MODEL_DOCS`` of all and about ``LANG_DOCS`` of every language, all of a
   language with fewer, so that no language of the documents is missing) give
   smoothed trigram probabilities per language; each page's whole main text is
   scored.  Overlapping trigrams are not independent, so the log-likelihood is
   tempered by ``TEMPER``.
2. *Grouped evidence.*  Over all pages, the text posteriors are summed by host,
   by domain (last two labels of the host), by declared markup language and by
   address suffix (top level domain and a two-letter first path segment); one
   hash aggregation each, combined map-side.
3. *Hierarchical smoothing.*  P(l | host) is smoothed towards P(l | domain) and
   that towards P(l); the other two towards P(l), with ``STRENGTH`` pseudo
   counts.  A page's own posterior is taken out of its groups first.
4. *Fusion.*  The log posterior is the tempered text log-likelihood plus log
   P(l | host) plus log P(l | key) - log P(l) for the declared language and the
   address suffix (Bayes' rule with conditionally independent evidence).

Defined results: one row per input row.  A page without text, declaration or
address has no evidence of that kind (null keys); without any, its language is
the most frequent one (ties: first by name).  Without labelled documents every
language is null.  Extra columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if, int_hash, stored
from .html_extract import main_text

#: Documents that the trigram model is counted on: of all, and besides of every language.
MODEL_DOCS = 8_000
LANG_DOCS = 500
BUCKETS = 1 << 16
ALPHA = 0.5
TEMPER = 0.1
STRENGTH = 5.0
SMALL = 50_000
_DECLARED = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?\s*([a-zA-Z]{2,3})", re.I)
_FOLD = np.array([i + 32 if 65 <= i <= 90 else 32 if i < 48 or 57 < i < 65 or 90 < i < 97
                  or 122 < i < 128 else i for i in range(256)], np.uint64)


def trigrams(text: str | None) -> np.ndarray:
    """Hashed byte trigrams of a text, letters folded, other ASCII as blanks."""
    raw = np.frombuffer((" " + (text or "") + " ").encode(), np.uint8)
    if not text or len(raw) < 3:
        return np.empty(0, np.int64)
    c = _FOLD[raw]
    x = (c[:-2] << np.uint64(16)) | (c[1:-1] << np.uint64(8)) | c[2:]
    x = x[x != 0x202020] * np.uint64(0x9E3779B97F4A7C15)
    return (x >> np.uint64(48)).astype(np.int64)


def _count(batches):
    for b in batches:
        langs, out = b.column("lang").to_pylist(), {}
        for lang, text in zip(langs, b.column("text")):
            c = out.setdefault(lang, np.zeros(BUCKETS, np.int64))
            c += np.bincount(trigrams(text.as_py()), minlength=BUCKETS)
        yield pa.RecordBatch.from_pydict(
            {"lang": list(out), "counts": [c.tobytes() for c in out.values()]},
            schema=pa.schema([("lang", pa.string()), ("counts", pa.binary())]))


def text_model(documents: DataFrame) -> tuple[list[str], np.ndarray]:
    """(languages, log probability of every trigram bucket per language)."""
    docs = documents.where("lang is not null and text is not null and doc_id is not null")
    ids = docs.select("doc_id").distinct().orderBy(
        F.xxhash64("doc_id", F.lit(41)), "doc_id").limit(MODEL_DOCS)
    # all doc_ids of a language that has few, about LANG_DOCS by hash of one that has many
    pairs = docs.select("lang", "doc_id").distinct()
    sizes = F.broadcast(stored(pairs.groupBy("lang").agg(F.count("*").alias("n"))))
    per_lang = pairs.join(sizes, "lang").where(
        int_hash(F.col("doc_id"), 43, F.col("n")) < LANG_DOCS).drop("n")
    # MODEL_DOCS rows of one number, about LANG_DOCS names and numbers per language
    ids = docs.select("lang", "doc_id").join(F.broadcast(stored(ids)), "doc_id").select(
        "lang", "doc_id").unionAll(per_lang).distinct()
    sample = docs.select("doc_id", "lang", "text").join(
        F.broadcast(stored(ids)), ["lang", "doc_id"])
    counts: dict[str, np.ndarray] = {}
    # one row per language and Arrow batch of the sample
    for r in sample.mapInArrow(_count, "lang string, counts binary").toLocalIterator():
        c = np.frombuffer(bytes(r["counts"]), np.int64)
        counts[r["lang"]] = counts.get(r["lang"], 0) + c
    langs = sorted(counts)
    total = np.array([counts[g] for g in langs], float).reshape(-1, BUCKETS)
    return langs, np.log((total + ALPHA) / (total.sum(1, keepdims=True) + ALPHA * BUCKETS)).T


def _evidence(model: np.ndarray):
    def run(batches):
        for b in batches:
            n, ll, declared = [], [], []
            for h in b.column("html"):
                source = h.as_py()
                x = trigrams(main_text(source))
                n.append(len(x))
                # a very long text by its counts: one row per bucket, not per trigram
                ll.append(np.bincount(x, minlength=BUCKETS) @ model if len(x) > BUCKETS
                          else model[x].sum(0))
                m = _DECLARED.search(source or "")
                declared.append(m[1].lower() if m else None)
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(declared, pa.string()),
                 pa.array(n, pa.int64()), pa.array([list(x) for x in ll], pa.list_(pa.float64()))],
                names=["page_id", "url", "declared", "n_trigrams", "ll"])
    return run


def _softmax(x: Column) -> Column:
    top = F.array_max(x)
    e = F.transform(x, lambda v: F.exp(v - top))
    return F.transform(e, lambda v: v / F.aggregate(e, F.lit(0.0), lambda s, y: s + y))


def _sums(rows: DataFrame, key: str, langs: int) -> DataFrame:
    """Sum of the text posteriors by key."""
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.array(*[F.sum(F.get("post", F.lit(i))) for i in range(langs)]).alias(f"{key}_n"))


def _smoothed(counts: str, toward: Column) -> Column:
    """P(l | key) without the page's own share, smoothed; ``toward`` if no key."""
    others = F.zip_with(counts, "post", lambda a, b: F.greatest(a - b, F.lit(0.0)))
    total = F.aggregate(others, F.lit(0.0), lambda s, x: s + x)
    mixed = F.zip_with(others, toward, lambda a, p: (a + STRENGTH * p) / (total + STRENGTH))
    return F.when(F.col(counts).isNull(), toward).otherwise(mixed)


def identify_language(pages: DataFrame, documents: DataFrame) -> DataFrame:
    """page_id, url, host, declared, suffix, n_trigrams, text_lang, lang and its
    posterior p of every page row."""
    langs, model = text_model(documents)
    if not langs:
        model, langs = np.zeros((BUCKETS, 1)), [None]
    names = F.array(*[F.lit(g).cast("string") for g in langs])
    host = F.nullif(F.lower(F.regexp_extract("url", r"^[^:/?#]+://(?:[^/?#@]*@)?([^/:?#]+)", 1)),
                    F.lit(""))
    path = F.lower(F.regexp_extract("url", r"^[^:/?#]+://[^/?#]*/([a-zA-Z]{2})(?:[/?#_-]|$)", 1))
    rows = pages.select("page_id", "url", "html").mapInArrow(
        _evidence(model), "page_id long, url string, declared string, n_trigrams long, "
                          "ll array<double>")
    rows = rows.withColumn("host", host).withColumns({
        "domain": F.substring_index("host", ".", -2),
        "suffix": F.concat(F.substring_index("host", ".", -1), F.lit("/"), path),
        "ll": F.transform("ll", lambda x: TEMPER * x)}).withColumn(
        "post", _softmax(F.col("ll")))
    rows = stored(rows)
    k = len(langs)
    base = rows.agg(*[F.sum(F.get("post", F.lit(i))) for i in range(k)]).first()
    base = np.array([x or 0.0 for x in base]) + 1.0
    base = base / base.sum()
    prior = F.array(*map(F.lit, base.tolist()))
    for key in ("host", "domain", "declared", "suffix"):
        rows = rows.join(broadcast_if(_sums(rows, key, k), SMALL), key, "left")
    near = _smoothed("host_n", _smoothed("domain_n", prior))
    log = lambda a: F.transform(a, lambda v: F.log(v))
    plus = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    minus = lambda a, b: F.zip_with(a, b, lambda x, y: x - y)
    score = plus(F.col("ll"), log(near))
    for key in ("declared_n", "suffix_n"):
        score = plus(score, minus(log(_smoothed(key, prior)), log(prior)))
    rows = rows.withColumn("score", score).withColumn("final", _softmax(F.col("score")))
    best = lambda a: F.get(names, F.array_position(a, F.array_max(a)).cast("int") - 1)
    return rows.select(
        "page_id", "url", "host", "declared", "suffix", "n_trigrams",
        F.when(F.col("n_trigrams") > 0, best("post")).alias("text_lang"),
        best("final").alias("lang"), F.array_max("final").alias("p"))
