"""Operator 11: runs (maximal periodic stretches of words) by string synchronising sets.

A run is a maximal stretch of consecutive words of one text whose smallest period
is ``q`` and whose length is at least ``max(MIN_LENGTH, 2 q)``.

Every Arrow batch lays its texts end to end, each closed by a word of its own, so
no period crosses texts and all steps are array operations over the batch.

1. *Small periods*, up to ``SMALL`` words, are read off directly: words equal to
   the word ``q`` places on.  These are the highly periodic regions.
2. *Synchronising sets.*  At the scales t = 4, 8, 16, ... the set holds position i
   if the smallest hash among the t-word windows that start in [i, i+t] is the
   first or the last one; windows that lie in a found run of period <= t/3 take no
   part.  Membership depends on the 2t words at i alone, and any t neighbouring
   positions hold a member unless the 3t-1 words there have period <= t/3.
3. *Proposals.*  A run of period q in [4t, 8t) repeats its first members q words
   later with equal contexts of 2t words, so pairs of members with equal contexts
   at such distances propose q.  Equal contexts lie more than t/3 apart, so a member
   has at most twelve partners: that is a property of the set, not a cap.
4. *Omitted runs.*  Only where a whole period is itself of period p <= t/3 does a
   run hold no such pair.  Then it lies over two neighbouring runs of period p with
   a break between them, and q is one of the shifts that lay the first on the second.
5. *Verification.*  For every (text, q) proposed all words are compared with the
   words q places on; what is not maximal, too short or of a smaller period goes.
   Hashes only select, so the result is exact.

Larger scales look at the texts that are long enough for them, so the work is
near linear; nothing is shuffled and a batch holds ``TEXT_BYTES`` of text (or one
longer text), wherever its executor is lost it is computed again by itself.

Rows: one per input row, in no order.  Null, empty and blank texts have no words and
no runs, their ``collapsed`` text is empty.  Repeated rows get equal results, null
ids are kept.  Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, mix64, tokenize
from .packed import sized

MIN_LENGTH = 12
#: Periods found by direct comparison; the scales start where they end.
SMALL, FIRST_SCALE = 15, 4
TEXT_BYTES = 1 << 20

RUN = "struct<start: long, length: long, period: long>"
SCHEMA = f"doc_id long, n_words long, runs array<{RUN}>, collapsed string"


def stretches(w: np.ndarray, q: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal stretches of period ``q`` with at least
    ``least`` words (and 2 q)."""
    if len(w) <= q:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    cut = np.flatnonzero(w[:-q] != w[q:])
    cut = np.concatenate([[-1], cut, [len(w) - q]])
    same = np.diff(cut) - 1
    at = np.flatnonzero(same >= max(q, least - q))
    return cut[at] + 1, cut[at] + 1 + same[at] + q


def _window_min(x: np.ndarray, t: int) -> np.ndarray:
    """Smallest of x[i], ..., x[i + t] for a power of two ``t``."""
    m, k = x, 1
    while k < t:
        m = np.minimum(m[:-k], m[k:])
        k *= 2
    return np.minimum(m[:-1], m[1:])


def members(ids: np.ndarray, periodic: np.ndarray, t: int) -> np.ndarray:
    """The synchronising set of scale ``t``: ``ids`` are the hashes of the t-word
    windows, ``periodic`` marks windows of period <= t/3."""
    if len(ids) <= t:
        return np.empty(0, np.int64)
    none = np.uint64(0xFFFFFFFFFFFFFFFF)
    x = np.where(periodic, none, ids)
    low = _window_min(x, t)
    return np.flatnonzero((low != none) & ((low == x[:len(low)]) | (low == x[t:t + len(low)])))


def _covered(n: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Marks the positions inside any [lo, hi)."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, lo, 1)
    np.add.at(step, hi, -1)
    return np.cumsum(step[:-1]) > 0


def _proposals(ids: np.ndarray, at: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions i and distances q in [4t, 8t) of members with equal contexts whose
    agreement goes on for t words more, before or after (a run's does)."""
    n = len(ids)
    at = at[at + t < n]
    context = mix64(ids[at] * np.uint64(0x9E3779B97F4A7C15) + ids[at + t])
    order = np.argsort(context, kind="stable")
    at, context = at[order], context[order]
    left, gaps = [], []
    near = np.arange(len(at))
    step = 1
    while len(near := near[near + step < len(at)]):
        gap = at[near + step] - at[near]
        near = near[(context[near + step] == context[near]) & (gap < 8 * t)]
        gap = at[near + step] - at[near]
        far = gap >= 4 * t
        left.append(at[near[far]])
        gaps.append(gap[far])
        step += 1
    i = np.concatenate(left) if left else np.empty(0, np.int64)
    q = np.concatenate(gaps) if gaps else np.empty(0, np.int64)
    after = np.minimum(i + q + 2 * t, n - 1)
    before = np.maximum(i - t, 0)
    goes_on = (after == i + q + 2 * t) & (ids[after - q] == ids[after])
    goes_on |= (before == i - t) & (ids[before] == ids[before + q])
    return i[goes_on], q[goes_on]


def _over_breaks(w: np.ndarray, runs: np.ndarray) -> Iterator[tuple[int, int]]:
    """(position, q) of the runs whose period is itself periodic: they lie over two
    neighbouring runs of one period p that meet or overlap."""
    start, end, period = runs
    order = np.lexsort((start, period))
    start, end, period = start[order], end[order], period[order]
    long = end - start >= 12 * period
    start, end, period = start[long], end[long], period[long]
    meet = np.flatnonzero((period[1:] == period[:-1]) & (start[1:] <= end[:-1]))
    for k in meet:
        p, b1, e1, b2, e2 = (int(v) for v in (
            period[k], start[k], end[k], start[k + 1], end[k + 1]))
        root = w[b1:b1 + p]
        turn = np.lib.stride_tricks.sliding_window_view(w[b2:b2 + 2 * p - 1], p)
        fits = np.flatnonzero((turn == root).all(axis=1))
        for d in fits:
            shift = (b2 + int(d) - b1) % p
            for q in range(shift or p, min(e1 - b1, e2 - b2) + 1, p):
                # q words of the first run and q of the second side by side
                if q > SMALL and max(b1, b2 - q) <= min(e1 - q, e2 - 2 * q):
                    yield max(b1, b2 - q), q


def find_runs(words: np.ndarray, offsets: np.ndarray, least: int = MIN_LENGTH
              ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, end, period) of all runs, ordered by text, start, period.

    ``words`` are non-negative codes, text j holds words[offsets[j]:offsets[j + 1]].
    """
    sizes = np.diff(offsets)
    order = np.argsort(-sizes, kind="stable")            # long texts first
    at = np.concatenate([[0], np.cumsum(sizes[order] + 1)])
    w = np.empty(int(at[-1]), np.int64)
    for k, j in enumerate(order):
        w[at[k]:at[k + 1] - 1] = words[offsets[j]:offsets[j + 1]]
        w[at[k + 1] - 1] = -1 - k                        # closes the text
    found = [np.empty((3, 0), np.int64)]
    for q in range(1, SMALL + 1):
        s, e = stretches(w, q, 4)
        found.append(np.stack([s, e, np.full(len(s), q)]))

    ids = mix64(w.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
    t = 1
    lengths = sizes[order]
    while True:
        n = int(at[np.searchsorted(-lengths, -8 * t, side="right")])  # texts of 8 t words
        if t >= FIRST_SCALE and n == 0:
            break
        if t >= FIRST_SCALE:
            ids = ids[:max(n - t + 1, 0)]
            s, e, p = np.concatenate(found, axis=1)
            dense = (3 * p <= t) & (e - s >= t) & (s < n)
            inside = _covered(len(ids), s[dense], np.minimum(e[dense] - t + 1, len(ids)))
            i, q = _proposals(ids, members(ids, inside, t), t)
            found.append(_verified(w, at, i, q))
        # windows of 2 t words
        ids = mix64(ids[:-t] * np.uint64(0xD6E8FEB86659FD93) + ids[t:]) if len(ids) > t else ids[:0]
        t *= 2
    more = list(_over_breaks(w, np.concatenate(found, axis=1)))
    if more:
        found.append(_verified(w, at, *np.array(more, np.int64).T))

    s, e, p = np.concatenate(found, axis=1)
    # a stretch found by several periods has the smallest, which divides the others
    first = np.lexsort((p, e, s))
    s, e, p = s[first], e[first], p[first]
    keep = np.ones(len(s), bool)
    keep[1:] = (s[1:] != s[:-1]) | (e[1:] != e[:-1])
    keep &= e - s >= least
    s, e, p = s[keep], e[keep], p[keep]
    k = np.searchsorted(at, s, side="right") - 1
    text = order[k] if len(k) else k
    s, e = s - at[k], e - at[k]
    by = np.lexsort((p, s, text))
    return text[by], s[by], e[by], p[by]


def _verified(w: np.ndarray, at: np.ndarray, i: np.ndarray, q: np.ndarray) -> np.ndarray:
    """All stretches of the proposed periods in the texts that propose them."""
    k = np.searchsorted(at, i, side="right") - 1
    out = [np.empty((3, 0), np.int64)]
    for text, period in np.unique(np.stack([k, q]), axis=1).T if len(k) else ():
        a, b = at[text], at[text + 1]
        s, e = stretches(w[a:b - 1], int(period), 0)
        if len(s):
            out.append(np.stack([s + a, e + a, np.full(len(s), period)]))
    return np.concatenate(out, axis=1)


def _scan(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("doc_id", pa.int64()), ("n_words", pa.int64()),
            ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()),
                                         ("period", pa.int64())]))),
            ("collapsed", pa.string())])
        for table in sized(batches, TEXT_BYTES):
            texts = table.column("text").combine_chunks()
            offsets, vocabulary, codes = tokenize(texts)
            text, s, e, p = find_runs(codes, offsets, least)
            size = int(offsets[-1])
            gone = _covered(size, offsets[text] + s + p, offsets[text] + e) if size else \
                np.empty(0, bool)
            kept = np.flatnonzero(~gone)
            ends = np.searchsorted(kept, offsets)
            lists = pa.ListArray.from_arrays(
                pa.array(ends, pa.int32()), vocabulary.cast(pa.string()).take(pa.array(codes[kept])))
            collapsed = pc.binary_join(lists, " ")
            bounds = np.searchsorted(text, np.arange(len(texts) + 1))
            runs = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.StructArray.from_arrays(
                [pa.array(s), pa.array(e - s), pa.array(p)], names=["start", "length", "period"]))
            yield pa.RecordBatch.from_arrays(
                [table.column("doc_id").combine_chunks().cast(pa.int64()),
                 pa.array(np.diff(offsets)), runs, collapsed], schema=schema)
    return run


def periodic_runs(documents: DataFrame, least: int = MIN_LENGTH) -> DataFrame:
    """doc_id, n_words, runs (start, length, period by start, then period) and
    ``collapsed``, the words left when every run keeps its first period."""
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _scan(least), SCHEMA)


def with_planted_periods(documents: DataFrame) -> DataFrame:
    """``documents`` (doc_id, text) in which the texts picked by the checksum of
    their id repeat a stretch of their own words to the end: with h = crc32 of the
    decimal id, g = h div 10 and n words, texts with h mod 10 = 0 repeat from word
    a = g mod n with period 1 + (n - a) div (3 + g mod 8).  Rows without an id stay.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    g, n = F.floor(F.col("h") / 10), F.size("w")
    cut = documents.select("doc_id", "text", h.alias("h")).withColumn(
        "w", F.when(F.col("h") % 10 == 0, words)).withColumn(
        "a", F.when(n > 0, g % n).cast("int")).withColumn(
        "p", (F.lit(1) + F.floor((n - F.col("a")) / (3 + g % 8))).cast("int"))
    again = F.transform("w", lambda x, i: F.when(i < F.col("a"), x).otherwise(
        F.get("w", F.col("a") + (i - F.col("a")) % F.col("p"))))
    return cut.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(again, " ")).otherwise(
        F.col("text")).alias("text"))
