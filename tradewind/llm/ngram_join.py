"""Operator 9: n-gram Jaccard join with Bayesian candidate pruning.

Documents are sets of five-word shingles; two documents link when the Jaccard
similarity of their sets is 0.8 or more.

1. Equal texts collapse into one class (hash aggregation, combined map-side).
2. 128 MinHash values per class give 32 bands of four; a pair at 0.8 shares no
   band with probability 5e-8.  A band bucket yields one edge per member (to
   its smallest), so the edges are linear in the documents; their components
   hold every candidate pair.
3. Small components are packed together, large ones are dealt into a grid of
   block pairs; each block pair is one task.
4. In a task the MinHash values are compared 16 at a time.  After n values with
   m agreeing (uniform prior) the posterior is Beta(m+1, n-m+1); a pair whose
   probability of reaching 0.8 falls below ``TOLERANCE`` is dropped.
5. The others are verified exactly on their shingle sets (64-bit shingle
   hashes) with integer arithmetic.  Links are counted and joined into
   components; pairs are never emitted.

Defined results: one row per input row.  ``copy_id`` is the smallest doc_id
with the same text, ``class_id`` the smallest doc_id reachable by links,
``n_links`` the number of other documents linked directly (copies included),
``kept`` marks one document per class.  A text of one to four words is one
shingle; null or blank texts have none and link with nothing (blank copies
neither).  Rows with a null doc_id link with nothing (class_id null, kept
true).  A repeated doc_id counts as one document per distinct text.  Extra
columns are ignored.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import block_pairs, forest, settle
from .common import (connected_components, int_hash, stored, tokenize, window_hashes, word_hashes)
from .packed import sized

SHINGLE = 5
#: Links are pairs with Jaccard >= 4/5.
NUM, DEN = 4, 5
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
#: Pairs are dropped below this posterior probability of reaching the threshold.
TOLERANCE = 1e-8
#: MinHash values compared before the next decision.
STEP = 16
#: Documents and shingles of one block, on average.
BLOCK_DOCS, BLOCK_SHINGLES = 2048, 2 << 20
TEXT_BYTES = 4 << 20

_RNG = np.random.default_rng(20_011)
FLIP = _RNG.integers(0, 2 ** 64, HASHES, dtype=np.uint64)
MULT = _RNG.integers(0, 2 ** 64, HASHES, dtype=np.uint64) | np.uint64(1)


def shingle_sets(texts: pa.Array, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, sorted distinct shingle hashes) of every text."""
    off, words, codes = tokenize(texts)
    h = word_hashes(words, 17)[codes]
    grams = window_hashes(h, k)
    sets, n = [], [0]
    for a, b in zip(off[:-1], off[1:]):
        if b - a >= k:
            s = np.unique(grams[a:b - k + 1])
        elif b > a:     # fewer than k words: one shingle of all of them
            s = window_hashes(h[a:b], int(b - a)) ^ np.uint64(b - a)
        else:
            s = np.empty(0, np.uint64)
        sets.append(s)
        n.append(n[-1] + len(s))
    return np.array(n), np.concatenate(sets) if sets else np.empty(0, np.uint64)


def minhashes(off: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """(sets, HASHES) minima; the sets must not be empty."""
    out = np.empty((len(off) - 1, HASHES), np.uint64)
    # runs of documents whose shingles fit the cache
    at = 0
    while at < len(off) - 1:
        to = max(at + 1, int(np.searchsorted(off, off[at] + 65536, "right")) - 1)
        g, starts = grams[off[at]:off[to]], off[at:to] - off[at]
        x = np.empty_like(g)
        for i in range(HASHES):
            np.bitwise_xor(g, FLIP[i], out=x)
            np.multiply(x, MULT[i], out=x)
            out[at:to, i] = np.minimum.reduceat(x, starts)
        at = to
    return out


def least_matches(tolerance: float = TOLERANCE) -> list[tuple[int, int]]:
    """(n, m): after n compared values a pair with fewer than m equal ones is
    dropped.  With a uniform prior P(similarity >= t | m of n) equals
    P(Binomial(n + 1, t) <= m)."""
    t = NUM / DEN
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        below, m = 0.0, 0
        while True:
            below += comb(n + 1, m) * t ** m * (1 - t) ** (n + 1 - m)
            if below >= tolerance:
                break
            m += 1
        out.append((n, m))
    return out


def _bands(batches):
    for t in sized(batches, TEXT_BYTES):
        off, grams = shingle_sets(t.column("text").combine_chunks())
        n = np.diff(off)
        has = n > 0
        sig = minhashes(np.append(off[:-1][has], off[-1]), grams)
        keys = np.zeros((len(sig), BANDS), np.uint64)
        for j in range(ROWS):
            keys = keys * np.uint64(0x9E3779B97F4A7C15) + sig[:, j::ROWS]
        keys ^= np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        lists = pa.ListArray.from_arrays(
            np.concatenate([[0], np.cumsum(has) * BANDS]).astype(np.int32),
            pa.array(keys.view(np.int64).ravel()))
        yield pa.RecordBatch.from_arrays(
            [t.column("doc_id").combine_chunks(), t.column("k1").combine_chunks(),
             t.column("k2").combine_chunks(), pa.array(n.astype(np.int64)), lists],
            names=["doc_id", "k1", "k2", "n", "bands"])


def _sketch(batches):
    """Candidate documents -> shingle set and MinHash values, as bytes."""
    for t in sized(batches, TEXT_BYTES):
        off, grams = shingle_sets(t.column("text").combine_chunks())
        sig = minhashes(off, grams)
        keep = [c for c in t.column_names if c != "text"]
        yield pa.RecordBatch.from_arrays(
            [t.column(c).combine_chunks() for c in keep]
            + [pa.array([grams[a:b].tobytes() for a, b in zip(off[:-1], off[1:])], pa.binary()),
               pa.array([s.tobytes() for s in sig], pa.binary())],
            names=[*keep, "grams", "sig"])


def _candidates(x: np.ndarray, y: np.ndarray, rules) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that outlive the incremental comparison of their MinHash values
    (one row of ``x`` and ``y`` for each hash function)."""
    equal = np.zeros((x.shape[1], y.shape[1]), np.uint8)
    for i in range(STEP):
        equal += x[i][:, None] == y[i][None]
    a, b = np.nonzero(equal >= rules[0][1])
    m = equal[a, b].astype(np.int32)
    for (n, least), at in zip(rules[1:], range(STEP, HASHES, STEP)):
        for i in range(at, at + STEP):
            m += x[i, a] == y[i, b]
        alive = m >= least
        a, b, m = a[alive], b[alive], m[alive]
    return a, b


def _verify(a, b, sets_x, sets_y) -> np.ndarray:
    """Mask of the pairs with Jaccard >= NUM/DEN.

    The shared shingles of all documents involved are numbered; sets become
    0/1 rows over a slice of them and intersections a matrix product.
    """
    ua, ia = np.unique(a, return_inverse=True)
    ub, ib = np.unique(b, return_inverse=True)
    na = np.array([len(sets_x[i]) for i in ua])
    nb = np.array([len(sets_y[i]) for i in ub])
    if len(a) * 4 < len(ua) + len(ub) or len(a) < 64:
        inter = np.array([len(np.intersect1d(sets_x[i], sets_y[j], assume_unique=True))
                          for i, j in zip(a, b)], np.int64)
    else:
        gx, gy = np.concatenate([sets_x[i] for i in ua]), np.concatenate([sets_y[i] for i in ub])
        rx, ry = np.repeat(np.arange(len(ua)), na), np.repeat(np.arange(len(ub)), nb)
        both = np.intersect1d(gx, gy)
        inter = np.zeros(len(a), np.float32)

        def column(g, r):
            c = np.searchsorted(both, g)
            ok = c < len(both)
            ok[ok] = both[c[ok]] == g[ok]
            order = np.argsort(c[ok], kind="stable")
            return c[ok][order], r[ok][order]
        cx, rx = column(gx, rx)
        cy, ry = column(gy, ry)
        width = max(1, (8 << 20) // (len(ua) + len(ub)))
        for lo in range(0, len(both), width):
            mats = []
            for c, r, n in ((cx, rx, len(ua)), (cy, ry, len(ub))):
                p, q = np.searchsorted(c, [lo, lo + width])
                m = np.zeros((n, width), np.float32)
                m[r[p:q], c[p:q] - lo] = 1
                mats.append(m)
            for at in range(0, len(ua), 1024):
                part = mats[0][at:at + 1024] @ mats[1].T
                sel = (ia >= at) & (ia < at + 1024)
                inter[sel] += part[ia[sel] - at, ib[sel]]
        inter = inter.astype(np.int64)
    total = na[ia] + nb[ib]
    return (NUM + DEN) * inter >= NUM * total


def _compare(key, t):
    i, j = key[1].as_py(), key[2].as_py()
    t = t.take(pa.array(np.lexsort((t.column("id").to_numpy(), t.column("side").to_numpy()))))
    once = np.append(True, np.diff(t.column("id").to_numpy()) != 0)  # input rows may repeat
    t = t.filter(pa.array(once))
    ids, w = t.column("id").to_numpy(), t.column("w").to_numpy()
    sig = np.ascontiguousarray(np.frombuffer(
        b"".join(t.column("sig").to_pylist()), np.uint64).reshape(-1, HASHES).T)
    sets = [np.frombuffer(g, np.uint64) for g in t.column("grams").to_pylist()]
    n = len(ids) if i == j else int((t.column("side").to_numpy() == 0).sum())
    first = 0 if i == j else n
    rules = least_matches()
    found = []
    for p in range(0, n, 512):
        for q in range(p if i == j else first, len(ids), 2048):
            a, b = _candidates(sig[:, p:min(p + 512, n)], sig[:, q:q + 2048], rules)
            a, b = a + p, b + q
            up = a < b
            a, b = a[up], b[up]
            if len(a):
                ok = _verify(a, b, sets, sets)
                found.append(np.stack([a[ok], b[ok]]))
    a, b = np.concatenate(found, axis=1) if found else np.empty((2, 0), int)
    links = np.zeros(len(ids), np.int64)
    np.add.at(links, a, w[b])
    np.add.at(links, b, w[a])
    tree = forest(len(ids), a, b)
    hit = links > 0
    return pa.table({"id": ids[hit], "links": links[hit], "parent": ids[tree[hit]]})


def ngram_join(documents: DataFrame) -> DataFrame:
    """doc_id, copy_id, class_id, n_links, kept, tag and lead of every document row.

    ``tag`` is the hash of the row's text; ``lead`` marks the rows whose text leads
    its class (of the texts of the smallest doc_id, the one with the smallest hash).
    """
    docs = documents.select("doc_id", "text", F.xxhash64("text").alias("k1"),
                            F.xxhash64("text", F.lit(1)).alias("k2"))
    live = docs.where("doc_id is not null and text is not null")
    rows = stored(live.mapInArrow(_bands, "doc_id long, k1 long, k2 long, n long, "
                                          "bands array<long>"))
    # one class per text; its id is the 64-bit text hash
    classes = stored(rows.where("n > 0").groupBy("k1", "k2").agg(
        F.min("doc_id").alias("first"), F.count_distinct("doc_id").alias("w"),
        F.first("n").alias("n"), F.first("bands").alias("bands"))
        .withColumnRenamed("k1", "id"))
    keyed = classes.select("id", F.explode("bands").alias("band"))
    least = keyed.groupBy("band").agg(F.min("id").alias("low"), F.count("*").alias("members"))
    near = keyed.join(least.where("members > 1").drop("members"), "band").where(
        "id <> low").select("id", "low")
    group = connected_components(near, "id", "low")
    size = group.join(classes.select("id", "n"), "id").groupBy("component").agg(
        F.count("*").alias("docs"), F.sum("n").alias("grams"))
    # whole small components share a block, large ones get a grid of their own
    blocks = F.greatest(F.ceil(F.col("docs") / BLOCK_DOCS),
                        F.ceil(F.col("grams") / BLOCK_SHINGLES)).cast("int")
    size = stored(size.withColumn("blocks", blocks))
    total = size.where("blocks = 1").agg(F.sum("docs"), F.sum("grams")).first()
    bins = max((total[0] or 0) // BLOCK_DOCS, (total[1] or 0) // BLOCK_SHINGLES) + 1
    placed = group.join(size, "component").select(
        "id", F.when(F.col("blocks") > 1, F.col("component")).otherwise(
            int_hash(F.col("component"), 5, int(bins))).alias("bin"), "blocks",
        int_hash(F.col("id"), 9, F.col("blocks")).cast("int").alias("own"))
    chosen = stored(placed.join(classes.select("id", "k2", "first", "w"), "id"))
    texts = live.select("doc_id", "text", F.col("k1").alias("id"), "k2").join(
        chosen.withColumnRenamed("first", "doc_id").hint("merge"), ["doc_id", "id", "k2"])
    sketched = texts.select("id", "w", "bin", "blocks", "own", "text").mapInArrow(
        _sketch, "id long, w long, bin long, blocks int, own int, grams binary, sig binary")
    tasks = sketched.select("*", F.explode(block_pairs(F.col("blocks"), F.col("own"))).alias("p"))
    tasks = tasks.select(
        F.when(F.col("blocks") > 1, F.xxhash64("bin", F.lit(1))).otherwise(F.col("bin"))
        .alias("bin"), F.col("p.i").alias("i"), F.col("p.j").alias("j"),
        F.when(F.col("p.i") == F.col("p.j"), 0).otherwise(
            (F.col("own") == F.col("p.j")).cast("int")).alias("side"), "id", "w", "grams", "sig")
    parts = stored(tasks.groupBy("bin", "i", "j").applyInArrow(
        _compare, "id long, links long, parent long"))
    linked = settle(parts).join(classes.select("id", "first"), "id")
    lowest = linked.groupBy("component").agg(F.min(F.struct("first", "id")).alias("l")).select(
        "component", F.col("l.first").alias("class_id"), F.col("l.id").alias("lead_id"))
    found = classes.join(linked.drop("first").join(lowest, "component"), "id", "left").select(
        F.col("id").alias("k1"), "k2", F.col("first").alias("copy"),
        (F.coalesce("links", F.lit(0)) + F.col("w") - 1).alias("links"),
        F.coalesce("class_id", "first").alias("class"),
        F.coalesce(F.col("id") == F.col("lead_id"), F.lit(True)).alias("lead"))
    out = docs.select("doc_id", "k1", "k2", F.col("doc_id").isNotNull().alias("ok")).join(
        found.withColumn("ok", F.lit(True)), ["k1", "k2", "ok"], "left")
    return out.select(
        "doc_id", F.coalesce("copy", "doc_id").alias("copy_id"),
        F.coalesce("class", "doc_id").alias("class_id"),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce(F.col("doc_id") == F.coalesce("class", "doc_id"), F.lit(True)).alias("kept"),
        F.col("k1").alias("tag"), F.coalesce("lead", F.lit(True)).alias("lead"))
