"""Operator 12: hard-negative mining with anchor spanning-tree bounds.

Rows with an id, a label and a vector of finite components take part; every component
x counts as floor(256 x) and a score is the integer inner product of two vectors.
Anchors are the stated query rows (``anchor`` divides their id).  An anchor's positives
are its first ``POSITIVES`` other rows of its label, and for each of them the first
``NEGATIVES`` rows of other labels whose score lies within [LOW, 1] times the positive's
score are its hard negatives; higher scores come first, ties by smaller id.

1. *Blocks.*  Anchors and rows are dealt into blocks by hash; each pair of blocks is a
   task, so every anchor meets every row once and no task holds more than two blocks.
   The search for positives deals within labels, so a hot label is many blocks.
2. *Spanning tree.*  A task spans its anchors by a minimum tree of Euclidean distances.
   With e the edge from parent p to child a, ``|<a, c> - <p, c>| <= |e| |c|``: the score
   at the parent, plus or minus edge length times norm, bounds the child's score of
   every row c; bounds widen edge by edge until a row is scored again.
3. *Windows.*  Only rows whose bounds meet the anchor's window are scored at it: for
   positives, what may beat the fifth best lower bound; for negatives, the stated window
   of the positives.  (When most rows of a chunk do, the chunk is scored in one product.)
   The bounds only skip work, so the result is exact; unclustered vectors have long
   edges, and then nearly every row is scored.
4. Tasks return at most five rows for an anchor (25 with its positives), which meet by
   anchor; a rank limit applies before and after that shuffle.

Defined results: vectors of different lengths do not meet; empty vectors score 0.
Identical rows count once; rows that share an id but differ count each, and each anchor
row of a repeated id returns its own rows.  "Other" rows are those with another id.
An anchor without positives, or a positive without rows in its window, returns nothing.
Scores beyond 64 bits fail the query (they cannot be returned as long).  Extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if, int_hash, stored

SCALE, QUERIES = 256, 100
POSITIVES, NEGATIVES = 5, 5
#: Window of a negative in hundredths of the positive's score.
LOW, HIGH = 80, 100
#: Anchors and rows of a block, rows scored at once.
ANCHOR_BLOCK, ROW_BLOCK, CHUNK = 2048, 16384, 4096

FOUND = pa.schema([("akey", pa.int64()), ("positive", pa.int32()), ("id", pa.int64()),
                   ("key", pa.int64()), ("score", pa.int64())])


def spanning_tree(x: np.ndarray) -> list[tuple[int, int, float]]:
    """(node, parent, edge length) of a minimum spanning tree, every parent before its
    children and depth first; the root has parent -1."""
    n = len(x)
    square = np.einsum("ij,ij->i", x, x)
    near = np.full(n, np.inf)
    parent = np.full(n, -1)
    children: list[list[int]] = [[] for _ in range(n)]
    waits = np.ones(n, bool)
    node = 0
    for _ in range(n):
        waits[node] = False
        if parent[node] >= 0:
            children[parent[node]].append(node)
        apart = np.maximum(square + square[node] - 2 * (x @ x[node]), 0)
        closer = waits & (apart < near)
        near[closer], parent[closer] = apart[closer], node
        left = np.where(waits, near, np.inf)
        node = int(np.argmin(left))
    out, stack = [], [0] if n else []
    while stack:
        j = stack.pop()
        edge = float(np.linalg.norm(x[j] - x[parent[j]])) if parent[j] >= 0 else 0.0
        out.append((j, int(parent[j]), edge))
        stack.extend(reversed(children[j]))
    return out


class Scores:
    """Exact integer scores of a chunk's rows at an anchor."""

    def __init__(self, rows: np.ndarray, anchors: np.ndarray):
        most = max((float(np.abs(m).max()) if m.size else 0.0) for m in (rows, anchors))
        self.wide = rows.shape[1] * most * most >= 2.0 ** 53
        self.rows, self.anchors = rows, anchors
        if self.wide:    # beyond exact doubles: whole Python numbers
            self.rows, self.anchors = (np.array([[int(v) for v in r] for r in m], object).reshape(
                m.shape) for m in (rows, anchors))

    def at(self, j: int, which: np.ndarray | slice) -> np.ndarray:
        s = self.rows[which] @ self.anchors[j]
        return s.astype(np.int64) if not self.wide else np.array([_long(v) for v in s], np.int64)


def _long(v: int) -> int:
    if not -2 ** 63 <= v < 2 ** 63:
        raise OverflowError("a score does not fit in 64 bits")
    return int(v)


def walk(tree: list[tuple[int, int, float]], rows: np.ndarray, anchors: np.ndarray, window
         ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(anchor, row numbers, scores) for every anchor of the tree: the rows whose bounds
    meet its window.  ``window(anchor, low, high)`` gives that window from the bounds."""
    score = Scores(rows, anchors)
    norm = np.linalg.norm(rows, axis=1) if rows.shape[1] else np.zeros(len(rows))
    open_children = np.bincount([p for _, p, _ in tree if p >= 0], minlength=len(tree))
    kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for j, p, edge in tree:
        if p < 0:
            which = np.arange(len(rows))
            exact = score.at(j, slice(None))
            guess, reach = exact.astype(float), np.zeros(len(rows))
        else:
            guess, reach = kept[p]
            open_children[p] -= 1
            if not open_children[p]:
                del kept[p]
            # the last term covers the rounding of the doubles
            reach = reach + edge * norm * (1 + 1e-9) + 1e-9 * np.abs(guess) + 1e-6
            low, high = window(j, guess - reach, guess + reach)
            meets = (guess + reach >= low) & (guess - reach <= high)
            many = 2 * np.count_nonzero(meets) > len(rows)
            which = np.arange(len(rows)) if many else np.flatnonzero(meets)
            exact = score.at(j, slice(None) if many else which)
            if open_children[j]:
                guess, reach = guess.copy(), reach
                guess[which], reach[which] = exact, 0
        if open_children[j]:
            kept[j] = guess, reach
        yield j, which, exact


def _matrix(column) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(SCALE * x).reshape(len(lists), -1 if len(x) else 0)


def _first(score: np.ndarray, ids: np.ndarray, keys: np.ndarray, n: int) -> np.ndarray:
    """The first ``n`` by score, id, key."""
    return np.lexsort((keys, ids, -score))[:n]


def _longs(t: pa.Table, name: str) -> np.ndarray:
    return t.column(name).to_numpy().astype(np.int64)


def _positives(key, anchors: pa.Table, rows: pa.Table) -> pa.Table:
    a, ids, keys = _matrix(anchors.column("v")), _longs(rows, "vec_id"), _longs(rows, "key")
    mine, names = _longs(anchors, "vec_id"), _longs(anchors, "key")
    x = _matrix(rows.column("v"))
    tree = spanning_tree(a) if len(x) else []
    best: list[tuple] = [(np.empty(0, np.int64),) * 3 for _ in mine]
    for at in range(0, len(x), CHUNK):
        some = slice(at, at + CHUNK)
        own_ids, own_keys = ids[some], keys[some]

        def window(j, low, high):
            rest = np.concatenate([low[own_ids != mine[j]], best[j][0]])
            k = len(rest) - POSITIVES
            return (np.partition(rest, k)[k] if k > 0 else -np.inf), np.inf

        for j, which, s in walk(tree, x[some], a, window):
            other = own_ids[which] != mine[j]
            which, s = which[other], s[other]
            s, i, k = (np.concatenate(z) for z in zip(
                best[j], (s, own_ids[which], own_keys[which])))
            top = _first(s, i, k, POSITIVES)
            best[j] = s[top], i[top], k[top]
    n = [len(b[0]) for b in best]
    s, i, k = (np.concatenate([b[c] for b in best]) if best else np.empty(0, np.int64)
               for c in range(3))
    return pa.table({"akey": np.repeat(names, n), "positive": np.zeros(len(s), np.int32),
                     "id": i, "key": k, "score": s}, schema=FOUND)


def _negatives(key, anchors: pa.Table, rows: pa.Table) -> pa.Table:
    a, ids, keys = _matrix(anchors.column("v")), _longs(rows, "vec_id"), _longs(rows, "key")
    labels, mine = _longs(rows, "label"), _longs(anchors, "label")
    names = _longs(anchors, "key")
    targets = [np.array(p, np.int64) for p in anchors.column("scores").to_pylist()]
    x = _matrix(rows.column("v"))
    tree = spanning_tree(a) if len(x) else []
    none = (np.empty(0, np.int64),) * 3
    best = [[none for _ in t] for t in targets]
    # in doubles, a little wider than the exact test below
    bounds = [(LOW * (min(t[t >= 0], default=np.inf) - 1) / 100, max(t[t >= 0], default=-np.inf) + 1)
              for t in targets]
    for at in range(0, len(x), CHUNK):
        some = slice(at, at + CHUNK)
        for j, which, s in walk(tree, x[some], a, lambda j, low, high: bounds[j]):
            fits = (s >= bounds[j][0]) & (s <= bounds[j][1]) & (labels[some][which] != mine[j])
            s, i, k = s[fits], ids[some][which[fits]], keys[some][which[fits]]
            order = _first(s, i, k, len(s))
            s, i, k = s[order], i[order], k[order]
            for r, target in enumerate(targets[j].tolist()):
                start = int(np.searchsorted(-s, -target, side="left"))
                end = start
                while end < min(len(s), start + NEGATIVES) and (
                        LOW * target <= 100 * int(s[end]) <= HIGH * target):
                    end += 1
                if end > start:
                    z = [np.concatenate([o, n[start:end]]) for o, n in zip(best[j][r], (s, i, k))]
                    top = _first(*z, NEGATIVES)
                    best[j][r] = tuple(c[top] for c in z)
    flat = [(names[j], r, b) for j, bs in enumerate(best) for r, b in enumerate(bs) if len(b[0])]
    n = [len(b[0]) for _, _, b in flat]
    s, i, k = (np.concatenate([b[c] for _, _, b in flat]) if flat else np.empty(0, np.int64)
               for c in range(3))
    return pa.table({
        "akey": np.repeat(np.array([f[0] for f in flat], np.int64), n),
        "positive": np.repeat(np.array([f[1] for f in flat], np.int32), n),
        "id": i, "key": k, "score": s}, schema=FOUND)


def _search(anchors: DataFrame, rows: DataFrame, within: list[str], task) -> DataFrame:
    """``task`` over every pair of an anchor block and a row block with equal ``within``."""
    blocks = rows.groupBy(*within).agg(
        F.ceil(F.count("*") / ROW_BLOCK).cast("int").alias("row_blocks")).join(
        anchors.groupBy(*within).agg(F.ceil(F.count("*") / ANCHOR_BLOCK).cast("int").alias(
            "anchor_blocks")), within)
    blocks = broadcast_if(blocks, 100_000)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = anchors.join(blocks, within).withColumn(
        "i", int_hash(F.col("key"), 3, F.col("anchor_blocks")).cast("int")).withColumn(
        "j", every("row_blocks"))
    right = rows.join(blocks, within).withColumn(
        "j", int_hash(F.col("key"), 5, F.col("row_blocks")).cast("int")).withColumn(
        "i", every("anchor_blocks"))
    left = left.toDF(*left.columns)      # columns of its own: both sides read one table
    keys = [*within, "i", "j"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        task, "akey long, positive int, id long, key long, score long")


def hard_negatives(embeddings: DataFrame, anchor: int = QUERIES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    v = F.col("embedding")
    ok = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = stored(embeddings.where(ok).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        v.alias("v"), F.size(v).alias("dim")).distinct().withColumn(
        "key", F.xxhash64("vec_id", "label", "v")))
    anchors = rows.where(F.col("vec_id") % anchor == 0)
    best = Window.partitionBy("akey", "positive").orderBy(F.desc("score"), "id", "key")
    near = stored(_search(anchors, rows, ["dim", "label"], _positives).withColumn(
        "rank", F.row_number().over(best)).where(F.col("rank") <= POSITIVES))
    listed = near.groupBy("akey").agg(F.array_sort(F.collect_list(F.struct(
        "rank", "id", "score"))).alias("near"))
    searching = stored(anchors.join(listed, anchors["key"] == listed["akey"]).select(
        "vec_id", "label", "v", "dim", "key", "near", F.col("near.score").alias("scores")))
    hard = _search(searching.drop("near"), rows, ["dim"], _negatives).withColumn(
        "rank", F.row_number().over(best)).where(F.col("rank") <= NEGATIVES)
    named = searching.select(F.col("key").alias("akey"), F.col("vec_id").alias("anchor_id"),
                             F.posexplode("near").alias("positive", "p"))
    return hard.join(named, ["akey", "positive"]).select(
        "anchor_id", F.col("p.id").alias("positive_id"), "rank", F.col("id").alias("negative_id"),
        F.col("p.score").alias("positive_score"), F.col("score").alias("negative_score"))


def with_shifted_labels(embeddings: DataFrame) -> DataFrame:
    """``embeddings`` in which every seventh id has the next of ten labels."""
    return embeddings.withColumn("label", F.when(
        F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
