"""Operator 2: embedding near-dedup over spherical k-means cells.

1. Equal vectors collapse into one class (hash aggregation, combined map-side).
2. Spherical k-means, fitted on a documented bounded sample (``SAMPLE_BYTES``),
   gives unit centroids; every class is assigned to the cell of its nearest
   centroid.
3. A link of cosine >= t can cross from cell c to c' only if the vector lies
   within the angle arccos(t) of the plane that halves c and c':
   ``v.c - v.c' <= sqrt(1 - t^2) |c - c'|``.  Such vectors are copied to c'
   (c < c', so no pair is met twice); the rule is exact, no link is lost.
4. Homes and copies of a cell are dealt into blocks by hash, and each block
   pair is one task of dense cosine products in double precision.  A task
   returns link counts and one tree edge per vector; the components of these
   edges are found by distributed label rounds.

On vectors without cluster structure the plane rule prunes little and step 4
approaches all block pairs; on clustered data most cells never meet.

Defined results: one row per input row.  A vector that is null, zero, empty or
holds null or non-finite components links with nothing, nor do vectors of
different lengths with each other, nor rows with a null vec_id (component_id
null, kept true).  Repeated rows of a vec_id and vector are one vector.  Extra
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import block_pairs, forest, settle
from .common import broadcast_if, int_hash, stored

THRESHOLD = 0.9
#: Mean vectors of a cell, and largest number of cells (of driver-side centroids).
CELL, MAX_CELLS = 2048, 1024
#: Bound of the sample that k-means is fitted on.
SAMPLE_BYTES = 8 << 20
BLOCK = 2048


def fit_centroids(x: np.ndarray, k: int, rounds: int = 8, seed: int = 5) -> np.ndarray:
    """Unit centroids of the unit rows of ``x``."""
    k = min(k, len(x))
    c = x[np.random.default_rng(seed).permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        home = np.argmax(x @ c.T, axis=1)
        total = np.zeros_like(c)
        np.add.at(total, home, x)
        norm = np.linalg.norm(total, axis=1)
        c[norm > 0] = total[norm > 0] / norm[norm > 0, None]
    return c


def _matrix(column) -> np.ndarray:
    """Unit rows in double precision; all lists are of one length."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)
    # scaled first, so that squares neither overflow nor vanish
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _assign(centroids: dict[int, np.ndarray], threshold: float):
    """dim, vector -> home cell, cells to copy to."""
    slack = np.sqrt(1 - threshold ** 2)
    gap = {d: slack * np.linalg.norm(c[:, None] - c[None], axis=2) + 1e-9
           for d, c in centroids.items()}

    def run(batches):
        for b in batches:
            dims = b.column("dim").to_numpy()
            for d in np.unique(dims):
                t = b.filter(pa.array(dims == d))
                home = np.zeros(t.num_rows, np.int32)
                copies = [[] for _ in home]
                if int(d) in centroids:
                    c = centroids[int(d)]
                    s = _matrix(t.column("v")) @ c.T
                    home = np.argmax(s, axis=1).astype(np.int32)
                    near = s[np.arange(len(s)), home][:, None] - s <= gap[int(d)][home]
                    near &= np.arange(len(c))[None] > home[:, None]
                    copies = [np.flatnonzero(r) for r in near]
                yield pa.RecordBatch.from_arrays(
                    [t.column("id"), t.column("w"), t.column("dim"), t.column("v"),
                     pa.array(home), pa.array(copies, pa.list_(pa.int32()))],
                    names=["id", "w", "dim", "v", "home", "copies"])
    return run


def _compare(threshold: float):
    def run(key, t):
        kind, i, j = key[2].as_py(), key[3].as_py(), key[4].as_py()
        side = t.column("side").to_numpy()
        order = np.argsort(side, kind="stable")
        t = t.take(pa.array(order))
        side = side[order]
        ids, w = t.column("id").to_numpy(), t.column("w").to_numpy()
        x = _matrix(t.column("v"))
        alone = kind == 0 and i == j
        n = len(x) if alone else int((side == 0).sum())
        left, right, first = x[:n], (x if alone else x[n:]), (0 if alone else n)
        a, b = [], []
        for at in range(0, n, 512):
            p, q = np.nonzero(left[at:at + 512] @ right.T >= threshold)
            p, q = p + at, q + first
            up = p < q
            a.append(p[up])
            b.append(q[up])
        a, b = (np.concatenate(z) if z else np.empty(0, int) for z in (a, b))
        links = np.zeros(len(x), np.int64)
        np.add.at(links, a, w[b])
        np.add.at(links, b, w[a])
        tree = forest(len(x), a, b)
        hit = links > 0
        return pa.table({"id": ids[hit], "links": links[hit], "parent": ids[tree[hit]]})
    return run


def embedding_dedup(embeddings: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept of every embedding row."""
    spark = embeddings.sparkSession
    v = F.col("embedding")
    ok = F.coalesce(F.col("vec_id").isNotNull() & (F.size(v) > 0)
                    & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x)
                               & (F.abs(x) < float("inf")))
                    & F.exists(v, lambda x: x != 0), F.lit(False))
    rows = embeddings.select("vec_id", v.alias("v"), ok.alias("ok"),
                             F.xxhash64("embedding").alias("k1"),
                             F.xxhash64("embedding", F.lit(1)).alias("k2"))
    members = rows.where("ok").groupBy("vec_id", "k1", "k2").agg(F.first("v").alias("v"))
    classes = stored(members.groupBy("k1", "k2").agg(
        F.min("vec_id").alias("first"), F.count("*").alias("w"), F.first("v").alias("v"))
        .select(F.col("k1").alias("id"), "k2", "first", "w", "v", F.size("v").alias("dim")))
    n, width = classes.agg(F.count("*"), F.max("dim")).first()
    k = int(min(MAX_CELLS, (n or 0) // CELL + 1))
    sample = classes.orderBy(F.xxhash64("id", F.lit(11)), "id").limit(
        max(1, SAMPLE_BYTES // (8 * (width or 1)))).select("dim", "v").toArrow()
    centroids = {}
    for d in set(sample.column("dim").to_pylist()):
        x = _matrix(sample.filter(pa.array(np.equal(sample.column("dim").to_numpy(), d)))
                    .column("v"))
        centroids[d] = fit_centroids(x, k)
    kind = dict(classes.dtypes)["v"]
    placed = stored(classes.select("id", "w", "dim", "v").mapInArrow(
        _assign(centroids, threshold),
        f"id long, w long, dim int, v {kind}, home int, copies array<int>"))
    roles = placed.select("dim", F.explode(F.concat(
        F.array(F.struct(F.col("home").alias("cell"), F.lit(0).alias("role"))),
        F.transform("copies", lambda c: F.struct(c.alias("cell"), F.lit(1).alias("role")))
    )).alias("r"), "id", "w", "v").select("dim", "r.*", "id", "w", "v")
    sizes = roles.groupBy("dim", "cell").agg(
        F.ceil(F.sum(1 - F.col("role")) / BLOCK).cast("int").alias("homes"),
        F.ceil(F.sum("role") / BLOCK).cast("int").alias("guests"))
    grid = roles.join(broadcast_if(sizes, 100_000), ["dim", "cell"])
    home = grid.where("role = 0").withColumn("own", int_hash(F.col("id"), 3, F.col("homes")))
    guest = grid.where("role = 1").withColumn("own", int_hash(F.col("id"), 3, F.col("guests")))
    own = F.col("own").cast("int")
    within = home.select("dim", "cell", F.lit(0).alias("kind"), "id", "w", "v", "own",
                         F.explode(block_pairs(F.col("homes"), own)).alias("p")).withColumn(
        "side", F.when(F.col("p.i") == F.col("p.j"), 0).otherwise((own == F.col("p.j")).cast("int")))
    out = home.where("guests > 0").select(
        "dim", "cell", F.lit(1).alias("kind"), "id", "w", "v", "own",
        F.explode(F.transform(F.sequence(F.lit(0), F.col("guests") - 1), lambda r: F.struct(
            own.alias("i"), r.cast("int").alias("j")))).alias("p")).withColumn("side", F.lit(0))
    into = guest.where("homes > 0").select(
        "dim", "cell", F.lit(1).alias("kind"), "id", "w", "v", "own",
        F.explode(F.transform(F.sequence(F.lit(0), F.col("homes") - 1), lambda h: F.struct(
            h.cast("int").alias("i"), own.alias("j")))).alias("p")).withColumn("side", F.lit(1))
    tasks = within.unionByName(out).unionByName(into).select(
        "dim", "cell", "kind", F.col("p.i").alias("i"), F.col("p.j").alias("j"), "side",
        "id", "w", "v")
    parts = stored(tasks.groupBy("dim", "cell", "kind", "i", "j").applyInArrow(
        _compare(threshold), "id long, links long, parent long"))
    linked = settle(parts).join(classes.select("id", "first"), "id")
    lowest = linked.groupBy("component").agg(F.min("first").alias("component_id"))
    found = classes.join(linked.drop("first").join(lowest, "component"), "id", "left").select(
        F.col("id").alias("k1"), "k2", F.lit(True).alias("ok"),
        (F.coalesce("links", F.lit(0)) + F.col("w") - 1).alias("links"),
        F.coalesce("component_id", "first").alias("component"))
    return rows.select("vec_id", "k1", "k2", "ok").join(found, ["k1", "k2", "ok"], "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component", "vec_id"), F.lit(True)).alias("kept"))
