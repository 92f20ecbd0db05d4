"""Helpers shared by the operators: written tables, tokens, components."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.session import ensure_checkpoint_dir

#: Contract word pattern: maximal runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder, read it
    back: cuts the lineage, survives lost executors, computes the plan once."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def broadcast_if(df: DataFrame, rows: int) -> DataFrame:
    """``df`` written once; hinted for broadcast when it has at most ``rows``
    rows (counted), else left to a shuffle join."""
    kept = stored(df)
    return F.broadcast(kept) if kept.limit(rows + 1).count() <= rows else kept


def int_hash(col: Column, seed: int, n: Column | int) -> Column:
    """Deterministic number in [0, n) from a column."""
    return F.pmod(F.xxhash64(col, F.lit(seed)), F.lit(n) if isinstance(n, int) else n)


def tokenize(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """ASCII-white-space words of every text, all in Arrow.

    Returns (offsets of n+1 entries, unique words, code of every word).  Null
    and blank texts have no words.
    """
    filled = pc.fill_null(texts.cast(pa.large_string()), "")
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(filled))
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    offsets = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    words = lists.values[offsets[0]:offsets[-1]] if len(offsets) else lists.values
    offsets = offsets - offsets[0]
    blank = pc.equal(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    if blank.any():  # a blank text splits into one empty word
        kept = np.concatenate([[0], np.cumsum(~blank)])
        offsets = kept[offsets]
        words = words.filter(pa.array(~blank))
    coded = words.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return offsets, coded.dictionary, codes


def word_hashes(words: pa.Array, seed: int) -> np.ndarray:
    """64-bit hash of each (unique) word."""
    h = xxhash.xxh64_intdigest
    return np.fromiter((h(w.encode(), seed) for w in words.to_pylist()),
                       dtype=np.uint64, count=len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer spreading every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def window_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive words (length n-k+1)."""
    n = len(hashes)
    if n < k:
        return np.empty(0, np.uint64)
    out = np.zeros(n - k + 1, np.uint64)
    base = np.uint64(0x9E3779B97F4A7C15)
    for j in range(k):
        out *= base
        out += hashes[j:n - k + 1 + j]
    return mix64(out)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b",
                         max_rounds: int = 60) -> DataFrame:
    """(id, component) for every node of an undirected edge list; the component
    is the smallest reachable id.

    Alternating large-star / small-star rounds: each is two hash aggregations
    (``min`` per node, combined map-side) and joins back on the node, so a hub
    is reduced before the shuffle and AQE may split the join.  Every round is a
    written table.  Stops when a round changes nothing; raises rather than
    return unfinished components.
    """
    def star(e: DataFrame, large: bool) -> DataFrame:
        if large:   # every neighbour of u, from both ends
            nb = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
                e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        else:       # only neighbours not above u (a > b in every stored edge)
            nb = e.select(F.col("a").alias("u"), F.col("b").alias("v"))
        low = nb.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m"))
        linked = nb.join(low, "u")
        if large:
            out = linked.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            out = linked.select(F.col("v").alias("a"), F.col("m").alias("b")).unionAll(
                low.select(F.col("u").alias("a"), F.col("m").alias("b")))
        return out.where("a <> b").distinct()

    e = stored(edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
               .where("a <> b").distinct())
    mark = None
    for _ in range(max_rounds):
        e = stored(star(star(e, True), False))
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == mark:
            return e.select(F.col("a").alias("id"), F.col("b").alias("component")).unionAll(
                e.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
        mark = tuple(now)
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
