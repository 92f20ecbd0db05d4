"""Operator 3: mixing sources to target weights by Sainte-Lague apportionment.

Sources, in code point order with null last, weigh 5, 2, 1, repeating, and share
all words by weight; a target stops at 3 times its source's size and the excess
is shared again by weight until no target is above.

1. The targets are cut into equal blocks (``block`` words, fewer when the
   smallest target would not fill 256 blocks), and the blocks go to the sources
   with the highest quotients target / (2 k + 1).
2. Each source's blocks are apportioned in the same way to its shards (cells of
   about ``CELL`` documents chosen by hash), by the words of the shard.
3. In a shard the documents stand in a seeded order; whole rounds take every
   word of the shard, the remaining blocks take the words from the front.

Only quotients near the proportional share are listed (their number is bounded
by five per party), so no list grows with the blocks.  A hot source has many
shards; no window holds more than one shard.  Reruns agree.

Defined results: one row per input row, repeated rows each counted.  Null or
blank text has size 0 and takes 0.  A null source is a source of its own.
Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, broadcast_if, stored

WEIGHTS = (5, 2, 1)
MOST = 3
BLOCK, CELL, SEED = 1024, 4096, 17


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def apportion(parties: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """Adds ``seats`` to rows with ``weight`` and ``total`` (seats of the group):
    the highest quotients weight / (2 k + 1) win, ties by ``order``.

    A divisor method moves a party from its share p * total by at most
    p * parties / 2 + 1 seats, so only these quotients are ranked.
    """
    w = Window.partitionBy(*group)
    near = (parties.withColumn("_p", F.col("weight") / F.sum("weight").over(w))
            .withColumn("_reach", F.ceil(F.col("_p") * F.count("*").over(w) / 2) + 2)
            .withColumn("_base", F.greatest(
                F.lit(0), F.floor(F.col("_p") * F.col("total") + 0.5) - F.col("_reach")))
            .withColumn("_left", F.col("total") - F.sum("_base").over(w)))
    ranked = near.select(*group, *order, "weight", "_left", F.explode(F.sequence(
        F.col("_base"), F.col("_base") + 2 * F.col("_reach"))).alias("_k")).withColumn(
        "_rank", F.row_number().over(w.orderBy(
            F.desc(F.col("weight") / (2 * F.col("_k") + 1)), *order)))
    won = ranked.where("_rank <= _left").groupBy(*group, *order).agg(F.count("*").alias("_won"))
    return near.join(won, [*group, *order], "left").withColumn(
        "seats", F.coalesce(F.col("_base") + F.coalesce("_won", F.lit(0)), F.lit(0))).drop(
        "_p", "_reach", "_base", "_left", "_won")


def targets(sources: DataFrame) -> DataFrame:
    """Adds ``target`` to one row per source (``src``, ``source_size``)."""
    everything = Window.partitionBy(F.lit(0))
    by_name = everything.orderBy("src")
    by_level = everything.orderBy("level")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)),
                          ((F.row_number().over(by_name) - 1) % len(WEIGHTS) + 1).cast("int"))
    rows = (sources.withColumn("w", weight)
            .withColumn("cap", MOST * F.col("source_size"))
            .withColumn("level", F.col("cap") / F.col("w")))
    # sources are capped in the order of cap / weight; the rest shares by weight
    below = by_level.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    share = (rows.withColumn("open_w", F.sum("w").over(everything) - F.sum("w").over(below) + F.col("w"))
             .withColumn("open_size", F.sum("source_size").over(everything)
                         - F.sum("cap").over(below) + F.col("cap")))
    # with ties of level any of the tied rows gives the same decision
    capped = F.col("cap") * F.col("open_w") <= F.col("open_size") * F.col("w")
    share = share.withColumn("capped", capped)
    rest = F.sum(F.when(~F.col("capped"), F.col("w"))).over(everything)
    words = F.sum("source_size").over(everything) - F.coalesce(
        F.sum(F.when(F.col("capped"), F.col("cap"))).over(everything), F.lit(0))
    return share.withColumn("target", F.when(F.col("capped"), F.col("cap").cast("double"))
                            .otherwise(words * F.col("w") / rest)).select(
        "src", "source_size", "docs", "target")


def mix_sources(documents: DataFrame, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken and text_key of every document row."""
    src = F.struct(F.col("source").isNull().alias("none"),
                   F.coalesce("source", F.lit("")).alias("name"))
    docs = stored(documents.select(
        "doc_id", src.alias("src"), word_count(F.col("text")).alias("size"),
        F.xxhash64("text").alias("text_key")))
    per = targets(docs.groupBy("src").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("docs")))
    per = stored(per.withColumn("shards", F.ceil(F.col("docs") / CELL)))
    every = F.col("target") > 0
    least, total = per.where(every).agg(F.min("target"), F.sum("target")).first()
    words = max(1, min(block, int((least or 0) // 256)))
    seats = apportion(per.where(every).select("src", F.col("target").alias("weight"), F.lit(
        int((total or 0) / words + 0.5)).alias("total"), F.lit(0).alias("all")), ["all"], ["src"])
    docs = docs.join(broadcast_if(per.drop("docs"), 50_000), "src").withColumn(
        "shard", F.pmod(F.xxhash64("doc_id", "text_key", F.lit(seed)), F.col("shards")))
    cells = docs.groupBy("src", "shard").agg(F.sum("size").alias("words"))
    quota = apportion(cells.join(seats.select("src", F.col("seats").alias("total")), "src").select(
        "src", "shard", "words", F.col("words").cast("double").alias("weight"), "total")
        .where("words > 0"), ["src"], ["shard"]).select(
        "src", "shard", "words",
        F.least(F.col("seats") * words, MOST * F.col("words")).alias("take"))
    front = Window.partitionBy("src", "shard").orderBy(
        F.xxhash64("doc_id", "text_key", F.lit(seed + 1)), "doc_id", "text_key").rowsBetween(
        Window.unboundedPreceding, -1)
    laid = docs.withColumn("before", F.coalesce(F.sum("size").over(front), F.lit(0)))
    out = laid.join(broadcast_if(quota, 50_000), ["src", "shard"], "left")
    rest = F.col("take") % F.col("words") - F.col("before")
    taken = F.floor(F.col("take") / F.col("words")) * F.col("size") + F.least(
        F.greatest(rest, F.lit(0)), F.col("size"))
    return out.select("doc_id", "size", "source_size", "target",
                      F.coalesce(taken, F.lit(0)).cast("long").alias("taken"), "text_key")
