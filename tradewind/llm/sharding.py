"""Operator 8 [native]: sharding by a minimax contiguous partition.

Equal texts stay together: the atomic groups are the texts that share the first
``UNIT_BITS`` bits of the text hash, ordered by hash; at most 65,536 groups,
whatever the input holds.  The law is ``bytes``: shard sizes are near equal.

1. One aggregation (combined map-side) gives rows and bytes of each group.
2. A group as large as an even share of what remains (copies of one text may be
   a third of all rows) gets a shard of its own, the last ones.
3. The smallest feasible capacity of the other shards is found by interval
   search; a capacity is checked greedily over the ordered group sizes.
4. The cuts are made under that capacity, each as near to an even split of the
   rest as the capacity of the remaining shards allows.
5. A row's slot is the offset of its group in the shard, of its part in the
   group and its rank in the part; large groups are dealt into parts by
   document hash, so no task ranks a whole shard or group.

Only DataFrame functions run; the driver sees the two ends of the search
interval and the cuts.  The sizes are one array of at most 65,536 numbers.

Defined results: all input columns but those named like a result column, which
are replaced.  Null text counts as an empty text.  Null or repeated doc_ids get
slots like any other row.  An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

SHARDS = 40
UNIT_BITS = 16
OVERHEAD = 16
#: Rows that one task ranks, on average.
PART = 4096
RESULT = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


def _state(**fields: Column) -> Column:
    return F.struct(*(c.alias(n) for n, c in fields.items()))


def _shards_used(sizes: Column, capacity: Column) -> Column:
    """Greedy check: shards that the ordered sizes fill at this capacity."""
    return F.aggregate(
        sizes, _state(used=F.lit(1), fill=F.lit(0).cast("long")),
        lambda s, x: F.when(s["fill"] + x > capacity, _state(used=s["used"] + 1, fill=x))
        .otherwise(_state(used=s["used"], fill=s["fill"] + x)))["used"]


def smallest_capacity(sizes: DataFrame, shards: int, lo: int, hi: int, ways: int = 16) -> int:
    """Smallest capacity in [lo, hi] at which the array ``sizes`` (one row) fits
    into ``shards`` shards; every pass tries up to ``ways`` capacities."""
    while lo < hi:
        step = (hi - lo) // ways + 1
        fits = sizes.select("sizes", F.explode(F.sequence(
            F.lit(lo), F.lit(hi - 1), F.lit(step))).alias("c")).where(
            _shards_used(F.col("sizes"), F.col("c")) <= shards).agg(F.min("c")).first()[0]
        if fits is None:    # feasibility is monotonic: above the last one tried
            lo = lo + (hi - 1 - lo) // step * step + 1
        else:
            lo, hi = max(lo, fits - step + 1), fits
    return lo


def _latest(sizes: Column, capacity: int) -> Column:
    """m-th number: the first group from which m shards hold all the rest."""
    return F.aggregate(
        F.reverse(sizes), _state(at=F.size(sizes), fill=F.lit(0).cast("long"),
                                 cuts=F.array().cast("array<int>")),
        lambda s, x: F.when(
            s["fill"] + x > capacity,
            _state(at=s["at"] - 1, fill=x, cuts=F.array_append(s["cuts"], s["at"])))
        .otherwise(_state(at=s["at"] - 1, fill=s["fill"] + x, cuts=s["cuts"])))["cuts"]


def _starts(sizes: Column, latest: Column, shards: int, capacity: int) -> Column:
    """Numbers (from 0) of the groups at which shards 1, 2, ... begin."""
    def step(s: Column, x: Column) -> Column:
        others = F.lit(shards - 1) - F.size(s["cuts"])      # shards after this one
        fits = F.when(others > F.size(latest), True).when(others < 1, False).otherwise(
            s["at"] >= F.element_at(latest, F.greatest(others, F.lit(1))))
        # the group's middle lies beyond an even split of the rest
        even = (2 * s["fill"] + x) * (others + 1) > 2 * s["rest"]
        new = (s["fill"] + x > capacity) | (fits & even & (s["fill"] > 0))
        return F.when(new, _state(at=s["at"] + 1, fill=x, rest=s["rest"] - s["fill"],
                                  cuts=F.array_append(s["cuts"], s["at"]))).otherwise(
            _state(at=s["at"] + 1, fill=s["fill"] + x, rest=s["rest"], cuts=s["cuts"]))

    total = F.aggregate(sizes, F.lit(0).cast("long"), lambda s, x: s + x)
    return F.aggregate(sizes, _state(
        at=F.lit(0), fill=F.lit(0).cast("long"), rest=total,
        cuts=F.array().cast("array<int>")), step)["cuts"]


def place_units(units: DataFrame, shards: int) -> DataFrame:
    """Adds ``shard`` to the groups (``unit``, ``bytes``), at most 2 ** UNIT_BITS rows."""
    whole = Window.partitionBy(F.lit(0))
    down = whole.orderBy(F.desc("bytes"), "unit")
    ranked = units.withColumn("rank", F.row_number().over(down)).withColumn(
        "rest", F.sum("bytes").over(whole) - F.sum("bytes").over(
            down.rowsBetween(Window.unboundedPreceding, Window.currentRow)) + F.col("bytes"))
    alone = (F.col("bytes") * (shards + 1 - F.col("rank")) >= F.col("rest")) & (
        F.col("rank") < shards)
    ranked = stored(ranked.withColumn("alone", alone).withColumn(
        "at", F.row_number().over(Window.partitionBy("alone").orderBy("unit")) - 1))
    n_alone, n, total, largest = ranked.agg(
        F.count_if("alone"), F.count_if(~F.col("alone")),
        F.sum(F.when(~F.col("alone"), F.col("bytes"))),
        F.max(F.when(~F.col("alone"), F.col("bytes")))).first()
    left = shards - n_alone
    cuts = []
    if n:
        sizes = stored(ranked.where("not alone").agg(F.transform(F.array_sort(F.collect_list(
            F.struct("unit", "bytes"))), lambda u: u["bytes"]).alias("sizes")))
        even = -(-total // left)
        capacity = smallest_capacity(sizes, left, max(even, largest), even + largest)
        cuts = sizes.withColumn("latest", _latest(F.col("sizes"), capacity)).select(
            _starts(F.col("sizes"), F.col("latest"), left, capacity)).first()[0]
    earlier = sum((F.when(F.col("at") >= c, 1).otherwise(0) for c in cuts), F.lit(0))
    return ranked.select("unit", F.when(F.col("alone"), left + F.col("at")).otherwise(earlier)
                         .cast("int").alias("shard"))


def shard(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The rows with size, text_crc32, law, shard, slot and grown_shard."""
    text = F.coalesce("text", F.lit(""))
    rows = documents.drop(*RESULT).withColumns({
        "_size": (F.octet_length(text) + OVERHEAD).cast("long"),
        "_crc": F.crc32(F.encode(text, "UTF-8")),
        "_unit": F.shiftrightunsigned(F.xxhash64(text), 64 - UNIT_BITS),
        "_text": F.xxhash64(text, F.lit(1)),
        "_doc": F.xxhash64("doc_id", F.lit(3))})
    units = stored(rows.groupBy(F.col("_unit").alias("unit")).agg(
        F.count("*").alias("rows"), F.sum("_size").alias("bytes")))
    placed = place_units(units, shards)
    ahead = Window.partitionBy("shard").orderBy("unit").rowsBetween(Window.unboundedPreceding, -1)
    units = stored(units.join(placed, "unit").select(
        F.col("unit").alias("_unit"), F.col("shard").alias("_shard"),
        F.coalesce(F.sum("rows").over(ahead), F.lit(0)).alias("_ahead"),
        F.ceil(F.col("rows") / PART).alias("_parts")))
    # at most 2 ** UNIT_BITS rows of four numbers
    rows = rows.join(F.broadcast(units), "_unit").withColumn(
        "_part", F.pmod(F.col("_doc"), F.col("_parts")))
    before = Window.partitionBy("_unit").orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1)
    parts = rows.where("_parts > 1").groupBy("_unit", "_part").agg(F.count("*").alias("n")).select(
        "_unit", "_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    rank = Window.partitionBy("_unit", "_part").orderBy("_text", "_doc", "doc_id")
    ranked = rows.withColumn("_rank", F.row_number().over(rank)).join(
        parts, ["_unit", "_part"], "left")
    keep = [c for c in documents.columns if c not in RESULT]
    return ranked.select(
        *keep, F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"),
        F.lit("bytes").alias("law"), F.col("_shard").alias("shard"),
        (F.col("_ahead") + F.coalesce("_before", F.lit(0)) + F.col("_rank") - 1).cast("long")
        .alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
