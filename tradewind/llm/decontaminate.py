"""Operator 10 [native]: benchmark decontamination by winnowing.

Words are runs of ASCII letters and digits and of any non-ASCII characters,
with A-Z lower-cased.  A window is 13 consecutive words of a benchmark item, or
the whole item if it is shorter.

1. *Fingerprints.*  Every run of ``K`` = 5 words is hashed; of each 9
   neighbouring hashes the smallest is kept (the leftmost of equals).  Two
   texts that share 13 words share 9 neighbouring runs and so keep the same
   fingerprint inside the shared span: no window is missed.
2. *Join.*  Document fingerprints, with the eight words on either side, meet
   the item fingerprints by hash: broadcast when the benchmark's fingerprints
   are counted to be few, shuffled otherwise.
3. *Extension.*  A hit is extended word by word to both sides, at most to the
   edge of the 13-word windows that hold the fingerprint; it counts when 13
   words agree, and every word of it is hit.
4. Items shorter than 13 words are searched in the same way with windows cut to
   the shortest item's length, extended over the whole item.

Rows: one per input row.  Null texts have no words.  Items with null ids are
searched, but have no name in ``items_sha256`` and count no item.  Repeated
document rows get equal results; an item_id that is repeated is one item with
the windows of all its texts.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if, stored

WINDOW, K = 13, 5
#: Item fingerprints that may be broadcast (each under 1 kB with its words).
BROADCAST_ROWS = 50_000
#: ASCII but letters and digits, after lower-casing.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def with_words(rows: DataFrame) -> DataFrame:
    """Replaces ``text`` by ``words``, the array of its lower-cased words."""
    plain = ~F.col("text").rlike(r"[^\x00-\x7F]")
    lower = F.when(plain, F.lower("text")).otherwise(F.translate("text", UPPER, UPPER.lower()))
    cut = rows.withColumn("words", F.split(F.coalesce(lower, F.lit("")), GAP)).drop("text")
    first = (F.get("words", F.lit(0)) == "").cast("int")
    last = (F.element_at("words", -1) == "").cast("int")
    return cut.withColumn("words", F.slice(
        "words", first + 1, F.greatest(F.size("words") - first - last, F.lit(0))))


def with_fingerprints(rows: DataFrame, k: int, window: int) -> DataFrame:
    """Adds ``kept``: the winnowed k-word hashes of ``words``, each a long with
    32 bits of hash above 32 bits of position, so the smallest of a window is
    its leftmost smallest hash and tells where it stands."""
    n = F.size("words") - (k - 1)
    word = lambda i, j: F.get(F.col("words"), i + j)
    grams = F.when(n >= window, F.transform(
        F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))),
        lambda i: F.shiftleft(F.shiftright(F.xxhash64(*[word(i, j) for j in range(k)]), 32), 32)
        .bitwiseOR(i.cast("long"))))
    kept = F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.greatest(n - (window - 1), F.lit(1))),
        lambda i: F.array_min(F.slice("grams", i, window))))
    return rows.withColumn("grams", grams).withColumn(
        "kept", F.when(F.col("grams").isNotNull(), kept).otherwise(
            F.array().cast("array<long>"))).drop("grams")


def _around(k: int, reach: int) -> Column:
    """Kept fingerprints with the words before (nearest first), in and after them."""
    def one(v: Column) -> Column:
        at = v.bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")
        before = F.least(at, F.lit(reach))
        return F.struct(
            F.shiftright(v, 32).alias("fp"), at.alias("at"),
            F.reverse(F.slice("words", at - before + 1, before)).alias("before"),
            F.slice("words", at + 1, k).alias("gram"),
            F.slice("words", at + k + 1, reach).alias("after"))
    return F.transform("kept", one)


def _agreeing(a: str, b: str) -> Column:
    """Leading positions at which two arrays agree."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    first = F.array_position(same, F.lit(False))
    return F.when(first > 0, first - 1).otherwise(F.size(same)).cast("int")


def _hits(docs: DataFrame, items: DataFrame, g: int, k: int, short: bool) -> DataFrame:
    """doc_id, tag, words, copies row per document row, and one row per hit:
    item_id and the span [start, stop) of hit words.

    ``g`` is the length of the shared span that is guaranteed to be found.
    """
    window, reach = g - k + 1, WINDOW - k
    mine = with_fingerprints(items, k, window).select(
        "item_id", F.size("words").alias("length"), F.explode(_around(k, reach)).alias("f")).select(
        F.col("f.fp").alias("fp"), "item_id", "length", F.col("f.at").alias("i_at"),
        F.col("f.before").alias("i_before"), F.col("f.gram").alias("i_gram"),
        F.col("f.after").alias("i_after")).distinct()
    mine = broadcast_if(mine, BROADCAST_ROWS)
    # the first row stands for the document itself: it has no fingerprint
    theirs = with_fingerprints(docs, k, window).select(
        "doc_id", "tag", F.size("words").alias("n_words"),
        F.explode(_around(k, reach) if short else F.concat(
            F.transform(F.array(F.lit(0)), lambda _: F.lit(None)), _around(k, reach))).alias("f"))
    theirs = theirs.select("doc_id", "tag", F.when(F.col("f").isNull(), F.col("n_words"))
                           .alias("n_words"), "f.*")
    met = theirs.join(mine, "fp", "inner" if short else "left").where(
        F.col("fp").isNull() | (F.col("gram") == F.col("i_gram")))
    back, on = _agreeing("before", "i_before"), _agreeing("after", "i_after")
    met = met.withColumn("back", back).withColumn("on", on)
    if short:    # the whole item
        met = met.where((F.col("back") >= F.col("i_at")) & (
            F.col("on") >= F.col("length") - F.col("i_at") - k)).withColumn(
            "back", F.col("i_at")).withColumn("on", F.col("length") - F.col("i_at") - k)
    else:
        met = met.where(F.col("fp").isNull() | (F.col("back") + F.col("on") + k >= WINDOW))
    return met.select(
        "doc_id", "tag", "n_words", "item_id", F.when(F.col("fp").isNotNull(), F.struct(
            (F.col("at") - F.col("back")).alias("start"),
            (F.col("at") + k + F.col("on")).alias("stop"))).alias("span"))


def decontaminate(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row."""
    docs = with_words(documents.select("doc_id", F.xxhash64("text").alias("tag"), "text"))
    items = stored(with_words(benchmark.select("item_id", "text")))
    hits = _hits(docs, items.where(F.size("words") >= WINDOW), WINDOW, K, False)
    few = items.where((F.size("words") > 0) & (F.size("words") < WINDOW))
    g = few.agg(F.min(F.size("words"))).first()[0]
    if g:
        hits = hits.unionByName(_hits(docs, few, g, (g + 1) // 2, True))
    found = hits.groupBy("doc_id", "tag").agg(
        F.max("n_words").alias("n_words"), F.count("n_words").alias("copies"),
        F.array_sort(F.collect_set("span")).alias("spans"),
        F.collect_set(F.col("item_id").cast("string")).alias("items"))
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto")),
        lambda s, x: F.struct(
            (s["n"] + F.greatest(x["stop"] - F.greatest(x["start"], s["upto"]), F.lit(0))).alias("n"),
            F.greatest(x["stop"], s["upto"]).alias("upto")))["n"]
    out = found.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"),
        covered.cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"), "tag",
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", (
        (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
        "tag")
