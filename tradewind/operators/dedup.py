"""Two-key first-wins insertion (B1 with both unique keys), set-wise.

Sequential semantics: rows are offered in order; a row is inserted unless a
previously *inserted* row shares its url key or its (source, guid) key.  A
rejected row blocks nothing.  (Rows (u1,g1), (u2,g1), (u2,g3): the second
loses on g1, the third is kept because u2 was never inserted.)

Of rows with equal pairs of keys only the earliest can be inserted.  The others
settle in rounds:

* a row that is the earliest of both its keys is inserted, and rows that share a
  key with an inserted row are rejected;
* a row with a single earlier row among those that share a key with it is inserted
  exactly if that one is not.  Such rows form chains, and a chain that starts at an
  inserted row is settled at once: pointers are doubled along it, so a chain of n
  rows takes about log2(n) steps.

The second rule is tried when the first alone has not settled the batch in
``PLAIN_ROUNDS``.  Rows whose fate hangs on several earlier ones wait until those
are settled; a batch made of nested dependencies of that kind can still take many
rounds (the general problem is inherently sequential).

Per-key minima are hash aggregates (map-side combine, so a hot key never lands
whole in one task); every step is a written table in the shared checkpoint folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

PLAIN_ROUNDS = 2
KEYS = ["_o", "_k1", "_k2"]


class _Steps:
    """Written tables of one call."""

    def __init__(self, spark):
        self.spark, self.path, self.n = spark, scratch_path(spark, f"dedup-{uuid.uuid4().hex}"), 0

    def put(self, df: DataFrame) -> DataFrame:
        self.n += 1
        df.write.parquet(f"{self.path}/step={self.n}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/step={self.n}")

    def accept(self, rows: DataFrame) -> DataFrame:
        self.n += 1
        rows.select(*KEYS).write.parquet(f"{self.path}/accepted/step={self.n}")
        return self.spark.read.schema(rows.select(*KEYS).schema).parquet(
            f"{self.path}/accepted/step={self.n}")

    def accepted(self, schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/accepted").select("_o")


def _with_first(rows: DataFrame, key: str, i: int) -> DataFrame:
    """Adds the earliest (``_m``) and the second earliest (``_s``) row of the key and
    their number; the second aggregate and join find the rows already dealt by it."""
    m, s, n = f"_m{i}", f"_s{i}", f"_n{i}"
    first = rows.join(rows.groupBy(key).agg(F.min("_o").alias(m), F.count("*").alias(n)), key)
    return first.join(first.groupBy(key).agg(F.min(F.when(F.col("_o") > F.col(m), F.col("_o")))
                                             .alias(s)), key)


def _ranked(rows: DataFrame) -> DataFrame:
    one = _with_first(rows, "_k1", 1)
    # null second keys stay out of the join: they would all meet in one task
    two = _with_first(one.where("_k2 is not null"), "_k2", 2)
    cols = [*KEYS, "_m1", "_s1", "_n1", "_m2", "_s2", "_n2"]
    return two.select(*cols).unionByName(one.where("_k2 is null").select(
        *KEYS, "_m1", "_s1", "_n1", F.col("_o").alias("_m2"),
        F.lit(None).cast(rows.schema["_o"].dataType).alias("_s2"), F.lit(1).cast("long").alias("_n2")))


def _along_chains(steps: _Steps, marked: DataFrame) -> DataFrame:
    """The rows of chains from an inserted row that are inserted themselves."""
    by1 = (F.col("_o") == F.col("_s1")) & (F.col("_o") == F.col("_m2"))
    by2 = (F.col("_o") == F.col("_s2")) & (F.col("_o") == F.col("_m1"))
    links = steps.put(marked.where(by1 | by2).select(
        *KEYS, F.when(by1, F.col("_m1")).otherwise(F.col("_m2")).alias("_to"),
        F.lit(True).alias("_odd")))
    while True:
        ahead = links.select(F.col("_o").alias("_to"), F.col("_to").alias("_next"),
                             F.col("_odd").alias("_odd2"))
        jumped = steps.put(links.join(ahead, "_to", "left").select(
            *KEYS, F.coalesce("_next", "_to").alias("_to"),
            (F.col("_odd") != F.coalesce("_odd2", F.lit(False))).alias("_odd"),
            F.col("_next").isNotNull().alias("_moved")))
        links = jumped.drop("_moved")
        if jumped.where("_moved").isEmpty():
            break
    heads = marked.where("_o = _m1 and _o = _m2").select(F.col("_o").alias("_to"))
    return links.where("not _odd").join(heads, "_to", "left_semi").select(*KEYS)


def first_wins_two_keys(batch: DataFrame, order_col: str, key1: str, key2: str,
                        max_rounds: int | None = None) -> DataFrame:
    """Rows of ``batch`` that sequential insertion would accept.

    ``order_col`` is a unique, totally ordered row position; ``key1`` must be
    non-null (the url hash); a null ``key2`` takes part in key1 only.  The
    rounds see keys only, and only of rows that share one with another row;
    the payload is joined back once.
    """
    steps = _Steps(batch.sparkSession)
    # written before it is ranked, which reads the keys several times
    keys = steps.put(batch.groupBy(F.col(key1).alias("_k1"), F.col(key2).alias("_k2")).agg(
        F.min(order_col).alias("_o")).select(*KEYS))
    marked = steps.put(_ranked(keys))
    steps.accept(marked.where("_n1 = 1 and _n2 = 1"))
    remaining = marked.where("_n1 > 1 or _n2 > 1").select(*KEYS)
    rounds = 0
    while not remaining.isEmpty():
        rounds += 1
        if max_rounds is not None and rounds > max_rounds:
            raise RuntimeError(f"first_wins_two_keys did not settle in {max_rounds} rounds")
        marked = steps.put(_ranked(remaining))
        won = marked.where("_o = _m1 and _o = _m2").select(*KEYS)
        if rounds > PLAIN_ROUNDS:
            won = won.unionByName(_along_chains(steps, marked))
        won = steps.accept(won)
        rest = remaining.join(won.select("_k1"), "_k1", "left_anti")
        lost = won.where("_k2 is not null").select("_k2")
        remaining = steps.put(rest.where("_k2 is not null").join(lost, "_k2", "left_anti").select(
            *KEYS).unionByName(rest.where("_k2 is null").select(*KEYS)))
    accepted = steps.accepted(marked.select(*KEYS).schema)
    return batch.join(accepted, batch[order_col] == accepted["_o"], "left_semi")
