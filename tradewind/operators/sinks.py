"""Table-maintenance operators on Parquet.

Plain Parquet has no MERGE, so every change is expressed as a DataFrame:
* ``upsert``            full outer join on the keys, new values win
* ``insert_if_absent``  first-wins dedup inside the batch, anti-join history
* ``replace_children``  drop the touched parents' rows, append the new rows
``tables.upsert_partitioned`` applies the first to a table stored by partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str],
           preserve: Sequence[str] = (), set_on_update: dict[str, Column] | None = None
           ) -> DataFrame:
    """ON CONFLICT (keys) DO UPDATE.

    Columns present in ``updates`` take the new value whenever the key is in
    the batch (even a null, as SQL's EXCLUDED does); ``preserve`` columns
    (surrogate ids, created_at) keep the target's value when the key existed;
    target rows whose key is not in the batch stay as they are.
    ``set_on_update`` overrides columns with expressions on updated rows.
    """
    keys = list(keys)
    t = target.select(*[F.col(c).alias(f"t__{c}") if c not in keys else F.col(c)
                        for c in target.columns], F.lit(True).alias("_in_t"))
    u = updates.select(*[F.col(c).alias(f"u__{c}") if c not in keys else F.col(c)
                         for c in updates.columns], F.lit(True).alias("_in_u"))
    j = t.join(u, keys, "full_outer")
    in_u = F.coalesce(F.col("_in_u"), F.lit(False))
    in_t = F.coalesce(F.col("_in_t"), F.lit(False))
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.col(c))
            continue
        tc = F.col(f"t__{c}")
        uc = F.col(f"u__{c}") if c in updates.columns else None
        if c in preserve:
            expr = F.when(in_t, tc).otherwise(uc if uc is not None else F.lit(None))
        elif set_on_update and c in set_on_update:
            expr = F.when(in_u & in_t, set_on_update[c]).when(
                in_u, uc if uc is not None else set_on_update[c]).otherwise(tc)
        elif uc is not None:
            expr = F.when(in_u, uc).otherwise(tc)
        else:
            expr = tc
        out.append(expr.alias(c))
    return j.select(*out)


def first_per_key(batch: DataFrame, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """Earliest row per key by ``order``, as a hash aggregate.

    ``min(struct(order..., row))`` combines map-side, so a hot key (even a
    third of the batch) is reduced in every task before the shuffle instead
    of being sorted whole in one task as a window would.
    """
    keys = [key] if isinstance(key, str) else list(key)
    payload = [c for c in batch.columns if c not in keys]
    s = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                 *[F.col(c) for c in payload])
    return (batch.groupBy(*keys).agg(F.min(s).alias("_m"))
            .select(*keys, *[F.col(f"_m.{c}").alias(c) for c in payload]))


def insert_if_absent(history: DataFrame, batch: DataFrame, key: str,
                     order: Sequence[str]) -> DataFrame:
    """B1 single key / B13 / D8: rows to insert (ON CONFLICT DO NOTHING).

    First writer wins inside the batch, and keys already in ``history`` are
    skipped.  Rows with a null key never conflict.
    """
    nonnull = batch.filter(F.col(key).isNotNull())
    nulls = batch.filter(F.col(key).isNull())
    firsts = first_per_key(nonnull, key, order)
    fresh = firsts.join(history.select(key).filter(F.col(key).isNotNull()), key, "left_anti")
    return fresh.select(*batch.columns).unionByName(nulls)


def pending_rows(inserted: DataFrame, key: str = "article_id") -> DataFrame:
    """B2: one processing-queue placeholder per inserted article."""
    return inserted.select(key, F.lit("pending").alias("processing_status"))


def stamped(df: DataFrame, *cols: str) -> DataFrame:
    """Load stamps (``current_timestamp`` is fixed per query, so every row
    of one write carries the same instant; keep stamps out of comparisons)."""
    for c in cols or ("created_at", "updated_at"):
        df = df.withColumn(c, F.current_timestamp())
    return df


def replace_children(children: DataFrame, new_children: DataFrame, parent_key: str,
                     touched: DataFrame) -> DataFrame:
    """Delete the touched parents' child rows, then insert the new ones."""
    kept = children.join(touched.select(parent_key).distinct(), parent_key, "left_anti")
    return kept.unionByName(new_children.select(*children.columns))
