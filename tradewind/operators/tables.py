"""Tables on shared storage: run partitions that are only appended, and upserts
that rewrite only the partitions a batch touches.

* ``append_run`` writes one folder per run; a retried run replaces its own folder
  and nothing else.  A run counts once its folder is complete, so a crash leaves
  the earlier runs in place.
* ``upsert_partitioned`` merges a batch into a table stored by a partition column.
  The touched partitions alone are read (the partition filter is a join, so Spark
  prunes the scan at run time) and alone are replaced.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import child_names, path_exists, scratch_path
from .sinks import upsert

#: Partition values of a batch that may be broadcast to prune the scan.
PRUNING_VALUES = 100_000


# ---- run partitions ---------------------------------------------------------
def run_name(run: str) -> str:
    """A run id as part of a folder name; the order of ids is kept."""
    return re.sub(r"[^0-9A-Za-z]+", "-", run)


def runs(spark: SparkSession, path: str, other_than: str | None = None) -> list[str]:
    """The complete runs of a table, oldest first."""
    names = sorted(n.removeprefix("run=") for n in child_names(spark, path) if n.startswith("run="))
    skip = None if other_than is None else run_name(other_than)
    return [n for n in names if n != skip and path_exists(spark, f"{path}/run={n}/_SUCCESS")]


def read_runs(spark: SparkSession, path: str, other_than: str | None = None) -> DataFrame | None:
    """The rows of all complete runs with their ``run``; ``other_than`` leaves one out
    (the one being written); None without any."""
    names = runs(spark, path, other_than)
    if not names:
        return None
    parts = spark.read.option("basePath", path).parquet(*[f"{path}/run={n}" for n in names])
    return parts.withColumn("run", F.col("run").cast("string"))


def append_run(df: DataFrame, path: str, run: str) -> DataFrame:
    """Writes the rows of one run, returns the whole table without ``run``."""
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(f"{path}/run={run_name(run)}")
    return read_runs(spark, path).drop("run").select(*df.columns)


def append_new(df: DataFrame, path: str, run: str, key: str) -> DataFrame:
    """``append_run`` of the rows whose key no other run holds."""
    held = read_runs(df.sparkSession, path, other_than=run)
    return append_run(df if held is None else df.join(held.select(key), key, "left_anti").select(
        *df.columns), path, run)


# ---- partitioned upsert -----------------------------------------------------
def write_partitions(df: DataFrame, path: str, partition_col: str) -> None:
    """Replaces only the partitions present in ``df`` (dynamic overwrite); large
    partitions are split over tasks."""
    (df.hint("rebalance", partition_col).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).parquet(path))


def touched_rows(target: DataFrame, updates: DataFrame, partition_col: str) -> DataFrame:
    """The target's rows in the partitions that ``updates`` names.

    The values are joined to the partition column, so the scan is pruned to them
    when the query runs; their range prunes already when it is planned.
    """
    values = updates.select(partition_col).distinct()
    n, low, high = values.agg(F.count("*"), F.min(partition_col), F.max(partition_col)).first()
    if not n:
        return target.where("false")
    values = values.where(F.col(partition_col).between(F.lit(low), F.lit(high)))
    if n <= PRUNING_VALUES:
        values = F.broadcast(values)
    return target.join(values, partition_col, "left_semi")


def upsert_partitioned(path: str, updates: DataFrame, keys: Sequence[str], partition_col: str,
                       preserve: Sequence[str] = (),
                       set_on_update: dict[str, Column] | None = None,
                       only_changed: bool = False) -> DataFrame:
    """Upserts into the table at ``path`` and returns it.

    ``partition_col`` is a column of ``updates`` that the keys decide.  The merged
    partitions are written beside the table before they replace the old ones, and an
    upsert that is run again has the same result.  ``only_changed`` leaves partitions
    alone whose rows are all in the table already.
    """
    spark = updates.sparkSession
    if not path_exists(spark, path):
        write_partitions(updates, path, partition_col)
        return spark.read.parquet(path)
    aside = scratch_path(spark, f"upsert-{uuid.uuid4().hex}")
    updates.write.parquet(f"{aside}/batch")
    batch = spark.read.parquet(f"{aside}/batch")
    target = spark.read.parquet(path)
    if only_changed:
        held = touched_rows(target, batch, partition_col).select(*batch.columns)
        batch = batch.subtract(held)
        batch.write.parquet(f"{aside}/changed")
        batch = spark.read.parquet(f"{aside}/changed")
    merged = upsert(touched_rows(target, batch, partition_col), batch, keys, preserve, set_on_update)
    merged.write.parquet(f"{aside}/merged")
    write_partitions(spark.read.parquet(f"{aside}/merged"), path, partition_col)
    return spark.read.parquet(path)
