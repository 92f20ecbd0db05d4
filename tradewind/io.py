"""Table access for the driver-generated parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one table; Catalyst prunes columns and pushes filters into the scan.

    The tables hold zone-less timestamps and every date rule works in UTC, so
    the session time zone is pinned to UTC for any session that reads them.
    """
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
