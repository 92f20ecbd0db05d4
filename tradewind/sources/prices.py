"""Price history (A6) and dimension lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REQUIRED_PRICE_COLUMNS = ("open_price", "high_price", "low_price", "close_price")


def validate_price_history(prices: DataFrame) -> DataFrame:
    """Fail when a required OHLC column is missing or the history is empty.

    The emptiness probe reads one row (``isEmpty``), not the table.
    """
    missing = [c for c in REQUIRED_PRICE_COLUMNS if c not in prices.columns]
    if missing:
        raise ValueError(f"price history lacks required columns: {missing}")
    if prices.isEmpty():
        raise ValueError("price history is empty")
    return prices


#: Columns of a landed price file, in their order.
PRICE_FILE = ("benchmark_code string, price_date date, open_price double, high_price double, "
              "low_price double, close_price double, volume long")


def read_price_files(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(price rows, rejected lines) of landed CSV files with a header.

    The schema is declared, and every file's header must name its columns.  A line that
    does not parse, or has no series or date, is rejected with its file and text.  A
    missing column and a file without rows raise ``ValueError`` here, not later.
    """
    names = [c.split()[0] for c in PRICE_FILE.split(", ")]
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").option(
        "recursiveFileLookup", "true").load(path).select("path")
    lines = spark.read.option("pathGlobFilter", "*.csv").option("recursiveFileLookup", "true").text(
        path).select(F.col("_metadata.file_path").alias("path"), "value",
                     F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("at"))
    # a file's first line, and whether it has others
    heads = lines.groupBy("path").agg(
        F.min_by("value", F.struct("block", "at")).alias("head"), F.count("*").alias("n"))
    broken = files.join(heads, "path", "left").where(
        f"n is null or n < 2 or trim(lower(head)) <> '{','.join(names)}'").limit(5).collect()
    for r in broken:
        missing = [c for c in names if c not in (r.head or "").lower().split(",")]
        raise ValueError(f"price file {r.path}: " + (
            f"columns {missing} are missing" if missing else "no rows" if (r.n or 0) < 2
            else "columns in another order"))
    rows = spark.read.schema(f"{PRICE_FILE}, _corrupt_record string").option("header", True).option(
        "mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").option(
        "dateFormat", "yyyy-MM-dd").option("pathGlobFilter", "*.csv").option(
        "recursiveFileLookup", "true").csv(path).select("*", F.col("_metadata.file_path").alias("path"))
    bad = F.col("_corrupt_record").isNotNull() | F.col("benchmark_code").isNull() | F.col(
        "price_date").isNull()
    line = F.coalesce("_corrupt_record", F.concat_ws(",", *names))
    return (validate_price_history(rows.where(~bad).select(*names)),
            rows.where(bad).select("path", line.alias("line")))


def attach_source_id(df: DataFrame, sources: DataFrame, name_col: str = "source_name",
                     id_col: str = "source_id") -> DataFrame:
    """Resolve a source name to its id; an unknown name is an error.

    ``sources`` is the source dimension (one row per feed), joined by AQE's
    choice; the check is one anti-join count.
    """
    dim = sources.select(name_col, id_col)
    unknown = df.select(name_col).distinct().join(dim, name_col, "left_anti")
    missing = [r[0] for r in unknown.take(5)]
    if missing:
        raise ValueError(f"unknown source(s): {missing}")
    return df.join(dim, name_col)
