"""Structured Streaming jobs (S1-S3) over landed scored-item files.

A stream has two steps, each an own query with its own checkpoint:

1. ``split_late`` deals the rows of every batch to ``on_time`` or ``late``: late
   is what lies further behind the newest event of the earlier batches than the
   allowed delay.  Late rows are kept there as a side output.
2. A stateful query reads the on-time rows, whole batches of the first step at a
   time (so its watermark is never ahead of theirs), with the same delay.
   Its state lives in Spark's state store, one entry per event-time day and key;
   days behind the watermark are closed and leave the store.  Since late rows are
   split off before, the state store never drops a row.

* S1 ``stream_dedup``: per day and key the state holds the earliest row; a batch
  writes the entries it changed and reads no earlier output.
* S2/S3 ``stream_daily``: per day and source the state holds the sums.  A batch
  upserts the days it changed into a table stored by day: only those partitions
  are rewritten.  The daily view sums over sources.

Both combine map-side before the state, so a hot key is reduced in every task.  A
retried batch replaces its own folder, or upserts the same rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..numerics import ratio_half_up
from ..operators.sinks import first_per_key
from ..operators.tables import upsert_partitioned
from ..session import child_names, path_exists, scratch_path

TIME = "published_at"
#: Most files that ``land_items`` writes.
LANDED_FILES = 200
#: Size of a batch unless its number of files is given.  A batch costs a fixed time, so
#: their number goes by the bytes that wait, however many files hold them.
BATCH_BYTES = 32 << 20
SUMS = ["articles", "s", "ns", "sr", "r", "nr", "pos", "neu", "neg"]


def land_items(items: DataFrame, dest: str, rows_per_file: int = 2500) -> None:
    """Land scored items in order of their event time as Parquet files of equal
    size that arrived one after the other: more rows a file from ``LANDED_FILES`` on."""
    spark = items.sparkSession
    n = min(LANDED_FILES, max(1, -(-items.count() // rows_per_file)))
    items.repartitionByRange(n, TIME).write.mode("overwrite").parquet(dest)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(dest).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = sorted(c for c in child_names(spark, dest) if c.startswith("part-"))
    newest = max(fs.getFileStatus(hadoop.Path(dest, c)).getModificationTime() for c in names)
    for i, c in enumerate(names):
        fs.setTimes(hadoop.Path(dest, c), newest - 1000 * (len(names) - i), -1)


def _run(query) -> StreamingQuery:
    done = query.trigger(availableNow=True).start()
    done.awaitTermination()
    return done


def split_late(spark: SparkSession, source: str, work: str, delay: str,
               files_per_batch: int | None = None) -> None:
    """Step 1: every batch (of ``files_per_batch`` files, else of ``BATCH_BYTES``)
    becomes a folder of on-time rows and one of late rows."""
    schema = spark.read.parquet(source).schema
    newest: dict = {}            # of the batches so far; read once after a restart

    def deal(batch: DataFrame, batch_id: int) -> None:
        s = batch.sparkSession
        if "at" not in newest:
            earlier = [f"{work}/{k}/{n}" for k in ("on_time", "late") for n in child_names(
                s, f"{work}/{k}") if int(n.removeprefix("batch=")) < batch_id]
            newest["at"] = s.read.schema(schema).parquet(*earlier).agg(
                F.max(TIME)).first()[0] if earlier else None
        late = F.lit(False) if newest["at"] is None else F.coalesce(
            F.col(TIME) < F.lit(newest["at"]) - F.expr(f"INTERVAL {delay}"), F.lit(False))
        now = batch.agg(F.max(TIME).alias("newest"), F.count_if(late).alias("late")).first()
        if now["late"]:
            _publish(batch.where(late), f"{work}/late", batch_id)
        _publish(batch.where(~late), f"{work}/on_time", batch_id)
        newest["at"] = max((t for t in (newest["at"], now["newest"]) if t is not None), default=None)

    limit = ("maxBytesPerTrigger", BATCH_BYTES) if files_per_batch is None else (
        "maxFilesPerTrigger", files_per_batch)
    items = spark.readStream.schema(schema).option(*limit).parquet(source)
    _run(items.writeStream.foreachBatch(deal)
         .option("checkpointLocation", f"{work}/split-checkpoint"))


def _publish(rows: DataFrame, table: str, batch_id: int) -> None:
    """Writes a batch's folder and shows it whole: readers of the table see nothing
    of a batch that failed half-way, and a batch that was shown stays as it is."""
    spark = rows.sparkSession
    shown, aside = f"{table}/batch={batch_id}", f"{table}-writing/{uuid.uuid4().hex}"
    if path_exists(spark, shown):
        return
    rows.write.parquet(aside)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(table).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop.Path(table))
    if not fs.rename(hadoop.Path(aside), hadoop.Path(shown)):
        raise RuntimeError(f"could not show {shown}")


def on_time(spark: SparkSession, work: str, schema, delay: str) -> DataFrame:
    """Step 2's input: the on-time rows as a stream with a watermark.  A batch takes all
    folders shown so far: a limit on files could cut one in two, and the watermark of
    its first half could close days of the second."""
    return spark.readStream.schema(schema).parquet(f"{work}/on_time/batch=*").withWatermark(TIME, delay)


def late_rows(spark: SparkSession, work: str, schema) -> DataFrame:
    """The side output of rows that came too late for their day."""
    if not path_exists(spark, f"{work}/late"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{work}/late").drop("batch")


def stream_dedup(spark: SparkSession, source: str, key: str, order: str, work: str,
                 delay: str = "2 days", files_per_batch: int | None = None) -> DataFrame:
    """Earliest row per ``key`` (by ``order``) over a file stream, late rows included."""
    schema = spark.read.parquet(source).schema
    split_late(spark, source, work, delay, files_per_batch)
    rest = [F.col(c) for c in schema.names if c not in (key, order)]
    firsts = on_time(spark, work, schema, delay).groupBy(
        F.window(TIME, "1 day"), F.col(key)).agg(F.min(F.struct(order, *rest)).alias("first"))
    entries = f"{work}/entries"

    def add(batch: DataFrame, batch_id: int) -> None:
        batch.select(key, "first.*").write.mode("overwrite").parquet(f"{entries}/batch={batch_id}")

    _run(firsts.writeStream.outputMode("update").foreachBatch(add)
         .option("checkpointLocation", f"{work}/state-checkpoint"))
    found = spark.read.parquet(entries).select(*schema.names).unionByName(
        late_rows(spark, work, schema))
    return first_per_key(found, key, [order])


def partial_sums(items: DataFrame, day: Column) -> DataFrame:
    """Additive sums per (``day`` as ``window``, source) of the eligible rows."""
    s, r = F.col("sentiment_e4"), F.col("relevance_e4")
    label = lambda x: F.count_if(F.col("sentiment_label") == x)
    return (items.filter((F.col("processing_status") == "processed")
                         & (F.coalesce(r, F.lit(0)) > 0))
            .groupBy(day.alias("window"), "source_id")
            .agg(F.count(F.lit(1)).alias("articles"), F.sum(s).alias("s"), F.count(s).alias("ns"),
                 F.sum(s * r).alias("sr"), F.sum(r).alias("r"), F.count(r).alias("nr"),
                 label("positive").alias("pos"), label("neutral").alias("neu"),
                 label("negative").alias("neg")))


def _dated(sums: DataFrame) -> DataFrame:
    return sums.select(F.to_date(F.col("window.start")).alias("feature_date"), "source_id", *SUMS)


def daily_view(sums: DataFrame) -> DataFrame:
    """E1's daily rows from sums per day and source, which may come in parts."""
    per_source = sums.groupBy("feature_date", "source_id").agg(*[F.sum(c).alias(c) for c in SUMS])
    day = per_source.groupBy("feature_date").agg(
        F.count("source_id").alias("sources"), *[F.sum(c).alias(c) for c in SUMS])
    return day.select(
        "feature_date", F.col("articles").alias("article_count"),
        F.col("sources").alias("distinct_source_count"),
        F.when(F.col("ns") > 0, ratio_half_up("s", "ns")).alias("avg_sentiment"),
        F.when(F.col("r") > 0, ratio_half_up("sr", "r")).alias("weighted_avg_sentiment"),
        F.when(F.col("nr") > 0, ratio_half_up("r", "nr")).alias("avg_relevance"),
        F.col("pos").alias("positive_article_count"),
        F.col("neu").alias("neutral_article_count"),
        F.col("neg").alias("negative_article_count"))


def batch_daily(items: DataFrame) -> DataFrame:
    """The same daily rows of a table, without a stream."""
    return daily_view(_dated(partial_sums(items, F.window(TIME, "1 day"))))


def stream_daily(spark: SparkSession, source: str, work: str, delay: str = "2 days",
                 files_per_batch: int | None = None, with_late: bool = False) -> DataFrame:
    """E1's daily aggregate as event-time windows.  Late rows are left to
    ``late_rows``; ``with_late`` adds them to their days in the view."""
    schema = spark.read.parquet(source).schema
    split_late(spark, source, work, delay, files_per_batch)
    sums = partial_sums(on_time(spark, work, schema, delay), F.window(TIME, "1 day"))
    table = f"{work}/daily_sums"

    def merge(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            upsert_partitioned(table, _dated(batch), ["feature_date", "source_id"], "feature_date")

    _run(sums.writeStream.outputMode("update").foreachBatch(merge)
         .option("checkpointLocation", f"{work}/state-checkpoint"))
    rows = spark.read.parquet(table).select("feature_date", "source_id", *SUMS)
    if with_late:
        rows = rows.unionByName(_dated(partial_sums(
            late_rows(spark, work, schema), F.window(TIME, "1 day"))))
    return daily_view(rows)


def fresh_workdir(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"stream-{name}-{uuid.uuid4().hex[:8]}")
