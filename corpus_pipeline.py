"""Training corpus in five stages over ``documents``.

Every stage works on all rows its predecessor kept and is written as Parquet
before the next one reads it; all but the last return the columns of
``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradewind.io import table
from tradewind.llm.common import broadcast_if
from tradewind.llm.decontaminate import decontaminate
from tradewind.llm.mixing import mix_sources
from tradewind.llm.ngram_join import ngram_join
from tradewind.llm.quality import RESULT as QUALITY_COLUMNS
from tradewind.llm.quality import classify_quality
from tradewind.llm.sharding import shard
from tradewind.session import ensure_checkpoint_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents that the classifier rejects go."""
    return classify_quality(docs, table(spark, sf_dir, "labels")).where("kept").drop(
        *QUALITY_COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: one document of each group stays, the smallest doc_id.  Rows that
    repeat an id and a text are one document; rows without an id stand behind all
    others and take part like them, by their text."""
    behind = 1 << 62
    keyed = docs.withColumn("_tag", F.xxhash64("text")).withColumn("_id", F.coalesce(
        "doc_id", F.lit(behind) + F.col("_tag").bitwiseAND(F.lit(behind - 1))))
    kept = ngram_join(keyed.select(F.col("_id").alias("doc_id"), "text")).where("kept AND lead").select(
        F.col("doc_id").alias("_id"), F.col("tag").alias("_tag")).distinct()
    # one plan at every size: the ids grow with the documents; the second step finds its
    # rows already dealt by both columns
    return keyed.join(kept.hint("merge"), ["_id", "_tag"], "left_semi").dropDuplicates(
        ["_id", "_tag"]).select(*docs.columns)


def contamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: contaminated documents go."""
    hit = decontaminate(docs, table(spark, sf_dir, "benchmark")).where("contaminated").select(
        "doc_id", "tag").distinct()
    hit = broadcast_if(hit, 50_000)
    tagged = docs.withColumn("_tag", F.xxhash64("text"))
    return tagged.join(hit, tagged["doc_id"].eqNullSafe(hit["doc_id"]) & (
        tagged["_tag"] == hit["tag"]), "left_anti").drop("_tag")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: every document as often as the mix takes it.  Of a document that is
    taken in part (the last one of a shard's quota) the nearest number of whole copies
    is taken.  Null and blank texts leave: no mix takes a word of them."""
    takes = mix_sources(docs).groupBy("doc_id", "text_key").agg(
        F.array_sort(F.collect_list(F.struct("taken", "size"))).alias("_takes"))
    keyed = docs.withColumn("_key", F.xxhash64("text"))
    # repeated rows get one entry each
    nth = F.row_number().over(Window.partitionBy("doc_id", "_key").orderBy("_key"))
    met = keyed.join(takes.withColumnRenamed("doc_id", "_id").hint("merge"), keyed["doc_id"].eqNullSafe(
        F.col("_id")) & (F.col("_key") == F.col("text_key"))).withColumn(
        "_take", F.get("_takes", nth - 1)).where("_take.taken > 0")
    copies = F.floor(F.col("_take.taken") / F.col("_take.size") + 0.5).cast("int")
    return met.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), copies))).select(*docs.columns)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: the rows with their shard and slot."""
    return shard(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("contamination", contamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: The stages train, hash and cut by seeded order, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stage-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
