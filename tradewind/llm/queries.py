"""Queries of the training-data operators over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.io import table

from .decontaminate import decontaminate
from .embedding_dedup import embedding_dedup
from .hard_negatives import hard_negatives, with_shifted_labels
from .html_extract import extract_html
from .language_id import identify_language
from .line_dedup import line_dedup
from .mixing import mix_sources
from .ngram_join import ngram_join
from .oracles import ORACLES
from .periodic_runs import periodic_runs, with_planted_periods
from .quality import classify_quality
from .secret_scan import scan_secrets
from .sharding import shard
from .substring_dedup import substring_dedup

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}



def query(f: Callable[[SparkSession, str], DataFrame]):
    QUERIES[f.__name__] = f
    return f


@query
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"))


@query
def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup(table(spark, sf_dir, "embeddings"))


@query
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).drop("text_key")


@query
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query
def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_html(table(spark, sf_dir, "pages"))


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_language(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


@query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "p_text", "p_meta", "score", "kept")


@query
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


@query
def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(table(spark, sf_dir, "documents")).drop("tag", "lead")


@query
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"),
                         table(spark, sf_dir, "benchmark")).drop("tag")


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_planted_periods(table(spark, sf_dir, "documents")))
    longest = F.try_element_at(F.sort_array(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p")))), F.lit(1))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(
        ",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.s").alias("start"),
        (-F.col("best.l")).alias("length"), F.col("best.p").alias("period"),
        F.expr("1000 * -best.l div best.p").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(with_shifted_labels(table(spark, sf_dir, "embeddings")))


@query
def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter(
        "findings", lambda f: f["kind"] == kind)).cast("long")
    joined = lambda fs: F.array_join(F.transform(fs, lambda f: F.concat_ws(
        ":", f["kind"], f["start"], f["end"])), ",")
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
        count("hex").alias("n_hex"), F.sha2(joined(F.filter(
            "findings", lambda f: f["kind"] != "literal")), 256).alias("base_sha256"),
        joined(F.col("findings")).alias("spans"))
