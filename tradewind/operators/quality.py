"""Constraint report (C11): the reference's DDL constraints as data rules.

Rules are data: ``Rule`` names a table, a kind and columns.  All rules of all tables
are evaluated together, and every table is scanned once:

* a row becomes its keys: one per unique rule, one per foreign key it holds and one per
  key of it that others refer to.  A single grouping by (rule, key), combined map-side,
  then tells duplicates and orphans;
* row rules (domain, not null, non-negative, longest) pass only the rows that break them
  into that grouping.

Output: (rule, violations), also for rules that hold.  A null key is neither unique nor
an orphan (as in SQL); unique rules count the rows beyond the first of each key.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Table name under which ``validate`` checks a single frame.
ONE = "one"


@dataclass(frozen=True)
class Rule:
    name: str
    kind: str                      # unique | foreign_key | domain | not_null | non_negative | longest
    columns: tuple[str, ...]
    values: tuple = ()
    ref: str | DataFrame | None = None       # table (or frame) referred to
    ref_column: str | None = None
    table: str = ONE


def unique(name, *cols, table=ONE):
    return Rule(name, "unique", tuple(cols), table=table)


def domain(name, col, values, table=ONE):
    return Rule(name, "domain", (col,), tuple(values), table=table)


def not_null(name, col, table=ONE):
    return Rule(name, "not_null", (col,), table=table)


def non_negative(name, col, table=ONE):
    return Rule(name, "non_negative", (col,), table=table)


def longest(name, col, chars, table=ONE):
    return Rule(name, "longest", (col,), (chars,), table=table)


def foreign_key(name, col, ref, ref_col: str, table=ONE):
    return Rule(name, "foreign_key", (col,), ref=ref, ref_column=ref_col, table=table)


def _broken(r: Rule) -> Column:
    c = F.col(r.columns[0])
    return {"domain": lambda: c.isNotNull() & ~c.isin(*r.values), "not_null": c.isNull,
            "non_negative": lambda: c < 0,
            "longest": lambda: F.char_length(c) > r.values[0]}[r.kind]()


def _key(columns: Iterable[str]) -> Column:
    """The exact key as text; null if a part is null."""
    cols = [F.col(c) for c in columns]
    some = reduce(lambda a, b: a & b, [c.isNotNull() for c in cols])
    return F.when(some, F.to_json(F.array(*[c.cast("string") for c in cols])))


def _marks(df: DataFrame, mine: Sequence[Rule], referred: Sequence[Rule]) -> DataFrame:
    """(rule, kind, key, holds, refers, broken) of one table's rows."""
    def mark(r: Rule, key: Column, **n: Column) -> Column:
        return F.struct(F.lit(r.name).alias("rule"), F.lit(r.kind).alias("kind"), key.alias("key"), *[
            n.get(c, F.lit(0)).cast("long").alias(c) for c in ("holds", "refers", "broken")])
    none = F.lit(None).cast("string")
    marks = []
    for r in mine:
        if r.kind in ("unique", "foreign_key"):
            marks.append(mark(r, _key(r.columns), holds=F.lit(1)))
        else:
            marks.append(F.when(F.coalesce(_broken(r), F.lit(False)), mark(r, none, broken=F.lit(1))))
    marks += [mark(r, _key([r.ref_column]), refers=F.lit(1)) for r in referred]
    used = {c for r in mine for c in r.columns} | {r.ref_column for r in referred}
    rows = df.select(*sorted(used)).select(F.explode(F.filter(F.array(*marks), lambda m: m.isNotNull()
                                           & (m["key"].isNotNull() | (m["broken"] > 0)))).alias("m"))
    return rows.select("m.*")


def validate_tables(tables: Mapping[str, DataFrame], rules: Sequence[Rule]) -> DataFrame:
    """(rule, violations) of every rule, each table scanned once."""
    parts = []
    for name, df in tables.items():
        mine = [r for r in rules if r.table == name]
        referred = [r for r in rules if r.ref == name]
        if mine or referred:
            parts.append(_marks(df, mine, referred))
    spark = next(iter(tables.values())).sparkSession
    keys = reduce(DataFrame.unionByName, parts).groupBy("rule", "kind", "key").agg(
        *[F.sum(c).alias(c) for c in ("holds", "refers", "broken")])
    wrong = F.when(F.col("kind") == "unique", F.col("holds") - 1).when(
        F.col("kind") == "foreign_key", F.when(F.col("refers") == 0, F.col("holds")).otherwise(
            F.lit(0))).otherwise(F.col("broken"))
    found = keys.groupBy("rule").agg(F.sum(wrong).alias("n"))
    named = spark.createDataFrame([(r.name,) for r in rules], "rule string")
    return named.join(found, "rule", "left").select(
        "rule", F.coalesce("n", F.lit(0)).cast("long").alias("violations"))


def validate(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Violations per rule for one table, whose foreign keys refer to frames."""
    if not rules:
        return df.sparkSession.createDataFrame([], "rule string, violations long")
    tables, named = {ONE: df}, []
    for i, r in enumerate(rules):
        if r.kind == "foreign_key":
            tables[f"ref{i}"] = r.ref
            r = Rule(r.name, r.kind, r.columns, ref=f"ref{i}", ref_column=r.ref_column)
        named.append(r)
    return validate_tables(tables, named)


def schema_rules(benchmarks: Sequence[str]) -> list[Rule]:
    """The constraints of the reference's tables as rules."""
    t = lambda table, make, *args: make(f"{table}_{make.__name__}_{args[0]}" + (
        f"_{args[1]}" if make is unique and len(args) > 1 else ""), *args, table=table)
    # The domains of the schema.
    labels, statuses = ("positive", "neutral", "negative"), ("pending", "processed", "failed")
    out = [
        t("sources", unique, "source_name"), t("sources", unique, "feed_url"),
        t("sources", domain, "source_type", ("rss", "api", "website", "manual")),
        t("articles_raw", unique, "url_hash"), t("articles_raw", unique, "source_id", "external_guid"),
        t("articles_raw", not_null, "url"), t("articles_raw", not_null, "title"),
        t("articles_raw", longest, "url_hash", 64), t("articles_raw", longest, "language_code", 10),
        t("articles_raw", foreign_key, "source_id", "sources", "source_name"),
        t("articles_processed", unique, "article_id"),
        t("articles_processed", domain, "sentiment_label", labels),
        t("articles_processed", domain, "processing_status", statuses),
        t("articles_processed", foreign_key, "article_id", "articles_raw", "article_id"),
        t("topics", unique, "topic_name"),
        t("article_topic_scores", unique, "article_id", "topic_id"),
        t("article_topic_scores", foreign_key, "article_id", "articles_raw", "article_id"),
        t("article_topic_scores", foreign_key, "topic_id", "topics", "topic_id"),
        t("daily_news_features", unique, "feature_date"),
        t("daily_topic_features", unique, "feature_date", "topic_id"),
        t("daily_topic_features", foreign_key, "topic_id", "topics", "topic_id"),
        t("daily_topic_features", non_negative, "article_count"),
        t("oil_prices", unique, "benchmark_code", "price_date"),
        t("oil_prices", domain, "benchmark_code", tuple(benchmarks)),
        t("oil_prices", not_null, "close_price"),
        t("model_features", unique, "benchmark_code", "feature_date"),
        t("model_features", domain, "target_direction_next_day", (-1, 0, 1)),
        t("model_runs", unique, "model_run_id"),
        t("model_runs", domain, "run_status", ("started", "completed", "failed")),
        t("model_runs", domain, "benchmark_code", tuple(benchmarks)),
        t("predictions", unique, "prediction_id"),
        t("predictions", foreign_key, "model_run_id", "model_runs", "model_run_id"),
        t("predictions", domain, "predicted_direction", (-1, 0, 1)),
        t("monitoring_logs", unique, "monitoring_id"),
        t("monitoring_logs", domain, "log_type", ("data_quality", "feature_drift", "model_drift",
                                                  "pipeline", "system")),
        t("monitoring_logs", domain, "severity", ("info", "warning", "error")),
    ]
    counts = ("article_count", "distinct_source_count", "positive_article_count",
              "neutral_article_count", "negative_article_count")
    return out + [t("daily_news_features", non_negative, c) for c in counts]
