"""Registered queries against their DuckDB oracle at sf0.001 (fast subset;
tools/check.py runs every key at sf0.01)."""

import duckdb
import pytest

import __spark_entry__ as E
from tools.check import digest
from tradewind.io import TABLES

from .conftest import SF_SMALL

FAST = ["price_features", "news_price_features", "forward_asof_news", "daily_news_features",
        "daily_event_features", "news_price_alignment", "clean_text", "topic_scores",
        "relevance", "lexicon_sentiment", "process_articles", "dedup_two_keys",
        "insert_if_absent", "ingest_counts", "price_upsert", "quality_report",
        "chronological_split", "ts_cv_folds", "drift_decisions", "retrain_actions",
        "serve_model_comparison", "latest_features", "stream_daily_news"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", FAST)
def test_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF_SMALL)
    rel = con.sql(E.oracle_sql()[key])
    assert sorted(df.columns) == sorted(rel.columns)
    hs, _ = digest(df.columns, [tuple(r) for r in df.collect()])
    ho, _ = digest(rel.columns, rel.fetchall())
    assert hs == ho


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "news_avg_sentiment_3d" in df.columns
