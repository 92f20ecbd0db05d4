"""Streams equal the batch result, whatever the files' order and batching."""

import datetime as dt
import os
import uuid

import pytest

from tradewind.session import scratch_path
from tradewind.streaming import jobs as J

SCHEMA = ("article_id long, source_id string, published_at timestamp, published_date date, "
          "processing_status string, relevance_e4 long, sentiment_e4 long, "
          "sentiment_label string, dedup_key string")


@pytest.fixture()
def items(spark):
    rows = []
    for i in range(200):
        t = dt.datetime(2024, 1, 1 + i // 25, i % 24)
        rows.append((i, f"s{i % 3}", t, t.date(), "processed" if i % 7 else "failed",
                     i % 5 * 100, i * 10 - 900, ("positive", "neutral", "negative")[i % 3],
                     f"k{i % 60}"))
    return spark.createDataFrame(rows, SCHEMA)


def _work(spark):
    return scratch_path(spark, f"t-{uuid.uuid4().hex[:8]}").removeprefix("file:")


def _arrive(rows, path, at):
    """One more file, ``at`` seconds after the first."""
    before = set(os.listdir(path)) if os.path.exists(path) else set()
    rows.coalesce(1).write.mode("append").parquet(path)
    for name in set(os.listdir(path)) - before:
        os.utime(f"{path}/{name}", (1_700_000_000 + at,) * 2)


def _states(work):
    """Entries of the state store after the last batch, from the checkpoint's log."""
    from pyspark.sql import SparkSession
    s = SparkSession.getActiveSession()
    return s.read.format("statestore").load(f"{work}/state-checkpoint").count()


def _days(items, *days):
    return items.where(f"day(published_at) in ({','.join(map(str, days))})")


def test_daily_state_late_rows_and_restart(spark, items):
    path, work = _work(spark), _work(spark)
    order = [1, 3, 2, 4, 6, 5]          # out of order, but within the two days
    for at, day in enumerate(order):
        _arrive(_days(items, day), path, at)
    got = J.stream_daily(spark, path, work, files_per_batch=1)
    assert sorted(got.collect()) == sorted(J.batch_daily(_days(items, *order)).collect())
    assert J.late_rows(spark, work, SCHEMA).count() == 0
    before = {n: os.listdir(f"{work}/daily_sums/{n}") for n in os.listdir(f"{work}/daily_sums")
              if "=" in n}
    # the stream goes on: a new day, and a file that is five days late
    _arrive(_days(items, 8), path, 20)
    _arrive(_days(items, 3).where("article_id % 2 = 0"), path, 21)
    got = J.stream_daily(spark, path, work, files_per_batch=1)
    on_time = _days(items, *order, 8)
    assert sorted(got.collect()) == sorted(J.batch_daily(on_time).collect())
    late = J.late_rows(spark, work, SCHEMA)
    assert late.columns == items.columns and sorted(late.collect()) == sorted(
        _days(items, 3).where("article_id % 2 = 0").collect())
    # only the new day's partition was written
    after = {n: os.listdir(f"{work}/daily_sums/{n}") for n in os.listdir(f"{work}/daily_sums")
             if "=" in n}
    assert {n for n in after if after[n] != before.get(n)} == {"feature_date=2024-01-08"}
    # closed days have left the store: the watermark stands at the 6th
    assert _states(work) <= 3 * 3
    # a run without new files changes nothing
    again = J.stream_daily(spark, path, work, with_late=True)
    want = J.batch_daily(on_time.unionByName(late))
    assert sorted(again.collect()) == sorted(want.collect())


def test_daily_whole_in_any_order_with_late_rows(spark, items):
    path = _work(spark)
    for at, day in enumerate((8, 1, 5, 2, 7, 3, 6, 4)):
        _arrive(_days(items, day), path, at)
    work = _work(spark)
    got = J.stream_daily(spark, path, work, files_per_batch=1, with_late=True)
    assert sorted(got.collect()) == sorted(J.batch_daily(items).collect())
    # everything further than two days behind the newest event of the 8th
    newest = _days(items, 8).agg({"published_at": "max"}).first()[0]
    assert J.late_rows(spark, work, SCHEMA).count() == sum(
        r.published_at < newest - dt.timedelta(days=2) for r in items.collect())


def test_dedup_keeps_the_earliest_in_any_order(spark, items):
    path, work = _work(spark), _work(spark)
    for at, lo in enumerate((150, 0, 100, 50)):
        _arrive(items.where(f"article_id >= {lo} and article_id < {lo + 50}"), path, at)
    got = J.stream_dedup(spark, path, "dedup_key", "article_id", work, files_per_batch=1)
    assert sorted(got.select(*items.columns).collect()) == sorted(
        items.where("article_id < 60").collect())
    assert _states(work) <= 60 and J.late_rows(spark, work, SCHEMA).count() > 0
    # a key that comes again later adds nothing but its own entry
    entries = len(os.listdir(f"{work}/entries"))
    _arrive(items.where("article_id = 199"), path, 30)
    again = J.stream_dedup(spark, path, "dedup_key", "article_id", work)
    assert sorted(again.collect()) == sorted(got.collect())
    assert len(os.listdir(f"{work}/entries")) >= entries


def test_landed_files_arrive_in_event_order(spark, items):
    path = _work(spark)
    J.land_items(items, path, 25)
    work = _work(spark)
    J.split_late(spark, path, work, "1 hour", 1)
    assert J.late_rows(spark, work, SCHEMA).count() == 0
    assert len(os.listdir(f"{work}/on_time")) >= 4


def test_many_small_files_take_few_batches(spark, items, monkeypatch):
    """Batches go by bytes: 40 small files are one; and landing bounds its files."""
    path, work = _work(spark), _work(spark)
    J.land_items(items, path, 5)
    assert sum(n.startswith("part-") for n in os.listdir(path)) == 40
    got = J.stream_dedup(spark, path, "dedup_key", "article_id", work)
    assert len(os.listdir(f"{work}/on_time")) == 1
    assert sorted(got.select(*items.columns).collect()) == sorted(
        items.where("article_id < 60").collect())
    monkeypatch.setattr(J, "LANDED_FILES", 6)
    monkeypatch.setattr(J, "BATCH_BYTES", 2 * os.path.getsize(
        f"{path}/{next(n for n in os.listdir(path) if n.startswith('part-'))}"))
    path, work = _work(spark), _work(spark)
    J.land_items(items, path, 5)
    assert sum(n.startswith("part-") for n in os.listdir(path)) == 6
    again = J.stream_dedup(spark, path, "dedup_key", "article_id", work)
    assert len(os.listdir(f"{work}/on_time")) > 1
    assert sorted(again.collect()) == sorted(got.collect())


def test_a_batch_that_was_shown_stays(spark, items):
    work = _work(spark)
    J._publish(items, f"{work}/on_time", 0)
    names = os.listdir(f"{work}/on_time/batch=0")
    J._publish(items.limit(1), f"{work}/on_time", 0)
    assert os.listdir(f"{work}/on_time/batch=0") == names
