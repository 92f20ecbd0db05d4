"""The daily run: retried on the same root nothing is added twice; a later run only
adds its own rows; retrained models are registered and start the cooldown."""

import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from tradewind.operators import tables as TB
from tradewind.plans import daily as D
from tradewind.plans import models as MD
from tradewind.plans import registry_m as RM
from tradewind.registry import LEX, TAX, _landing, _m, q_daily_run
from tradewind.session import scratch_path

from .conftest import SF_SMALL

APPENDED = ("articles_raw", "processing_queue", "articles_processed", "model_runs", "predictions",
            "monitoring_logs", "retrain_actions", "parameters")


def _files(root, *tables):
    return {os.path.join(d, n): os.stat(os.path.join(d, n)).st_mtime_ns for t in tables
            for d, _, names in os.walk(f"{root}/{t}") for n in names if n.endswith(".parquet")}


@pytest.fixture(scope="module")
def daily(spark):
    """(root, run): ``run(as_of)`` gives the rows of every stage."""
    root = scratch_path(spark, f"daily-test-{uuid.uuid4().hex[:8]}").removeprefix("file:")
    trained = []

    def train(feats, news):
        trained.append(news)
        rows = feats.where("target_close_next_day is not null").withColumn("split", F.lit("test"))
        preds = {n: rows.withColumn("prediction", F.col("close_price") * f) for n, f in (
            ("One", 1.0), ("Two", 0.5))}
        return preds, spark.createDataFrame([("One", "{}")], "model_name string, params string")

    def run(as_of):
        out = D.run_daily(spark, SF_SMALL, root, _landing(spark, SF_SMALL), TAX, LEX, as_of,
                          imported=_m(spark, SF_SMALL), train=train)
        return {r.table_name: r.rows for r in out.collect()}
    run.trained = trained
    return root, run


def test_daily_runs(spark, daily):
    root, run = daily
    first = run(RM.AS_OF)
    assert all(first.values()) and first["articles_processed"] == first["articles_raw"]
    waiting = D.queue(spark, root)
    assert waiting.where("processing_status = 'pending'").count() == 0
    assert waiting.count() == first["articles_raw"] == waiting.select("article_id").distinct().count()
    raw = TB.read_runs(spark, f"{root}/articles_raw")
    assert raw.where("raw_payload is null or created_at is null or feed_file is null").count() == 0
    runs, preds = D.registry(spark, root)
    live = preds.where("not is_backtest")
    assert live.count() == 5 and live.where("actual_close is not null").count() == 0

    # what was retrained is registered with its errors, predictions and parameters
    actions = {r.group_prefix: r.action for r in TB.read_runs(spark, f"{root}/retrain_actions").collect()}
    due = [g for g, a in actions.items() if a == "retrain"]
    assert due and len(run.trained) == len(due)
    for g in due:
        mine = runs.where(F.col("model_version") == RM.AS_OF).where(F.col("model_name").startswith(g))
        assert {r.model_name for r in mine.collect()} == {f"{g}One", f"{g}Two", f"{g}Ensemble"}
        assert mine.where("mae is null or test_start_date is null or run_status <> 'completed'").count() == 0
        assert preds.join(mine, "model_run_id", "left_semi").where(
            "is_backtest and actual_close is not null").count() > 0
    assert TB.read_runs(spark, f"{root}/parameters").count() == len(due)
    assert preds.join(runs, "model_run_id", "left_anti").count() == 0
    assert preds.count() == preds.select("prediction_id").distinct().count()
    logs = TB.read_runs(spark, f"{root}/monitoring_logs")
    steps = [(r.severity, json.loads(r.details)) for r in logs.where("log_type = 'pipeline'").collect()]
    assert len(steps) == 1 + sum({"retrain": 2, "cooldown": 1}.get(a, 0) for a in actions.values())
    assert sum(s == "warning" for s, _ in steps) == len(due)
    assert logs.count() == logs.select("monitoring_id").distinct().count()

    # the same run again: a retry
    assert run(RM.AS_OF) == first
    assert len(run.trained) == 2 * len(due)

    # half a day later: only its own rows, prices and features untouched, cooldown
    before = _files(root, *APPENDED, "prices", "model_features")
    later = "2001-09-02 12:00:00"
    second = run(later)
    after = _files(root, *APPENDED, "prices", "model_features")
    assert {n: after.get(n) for n in before} == before
    assert all("run=2001-09-02-12-00-00" in n for n in set(after) - set(before))
    same = ("prices", "articles_raw", "articles_processed", "model_features")
    assert {t: second[t] for t in same} == {t: first[t] for t in same}
    assert second["predictions"] > first["predictions"]
    now = {r.group_prefix: r.action for r in TB.read_runs(spark, f"{root}/retrain_actions").where(
        "run = '2001-09-02-12-00-00'").collect()}
    # those retrained rest; one whose imported run is a day old by now may follow
    assert all(now[g] in ("cooldown", "skipped") for g in due) and "cooldown" in now.values()
    assert len(run.trained) == 2 * len(due) + sum(a == "retrain" for a in now.values())
    # read again: the retry replaced the files of its run
    logs = TB.read_runs(spark, f"{root}/monitoring_logs").withColumn(
        "later", F.col("run").startswith("2001-09-02-12"))
    ends = {r.later: (r.low, r.high) for r in logs.groupBy("later").agg(
        F.min("monitoring_id").alias("low"), F.max("monitoring_id").alias("high")).collect()}
    assert ends[True][0] > ends[False][1]


def test_query_trains_on_what_the_run_stored(spark, monkeypatch):
    fitted = []
    monkeypatch.setattr(MD, "fit_all", lambda feats, news: fitted.append((feats, news)))
    monkeypatch.setattr(D, "run_daily", lambda *args, train, **kw: [
        train("features of the run", news) for news in (False, True)])
    q_daily_run(spark, SF_SMALL)
    assert fitted == [("features of the run", False), ("features of the run", True)]


def test_ids_of_names_that_share_a_hash(spark):
    rows = spark.createDataFrame([(f"m{i}",) for i in range(50)], "name string")
    assert D.numbered(rows, RM.AS_OF, "id", "name").select("id").distinct().count() == 50
    with pytest.raises(ValueError):
        D.numbered(rows.unionByName(rows), RM.AS_OF, "id", "name")


def test_items_are_parsed_once_and_first_wins(spark):
    parsed = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def parse(text):
        parsed.add(1)
        return text
    # (url key, guid, reject reason) in order of offer
    offered = [("u1", "g1", None), ("u2", "g1", None), ("u2", "g3", None), ("u4", None, "no title"),
               ("u4", None, None), ("u5", "g5", None), ("u5", "g6", None), ("u6", "g6", None)]

    def items(rows, file):
        return spark.createDataFrame(
            [("s", i, g, u, "text", file, why) for i, (u, g, why) in enumerate(rows)],
            "source_id string, position long, external_guid string, url_hash string, title string, "
            "feed_file string, reject_reason string").withColumn("url_hash", parse("url_hash"))
    root = scratch_path(spark, f"articles-test-{uuid.uuid4().hex[:8]}")
    kept = {("u1", "g1", 0), ("u2", "g3", 2), ("u4", None, 4), ("u5", "g5", 5), ("u6", "g6", 7)}

    def held(raw):
        return {(r.url_hash, r.external_guid, r.position) for r in raw.collect()}
    assert held(D.insert_articles(spark, root, "2001-09-02", items(offered, "a"))) == kept
    assert parsed.value == len(offered)
    # a later run offers them again among others: few are new, then most
    assert held(D.insert_articles(spark, root, "2001-09-03", items(
        [*offered, ("u7", "g7", None)], "b"))) == kept | {("u7", "g7", 8)}
    more = [("u8", None, None), ("u9", "g9", None), ("u1", "g10", None)]
    assert held(D.insert_articles(spark, root, "2001-09-04", items(more, "c"))) == kept | {
        ("u7", "g7", 8), ("u8", None, 0), ("u9", "g9", 1)}
    assert parsed.value == 2 * len(offered) + 1 + len(more)
