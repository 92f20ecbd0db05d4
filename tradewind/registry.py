"""Registered queries: name -> (spark, sf_dir) -> DataFrame, plus oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bindings as B
from . import oracles as O
from .io import table
from .operators import aggregates as AG
from .operators import topics as TP
from .plans import articles as AR
from .plans import features as FE
from .sources.dimensions import test_lexicon, test_taxonomy

TAX = test_taxonomy()
LEX = test_lexicon()

Query = Callable[[SparkSession, str], DataFrame]


def _prices(spark, d):
    return B.price_series(table(spark, d, "orders"))


def _checked_prices(spark, d):
    from .sources.prices import validate_price_history
    return validate_price_history(_prices(spark, d))


def _daily(spark, d):
    return AG.daily_news(B.news_items(table(spark, d, "documents")))


def q_price_features(spark, d):
    return FE.price_features(_prices(spark, d))


def q_news_price_features(spark, d):
    return FE.model_features(_prices(spark, d), _daily(spark, d))


def q_forward_asof_news(spark, d):
    return FE.forward_asof_news(_prices(spark, d), _daily(spark, d))


def q_daily_news_features(spark, d):
    return _daily(spark, d)


def q_daily_event_features(spark, d):
    return AG.daily_news(B.scored_events(table(spark, d, "events")))


def _scored(spark, d):
    return AR.score_articles(B.articles(table(spark, d, "documents")), TAX, LEX)


def q_clean_text(spark, d):
    c = AR.cleaned(B.articles(table(spark, d, "documents")))
    return c.select("article_id", F.col("c_title").alias("cleaned_title"),
                    F.col("c_summary").alias("cleaned_summary"),
                    F.col("c_content").alias("cleaned_content"),
                    F.col("c_combined").alias("cleaned_combined"))


def q_topic_scores(spark, d):
    return AR.topic_score_rows(_scored(spark, d), TAX).drop("topic_score_e4")


def q_relevance(spark, d):
    from .operators.topics import score_topics
    s = score_topics(AR.cleaned(B.articles(table(spark, d, "documents"))), TAX)
    names = F.create_map(*[x for t, n in TAX.topic_ids for x in (F.lit(t), F.lit(n))])
    return s.filter("_ok").select(
        "article_id", (F.col("relevance_e4") / F.lit(10000.0)).alias("relevance_score"),
        "primary_topic_id", F.element_at(names, F.col("primary_topic_id")).alias("primary_topic_name"))


def q_lexicon_sentiment(spark, d):
    from .operators.sentiment import label, with_compound
    c = AR.cleaned(B.articles(table(spark, d, "documents")))
    s = with_compound(c, "c_combined", LEX, out="_c")
    e4 = F.when(F.col("_ok"), F.round(F.col("_c") * 10000).cast("long")).otherwise(F.lit(0))
    return s.select("article_id", (e4 / F.lit(10000.0)).alias("sentiment_score"),
                    label(e4).alias("sentiment_label"))


FILLERS = 7_500      # entries of a full lexicon or taxonomy that the texts do not hold


def q_topic_scores_joined(spark, d):
    """The topic rows by an n-gram join with a keyword table of full size."""
    from .operators import keyword_join as KJ
    from .sources.dimensions import keywords_frame
    more = spark.range(FILLERS).select(
        (F.col("id") % len(TAX.topics) + 1).cast("int").alias("topic_id"),
        F.concat(F.lit("zq"), "id", F.when(F.col("id") % 3 == 0, " and more").otherwise(""))
        .alias("keyword"))
    c = AR.cleaned(B.articles(table(spark, d, "documents"))).where("_ok")
    s = KJ.topic_scores(c, keywords_frame(spark, TAX).select("topic_id", "keyword").unionByName(more))
    return s.select("article_id", "topic_id",
                    (F.col("topic_score_e4") / F.lit(10000.0)).alias("topic_score"),
                    "is_primary_topic")


def q_lexicon_sentiment_joined(spark, d):
    """The sentiment by a join with a lexicon table of full size."""
    from .operators import keyword_join as KJ
    from .operators.sentiment import label
    more = spark.range(FILLERS).select(
        F.concat(F.lit("zq"), "id").alias("token"), (F.col("id") % 9 - 4).cast("double").alias("valence"),
        F.lit(None).cast("double").alias("boost"), F.lit(False).alias("negates"))
    c = AR.cleaned(B.articles(table(spark, d, "documents")))
    s = KJ.compound(c.where("_ok"), "c_combined", KJ.lexicon_table(spark, LEX).unionByName(more))
    e4 = F.coalesce(F.round(F.col("sentiment_score") * 10000).cast("long"), F.lit(0))
    return c.select("article_id").join(s, "article_id", "left").select(
        "article_id", (e4 / F.lit(10000.0)).alias("sentiment_score"), label(e4).alias("sentiment_label"))


def q_process_articles(spark, d):
    return AR.processed_rows(_scored(spark, d), TAX)


def q_daily_topic_features(spark, d):
    s = AR.persisted_scores(_scored(spark, d), TAX)
    return AG.daily_topics(s, TP.topic_rows(s.filter("_ok"), TAX))


def q_daily_scored_news(spark, d):
    return AG.daily_news(AR.persisted_scores(_scored(spark, d), TAX))


def q_news_price_alignment(spark, d):
    p = _prices(spark, d)
    daily = _daily(spark, d)
    return p.join(daily, p["price_date"] == daily["feature_date"], "left").select(
        "benchmark_code", "price_date", "open_price", "high_price", "low_price", "close_price",
        "volume", "article_count", "distinct_source_count", "avg_sentiment",
        "weighted_avg_sentiment", "avg_relevance", "positive_article_count",
        "neutral_article_count", "negative_article_count")


def _landing(spark, d, *shapes):
    """Land the X feed files (derived from pages / documents) once per session: those of
    ``shapes``, else of all readers."""
    import hashlib
    from .session import scratch_path
    key = hashlib.sha1(d.encode()).hexdigest()[:10]
    path = scratch_path(spark, f"landing-{key}")
    land = {"rss": (B.land_rss, "pages"), "search": (B.land_search, "documents"),
            "timeline": (B.land_timeline, "documents")}
    for shape in shapes or land:
        if spark.conf.get(f"tradewind.landing.{shape}.{key}", None) != path:
            write, name = land[shape]
            write(table(spark, d, name), f"{path}/{shape}")
            spark.conf.set(f"tradewind.landing.{shape}.{key}", path)
    return path


def _sources(spark, d):
    return B.source_registry(table(spark, d, "documents"), table(spark, d, "pages"))


def q_feed_items_rss(spark, d):
    from .sources.feeds import read_rss
    return read_rss(spark, f"{_landing(spark, d, 'rss')}/rss")


def q_feed_items_search(spark, d):
    from .sources.feeds import read_search
    return read_search(spark, f"{_landing(spark, d, 'search')}/search")


def q_feed_items_timeline(spark, d):
    from .sources.feeds import read_timeline
    return read_timeline(spark, f"{_landing(spark, d, 'timeline')}/timeline")


def q_payload_variant(spark, d):
    """I8: the payloads of the three readers, stored as variants and read by path."""
    import uuid
    from .session import scratch_path
    from .sources.feeds import rss_items, search_items, stored_payloads, timeline_items
    land = _landing(spark, d)
    path = scratch_path(spark, f"payloads-{uuid.uuid4().hex}")
    read = {"rss": (rss_items, "$.entry_id", "$.tags[0]", F.size(
                F.try_variant_get("payload", "$.tags", "array<string>")).cast("bigint")),
            "search": (search_items, "$.objectID", "$.author", F.try_variant_get(
                "payload", "$.points", "bigint")),
            "timeline": (timeline_items, "$.id", "$.account.acct", F.lit(None).cast("bigint"))}
    out = None
    for shape, (items, item_id, label, n) in read.items():
        held = stored_payloads(items(spark, f"{land}/{shape}"), f"{path}/{shape}")
        part = held.select(
            F.lit(shape).alias("shape"), F.try_variant_get("payload", item_id, "string").alias("item_id"),
            F.try_variant_get("payload", label, "string").alias("label"), n.alias("n"))
        out = part if out is None else out.unionByName(part)
    return out


def q_feed_ingest(spark, d):
    from .sources.feeds import ingest
    return ingest(spark, _sources(spark, d), _landing(spark, d))


def q_active_sources(spark, d):
    from .sources.feeds import route_sources
    return route_sources(_sources(spark, d)).select(
        "source_name", "source_type", "feed_url", "domain_name", "reader")


def _rss_keys(spark, d):
    from .functions.text import url_hash
    k = B.rss_item_keys(table(spark, d, "pages")).drop("html")
    return k.select("source_id", "position", "url", "guid",
                    url_hash("url").alias("url_hash"),
                    F.when(F.col("guid").isNotNull(), F.concat_ws("\u0001", "source_id", "guid"))
                    .alias("guid_key"),
                    F.struct("source_id", "position").alias("_ord"))


def q_dedup_two_keys(spark, d):
    from .operators.dedup import first_wins_two_keys
    acc = first_wins_two_keys(_rss_keys(spark, d), "_ord", "url_hash", "guid_key")
    return acc.select("source_id", "position", "url", "guid")


def q_insert_if_absent(spark, d):
    from .functions.text import url_hash
    from .operators.sinks import insert_if_absent
    pages = table(spark, d, "pages")
    history = (pages.filter(F.col("page_id") % 4 == 0)
               .select(url_hash(F.concat(F.lit("  "), F.upper("url"), F.lit("\t")))
                       .alias("url_hash")))
    batch = _rss_keys(spark, d).select("source_id", "position", "url", "url_hash")
    ins = insert_if_absent(history, batch, "url_hash", ["source_id", "position"])
    return ins.select("source_id", "position", "url", "url_hash")


def q_ingest_counts(spark, d):
    from .operators.sinks import insert_if_absent
    batch = _rss_keys(spark, d).select("source_id", "position", "url", "url_hash")
    ins = insert_if_absent(batch.filter(F.lit(False)).select("url_hash"), batch, "url_hash",
                           ["source_id", "position"])
    per = (batch.groupBy("source_id").agg(F.count(F.lit(1)).alias("offered"))
           .join(ins.groupBy("source_id").agg(F.count(F.lit(1)).alias("inserted")),
                 "source_id", "left")
           .select("source_id", "offered", F.coalesce("inserted", F.lit(0)).alias("inserted")))
    return (per.rollup("source_id")
            .agg(F.sum("inserted").alias("inserted"),
                 (F.sum("offered") - F.sum("inserted")).alias("skipped"))
            .select(F.coalesce("source_id", F.lit("TOTAL")).alias("source_id"),
                    "inserted", "skipped"))


CUTOVER = "2000-01-01"      # upsert tests: target before, batch from OVERLAP on
OVERLAP = "1999-10-01"


def _month(day):
    return (F.year(day) * 100 + F.month(day)).alias("month")


def _upserted(spark, name, target, updates, day, **kw):
    """The month-partitioned table of ``target`` after an upsert of ``updates``."""
    import uuid
    from .operators.tables import upsert_partitioned, write_partitions
    from .session import scratch_path
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    write_partitions(target.select("*", _month(day)), path, "month")
    return upsert_partitioned(path, updates.select("*", _month(day)), ["benchmark_code", day],
                              "month", **kw).drop("month")


def _landed_prices(spark, d):
    """The price history as landed CSV files, written once per session."""
    import hashlib
    from .session import scratch_path
    from .sources.prices import read_price_files
    key = hashlib.sha1(d.encode()).hexdigest()[:10]
    path = scratch_path(spark, f"price-files-{key}")
    if spark.conf.get("tradewind.prices." + key, None) != path:
        _prices(spark, d).select("benchmark_code", "price_date", "open_price", "high_price",
                                 "low_price", "close_price", "volume").hint("rebalance").write.mode(
            "overwrite").option("header", True).csv(path)
        spark.conf.set("tradewind.prices." + key, path)
    return read_price_files(spark, path)[0]


def q_price_upsert(spark, d):
    p = _landed_prices(spark, d)
    pid = (F.datediff("price_date", F.lit("1970-01-01")) * 10
           + F.substring("benchmark_code", 1, 1).cast("int")).cast("long")
    target = p.filter(F.col("price_date") < CUTOVER).select(
        pid.alias("price_id"), "benchmark_code", "price_date", "open_price", "high_price",
        "low_price", "close_price", F.lit(None).cast("double").alias("adjusted_close_price"),
        "volume", F.lit("2000-01-01 00:00:00").cast("timestamp").alias("created_at"))
    updates = p.filter(F.col("price_date") >= OVERLAP).select(
        (pid + 5).alias("price_id"), "benchmark_code", "price_date", "open_price", "high_price",
        "low_price", "close_price", F.col("close_price").alias("adjusted_close_price"),
        (F.col("volume") + 1).alias("volume"),
        F.lit("2001-09-01 00:00:00").cast("timestamp").alias("created_at"))
    return _upserted(spark, "price-upsert", target, updates, "price_date",
                     preserve=["price_id", "created_at"])


def q_feature_upsert(spark, d):
    p = _prices(spark, d)
    old = FE.price_features(p.filter(F.col("price_date") < CUTOVER))
    new = FE.price_features(p).filter(F.col("feature_date") >= OVERLAP)
    return _upserted(spark, "feature-upsert", old, new, "feature_date")


def q_source_upsert(spark, d):
    from .operators.sinks import upsert
    src = _sources(spark, d)
    stamp = F.lit("2001-09-01 00:00:00").cast("timestamp")
    target = src.select("source_name", "source_type", "feed_url", "domain_name",
                        (F.col("source_type") == "rss").alias("is_active"),
                        F.lit("2000-01-01 00:00:00").cast("timestamp").alias("updated_at"))
    updates = (src.filter(F.col("domain_name") != "unsupported.example")
               .select("source_name", "source_type", "feed_url", "domain_name",
                       F.lit(True).alias("is_active"), stamp.alias("updated_at")))
    return upsert(target, updates, ["source_name"])


def q_full_refresh(spark, d):
    from .session import scratch_path
    path = scratch_path(spark, "daily_news_features")
    daily = _daily(spark, d)
    for _ in range(2):      # a refresh is idempotent: running it twice changes nothing
        daily.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def q_child_replace(spark, d):
    from .operators.sinks import replace_children
    from .sources.dimensions import Taxonomy
    old_tax = Taxonomy([(n, [k for k in kws if k != "que"]) for n, kws in TAX.topics])
    arts = B.articles(table(spark, d, "documents"))
    old = AR.topic_score_rows(AR.score_articles(arts, old_tax, LEX), old_tax)
    changed = arts.filter(F.col("article_id") % 3 == 0)      # scored where they lie
    touched = changed.select("article_id")
    new = AR.topic_score_rows(AR.score_articles(changed, TAX, LEX), TAX)
    cols = ["article_id", "topic_id", "topic_score", "is_primary_topic"]
    return replace_children(old.select(*cols), new.select(*cols), "article_id", touched)


def q_quality_report(spark, d):
    from .operators import quality as Q
    prices = _prices(spark, d)
    tables = {
        "prices": prices, "news": B.news_items(table(spark, d, "documents")),
        "items": _rss_keys(spark, d), "daily": _daily(spark, d),
        "features": FE.price_features(prices), "sources": _sources(spark, d)}
    return Q.validate_tables(tables, [
        Q.unique("prices_unique_series_date", "benchmark_code", "price_date", table="prices"),
        Q.not_null("prices_close_not_null", "close_price", table="prices"),
        Q.domain("news_label_domain", "sentiment_label", ["negative", "neutral", "positive"], table="news"),
        Q.domain("news_status_domain", "processing_status", ["pending", "processed", "failed"],
                 table="news"),
        Q.unique("items_unique_url_hash", "url_hash", table="items"),
        Q.unique("items_unique_source_guid", "source_id", "guid", table="items"),
        Q.not_null("items_url_not_null", "url", table="items"),
        Q.foreign_key("items_source_fk", "source_id", "sources", "source_name", table="items"),
        Q.non_negative("daily_article_count_nonneg", "article_count", table="daily"),
        Q.non_negative("daily_positive_nonneg", "positive_article_count", table="daily"),
        Q.unique("daily_unique_date", "feature_date", table="daily"),
        Q.domain("features_direction_domain", "target_direction_next_day", [-1, 0, 1], table="features"),
        Q.unique("features_unique_series_date", "benchmark_code", "feature_date", table="features")])


# one series is left out, so that a rule is broken
SCHEMA_BENCHMARKS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED")


def q_schema_report(spark, d):
    """C11: every constraint of the reference's tables over the bound tables.  The
    topic rows and the benchmark codes are bound so that some rules are broken."""
    from .operators import quality as Q
    from .session import cut_lineage
    from .sources.dimensions import topics_frame
    prices = _prices(spark, d)
    news = B.news_items(table(spark, d, "documents"))
    topics = news.select("article_id", "published_date",
                         (F.col("article_id") % 6 + 1).alias("topic_id"))
    runs, logs = _logs(spark, d)
    preds = _m(spark, d)[1]
    tables = {
        "sources": _sources(spark, d),
        "articles_raw": _rss_keys(spark, d).select(
            F.col("position").alias("article_id"), "source_id", "url", "url_hash",
            F.col("guid").alias("external_guid"), F.col("url").alias("title"),
            F.col("guid").alias("language_code")),
        "articles_processed": news, "topics": topics_frame(spark, TAX),
        "article_topic_scores": topics, "daily_news_features": cut_lineage(AG.daily_news(news)),
        "daily_topic_features": topics.groupBy(
            F.col("published_date").alias("feature_date"), "topic_id").agg(
            (F.count("*") - 2).alias("article_count")),
        "oil_prices": prices, "model_features": FE.price_features(prices),
        "model_runs": runs.withColumn("run_status", F.lit("completed")),
        "predictions": preds.withColumn("predicted_direction", F.signum(
            F.col("predicted_close") - F.col("actual_close")).cast("int")),
        "monitoring_logs": logs}
    return Q.validate_tables(tables, Q.schema_rules(SCHEMA_BENCHMARKS))


def _m(spark, d):
    """Binding M: the reference stores runs and predictions as tables; the
    feature input is written once (checkpoint) and read by every branch."""
    from .plans import registry_m as M
    from .session import cut_lineage
    feats = cut_lineage(FE.price_features(_prices(spark, d)))
    return M.model_runs(feats), M.predictions(feats)


def q_latest_runs(spark, d):
    from .plans.monitor import latest_runs
    runs, _ = _m(spark, d)
    return latest_runs(runs).select("benchmark_code", "model_name", "model_run_id",
                                    "model_version", "finished_at")


def q_drift_decisions(spark, d):
    from .plans.monitor import drift_decisions
    runs, preds = _m(spark, d)
    return drift_decisions(runs, preds)


def _logs(spark, d):
    from .plans.monitor import drift_decisions
    from .session import cut_lineage
    runs, preds = _m(spark, d)
    dec = cut_lineage(drift_decisions(runs, preds))
    older = dec.select(F.col("model_run_id").alias("monitoring_id"),
                       F.lit("model_drift").alias("log_type"), F.lit("info").alias("severity"),
                       F.concat("model_name", F.lit("@"), "benchmark_code").alias("component_name"),
                       F.lit("older").alias("message"),
                       F.lit('{"should_retrain": true}').alias("details"))
    newer = dec.select((F.lit(1000000) + F.col("model_run_id")).alias("monitoring_id"),
                       F.lit("model_drift").alias("log_type"), "severity",
                       F.concat("model_name", F.lit("@"), "benchmark_code").alias("component_name"),
                       "message",
                       F.when(F.col("reason") == "insufficient_history",
                              F.lit('{"reason": "insufficient_history"}'))
                       .otherwise(F.to_json(F.struct("should_retrain"))).alias("details"))
    return runs, older.unionByName(newer)


def q_latest_flags(spark, d):
    from .plans.monitor import latest_flags
    _, logs = _logs(spark, d)
    return latest_flags(logs).select("component_name", "severity", "message", "should_retrain")


def q_retrain_actions(spark, d):
    from .plans.monitor import latest_flags, retrain_actions
    from .plans.registry_m import AS_OF
    runs, logs = _logs(spark, d)
    return retrain_actions(latest_flags(logs), runs, F.lit(AS_OF).cast("timestamp"))


def q_cooldown(spark, d):
    from .plans.monitor import cooldown_state
    from .plans.registry_m import AS_OF
    runs, _ = _m(spark, d)
    return cooldown_state(runs, F.lit(AS_OF).cast("timestamp"))


def _sv():
    from .plans import serving
    return serving


def q_serve_price_trend(spark, d):
    return _sv().price_trend(_prices(spark, d), "1996-01-01", "1996-12-31")


def q_serve_daily_counts(spark, d):
    return _sv().daily_counts(_daily(spark, d))


def q_serve_sentiment(spark, d):
    return _sv().sentiment(_daily(spark, d), "weighted")


def q_serve_label_counts(spark, d):
    return _sv().label_counts(_daily(spark, d))


def q_serve_pred_vs_actual(spark, d):
    return _sv().pred_vs_actual(*_m(spark, d))


def q_serve_error(spark, d):
    return _sv().prediction_error(*_m(spark, d))


def q_serve_model_comparison(spark, d):
    return _sv().model_comparison(*_m(spark, d))


def q_serve_monitoring(spark, d):
    _, logs = _logs(spark, d)
    return _sv().monitoring_panel(logs)


def q_serve_by_source(spark, d):
    return _sv().by_source(B.news_items(table(spark, d, "documents")))


def q_serve_health(spark, d):
    prices = _prices(spark, d)
    runs, preds = _m(spark, d)
    return _sv().health({"prices": prices,
                         "news_items": B.news_items(table(spark, d, "documents")),
                         "daily_news": _daily(spark, d),
                         "features": FE.price_features(prices),
                         "predictions": preds})


def q_latest_features(spark, d):
    return _sv().latest_rows(FE.price_features(_prices(spark, d)), "benchmark_code",
                             "feature_date", 5)


def q_last_predictions(spark, d):
    runs, preds = _m(spark, d)
    p = _sv().pred_vs_actual(runs, preds).withColumn(
        "model_key", F.concat("model_name", F.lit("@"), "benchmark_code"))
    return _sv().latest_rows(p, "model_key", "prediction_for_date", 10).drop("model_key")


def _mo():
    from .plans import models
    return models


def _feats(spark, d):
    return FE.model_features(_prices(spark, d), _daily(spark, d))


def q_complete_cases(spark, d):
    M = _mo()
    f = M.coerce(_feats(spark, d), M.PRICE_FEATURES + [M.TARGET])
    return M.complete_cases(f, M.PRICE_FEATURES).select(
        "benchmark_code", "feature_date", "target_date", *M.PRICE_FEATURES, M.TARGET)


def q_labelled_rows(spark, d):
    M = _mo()
    cols = M.PRICE_FEATURES + M.NEWS_FEATURES
    f = M.with_news_filled(M.coerce(_feats(spark, d), cols + M.TARGETS))
    return M.complete_cases(f, cols, M.TARGETS).select("benchmark_code", "feature_date", *cols,
                                                       *M.TARGETS)


def q_live_candidates(spark, d):
    M = _mo()
    cols = M.PRICE_FEATURES + M.NEWS_FEATURES
    f = M.with_news_filled(M.coerce(_feats(spark, d), cols + ["close_price"]))
    return M.live_candidates(f, cols).select("benchmark_code", "feature_date", "close_price", *cols)


def q_chronological_split(spark, d):
    M = _mo()
    return M.split_summary(M.prepared(_feats(spark, d), M.PRICE_FEATURES, news=False))


def q_ts_cv_folds(spark, d):
    M = _mo()
    s = M.prepared(_feats(spark, d), M.PRICE_FEATURES, news=False)
    return M.fold_summary(M.time_series_folds(s.filter("split = 'train'")))


def q_ols_backtest(spark, d):
    M = _mo()
    p = M.ols_backtest(_feats(spark, d))
    return p.select("benchmark_code", "feature_date", "target_date", M.TARGET, "prediction")


def q_median_regression(spark, d):
    M = _mo()
    p, _ = M.median_backtest(_feats(spark, d))
    return p.select("benchmark_code", "feature_date", "target_date", M.TARGET, "prediction")


def _experiment(spark, d, news):
    """One run of K10/K11 per session and table folder: its predictions and
    parameters are stored, as the reference's registry keeps them."""
    import hashlib
    from .session import scratch_path
    M = _mo()
    key = f"tradewind.experiment.{hashlib.sha1(d.encode()).hexdigest()[:10]}.{int(news)}"
    path = spark.conf.get(key, None)
    if path is None:
        import uuid
        path = scratch_path(spark, f"experiment-{uuid.uuid4().hex[:8]}")
        preds, best = M.fit_all(_feats(spark, d), news)
        for name, p in preds.items():
            p.write.parquet(f"{path}/predictions/model_name={name}")
        best.write.parquet(f"{path}/parameters")
        spark.conf.set(key, path)
    preds = {n: spark.read.parquet(f"{path}/predictions/model_name={n}") for n in M.MODELS}
    return preds, spark.read.parquet(f"{path}/parameters")


def _test_rows(preds):
    return {n: p.filter("split = 'test'") for n, p in preds.items()}


def _backtest(spark, d, name):
    p = _test_rows(_experiment(spark, d, False)[0])[name]
    return p.select("benchmark_code", "feature_date", "target_date", _mo().TARGET, "prediction")


def q_rf_backtest(spark, d):
    return _backtest(spark, d, "RandomForest")


def q_gbt_backtest(spark, d):
    return _backtest(spark, d, "XGBoost")


def q_ensemble_backtest(spark, d):
    M = _mo()
    preds = _test_rows(_experiment(spark, d, False)[0])
    return M.ensemble(preds).select("benchmark_code", "feature_date", "target_date", M.TARGET,
                                    *[f"pred_{n}" for n in preds], "prediction")


def q_experiment_compare(spark, d):
    M = _mo()
    a, b = (M.experiment_metrics(_test_rows(_experiment(spark, d, news)[0]))
            for news in (False, True))
    return M.compare_experiments(a, b)


def q_forecast_summary(spark, d):
    return _mo().newest_forecast(_experiment(spark, d, False)[0])


def q_best_parameters(spark, d):
    """The parameters that the searches chose, with their CV MAE."""
    return _experiment(spark, d, False)[1].select(
        "benchmark_code", "model_name", "params", "cv_mae")


def q_direction_backtest(spark, d):
    M = _mo()
    _, met, _ = M.direction_and_live(_feats(spark, d))
    return met


def q_live_forecast(spark, d):
    return _mo().live_forecast(_feats(spark, d))


def _landed_events(spark, d):
    import hashlib
    from .session import scratch_path
    from .streaming.jobs import land_items
    key = hashlib.sha1(d.encode()).hexdigest()[:10]
    path = scratch_path(spark, f"events-{key}")
    if spark.conf.get("tradewind.events." + key, None) != path:
        items = B.scored_events(table(spark, d, "events")).withColumn(
            "dedup_key", F.concat_ws(":", "source_id", F.col("published_date").cast("string")))
        land_items(items, path)
        spark.conf.set("tradewind.events." + key, path)
    return path


def q_stream_dedup(spark, d):
    from .streaming.jobs import fresh_workdir, stream_dedup
    out = stream_dedup(spark, _landed_events(spark, d), "dedup_key", "article_id",
                       fresh_workdir(spark, "dedup"))
    return out.select("dedup_key", "article_id", "source_id",
                      F.col("published_at").cast("timestamp_ntz").alias("published_at"),
                      "sentiment_e4")


def q_stream_daily_news(spark, d):
    from .streaming.jobs import fresh_workdir, stream_daily
    return stream_daily(spark, _landed_events(spark, d), fresh_workdir(spark, "daily"),
                        with_late=True)


def q_strip_html(spark, d):
    from .functions.text import strip_html
    return table(spark, d, "pages").select("page_id", strip_html(F.col("html")).alias("text"))


def q_daily_run(spark, d):
    import uuid
    from .plans.daily import run_daily
    from .session import scratch_path
    root = scratch_path(spark, f"daily-run-{uuid.uuid4().hex[:8]}")
    from .plans import registry_m as RM
    return run_daily(spark, d, root, _landing(spark, d), TAX, LEX, RM.AS_OF,
                     imported=_m(spark, d), train=_mo().fit_all)


def q_append_registry(spark, d):
    """Append runs, predictions and drift logs to registry tables and
    report the rows each append added (two appends: counts double)."""
    import uuid
    from .plans.monitor import drift_decisions, drift_logs
    from .session import scratch_path
    root = scratch_path(spark, f"registry-{uuid.uuid4().hex[:8]}")
    runs, preds = _m(spark, d)
    logs = drift_logs(drift_decisions(runs, preds), id_base=1_000_000)
    rows = []
    for name, df in (("model_runs", runs), ("predictions", preds), ("monitoring_logs", logs)):
        for _ in range(2):
            df.write.mode("append").parquet(f"{root}/{name}")
        rows.append(spark.read.parquet(f"{root}/{name}")
                    .agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"),
                                                                 "rows"))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


QUERIES: dict[str, Query] = {
    "daily_run": q_daily_run,
    "append_registry": q_append_registry,
    "stream_dedup": q_stream_dedup,
    "stream_daily_news": q_stream_daily_news,
    "strip_html": q_strip_html,
    "rf_backtest": q_rf_backtest,
    "gbt_backtest": q_gbt_backtest,
    "ensemble_backtest": q_ensemble_backtest,
    "experiment_compare": q_experiment_compare,
    "forecast_summary": q_forecast_summary,
    "direction_backtest": q_direction_backtest,
    "live_forecast": q_live_forecast,
    "complete_cases": q_complete_cases,
    "labelled_rows": q_labelled_rows,
    "live_candidates": q_live_candidates,
    "chronological_split": q_chronological_split,
    "ts_cv_folds": q_ts_cv_folds,
    "ols_backtest": q_ols_backtest,
    "median_regression": q_median_regression,
    "best_parameters": q_best_parameters,
    "serve_price_trend": q_serve_price_trend,
    "serve_daily_counts": q_serve_daily_counts,
    "serve_sentiment": q_serve_sentiment,
    "serve_label_counts": q_serve_label_counts,
    "serve_pred_vs_actual": q_serve_pred_vs_actual,
    "serve_error": q_serve_error,
    "serve_model_comparison": q_serve_model_comparison,
    "serve_monitoring": q_serve_monitoring,
    "serve_by_source": q_serve_by_source,
    "serve_health": q_serve_health,
    "latest_features": q_latest_features,
    "last_predictions": q_last_predictions,
    "latest_runs": q_latest_runs,
    "drift_decisions": q_drift_decisions,
    "latest_flags": q_latest_flags,
    "retrain_actions": q_retrain_actions,
    "cooldown": q_cooldown,
    "price_upsert": q_price_upsert,
    "feature_upsert": q_feature_upsert,
    "source_upsert": q_source_upsert,
    "full_refresh": q_full_refresh,
    "child_replace": q_child_replace,
    "quality_report": q_quality_report,
    "schema_report": q_schema_report,
    "feed_items_rss": q_feed_items_rss,
    "feed_items_search": q_feed_items_search,
    "feed_items_timeline": q_feed_items_timeline,
    "feed_ingest": q_feed_ingest,
    "payload_variant": q_payload_variant,
    "active_sources": q_active_sources,
    "dedup_two_keys": q_dedup_two_keys,
    "insert_if_absent": q_insert_if_absent,
    "ingest_counts": q_ingest_counts,
    "clean_text": q_clean_text,
    "topic_scores": q_topic_scores,
    "topic_scores_joined": q_topic_scores_joined,
    "relevance": q_relevance,
    "lexicon_sentiment": q_lexicon_sentiment,
    "lexicon_sentiment_joined": q_lexicon_sentiment_joined,
    "process_articles": q_process_articles,
    "daily_topic_features": q_daily_topic_features,
    "daily_scored_news": q_daily_scored_news,
    "news_price_alignment": q_news_price_alignment,
    "price_features": q_price_features,
    "news_price_features": q_news_price_features,
    "forward_asof_news": q_forward_asof_news,
    "daily_news_features": q_daily_news_features,
    "daily_event_features": q_daily_event_features,
}

ORACLES: dict[str, Callable[[], str]] = {
    "append_registry": O.append_registry_sql,
    "strip_html": O.strip_html_sql,
    "stream_dedup": O.stream_dedup_sql,
    "stream_daily_news": lambda: O.daily_news_sql("events"),
    "complete_cases": O.complete_cases_sql,
    "labelled_rows": O.labelled_rows_sql,
    "live_candidates": O.live_candidates_sql,
    "chronological_split": O.chronological_split_sql,
    "ts_cv_folds": O.ts_cv_folds_sql,
    "serve_price_trend": O.serve_price_trend_sql,
    "serve_daily_counts": O.serve_daily_counts_sql,
    "serve_sentiment": O.serve_sentiment_sql,
    "serve_label_counts": O.serve_label_counts_sql,
    "serve_pred_vs_actual": O.serve_pred_vs_actual_sql,
    "serve_error": O.serve_error_sql,
    "serve_model_comparison": O.serve_model_comparison_sql,
    "serve_monitoring": O.serve_monitoring_sql,
    "serve_by_source": O.serve_by_source_sql,
    "serve_health": O.serve_health_sql,
    "latest_features": O.latest_features_sql,
    "last_predictions": O.last_predictions_sql,
    "latest_runs": O.latest_runs_sql,
    "drift_decisions": O.drift_decisions_sql,
    "latest_flags": O.latest_flags_sql,
    "retrain_actions": O.retrain_actions_sql,
    "cooldown": O.cooldown_sql,
    "price_upsert": O.price_upsert_sql,
    "feature_upsert": O.feature_upsert_sql,
    "source_upsert": O.source_upsert_sql,
    "full_refresh": lambda: O.daily_news_sql("news"),
    "child_replace": lambda: O.child_replace_sql(TAX, LEX),
    "quality_report": O.quality_report_sql,
    "payload_variant": O.payload_variant_sql,
    "schema_report": lambda: O.schema_report_sql(TAX, SCHEMA_BENCHMARKS),
    "active_sources": O.active_sources_sql,
    "dedup_two_keys": O.dedup_two_keys_sql,
    "insert_if_absent": O.insert_if_absent_sql,
    "ingest_counts": O.ingest_counts_sql,
    "clean_text": O.clean_text_query_sql,
    "topic_scores": lambda: O.topic_scores_sql(TAX, LEX),
    "relevance": lambda: O.relevance_sql(TAX),
    "lexicon_sentiment": lambda: O.lexicon_sentiment_sql(LEX),
    "topic_scores_joined": lambda: O.topic_scores_sql(TAX, LEX),
    "lexicon_sentiment_joined": lambda: O.lexicon_sentiment_sql(LEX),
    "process_articles": lambda: O.process_articles_sql(TAX, LEX),
    "daily_topic_features": lambda: O.daily_topic_features_sql(TAX, LEX),
    "daily_scored_news": lambda: O.daily_scored_news_sql(TAX, LEX),
    "news_price_alignment": O.alignment_sql,
    "price_features": O.price_features_sql,
    "news_price_features": O.news_price_features_sql,
    "forward_asof_news": O.forward_asof_news_sql,
    "daily_news_features": lambda: O.daily_news_sql("news"),
    "daily_event_features": lambda: O.daily_news_sql("events"),
}
