"""Bindings: give the driver's synthetic tables the shapes the operators need.

Each binding has a Spark form and the equivalent SQL text used by the DuckDB
oracle, so both engines start from the same rows.

* P  price series      orders    -> (benchmark_code, price_date, OHLC, volume)
* N  scored news items documents -> per-article scores held as 10^-4 units
* A  articles w/ text  documents -> N plus title / summary / content
* E  scored events     events    -> N's shape, timestamps of January 2024
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


# Fixed values of the bindings (score formulas and calendar rules).
NEWS_NULL_DATE_MOD = 50        # doc_id % 50 = 0   -> no published date
NEWS_LATE_DATE_MOD = 97        # doc_id % 97 = 1   -> dated after the last price
NEWS_LATE_DATE = "2002-06-01"
NEWS_BASE_DATE = "1995-01-01"  # else base + (doc_id * 7) % 300 days
NEWS_FAILED_MOD = 37           # doc_id % 37 = 0   -> processing failed
LABEL_THRESHOLD_E4 = 500       # |score| >= 0.05 decides positive / negative


def price_series(orders: DataFrame) -> DataFrame:
    """P: one daily OHLCV row per (order priority, order date)."""
    return (orders
            .groupBy(F.col("o_orderpriority").alias("benchmark_code"),
                     F.to_date("o_orderdate").alias("price_date"))
            .agg(F.min_by("o_totalprice", "o_orderkey").alias("open_price"),
                 F.max("o_totalprice").alias("high_price"),
                 F.min("o_totalprice").alias("low_price"),
                 F.max_by("o_totalprice", "o_orderkey").alias("close_price"),
                 F.count(F.lit(1)).alias("volume")))


PRICES_SQL = """
SELECT o_orderpriority AS benchmark_code, CAST(o_orderdate AS DATE) AS price_date,
       arg_min(o_totalprice, o_orderkey) AS open_price, max(o_totalprice) AS high_price,
       min(o_totalprice) AS low_price, arg_max(o_totalprice, o_orderkey) AS close_price,
       count(*) AS volume
FROM orders GROUP BY 1, 2"""


def label_from_e4(col: str = "sentiment_e4"):
    c = F.col(col)
    return (F.when(c >= LABEL_THRESHOLD_E4, "positive")
            .when(c <= -LABEL_THRESHOLD_E4, "negative")
            .otherwise("neutral"))


def label_from_e4_sql(expr: str = "sentiment_e4") -> str:
    return (f"CASE WHEN {expr} >= {LABEL_THRESHOLD_E4} THEN 'positive' "
            f"WHEN {expr} <= -{LABEL_THRESHOLD_E4} THEN 'negative' ELSE 'neutral' END")


def news_items(documents: DataFrame) -> DataFrame:
    """N: scored articles keyed by doc_id, dates on a 300-day calendar."""
    d = F.col("doc_id")
    pub = (F.when(d % NEWS_NULL_DATE_MOD == 0, F.lit(None).cast("date"))
           .when(d % NEWS_LATE_DATE_MOD == 1, F.lit(NEWS_LATE_DATE).cast("date"))
           .otherwise(F.date_add(F.lit(NEWS_BASE_DATE).cast("date"),
                                 ((d * 7) % 300).cast("int"))))
    return (documents
            .select(d.alias("article_id"), F.col("source").alias("source_id"),
                    pub.alias("published_date"),
                    ((F.col("n_chars") * 37 + d * 101) % 20001 - 10000).alias("sentiment_e4"),
                    ((F.col("n_chars") * 13 + d) % 10001).alias("relevance_e4"),
                    F.when(d % NEWS_FAILED_MOD == 0, "failed").otherwise("processed")
                    .alias("processing_status"))
            .withColumn("sentiment_label", label_from_e4()))


NEWS_SQL = f"""
SELECT doc_id AS article_id, source AS source_id,
       CASE WHEN doc_id % {NEWS_NULL_DATE_MOD} = 0 THEN NULL
            WHEN doc_id % {NEWS_LATE_DATE_MOD} = 1 THEN DATE '{NEWS_LATE_DATE}'
            ELSE CAST(DATE '{NEWS_BASE_DATE}' + CAST((doc_id * 7) % 300 AS INTEGER) AS DATE) END
         AS published_date,
       (n_chars * 37 + doc_id * 101) % 20001 - 10000 AS sentiment_e4,
       (n_chars * 13 + doc_id) % 10001 AS relevance_e4,
       CASE WHEN doc_id % {NEWS_FAILED_MOD} = 0 THEN 'failed' ELSE 'processed' END
         AS processing_status,
       {label_from_e4_sql("(n_chars * 37 + doc_id * 101) % 20001 - 10000")} AS sentiment_label
FROM documents"""


def articles(documents: DataFrame) -> DataFrame:
    """A: N's keys plus raw title (first 80 chars), summary (first line) and
    content, in one projection of ``documents`` (no self-join)."""
    d = F.col("doc_id")
    pub = (F.when(d % NEWS_NULL_DATE_MOD == 0, F.lit(None).cast("date"))
           .when(d % NEWS_LATE_DATE_MOD == 1, F.lit(NEWS_LATE_DATE).cast("date"))
           .otherwise(F.date_add(F.lit(NEWS_BASE_DATE).cast("date"),
                                 ((d * 7) % 300).cast("int"))))
    return documents.select(
        d.alias("article_id"), F.col("source").alias("source_id"),
        pub.alias("published_date"),
        F.substring("text", 1, 80).alias("title"),
        F.substring_index("text", "\n", 1).alias("summary"),
        F.col("text").alias("content"))


ARTICLES_SQL = f"""
SELECT doc_id AS article_id, source AS source_id,
       CASE WHEN doc_id % {NEWS_NULL_DATE_MOD} = 0 THEN NULL
            WHEN doc_id % {NEWS_LATE_DATE_MOD} = 1 THEN DATE '{NEWS_LATE_DATE}'
            ELSE CAST(DATE '{NEWS_BASE_DATE}' + CAST((doc_id * 7) % 300 AS INTEGER) AS DATE) END
         AS published_date,
       substr(text, 1, 80) AS title,
       split_part(text, chr(10), 1) AS summary,
       text AS content
FROM documents"""


def scored_events(events: DataFrame) -> DataFrame:
    """E: events as scored items (event time kept for streaming)."""
    v = F.round(F.col("value") * 100).cast("long")
    return (events
            .select(F.col("event_id").alias("article_id"),
                    F.col("user_id").cast("string").alias("source_id"),
                    F.col("ts").cast("timestamp").alias("published_at"),
                    F.to_date("ts").alias("published_date"),
                    ((v * 37) % 20001 - 10000).alias("sentiment_e4"),
                    (v % 10001).alias("relevance_e4"),
                    F.when(F.col("event_type") == "error", "failed").otherwise("processed")
                    .alias("processing_status"))
            .withColumn("sentiment_label", label_from_e4()))


EVENTS_SQL = f"""
SELECT event_id AS article_id, CAST(user_id AS VARCHAR) AS source_id, ts AS published_at,
       CAST(ts AS DATE) AS published_date,
       (CAST(round(value * 100) AS BIGINT) * 37) % 20001 - 10000 AS sentiment_e4,
       CAST(round(value * 100) AS BIGINT) % 10001 AS relevance_e4,
       CASE WHEN event_type = 'error' THEN 'failed' ELSE 'processed' END AS processing_status,
       {label_from_e4_sql("(CAST(round(value * 100) AS BIGINT) * 37) % 20001 - 10000")}
         AS sentiment_label
FROM events"""


# ---------------------------------------------------------------------------
# X: landed feed files derived from pages (RSS) and documents (JSON payloads)
# ---------------------------------------------------------------------------
# Fixed values of the X binding.
RSS_FEEDS = 3                 # page_id % 3 picks the feed rss0 / rss1 / rss2
RSS_LANGUAGES = ["en", "fr", "de"]
URL_REPEAT_MOD, URL_REPEAT_BACK = 20, 7     # every 20th item reuses an earlier url
GUID_REPEAT_MOD, GUID_REPEAT_BACK = 30, 3   # every 30th reuses an earlier guid (same feed)
SEARCH_DOMAIN_SOURCES = 0     # documents.source number % 2 == 0 -> search API, else timeline
UNROUTED_MOD = 5              # source number % 5 == 4 -> unsupported domain
PAGE_SIZE = 50                # hits per landed payload


def rss_item_keys(pages: DataFrame) -> DataFrame:
    """(source_id, position, url, guid) of the RSS items, before any parsing."""
    pid = F.col("p.page_id")
    base = pages.alias("p").join(
        pages.select((F.col("page_id") + URL_REPEAT_BACK).alias("page_id"),
                     F.col("url").alias("earlier_url")).alias("e"),
        F.col("p.page_id") == F.col("e.page_id"), "left")
    return base.select(*_item_keys(pid, F.col("p.url"), F.col("earlier_url")),
                       F.col("p.html").alias("html"))


def _item_keys(pid, url, earlier_url):
    return (F.concat(F.lit("rss"), (pid % RSS_FEEDS).cast("string")).alias("source_id"),
            pid.alias("position"),
            F.when(_reuses_url(pid) & earlier_url.isNotNull(), earlier_url).otherwise(url)
            .alias("url"),
            F.concat(F.lit("g"), F.when((pid % GUID_REPEAT_MOD == GUID_REPEAT_MOD - 1)
                                        & (pid >= GUID_REPEAT_BACK), pid - GUID_REPEAT_BACK)
                     .otherwise(pid).cast("string")).alias("guid"))


def _reuses_url(pid):
    return pid % URL_REPEAT_MOD == URL_REPEAT_MOD - 1


RSS_KEYS_SQL = f"""
SELECT 'rss' || CAST(p.page_id % {RSS_FEEDS} AS VARCHAR) AS source_id, p.page_id AS position,
       CASE WHEN p.page_id % {URL_REPEAT_MOD} = {URL_REPEAT_MOD - 1} AND e.url IS NOT NULL
            THEN e.url ELSE p.url END AS url,
       'g' || CAST(CASE WHEN p.page_id % {GUID_REPEAT_MOD} = {GUID_REPEAT_MOD - 1}
                         AND p.page_id >= {GUID_REPEAT_BACK}
                        THEN p.page_id - {GUID_REPEAT_BACK} ELSE p.page_id END AS VARCHAR) AS guid
FROM pages p LEFT JOIN pages e ON e.page_id + {URL_REPEAT_BACK} = p.page_id"""


def _xml_escape(c):
    c = F.regexp_replace(c, "&", "&amp;")
    c = F.regexp_replace(c, "<", "&lt;")
    return F.regexp_replace(c, ">", "&gt;")


def _el(tag, c):
    return F.when(c.isNotNull(), F.concat(F.lit(f"<{tag}>"), _xml_escape(c), F.lit(f"</{tag}>")))


def land_rss(pages: DataFrame, dest: str) -> None:
    """Write one RSS 2.0 file per feed under ``dest/source_id=<feed>``."""
    # one landed file = one poll of at most PAGE_SIZE items of one feed
    file = lambda pid: (F.concat(F.lit("rss"), (pid % RSS_FEEDS).cast("string")).alias("source_id"),
                        (pid / (PAGE_SIZE * RSS_FEEDS)).cast("long").alias("chunk"))
    # the earlier urls go to the files that reuse them, so that the pages are dealt once,
    # by file; a page stands once per row of the earlier page (its url matters to some)
    target = (F.col("page_id") + URL_REPEAT_BACK).alias("pid")
    earlier = (pages.where("page_id is not null").select(target, F.when(
                   _reuses_url(target), F.col("url")).alias("url"))
               .groupBy("pid").agg(F.collect_list(F.struct("url")).alias("urls"))
               .where(_reuses_url(F.col("pid")) | (F.size("urls") > 1))
               .groupBy(*file(F.col("pid")))
               .agg(F.map_from_entries(F.collect_list(F.struct("pid", "urls"))).alias("earlier")))
    id_ = F.col("page_id")
    none = F.array(F.struct(F.lit(None).cast("string").alias("url")))
    k = (pages.select(*file(id_), "page_id", "url", "html")
         .join(earlier, ["source_id", "chunk"], "left")
         .select("source_id", "chunk", "page_id", "url", "html", F.explode(F.coalesce(
             F.try_element_at("earlier", id_), none)).alias("e"))
         .select("source_id", "chunk", *_item_keys(id_, F.col("url"), F.col("e.url"))[1:], "html"))
    pid = F.col("position")
    pub = F.date_format(F.timestamp_seconds(F.lit(1704067200) + pid * 3671),
                        "EEE, dd MMM yyyy HH:mm:ss +0000")
    title = F.regexp_extract("html", r"<title>(.*?)</title>", 1)
    item = F.concat_ws("", F.lit("<item>"), _el("title", title), _el("link", F.col("url")),
                       _el("guid", F.col("guid")), _el("pubDate", pub),
                       _el("description", F.col("html")),
                       _el("category", F.concat(F.lit("cat"), (pid % 4).cast("string"))),
                       _el("category", F.lit("news")),
                       _el("position", pid.cast("string")), F.lit("</item>"))
    lang = F.element_at(F.array(*[F.lit(x) for x in RSS_LANGUAGES]),
                        (F.substring("source_id", 4, 3).cast("int") % len(RSS_LANGUAGES)) + 1)
    head = F.concat(
        F.lit('<?xml version="1.0" encoding="UTF-8"?><rss version="2.0"><channel><language>'),
        lang, F.lit("</language>\n"))
    in_file = Window.partitionBy("source_id", "chunk").orderBy("position")
    first = F.row_number().over(in_file) == 1
    last = F.lead(F.lit(1)).over(in_file).isNull()
    (k.select("source_id", "chunk", "position", "url", "guid", "html", first.alias("first"),
              last.alias("last"))
     .select("source_id", "chunk", F.concat(
         F.when(F.col("first"), F.coalesce(head, F.lit("\n"))).otherwise(""), item,
         F.when(F.col("last"), "\n</channel></rss>").otherwise("")).alias("value"))
     .write.mode("overwrite").partitionBy("source_id", "chunk").text(dest))


def _doc_src_num():
    return F.regexp_extract("source", r"(\d+)", 1).cast("int")


def land_payloads(documents: DataFrame, dest_search: str, dest_timeline: str) -> None:
    """Search payloads ``{"hits": [...]}`` (pages of 50) and timeline arrays,
    one JSON document per line, partitioned by source."""
    land_search(documents, dest_search)
    land_timeline(documents, dest_timeline)


def _created(d):
    return F.concat(
        F.date_format(F.timestamp_seconds(F.lit(1704067200) + d * 977), "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(d % 3 == 0, F.lit("+05:30")).when(d % 3 == 1, F.lit("-08:00"))
        .otherwise(F.lit("Z")))


def land_search(documents: DataFrame, dest: str) -> None:
    d = F.col("doc_id")
    first_line = F.substring_index("text", "\n", 1)
    docs = documents.withColumn("_n", _doc_src_num())
    hit = F.struct(
        d.cast("string").alias("objectID"),
        F.when(d % 11 == 0, F.lit(None).cast("string")).otherwise(first_line).alias("title"),
        first_line.alias("story_title"),
        F.when(d % 13 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("https://"), F.col("source"), F.lit(".example/d/"),
                            d.cast("string"))).alias("url"),
        F.concat(F.lit("user"), (F.col("n_chars") % 10).cast("string")).alias("author"),
        (F.col("n_chars") % 500).alias("points"), (d % 40).alias("num_comments"),
        _created(d).alias("created_at"),
        F.when(d % 17 == 0, F.lit(None).cast("string")).otherwise(F.col("text")).alias("story_text"),
        F.when(d % 17 == 0, F.col("text")).alias("comment_text"),
        d.alias("position"))
    search = (docs.filter(F.col("_n") % 2 == SEARCH_DOMAIN_SOURCES)
              .groupBy(F.col("source").alias("source_id"), (d / PAGE_SIZE).cast("long").alias("pg"))
              .agg(F.sort_array(F.collect_list(F.struct(d.alias("k"), hit.alias("h"))))
                   .alias("hs"))
              .select("source_id", F.to_json(F.struct(
                  F.transform("hs", lambda x: x["h"]).alias("hits"))).alias("value")))
    search.write.mode("overwrite").partitionBy("source_id").text(dest)


def land_timeline(documents: DataFrame, dest: str) -> None:
    d = F.col("doc_id")
    docs = documents.withColumn("_n", _doc_src_num())
    status = F.struct(
        d.cast("string").alias("id"),
        F.concat(F.lit("https://"), F.col("source"), F.lit(".example/@s/"), d.cast("string"))
        .alias("url"),
        _created(d).alias("created_at"),
        F.when(d % 19 == 0, F.lit("")).otherwise(
            F.concat(F.lit("<p>"), F.col("text"), F.lit("</p>"))).alias("content"),
        F.when(d % 7 == 0, F.lit(None).cast("string")).otherwise(F.col("lang")).alias("language"),
        F.when(d % 9 == 0, F.lit(None)).otherwise(F.struct(
            F.concat(F.lit("user"), (F.col("n_chars") % 10).cast("string")).alias("acct"),
            F.lit(False).alias("bot"))).alias("account"),
        d.alias("position"))
    timeline = (docs.filter(F.col("_n") % 2 != SEARCH_DOMAIN_SOURCES)
                .groupBy(F.col("source").alias("source_id"),
                         (d / PAGE_SIZE).cast("long").alias("pg"))
                .agg(F.sort_array(F.collect_list(F.struct(d.alias("k"), status.alias("s"))))
                     .alias("ss"))
                .select("source_id", F.to_json(F.transform("ss", lambda x: x["s"])).alias("value")))
    timeline.write.mode("overwrite").partitionBy("source_id").text(dest)


def source_registry(documents: DataFrame, pages: DataFrame) -> DataFrame:
    """Sources seen in the data: three RSS feeds from pages, one API source per
    documents.source (search or timeline by its number; every fifth one on an
    unsupported domain)."""
    rss = (pages.select(F.concat(F.lit("rss"), (F.col("page_id") % RSS_FEEDS).cast("string"))
                        .alias("source_name")).distinct()
           .select("source_name", F.lit("rss").alias("source_type"),
                   F.concat(F.lit("https://"), F.col("source_name"), F.lit(".example/feed.xml"))
                   .alias("feed_url"),
                   F.concat(F.col("source_name"), F.lit(".example")).alias("domain_name")))
    n = _doc_src_num()
    api = (documents.select(F.col("source").alias("source_name"), n.alias("_n")).distinct()
           .select("source_name", F.lit("api").alias("source_type"),
                   F.concat(F.lit("https://api.example/"), F.col("source_name")).alias("feed_url"),
                   F.when(F.col("_n") % UNROUTED_MOD == UNROUTED_MOD - 1, "unsupported.example")
                   .when(F.col("_n") % 2 == SEARCH_DOMAIN_SOURCES, "hn.algolia.com")
                   .otherwise("mastodon.social").alias("domain_name")))
    return (rss.unionByName(api)
            .withColumn("is_active", F.lit(True))
            .withColumn("base_url", F.concat(F.lit("https://"), F.col("domain_name"))))


SOURCES_SQL = f"""
SELECT source_name, source_type, feed_url, domain_name, true AS is_active,
       'https://' || domain_name AS base_url FROM (
  SELECT DISTINCT 'rss' || CAST(page_id % {RSS_FEEDS} AS VARCHAR) AS source_name, 'rss' AS source_type,
         'https://rss' || CAST(page_id % {RSS_FEEDS} AS VARCHAR) || '.example/feed.xml' AS feed_url,
         'rss' || CAST(page_id % {RSS_FEEDS} AS VARCHAR) || '.example' AS domain_name
  FROM pages
  UNION ALL
  SELECT DISTINCT source, 'api', 'https://api.example/' || source,
         CASE WHEN CAST(regexp_extract(source, '(\\d+)', 1) AS INTEGER) % {UNROUTED_MOD} = {UNROUTED_MOD - 1}
              THEN 'unsupported.example'
              WHEN CAST(regexp_extract(source, '(\\d+)', 1) AS INTEGER) % 2 = {SEARCH_DOMAIN_SOURCES}
              THEN 'hn.algolia.com' ELSE 'mastodon.social' END
  FROM documents) s"""
