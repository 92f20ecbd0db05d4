"""DuckDB oracle SQL for the registered queries.

Written independently of the Spark plans, in plain SQL over the same
parquet views (correlated subqueries, unnest, window functions).  Shared
CTE fragments come from ``bindings`` so both sides read identical inputs.
"""

from __future__ import annotations

from .bindings import ARTICLES_SQL, EVENTS_SQL, NEWS_SQL, PRICES_SQL
from .numerics import ratio_half_up_sql as ratio
from .numerics import rnd_sql as rnd


def _with(*ctes: tuple[str, str]) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in ctes)


PRICE_BLOCK = f"""
SELECT benchmark_code, price_date AS feature_date, close_price,
       lag(close_price, 1) OVER w AS lag_close_1d,
       lag(close_price, 3) OVER w AS lag_close_3d,
       CASE WHEN lag(close_price, 1) OVER w IS NULL OR lag(close_price, 1) OVER w = 0 THEN NULL
            ELSE close_price / lag(close_price, 1) OVER w - 1 END AS return_1d,
       avg(close_price) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS rolling_mean_3d,
       avg(close_price) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS rolling_mean_7d,
       stddev_samp(close_price) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
         AS rolling_volatility_7d,
       coalesce(lead(price_date, 1) OVER w,
                CAST(price_date + CASE isodow(price_date) WHEN 5 THEN 3 WHEN 6 THEN 2 ELSE 1 END
                     AS DATE)) AS target_date,
       lead(close_price, 1) OVER w AS target_close_next_day
FROM prices WINDOW w AS (PARTITION BY benchmark_code ORDER BY price_date)"""

PRICE_ENRICHED = """
SELECT *, lag(return_1d, 1) OVER w AS lag_return_1d, lag(return_1d, 3) OVER w AS lag_return_3d,
       CASE WHEN close_price IS NULL OR target_close_next_day IS NULL OR close_price = 0 THEN NULL
            ELSE target_close_next_day / close_price - 1 END AS target_return_next_day
FROM pb WINDOW w AS (PARTITION BY benchmark_code ORDER BY feature_date)"""

PRICE_OUT_COLS = f"""benchmark_code, feature_date, target_date,
       {rnd('close_price', 4)} AS close_price, {rnd('return_1d', 6)} AS return_1d,
       {rnd('lag_close_1d', 4)} AS lag_close_1d, {rnd('lag_close_3d', 4)} AS lag_close_3d,
       {rnd('lag_return_1d', 6)} AS lag_return_1d, {rnd('lag_return_3d', 6)} AS lag_return_3d,
       {rnd('rolling_mean_3d', 6)} AS rolling_mean_3d, {rnd('rolling_mean_7d', 6)} AS rolling_mean_7d,
       {rnd('rolling_volatility_7d', 6)} AS rolling_volatility_7d,
       {rnd('target_close_next_day', 4)} AS target_close_next_day,
       {rnd('target_return_next_day', 6)} AS target_return_next_day,
       CAST(sign(target_return_next_day) AS INTEGER) AS target_direction_next_day"""


def price_features_sql() -> str:
    return (_with(("prices", PRICES_SQL), ("pb", PRICE_BLOCK), ("pe", PRICE_ENRICHED))
            + f"\nSELECT {PRICE_OUT_COLS} FROM pe")


def daily_news_body(src: str) -> str:
    return f"""
SELECT published_date AS feature_date, count(*) AS article_count,
       count(DISTINCT source_id) AS distinct_source_count,
       {ratio('sum(sentiment_e4)', 'count(sentiment_e4)')} AS avg_sentiment,
       CASE WHEN sum(coalesce(relevance_e4, 0)) > 0
            THEN {ratio('sum(sentiment_e4 * relevance_e4)', 'sum(relevance_e4)')} END
         AS weighted_avg_sentiment,
       {ratio('sum(relevance_e4)', 'count(relevance_e4)')} AS avg_relevance,
       count_if(sentiment_label = 'positive') AS positive_article_count,
       count_if(sentiment_label = 'neutral') AS neutral_article_count,
       count_if(sentiment_label = 'negative') AS negative_article_count
FROM {src}
WHERE processing_status = 'processed' AND published_date IS NOT NULL
  AND coalesce(relevance_e4, 0) > 0
GROUP BY published_date"""


def daily_news_sql(binding: str = "news") -> str:
    src = NEWS_SQL if binding == "news" else EVENTS_SQL
    return _with(("n", src)) + "\n" + daily_news_body("n")


TRADING_DAY = """
SELECT benchmark_code, mapped_date AS feature_date, sum(article_count) AS news_n,
       sum(CAST(round(avg_sentiment * 10000) AS BIGINT) * article_count) AS news_a,
       sum(CAST(round(weighted_avg_sentiment * 10000) AS BIGINT) * article_count) AS news_w
FROM (
  SELECT s.benchmark_code, d.*,
         (SELECT min(p.price_date) FROM prices p
           WHERE p.benchmark_code = s.benchmark_code AND p.price_date >= d.feature_date)
           AS mapped_date
  FROM daily d, (SELECT DISTINCT benchmark_code FROM prices) s) m
WHERE mapped_date IS NOT NULL
GROUP BY 1, 2"""


def forward_asof_news_sql() -> str:
    return (_with(("prices", PRICES_SQL), ("n", NEWS_SQL), ("daily", daily_news_body("n")),
                  ("t", TRADING_DAY))
            + f"""
SELECT benchmark_code, feature_date, CAST(news_n AS INTEGER) AS news_article_count_1d,
       {ratio('news_a', 'news_n')} AS news_avg_sentiment_1d,
       {ratio('news_w', 'news_n')} AS news_weighted_sentiment_1d
FROM t""")


def _mean3_sql(a: str, b: str) -> str:
    xs, ys, ks = [], [], []
    for i in range(3):
        ai, bi = f"{a}{i}", f"{b}{i}"
        xs.append(f"CAST(coalesce({ai}, 0) AS HUGEINT)")
        ys.append(f"CAST(CASE WHEN {ai} IS NULL THEN 1 ELSE {bi} END AS HUGEINT)")
        ks.append(f"CASE WHEN {ai} IS NULL THEN 0 ELSE 1 END")
    num = " + ".join(f"{xs[i]} * {ys[(i + 1) % 3]} * {ys[(i + 2) % 3]}" for i in range(3))
    k = " + ".join(ks)
    den = f"CAST(({k}) AS HUGEINT) * {ys[0]} * {ys[1]} * {ys[2]}"
    return (f"CASE WHEN ({k}) = 0 THEN NULL ELSE {ratio(f'({num})', den)} END")


def news_price_features_sql() -> str:
    return (_with(("prices", PRICES_SQL), ("pb", PRICE_BLOCK), ("pe", PRICE_ENRICHED),
                  ("n", NEWS_SQL), ("daily", daily_news_body("n")), ("t", TRADING_DAY),
                  ("j", """SELECT pe.*, t.news_n, t.news_a, t.news_w,
       t.news_a AS a0, t.news_n AS b0, t.news_w AS w0,
       lag(t.news_a, 1) OVER w AS a1, lag(t.news_n, 1) OVER w AS b1, lag(t.news_w, 1) OVER w AS w1,
       lag(t.news_a, 2) OVER w AS a2, lag(t.news_n, 2) OVER w AS b2, lag(t.news_w, 2) OVER w AS w2
FROM pe LEFT JOIN t USING (benchmark_code, feature_date)
WINDOW w AS (PARTITION BY pe.benchmark_code ORDER BY pe.feature_date)"""))
            + f"""
SELECT {PRICE_OUT_COLS},
       CAST(coalesce(news_n, 0) AS INTEGER) AS news_article_count_1d,
       CASE WHEN news_n IS NOT NULL THEN {ratio('news_a', 'news_n')} END AS news_avg_sentiment_1d,
       CASE WHEN news_w IS NOT NULL THEN {ratio('news_w', 'news_n')} END
         AS news_weighted_sentiment_1d,
       {_mean3_sql('a', 'b')} AS news_avg_sentiment_3d,
       {_mean3_sql('w', 'b')} AS news_weighted_sentiment_3d
FROM j""")


# ---------------------------------------------------------------------------
# Text scoring oracles
# ---------------------------------------------------------------------------
from .functions.text import clean_text_sql, combined_text_sql, keyword_in_text_sql  # noqa: E402
from .sources.dimensions import (BOOSTER_DAMPING, CONTRAST_AFTER, CONTRAST_BEFORE,  # noqa: E402
                                 CONTRAST_WORD, NEGATION_SCALAR, NORMALIZATION_ALPHA,
                                 Lexicon, Taxonomy)


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _dbl(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def cleaned_articles_sql() -> tuple[tuple[str, str], ...]:
    comb = combined_text_sql("title", "summary", "content")
    return (("a", ARTICLES_SQL),
            ("c", f"""SELECT article_id, source_id, published_date,
       {clean_text_sql('title')} AS c_title, {clean_text_sql('summary')} AS c_summary,
       {clean_text_sql('content')} AS c_content,
       coalesce(regexp_matches({comb}, '\\S'), false) AS ok,
       {clean_text_sql(comb)} AS c_combined
FROM a"""))


def topic_ctes(tax: Taxonomy) -> tuple[tuple[str, str], ...]:
    kws = tax.keywords
    idx = {k: i for i, k in enumerate(kws)}
    kw_cols = ",\n       ".join(
        f"least(CASE WHEN {keyword_in_text_sql('c_title', k)} THEN 5 ELSE 0 END"
        f" + CASE WHEN {keyword_in_text_sql('c_summary', k)} THEN 3 ELSE 0 END"
        f" + CASE WHEN {keyword_in_text_sql('c_content', k)} THEN 2 ELSE 0 END, 10) AS kw{i}"
        for i, k in enumerate(kws))
    ids = [t for t, _ in tax.topic_ids]
    k_cols, hit_cols = [], []
    for t, (name, tk) in zip(ids, tax.topics):
        k_cols.append(" + ".join(f"kw{idx[k.strip().lower()]}" for k in tk) + f" AS k{t}")
        items = ", ".join(f"CASE WHEN kw{idx[k]} > 0 THEN {_q(k)} END"
                          for k in tax.sorted_keywords(name))
        hit_cols.append(f"list_filter([{items}], lambda x: x IS NOT NULL) AS hits{t}")
    ts_cols = ", ".join(
        f"least(CAST({ratio(f'k{t} * 10000', '30', scale=1)} AS BIGINT), 10000) AS ts{t}"
        for t in ids)
    arr = ", ".join(f"ts{t}" for t in ids)
    greatest = f"greatest({arr})" if len(ids) > 1 else arr
    primary = "CASE " + " ".join(f"WHEN ts{t} = g THEN {t}" for t in ids) + " END"
    json_parts = ", ".join(
        f"CASE WHEN len(hits{t}) > 0 THEN '\"{n}\": [' || array_to_string("
        f"list_transform(hits{t}, lambda x: '\"' || x || '\"'), ', ') || ']' END"
        for t, n in tax.topic_ids)
    return (("kw", f"SELECT *,\n       {kw_cols}\nFROM c"),
            ("kt", f"SELECT *, {', '.join(k_cols)}, {', '.join(hit_cols)} FROM kw"),
            ("ts", f"SELECT *, {ts_cols} FROM kt"),
            ("tr", f"""SELECT *, {greatest} AS g,
       coalesce(list_sort([{arr}], 'DESC')[2], 0) AS top2 FROM ts"""),
            ("scored", f"""SELECT *,
       least(CAST({ratio('(8 * g + 2 * top2)', '10', scale=1)} AS BIGINT), 10000) AS relevance_e4,
       CASE WHEN g > 0 THEN {primary} END AS primary_topic_id,
       '{{' || concat_ws(', ', {json_parts}) || '}}' AS hits_json
FROM tr"""))


def compound_ctes(lex: Lexicon, src: str = "c", text: str = "c_combined"
                  ) -> tuple[tuple[str, str], ...]:
    """Token rows with lags: an independent formulation of the lexicon rules."""
    lv = ("CASE tok " + " ".join(f"WHEN {_q(k)} THEN {_dbl(v)}" for k, v in lex.valence.items())
          + " END") if lex.valence else "CAST(NULL AS DOUBLE)"
    bv = ("CASE tok " + " ".join(f"WHEN {_q(k)} THEN {_dbl(v)}" for k, v in lex.boosters.items())
          + f" ELSE {_dbl(0.0)} END") if lex.boosters else _dbl(0.0)
    isb = (f"tok IN ({', '.join(_q(k) for k in lex.boosters)})" if lex.boosters else "false")
    ng = (f"tok IN ({', '.join(_q(k) for k in lex.negators)})" if lex.negators else "false")
    strip = "regexp_replace(raw, '^[-+./]+|[-+./]+$', '', 'g')"
    lags = ", ".join(f"lag(lv, {d}) OVER w AS lv{d}, lag(bv, {d}) OVER w AS bv{d}, "
                     f"lag(ng, {d}) OVER w AS ng{d}" for d in (1, 2, 3))
    steps = []
    prev = "v0"
    for d, damp in zip((1, 2, 3), BOOSTER_DAMPING):
        cur = f"v{d}"
        boosted = (f"({prev} + ((CASE WHEN {prev} < 0 THEN {_dbl(-1.0)} ELSE {_dbl(1.0)} END)"
                   f" * bv{d}) * {_dbl(damp)})")
        expr = (f"CASE WHEN pos > {d} AND lv IS NOT NULL AND NOT isb AND lv{d} IS NULL THEN "
                f"(CASE WHEN ng{d} THEN {boosted} * {_dbl(NEGATION_SCALAR)} ELSE {boosted} END)"
                f" ELSE {prev} END")
        steps.append((f"s{d}", f"SELECT *, {expr} AS {cur} FROM "
                      + ("t0" if d == 1 else f"s{d - 1}")))
        prev = cur
    final = (f"CASE WHEN bpos IS NOT NULL AND pos < bpos THEN v3 * {_dbl(CONTRAST_BEFORE)} "
             f"WHEN bpos IS NOT NULL AND pos > bpos THEN v3 * {_dbl(CONTRAST_AFTER)} ELSE v3 END")
    return (("tk", f"""SELECT article_id, unnest(string_split({text}, ' ')) AS raw,
       generate_subscripts(string_split({text}, ' '), 1) AS pos FROM {src}"""),
            ("tn", f"SELECT article_id, pos, CASE WHEN length({strip}) > 2 THEN {strip} "
                   f"ELSE raw END AS tok FROM tk"),
            ("tl", f"SELECT *, {lv} AS lv, {bv} AS bv, {isb} AS isb, {ng} AS ng FROM tn"),
            ("t0", f"""SELECT *, {lags},
       min(CASE WHEN tok = {_q(CONTRAST_WORD)} THEN pos END) OVER (PARTITION BY article_id)
         AS bpos,
       CASE WHEN isb OR lv IS NULL THEN {_dbl(0.0)} ELSE lv END AS v0
FROM tl WINDOW w AS (PARTITION BY article_id ORDER BY pos)"""),
            *steps,
            ("ssum", f"""SELECT article_id,
       list_reduce(list(({final}) ORDER BY pos), lambda acc, x: acc + x) AS total
FROM s3 GROUP BY article_id"""),
            ("comp", f"""SELECT article_id, {rnd(
                f'least(greatest(total / sqrt(total * total + {_dbl(NORMALIZATION_ALPHA)}), '
                f'{_dbl(-1.0)}), {_dbl(1.0)})', 4)} AS compound FROM ssum"""))


def _label_sql(e4: str) -> str:
    return (f"CASE WHEN {e4} >= 500 THEN 'positive' WHEN {e4} <= -500 THEN 'negative' "
            f"ELSE 'neutral' END")


def processed_ctes(tax: Taxonomy, lex: Lexicon) -> tuple[tuple[str, str], ...]:
    names = "CASE primary_topic_id " + " ".join(
        f"WHEN {t} THEN {_q(n)}" for t, n in tax.topic_ids) + " END"
    return (*cleaned_articles_sql(), *topic_ctes(tax), *compound_ctes(lex),
            ("p0", """SELECT scored.*, CASE WHEN ok THEN CAST(round(compound * 10000) AS BIGINT)
       ELSE 0 END AS sentiment_e4 FROM scored JOIN comp USING (article_id)"""),
            ("proc", f"""SELECT article_id, source_id, published_date, primary_topic_id, ok,
       {', '.join(f'ts{t}' for t, _ in tax.topic_ids)},
       CASE WHEN ok THEN c_combined END AS cleaned_text,
       CAST(CASE WHEN ok THEN relevance_e4 ELSE 0 END AS DOUBLE) / CAST(10000 AS DOUBLE)
         AS relevance_score,
       CAST(sentiment_e4 AS DOUBLE) / CAST(10000 AS DOUBLE) AS sentiment_score,
       {_label_sql('sentiment_e4')} AS sentiment_label,
       CASE WHEN ok THEN 'processed' ELSE 'failed' END AS processing_status,
       CASE WHEN ok THEN
         CASE WHEN published_date IS NOT NULL
              THEN 'Processed from published_date=' || strftime(published_date, '%Y-%m-%d')
              ELSE 'Processed with missing published_date' END
         || '; primary_topic=' || coalesce({names}, 'None') || '; keyword_hits=' || hits_json
       ELSE 'No usable text found in title/summary/content.' END AS notes,
       sentiment_e4, CASE WHEN ok THEN relevance_e4 ELSE 0 END AS rel_e4
FROM p0"""))


def topic_rows_cte(tax: Taxonomy) -> tuple[str, str]:
    return ("trows", " UNION ALL ".join(
        f"SELECT article_id, {t} AS topic_id, ts{t} AS topic_score_e4, "
        f"(primary_topic_id = {t}) AS is_primary_topic FROM proc WHERE ok AND ts{t} > 0"
        for t, _ in tax.topic_ids))


def clean_text_query_sql() -> str:
    return _with(*cleaned_articles_sql()) + """
SELECT article_id, c_title AS cleaned_title, c_summary AS cleaned_summary,
       c_content AS cleaned_content, c_combined AS cleaned_combined FROM c"""


def topic_scores_sql(tax: Taxonomy, lex: Lexicon) -> str:
    return _with(*cleaned_articles_sql(), *topic_ctes(tax),
                 ("proc", "SELECT * FROM scored"), topic_rows_cte(tax)) + """
SELECT article_id, topic_id, CAST(topic_score_e4 AS DOUBLE) / CAST(10000 AS DOUBLE) AS topic_score,
       is_primary_topic FROM trows"""


def relevance_sql(tax: Taxonomy) -> str:
    names = "CASE primary_topic_id " + " ".join(
        f"WHEN {t} THEN {_q(n)}" for t, n in tax.topic_ids) + " END"
    return _with(*cleaned_articles_sql(), *topic_ctes(tax)) + f"""
SELECT article_id, CAST(relevance_e4 AS DOUBLE) / CAST(10000 AS DOUBLE) AS relevance_score,
       primary_topic_id, {names} AS primary_topic_name
FROM scored WHERE ok"""


def lexicon_sentiment_sql(lex: Lexicon) -> str:
    return _with(*cleaned_articles_sql(), *compound_ctes(lex)) + f"""
SELECT c.article_id, CASE WHEN ok THEN compound ELSE CAST(0 AS DOUBLE) END AS sentiment_score,
       {_label_sql('CASE WHEN ok THEN CAST(round(compound * 10000) AS BIGINT) ELSE 0 END')}
         AS sentiment_label
FROM c JOIN comp USING (article_id)"""


def process_articles_sql(tax: Taxonomy, lex: Lexicon) -> str:
    return _with(*processed_ctes(tax, lex)) + """
SELECT article_id, cleaned_text, relevance_score, sentiment_score, sentiment_label,
       processing_status, notes FROM proc"""


def daily_topic_features_sql(tax: Taxonomy, lex: Lexicon) -> str:
    return _with(*processed_ctes(tax, lex), topic_rows_cte(tax)) + f"""
SELECT p.published_date AS feature_date, t.topic_id, count(*) AS article_count,
       {ratio('sum(p.sentiment_e4)', 'count(p.sentiment_e4)')} AS avg_sentiment,
       CASE WHEN sum(coalesce(t.topic_score_e4, 0)) > 0
            THEN {ratio('sum(p.sentiment_e4 * t.topic_score_e4)', 'sum(t.topic_score_e4)')} END
         AS weighted_avg_sentiment,
       {ratio('sum(t.topic_score_e4)', 'count(t.topic_score_e4)')} AS avg_relevance
FROM proc p JOIN trows t USING (article_id)
WHERE p.processing_status = 'processed' AND p.published_date IS NOT NULL
GROUP BY p.published_date, t.topic_id"""


def daily_scored_news_sql(tax: Taxonomy, lex: Lexicon) -> str:
    return _with(*processed_ctes(tax, lex),
                 ("items", "SELECT article_id, source_id, published_date, processing_status, "
                           "sentiment_label, sentiment_e4, rel_e4 AS relevance_e4 FROM proc")
                 ) + daily_news_body("items")


def alignment_sql() -> str:
    return _with(("prices", PRICES_SQL), ("n", NEWS_SQL), ("daily", daily_news_body("n"))) + """
SELECT p.benchmark_code, p.price_date, p.open_price, p.high_price, p.low_price, p.close_price,
       p.volume, d.article_count, d.distinct_source_count, d.avg_sentiment,
       d.weighted_avg_sentiment, d.avg_relevance, d.positive_article_count,
       d.neutral_article_count, d.negative_article_count
FROM prices p LEFT JOIN daily d ON d.feature_date = p.price_date"""


# ---------------------------------------------------------------------------
# Sources, sinks
# ---------------------------------------------------------------------------
from .bindings import RSS_KEYS_SQL, SOURCES_SQL  # noqa: E402

_HASH = "sha256(lower(regexp_replace({u}, '^\\s+|\\s+$', '', 'g')))"


def active_sources_sql() -> str:
    return _with(("s", SOURCES_SQL)) + """
SELECT source_name, source_type, feed_url, domain_name,
       CASE WHEN source_type = 'rss' THEN 'rss'
            WHEN source_type = 'api' AND domain_name = 'hn.algolia.com' THEN 'search'
            WHEN source_type = 'api' AND domain_name = 'mastodon.social' THEN 'timeline' END
         AS reader
FROM s WHERE source_type IN ('rss', 'api') AND is_active AND feed_url IS NOT NULL"""


def dedup_two_keys_sql() -> str:
    """Sequential first-wins insertion, literally: a recursive walk in order."""
    ok = ("(NOT list_contains(w.urls, i.uh) AND "
          "(i.gk IS NULL OR NOT list_contains(w.guids, i.gk)))")
    return f"""
WITH RECURSIVE k AS ({RSS_KEYS_SQL}),
items AS (SELECT row_number() OVER (ORDER BY source_id, position) AS rn, source_id, position,
                 url, guid, {_HASH.format(u='url')} AS uh,
                 CASE WHEN guid IS NULL THEN NULL ELSE source_id || chr(1) || guid END AS gk
          FROM k),
walk(rn, urls, guids, acc) AS (
  SELECT CAST(0 AS BIGINT), CAST([] AS VARCHAR[]), CAST([] AS VARCHAR[]), false
  UNION ALL
  SELECT i.rn,
         CASE WHEN {ok} THEN list_append(w.urls, i.uh) ELSE w.urls END,
         CASE WHEN {ok} AND i.gk IS NOT NULL THEN list_append(w.guids, i.gk) ELSE w.guids END,
         {ok}
  FROM walk w JOIN items i ON i.rn = w.rn + 1)
SELECT i.source_id, i.position, i.url, i.guid FROM walk w JOIN items i USING (rn) WHERE w.acc"""


def insert_if_absent_sql() -> str:
    hist = _HASH.format(u="'  ' || upper(url) || chr(9)")
    return f"""
WITH k AS ({RSS_KEYS_SQL}),
b AS (SELECT source_id, position, url, {_HASH.format(u='url')} AS url_hash FROM k),
h AS (SELECT {hist} AS url_hash FROM pages WHERE page_id % 4 = 0),
f AS (SELECT *, row_number() OVER (PARTITION BY url_hash ORDER BY source_id, position) AS r FROM b)
SELECT source_id, position, url, url_hash FROM f
WHERE r = 1 AND url_hash NOT IN (SELECT url_hash FROM h)"""


def ingest_counts_sql() -> str:
    return f"""
WITH k AS ({RSS_KEYS_SQL}),
b AS (SELECT source_id, position, {_HASH.format(u='url')} AS url_hash FROM k),
f AS (SELECT *, row_number() OVER (PARTITION BY url_hash ORDER BY source_id, position) AS r FROM b),
per AS (SELECT source_id, count(*) AS offered, count(*) FILTER (WHERE r = 1) AS inserted
        FROM f GROUP BY source_id)
SELECT source_id, inserted, offered - inserted AS skipped FROM per
UNION ALL
SELECT 'TOTAL', sum(inserted), sum(offered) - sum(inserted) FROM per"""


def price_upsert_sql() -> str:
    pid = ("CAST((price_date - DATE '1970-01-01') * 10 + "
           "CAST(substr(benchmark_code, 1, 1) AS INTEGER) AS BIGINT)")
    return _with(("prices", PRICES_SQL),
                 ("t", f"""SELECT {pid} AS price_id, benchmark_code, price_date, open_price,
       high_price, low_price, close_price, CAST(NULL AS DOUBLE) AS adjusted_close_price, volume,
       TIMESTAMP '2000-01-01 00:00:00' AS created_at
FROM prices WHERE price_date < DATE '2000-01-01'"""),
                 ("u", f"""SELECT {pid} + 5 AS price_id, benchmark_code, price_date, open_price,
       high_price, low_price, close_price, close_price AS adjusted_close_price, volume + 1 AS volume,
       TIMESTAMP '2001-09-01 00:00:00' AS created_at
FROM prices WHERE price_date >= DATE '1999-10-01'""")) + """
SELECT coalesce(t.price_id, u.price_id) AS price_id,
       coalesce(t.benchmark_code, u.benchmark_code) AS benchmark_code,
       coalesce(t.price_date, u.price_date) AS price_date,
       CASE WHEN u.price_date IS NOT NULL THEN u.open_price ELSE t.open_price END AS open_price,
       CASE WHEN u.price_date IS NOT NULL THEN u.high_price ELSE t.high_price END AS high_price,
       CASE WHEN u.price_date IS NOT NULL THEN u.low_price ELSE t.low_price END AS low_price,
       CASE WHEN u.price_date IS NOT NULL THEN u.close_price ELSE t.close_price END AS close_price,
       CASE WHEN u.price_date IS NOT NULL THEN u.adjusted_close_price
            ELSE t.adjusted_close_price END AS adjusted_close_price,
       CASE WHEN u.price_date IS NOT NULL THEN u.volume ELSE t.volume END AS volume,
       CASE WHEN t.price_date IS NOT NULL THEN t.created_at ELSE u.created_at END AS created_at
FROM t FULL OUTER JOIN u ON t.benchmark_code = u.benchmark_code AND t.price_date = u.price_date"""


def feature_upsert_sql() -> str:
    cols = ["target_date", "close_price", "return_1d", "lag_close_1d", "lag_close_3d",
            "lag_return_1d", "lag_return_3d", "rolling_mean_3d", "rolling_mean_7d",
            "rolling_volatility_7d", "target_close_next_day", "target_return_next_day",
            "target_direction_next_day"]
    sel = ",\n       ".join(f"CASE WHEN u.feature_date IS NOT NULL THEN u.{c} ELSE o.{c} END AS {c}"
                            for c in cols)
    return _with(("prices", PRICES_SQL),
                 ("pb", PRICE_BLOCK), ("pe", PRICE_ENRICHED),
                 ("newf", f"SELECT {PRICE_OUT_COLS} FROM pe"),
                 ("prices_old", "SELECT * FROM prices WHERE price_date < DATE '2000-01-01'"),
                 ("pb_old", PRICE_BLOCK.replace("FROM prices", "FROM prices_old")),
                 ("pe_old", PRICE_ENRICHED.replace("FROM pb", "FROM pb_old")),
                 ("o", f"SELECT {PRICE_OUT_COLS} FROM pe_old"),
                 ("u", "SELECT * FROM newf WHERE feature_date >= DATE '1999-10-01'")) + f"""
SELECT coalesce(o.benchmark_code, u.benchmark_code) AS benchmark_code,
       coalesce(o.feature_date, u.feature_date) AS feature_date,
       {sel}
FROM o FULL OUTER JOIN u ON o.benchmark_code = u.benchmark_code AND o.feature_date = u.feature_date"""


def source_upsert_sql() -> str:
    return _with(("s", SOURCES_SQL)) + """
SELECT s.source_name, s.source_type, s.feed_url, s.domain_name,
       CASE WHEN s.domain_name <> 'unsupported.example' THEN true ELSE s.source_type = 'rss' END
         AS is_active,
       CASE WHEN s.domain_name <> 'unsupported.example' THEN TIMESTAMP '2001-09-01 00:00:00'
            ELSE TIMESTAMP '2000-01-01 00:00:00' END AS updated_at
FROM s"""


def child_replace_sql(tax: Taxonomy, lex: Lexicon) -> str:
    old_tax = Taxonomy([(n, [k for k in kws if k != "que"]) for n, kws in tax.topics])

    def rows(t: Taxonomy, suffix: str) -> list[tuple[str, str]]:
        ctes = list(cleaned_articles_sql()) + list(topic_ctes(t))
        ctes.append(("proc", "SELECT * FROM scored"))
        ctes.append(topic_rows_cte(t))
        renamed = []
        names = {n for n, _ in ctes}
        for n, body in ctes:
            for m in sorted(names, key=len, reverse=True):
                body = body.replace(f"FROM {m}\n", f"FROM {m}_{suffix}\n").replace(
                    f"FROM {m} ", f"FROM {m}_{suffix} ")
                if body.rstrip().endswith(f"FROM {m}"):
                    body = body.rstrip()[: -len(m)] + f"{m}_{suffix}"
            renamed.append((f"{n}_{suffix}", body))
        return renamed
    return _with(*rows(old_tax, "o"), *rows(tax, "n")) + """
SELECT article_id, topic_id, CAST(topic_score_e4 AS DOUBLE) / CAST(10000 AS DOUBLE) AS topic_score,
       is_primary_topic FROM trows_o WHERE article_id % 3 <> 0
UNION ALL
SELECT article_id, topic_id, CAST(topic_score_e4 AS DOUBLE) / CAST(10000 AS DOUBLE) AS topic_score,
       is_primary_topic FROM trows_n WHERE article_id % 3 = 0"""


def quality_report_sql() -> str:
    h = _HASH.format(u="url")
    return _with(("prices", PRICES_SQL), ("n", NEWS_SQL), ("daily", daily_news_body("n")),
                 ("k", RSS_KEYS_SQL), ("s", SOURCES_SQL),
                 ("pb", PRICE_BLOCK), ("pe", PRICE_ENRICHED),
                 ("f", f"SELECT {PRICE_OUT_COLS} FROM pe")) + f"""
SELECT 'prices_unique_series_date' AS rule, coalesce(sum(c - 1), 0)::BIGINT AS violations
  FROM (SELECT count(*) c FROM prices GROUP BY benchmark_code, price_date HAVING count(*) > 1)
UNION ALL SELECT 'prices_close_not_null', count_if(close_price IS NULL) FROM prices
UNION ALL SELECT 'news_label_domain',
  count_if(sentiment_label NOT IN ('negative', 'neutral', 'positive')) FROM n
UNION ALL SELECT 'news_status_domain',
  count_if(processing_status NOT IN ('pending', 'processed', 'failed')) FROM n
UNION ALL SELECT 'items_unique_url_hash', coalesce(sum(c - 1), 0)::BIGINT
  FROM (SELECT count(*) c FROM k GROUP BY {h} HAVING count(*) > 1)
UNION ALL SELECT 'items_unique_source_guid', coalesce(sum(c - 1), 0)::BIGINT
  FROM (SELECT count(*) c FROM k WHERE guid IS NOT NULL GROUP BY source_id, guid HAVING count(*) > 1)
UNION ALL SELECT 'items_url_not_null', count_if(url IS NULL) FROM k
UNION ALL SELECT 'items_source_fk', count(*) FROM k
  WHERE source_id NOT IN (SELECT source_name FROM s)
UNION ALL SELECT 'daily_article_count_nonneg', count_if(article_count < 0) FROM daily
UNION ALL SELECT 'daily_positive_nonneg', count_if(positive_article_count < 0) FROM daily
UNION ALL SELECT 'daily_unique_date', coalesce(sum(c - 1), 0)::BIGINT
  FROM (SELECT count(*) c FROM daily GROUP BY feature_date HAVING count(*) > 1)
UNION ALL SELECT 'features_direction_domain',
  count_if(target_direction_next_day NOT IN (-1, 0, 1)) FROM f
UNION ALL SELECT 'features_unique_series_date', coalesce(sum(c - 1), 0)::BIGINT
  FROM (SELECT count(*) c FROM f GROUP BY benchmark_code, feature_date HAVING count(*) > 1)"""


# ---------------------------------------------------------------------------
# Monitoring (binding M over the price features)
# ---------------------------------------------------------------------------
from .plans.registry_m import AS_OF, MODELS, OLD_RUN_FACTOR, RUN_FINISHED  # noqa: E402


def _m_ctes() -> tuple[tuple[str, str], ...]:
    runs, preds = [], []
    digit = "CAST(substr(benchmark_code, 1, 1) AS INTEGER)"
    for name, idx, col in MODELS:
        for ver in (1, 2):
            rid = f"CAST({digit} * 100 + {idx * 10 + ver} AS BIGINT)"
            runs.append(f"SELECT DISTINCT {rid} AS model_run_id, benchmark_code, '{name}' AS model_name,"
                        f" 'v{ver}' AS model_version,"
                        f" TIMESTAMP '{RUN_FINISHED[(idx, ver)]}' AS finished_at FROM f")
            factor = OLD_RUN_FACTOR if ver == 1 else 1.0
            preds.append(
                f"SELECT CAST({rid} * 100000 + (feature_date - DATE '1995-01-01') AS BIGINT)"
                f" AS prediction_id, {rid} AS model_run_id, benchmark_code, feature_date,"
                f" target_date AS prediction_for_date,"
                f" {rnd(f'{col} * {_dbl(factor)}', 4)} AS predicted_close,"
                f" target_close_next_day AS actual_close, true AS is_backtest"
                f" FROM f WHERE target_close_next_day IS NOT NULL AND {col} IS NOT NULL")
    return (("prices", PRICES_SQL), ("pb", PRICE_BLOCK), ("pe", PRICE_ENRICHED),
            ("f", f"SELECT {PRICE_OUT_COLS} FROM pe"),
            ("runs", "\nUNION ALL ".join(runs)), ("preds", "\nUNION ALL ".join(preds)))


def _decision_ctes() -> tuple[tuple[str, str], ...]:
    mae = "CAST({s} AS DOUBLE) / (CAST({n} AS DOUBLE) * CAST(10000 AS DOUBLE))"
    r, pv = "recent_mae", "previous_mae"
    f4 = "printf('%.4f', {})"
    return (*_m_ctes(),
            ("lr", """SELECT benchmark_code, model_name, max(model_run_id) AS model_run_id
FROM runs GROUP BY benchmark_code, model_name"""),
            ("pp", """SELECT p.*, lr.model_name,
       abs(CAST(round(predicted_close * 10000) AS BIGINT) - CAST(round(actual_close * 10000) AS BIGINT))
         AS e
FROM preds p JOIN lr ON p.model_run_id = lr.model_run_id WHERE actual_close IS NOT NULL"""),
            ("rk", """SELECT *, row_number() OVER (PARTITION BY benchmark_code, model_name
                                ORDER BY prediction_for_date DESC, prediction_id DESC) AS rn FROM pp"""),
            ("ag", """SELECT benchmark_code, model_name, model_run_id, count(*) AS rows_available,
       sum(e) AS all_s, sum(e) FILTER (WHERE rn <= 30) AS rec_s, count(*) FILTER (WHERE rn <= 30) AS rec_n,
       sum(e) FILTER (WHERE rn > 30 AND rn <= 60) AS prev_s,
       count(*) FILTER (WHERE rn > 30 AND rn <= 60) AS prev_n
FROM rk GROUP BY benchmark_code, model_name, model_run_id"""),
            ("dm", f"""SELECT benchmark_code, model_name, model_run_id, rows_available,
       CASE WHEN rows_available < 30 THEN {mae.format(s='all_s', n='rows_available')}
            ELSE {mae.format(s='rec_s', n='rec_n')} END AS recent_mae,
       CASE WHEN rows_available >= 30 AND prev_n > 0 THEN {mae.format(s='prev_s', n='prev_n')} END
         AS previous_mae
FROM ag"""),
            ("dd", f"""SELECT *,
       CASE WHEN {pv} IS NULL THEN NULL WHEN {pv} <> 0 THEN ({r} - {pv}) / {pv}
            ELSE CAST(0 AS DOUBLE) END AS relative_change,
       ({pv} IS NOT NULL AND {r} > {pv} * CAST(1.3 AS DOUBLE)) AS is_err,
       ({pv} IS NOT NULL AND NOT ({r} > {pv} * CAST(1.3 AS DOUBLE))
        AND {r} > {pv} * CAST(1.15 AS DOUBLE)) AS is_warn
FROM dm"""),
            ("decisions", f"""SELECT benchmark_code, model_name, model_run_id, rows_available,
       recent_mae, previous_mae, relative_change,
       CASE WHEN is_err THEN 'error' WHEN is_warn THEN 'warning' ELSE 'info' END AS severity,
       (is_err OR is_warn) AS should_retrain,
       CASE WHEN rows_available < 30 THEN 'insufficient_history'
            WHEN {pv} IS NULL THEN 'no_previous_window' END AS reason,
       CASE WHEN rows_available < 30
              THEN 'Not enough predictions yet for robust retraining decision on ' || model_name || '.'
            WHEN {pv} IS NULL THEN model_name || ' is stable. No retraining needed.'
            WHEN is_err THEN model_name || ' degraded sharply. Recent MAE=' || {f4.format(r)}
                 || ', previous MAE=' || {f4.format(pv)} || '. Retraining strongly recommended.'
            WHEN is_warn THEN model_name || ' degraded. Recent MAE=' || {f4.format(r)}
                 || ', previous MAE=' || {f4.format(pv)} || '. Retraining recommended.'
            ELSE model_name || ' stable. Recent MAE=' || {f4.format(r)} || ', previous MAE='
                 || {f4.format(pv)} || '.' END AS message,
       30 AS recent_window
FROM dd"""))


def latest_runs_sql() -> str:
    return _with(*_m_ctes()) + """
SELECT benchmark_code, model_name, arg_max(model_run_id, model_run_id) AS model_run_id,
       arg_max(model_version, model_run_id) AS model_version,
       arg_max(finished_at, model_run_id) AS finished_at
FROM runs GROUP BY benchmark_code, model_name"""


def drift_decisions_sql() -> str:
    return _with(*_decision_ctes()) + "\nSELECT * FROM decisions"


def _logs_ctes() -> tuple[tuple[str, str], ...]:
    return (*_decision_ctes(),
            ("logs", """SELECT model_run_id AS monitoring_id, 'model_drift' AS log_type,
       'info' AS severity, model_name || '@' || benchmark_code AS component_name,
       'older' AS message, '{"should_retrain": true}' AS details FROM decisions
UNION ALL
SELECT 1000000 + model_run_id, 'model_drift', severity, model_name || '@' || benchmark_code,
       message, CASE WHEN reason = 'insufficient_history' THEN '{"reason": "insufficient_history"}'
                     ELSE '{"should_retrain": ' || CASE WHEN should_retrain THEN 'true' ELSE 'false' END
                          || '}' END
FROM decisions"""),
            ("flags", """SELECT component_name, arg_max(severity, monitoring_id) AS severity,
       arg_max(message, monitoring_id) AS message, arg_max(details, monitoring_id) AS details
FROM logs WHERE log_type = 'model_drift'
  AND (component_name LIKE 'ModelA\\_%' ESCAPE '\\' OR component_name LIKE 'ModelA_%'
       OR component_name LIKE 'ModelB_%')
GROUP BY component_name"""),
            ("flags2", """SELECT *, coalesce(TRY_CAST(json_extract_string(details, '$.should_retrain')
                                        AS BOOLEAN), false) AS should_retrain FROM flags"""))


def payload_variant_sql() -> str:
    number = "CAST(regexp_extract(source, '(\\d+)', 1) AS INTEGER)"
    return _with(("k", RSS_KEYS_SQL)) + f"""
SELECT 'rss' AS shape, guid AS item_id, 'cat' || CAST(position % 4 AS VARCHAR) AS label,
       CAST(2 AS BIGINT) AS n FROM k
UNION ALL
SELECT 'search', CAST(doc_id AS VARCHAR), 'user' || CAST(n_chars % 10 AS VARCHAR),
       CAST(n_chars % 500 AS BIGINT) FROM documents WHERE {number} % 2 = 0
UNION ALL
SELECT 'timeline', CAST(doc_id AS VARCHAR),
       CASE WHEN doc_id % 9 <> 0 THEN 'user' || CAST(n_chars % 10 AS VARCHAR) END, NULL
FROM documents WHERE {number} % 2 <> 0"""


def schema_report_sql(tax: Taxonomy, benchmarks: tuple[str, ...]) -> str:
    from .operators.quality import schema_rules
    ctes = [*_logs_ctes(), ("n", NEWS_SQL), ("k", RSS_KEYS_SQL), ("sources", SOURCES_SQL),
            ("daily_news_features", daily_news_body("n")),
            ("articles_raw", f"""SELECT position AS article_id, source_id, url, guid AS external_guid,
       {_HASH.format(u="url")} AS url_hash, url AS title, guid AS language_code FROM k"""),
            ("articles_processed", "SELECT * FROM n"),
            ("topics", " UNION ALL ".join(f"SELECT {t} AS topic_id, {_q(n)} AS topic_name"
                                          for t, n in tax.topic_ids)),
            ("article_topic_scores",
             "SELECT article_id, published_date, article_id % 6 + 1 AS topic_id FROM n"),
            ("daily_topic_features", """SELECT published_date AS feature_date, topic_id,
       count(*) - 2 AS article_count FROM article_topic_scores GROUP BY ALL"""),
            ("oil_prices", "SELECT * FROM prices"), ("model_features", "SELECT * FROM f"),
            ("model_runs", "SELECT *, 'completed' AS run_status FROM runs"),
            ("predictions", """SELECT *, sign(predicted_close - actual_close) AS predicted_direction
FROM preds"""),
            ("monitoring_logs", "SELECT * FROM logs")]
    listed = lambda vs: ", ".join(_q(v) if isinstance(v, str) else str(v) for v in vs)
    parts = []
    for r in schema_rules(benchmarks):
        c = r.columns[0]
        if r.kind == "unique":
            some = " AND ".join(f"{x} IS NOT NULL" for x in r.columns)
            count = (f"(SELECT coalesce(sum(c - 1), 0) FROM (SELECT count(*) AS c FROM {r.table} "
                     f"WHERE {some} GROUP BY {', '.join(r.columns)}))")
        elif r.kind == "foreign_key":
            count = (f"(SELECT count(*) FROM {r.table} t WHERE {c} IS NOT NULL AND NOT EXISTS "
                     f"(SELECT 1 FROM {r.ref} o WHERE o.{r.ref_column} = t.{c}))")
        else:
            test = {"domain": f"{c} NOT IN ({listed(r.values)})", "not_null": f"{c} IS NULL",
                    "non_negative": f"{c} < 0", "longest": f"length({c}) > {listed(r.values)}"}[r.kind]
            count = f"(SELECT count(*) FROM {r.table} WHERE {test})"
        parts.append(f"SELECT '{r.name}' AS rule, CAST({count} AS BIGINT) AS violations")
    return _with(*ctes) + "\n" + "\nUNION ALL ".join(parts)


def latest_flags_sql() -> str:
    return _with(*_logs_ctes()) + """
SELECT component_name, severity, message, should_retrain FROM flags2"""


def retrain_actions_sql() -> str:
    return _with(*_logs_ctes(),
                 ("g", "SELECT 'ModelA_' AS group_prefix UNION ALL SELECT 'ModelB_'"),
                 ("per", """SELECT g.group_prefix, bool_or(f.should_retrain) AS anyf
FROM g JOIN flags2 f ON starts_with(f.component_name, g.group_prefix) GROUP BY g.group_prefix"""),
                 ("last", """SELECT g.group_prefix, max(r.finished_at) AS last_finished_at
FROM g JOIN runs r ON r.model_name LIKE g.group_prefix || '%' GROUP BY g.group_prefix""")) + f"""
SELECT g.group_prefix, coalesce(per.anyf, false) AS retrain_flag,
       coalesce(last.last_finished_at >= TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR, false)
         AS cooldown_active,
       last.last_finished_at,
       (SELECT count(*) FROM flags2) AS flag_count,
       CASE WHEN (SELECT count(*) FROM flags2) = 0 THEN 'none'
            WHEN NOT coalesce(per.anyf, false) THEN 'skipped'
            WHEN coalesce(last.last_finished_at >= TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR, false)
              THEN 'cooldown' ELSE 'retrain' END AS action
FROM g LEFT JOIN per USING (group_prefix) LEFT JOIN last USING (group_prefix)"""


def cooldown_sql() -> str:
    return _with(*_m_ctes(),
                 ("g", "SELECT 'ModelA_' AS group_prefix UNION ALL SELECT 'ModelB_'"),
                 ("last", """SELECT g.group_prefix, max(r.finished_at) AS last_finished_at
FROM g JOIN runs r ON r.model_name LIKE g.group_prefix || '%' GROUP BY g.group_prefix""")) + f"""
SELECT g.group_prefix, last.last_finished_at,
       last.last_finished_at + INTERVAL 24 HOUR AS cooldown_ends_at,
       coalesce(last.last_finished_at >= TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR, false)
         AS cooldown_active
FROM g LEFT JOIN last USING (group_prefix)"""


# ---------------------------------------------------------------------------
# Serving panels and top-k reports
# ---------------------------------------------------------------------------
def serve_price_trend_sql() -> str:
    return _with(("prices", PRICES_SQL)) + """
SELECT benchmark_code, price_date, open_price, high_price, low_price, close_price, volume
FROM prices WHERE price_date BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'"""


def _daily_with() -> str:
    return _with(("n", NEWS_SQL), ("daily", daily_news_body("n")))


def serve_daily_counts_sql() -> str:
    return _daily_with() + "\nSELECT feature_date, article_count, distinct_source_count FROM daily"


def serve_sentiment_sql() -> str:
    return _daily_with() + """
SELECT feature_date, 'weighted' AS mode, weighted_avg_sentiment AS sentiment FROM daily"""


def serve_label_counts_sql() -> str:
    return _daily_with() + """
SELECT feature_date, positive_article_count, neutral_article_count, negative_article_count
FROM daily"""


def _pva() -> str:
    return """SELECT p.benchmark_code, lr.model_name, p.prediction_for_date, p.predicted_close,
       p.actual_close FROM preds p JOIN lr ON p.model_run_id = lr.model_run_id"""


def _lr() -> tuple[str, str]:
    return ("lr", """SELECT benchmark_code, model_name, max(model_run_id) AS model_run_id
FROM runs GROUP BY benchmark_code, model_name""")


def serve_pred_vs_actual_sql() -> str:
    return _with(*_m_ctes(), _lr()) + "\n" + _pva()


def serve_error_sql() -> str:
    return _with(*_m_ctes(), _lr(), ("pva", _pva())) + """
SELECT *, abs(predicted_close - actual_close) AS abs_error,
       CASE WHEN actual_close = 0 THEN NULL
            ELSE abs(predicted_close - actual_close) / actual_close END AS pct_error
FROM pva"""


def serve_model_comparison_sql() -> str:
    e = ("CAST(CAST(round(p.predicted_close * 10000) AS BIGINT) - "
         "CAST(round(p.actual_close * 10000) AS BIGINT) AS HUGEINT)")
    return _with(*_m_ctes(), _lr()) + f"""
SELECT lr.benchmark_code, lr.model_name, lr.model_run_id, count(*) AS n,
       CAST(sum(abs({e})) AS DOUBLE) / (CAST(count(*) AS DOUBLE) * CAST(10000 AS DOUBLE)) AS mae,
       sqrt(CAST(sum({e} * {e}) AS DOUBLE) / CAST(count(*) AS DOUBLE)) / CAST(10000 AS DOUBLE)
         AS rmse
FROM preds p JOIN lr ON p.model_run_id = lr.model_run_id
WHERE p.actual_close IS NOT NULL
GROUP BY lr.benchmark_code, lr.model_name, lr.model_run_id"""


def serve_monitoring_sql() -> str:
    return _with(*_logs_ctes()) + """
SELECT component_name, arg_max(log_type, monitoring_id) AS log_type,
       arg_max(severity, monitoring_id) AS severity, arg_max(message, monitoring_id) AS message
FROM logs GROUP BY component_name"""


def serve_by_source_sql() -> str:
    return _with(("n", NEWS_SQL)) + f"""
SELECT published_date AS feature_date, source_id, count(*) AS article_count,
       {ratio('sum(sentiment_e4)', 'count(*)')} AS avg_sentiment
FROM n WHERE processing_status = 'processed' AND published_date IS NOT NULL
  AND coalesce(relevance_e4, 0) > 0
GROUP BY published_date, source_id"""


def serve_health_sql() -> str:
    return _with(*_m_ctes(), ("n", NEWS_SQL), ("daily", daily_news_body("n"))) + """
SELECT 'prices' AS table_name, count(*) AS row_count FROM prices
UNION ALL SELECT 'news_items', count(*) FROM n
UNION ALL SELECT 'daily_news', count(*) FROM daily
UNION ALL SELECT 'features', count(*) FROM f
UNION ALL SELECT 'predictions', count(*) FROM preds"""


def latest_features_sql() -> str:
    return _with(("prices", PRICES_SQL), ("pb", PRICE_BLOCK), ("pe", PRICE_ENRICHED),
                 ("f", f"SELECT {PRICE_OUT_COLS} FROM pe")) + """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY benchmark_code ORDER BY feature_date DESC) AS rn FROM f)
WHERE rn <= 5"""


def last_predictions_sql() -> str:
    return _with(*_m_ctes(), _lr(), ("pva", _pva())) + """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY model_name, benchmark_code
                               ORDER BY prediction_for_date DESC) AS rn FROM pva)
WHERE rn <= 10"""


# ---------------------------------------------------------------------------
# Model inputs: filters, chronological split, time-series folds
# ---------------------------------------------------------------------------
_PF = ["lag_close_1d", "lag_close_3d", "lag_return_1d", "lag_return_3d", "rolling_mean_3d",
       "rolling_mean_7d", "rolling_volatility_7d"]
_NF = ["news_article_count_1d", "news_avg_sentiment_1d", "news_weighted_sentiment_1d",
       "news_avg_sentiment_3d", "news_weighted_sentiment_3d"]
_TG = ["target_close_next_day", "target_return_next_day", "target_direction_next_day"]


def _features_with() -> str:
    s = news_price_features_sql()
    return s[: s.rindex("\nSELECT ")] + ",\nfeat AS (" + s[s.rindex("\nSELECT ") + 1:] + ")"


def _notnull(cols) -> str:
    return " AND ".join(f"{c} IS NOT NULL" for c in cols)


def complete_cases_sql() -> str:
    return _features_with() + f"""
SELECT benchmark_code, feature_date, target_date, {', '.join(_PF)}, target_close_next_day
FROM feat WHERE {_notnull(_PF + ['target_close_next_day'])}"""


def _filled() -> str:
    cols = ", ".join(f"CAST(coalesce({c}, 0) AS DOUBLE) AS {c}" for c in _NF)
    return (f"SELECT * REPLACE ({cols}, CAST(target_direction_next_day AS DOUBLE)"
            f" AS target_direction_next_day) FROM feat")


def labelled_rows_sql() -> str:
    return _features_with() + f""", filled AS ({_filled()})
SELECT benchmark_code, feature_date, {', '.join(_PF + _NF + _TG)}
FROM filled WHERE {_notnull(_PF + _NF + _TG)}"""


def live_candidates_sql() -> str:
    return _features_with() + f""", filled AS ({_filled()})
SELECT benchmark_code, feature_date, close_price, {', '.join(_PF + _NF)}
FROM filled WHERE {_notnull(_PF + _NF + ['close_price'])}"""


def _split_with() -> str:
    return _features_with() + f""",
cc AS (SELECT * FROM feat WHERE {_notnull(_PF + ['target_close_next_day'])}),
sp AS (SELECT *, row_number() OVER (PARTITION BY benchmark_code ORDER BY feature_date) AS rn,
              count(*) OVER (PARTITION BY benchmark_code) AS n FROM cc),
sp2 AS (SELECT *, CASE WHEN rn <= floor(n * CAST(0.7 AS DOUBLE)) THEN 'train'
                       WHEN rn <= floor(n * CAST(0.8 AS DOUBLE)) THEN 'validation'
                       ELSE 'test' END AS split FROM sp)"""


def chronological_split_sql() -> str:
    return _split_with() + """
SELECT benchmark_code, split, count(*) AS rows, min(feature_date) AS start_date,
       max(feature_date) AS end_date FROM sp2 GROUP BY benchmark_code, split"""


def ts_cv_folds_sql() -> str:
    return _split_with() + """,
tr AS (SELECT *, row_number() OVER (PARTITION BY benchmark_code ORDER BY feature_date) AS ti,
              count(*) OVER (PARTITION BY benchmark_code) AS nt FROM sp2 WHERE split = 'train'),
fo AS (SELECT tr.*, f.fold, nt // 4 AS sz, nt - (3 - f.fold) * (nt // 4) AS st
       FROM tr, (SELECT unnest([0, 1, 2]) AS fold) f),
ro AS (SELECT *, CASE WHEN ti <= st THEN 'train' WHEN ti <= st + sz THEN 'test' END AS role FROM fo)
SELECT benchmark_code, fold, role, count(*) AS rows, min(feature_date) AS start_date,
       max(feature_date) AS end_date FROM ro WHERE role IS NOT NULL
GROUP BY benchmark_code, fold, role"""


def stream_dedup_sql() -> str:
    return _with(("e", EVENTS_SQL)) + """
SELECT dedup_key, article_id, source_id, published_at, sentiment_e4 FROM (
  SELECT *, source_id || ':' || CAST(published_date AS VARCHAR) AS dedup_key,
         row_number() OVER (PARTITION BY source_id, published_date ORDER BY article_id) AS r
  FROM e) WHERE r = 1"""


def append_registry_sql() -> str:
    """Two appends of each table: its rows count twice."""
    return _with(*_decision_ctes()) + """
SELECT 'model_runs' AS table_name, CAST(2 * count(*) AS BIGINT) AS rows FROM runs
UNION ALL SELECT 'predictions', CAST(2 * count(*) AS BIGINT) FROM preds
UNION ALL SELECT 'monitoring_logs', CAST(2 * count(*) AS BIGINT) FROM decisions"""


def strip_html_sql() -> str:
    """Only the references that the pages hold; the ampersand last, so that
    nothing is unescaped twice (one without its semicolon may end a cut page)."""
    x = "html"
    for ref, char in (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&lt;", "<"),
                      ("&gt;", ">"), ("&amp;", "&")):
        x = f"replace({x}, '{ref}', '{char}')"
    x = f"regexp_replace({x}, '&amp$', '&')"
    x = f"regexp_replace(regexp_replace({x}, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')"
    return f"SELECT page_id, nullif(trim({x}), '') AS text FROM pages"
