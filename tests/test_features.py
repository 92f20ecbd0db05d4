"""Window features and the forward as-of mapping on hand-made inputs."""

import datetime as dt

from pyspark.sql import functions as F

from tradewind.operators.aggregates import trading_day_news
from tradewind.operators.asof import forward_asof
from tradewind.operators.windows import price_window_block

D = dt.date


def test_prices_tiny(spark):
    # series A ends Fri, B ends Sat, C ends Sun; A has a gap, a zero and a null close
    rows = [("A", D(2024, 1, 1), 10.0), ("A", D(2024, 1, 2), 0.0), ("A", D(2024, 1, 3), 12.0),
            ("A", D(2024, 1, 5), None), ("A", D(2024, 1, 8), 15.0), ("A", D(2024, 1, 12), 16.0),
            ("B", D(2024, 1, 12), 5.0), ("B", D(2024, 1, 13), 6.0),
            ("C", D(2024, 1, 13), 7.0), ("C", D(2024, 1, 14), 8.0)]
    df = spark.createDataFrame(rows, "benchmark_code string, price_date date, close_price double")
    out = {(r.benchmark_code, r.feature_date): r for r in price_window_block(df).collect()}
    a2, a3 = out[("A", D(2024, 1, 2))], out[("A", D(2024, 1, 3))]
    assert a2.return_1d == 0.0 / 10.0 - 1 and a3.return_1d is None      # zero previous close
    assert out[("A", D(2024, 1, 1))].rolling_volatility_7d is None       # one-row frame
    assert out[("A", D(2024, 1, 1))].rolling_mean_3d == 10.0             # partial frame
    assert out[("A", D(2024, 1, 3))].target_date == D(2024, 1, 5)        # next row, not +1
    assert out[("A", D(2024, 1, 12))].target_date == D(2024, 1, 15)      # Fri +3
    assert out[("B", D(2024, 1, 13))].target_date == D(2024, 1, 15)      # Sat +2
    assert out[("C", D(2024, 1, 14))].target_date == D(2024, 1, 15)      # Sun +1
    assert out[("A", D(2024, 1, 5))].lag_return_1d is None               # lag of null return
    assert out[("A", D(2024, 1, 3))].lag_return_1d == -1.0
    assert out[("A", D(2024, 1, 8))].lag_close_3d == 0.0
    assert out[("A", D(2024, 1, 1))].target_direction_next_day == -1


def test_news_tiny(spark):
    prices = spark.createDataFrame(
        [("A", D(2024, 1, 5)), ("A", D(2024, 1, 8)), ("A", D(2024, 1, 9))],
        "benchmark_code string, price_date date")
    news = spark.createDataFrame(
        [(D(2024, 1, 6), 2, 0.5, 0.4), (D(2024, 1, 7), 1, -0.2, None),    # Sat, Sun
         (D(2024, 1, 8), 1, 0.1, 0.1),                                   # Mon, exact match
         (D(2024, 1, 3), 3, 0.3, 0.3),                                   # before first price
         (D(2024, 1, 10), 5, 0.9, 0.9)],                                 # after the last price
        "feature_date date, article_count int, avg_sentiment double, "
        "weighted_avg_sentiment double")
    mapped = forward_asof(prices, news)
    m = {r.feature_date: r.mapped_date for r in mapped.collect()}
    assert m == {D(2024, 1, 6): D(2024, 1, 8), D(2024, 1, 7): D(2024, 1, 8),
                 D(2024, 1, 8): D(2024, 1, 8), D(2024, 1, 3): D(2024, 1, 5)}
    t = {r.feature_date: r for r in trading_day_news(mapped).collect()}
    mon = t[D(2024, 1, 8)]
    assert mon.news_n == 4
    assert mon.news_a == 5000 * 2 - 2000 * 1 + 1000 * 1        # count-weighted numerators
    assert mon.news_w == 4000 * 2 + 1000 * 1                   # null mean: no numerator ...
    # ... but its count stays in the denominator (news_n = 4)


def test_feature_table_is_causal(spark):
    """No feature at date d changes when later rows change (except targets)."""
    from tradewind.plans.features import PRICE_FEATURE_COLUMNS, price_features
    rows = [("A", D(2024, 1, i), float(10 + i * (-1) ** i)) for i in range(1, 20)]
    df = spark.createDataFrame(rows, "benchmark_code string, price_date date, close_price double")
    full = {r.feature_date: r for r in price_features(df).collect()}
    cut = {r.feature_date: r for r in price_features(
        df.filter(F.col("price_date") <= D(2024, 1, 10))).collect()}
    keep = [c for c in PRICE_FEATURE_COLUMNS if not c.startswith("target")]
    for d, r in cut.items():
        assert [r[c] for c in keep] == [full[d][c] for c in keep]


def test_asof_stray_early_date(spark):
    """One probe of year 1 adds a row per series, not two thousand years of days."""
    import datetime as dt

    from tradewind.operators.asof import covering_days, forward_asof
    keys = spark.createDataFrame([("A", dt.date(2024, 1, 5)), ("A", dt.date(2024, 1, 9)),
                                  ("B", dt.date(2024, 1, 8))], "benchmark_code string, price_date date")
    probes = spark.createDataFrame([(dt.date(1, 1, 1),), (dt.date(2024, 1, 7),),
                                    (dt.date(2024, 1, 10),)], "feature_date date")
    got = sorted((r.benchmark_code, r.feature_date, r.mapped_date)
                 for r in forward_asof(keys, probes).collect())
    d = dt.date
    assert got == [("A", d(1, 1, 1), d(2024, 1, 5)), ("A", d(2024, 1, 7), d(2024, 1, 9)),
                   ("B", d(1, 1, 1), d(2024, 1, 8)), ("B", d(2024, 1, 7), d(2024, 1, 8))]
    from pyspark.sql import functions as F
    dates = probes.select(F.collect_set("feature_date")).scalar()
    assert covering_days(keys, dates).count() == 9
