"""Physical-plan properties that matter at scale."""

from tradewind import bindings as B
from tradewind.io import table
from tradewind.plans import features as FE
from tradewind.registry import QUERIES

from .conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_price_window_block_single_exchange(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        prices = B.price_series(table(spark, SF_SMALL, "orders"))
        p = plan(FE.price_features(prices))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # one exchange for the daily grouping, one for the whole window block
    assert p.count("Exchange hashpartitioning") == 2, p
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_scan_pruning_and_pushdown(spark):
    df = QUERIES["serve_price_trend"](spark, SF_SMALL)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "o_custkey" not in p and "o_orderstatus" not in p
    pushed = [x for x in p.split("PushedFilters: [")[1:]]
    assert pushed and any("o_orderdate" in x.split("]")[0] for x in pushed), p


def test_features_plan_has_no_python(spark):
    p = plan(QUERIES["news_price_features"](spark, SF_SMALL))
    assert "EvalPython" not in p


def test_model_coefficients_join_without_a_hint(spark):
    """The coefficient table grows with the series: no forced broadcast."""
    from tradewind.plans import models as M
    f = QUERIES["news_price_features"](spark, SF_SMALL)
    s = M.prepared(f, M.PRICE_FEATURES, news=False)
    coefs = M.fit_ols(s.filter("split = 'train'"), ["benchmark_code"], M.PRICE_FEATURES)
    p = M.predict(s.filter("split = 'test'"), coefs, ["benchmark_code"], M.PRICE_FEATURES)
    assert "broadcast" not in p._jdf.queryExecution().logical().toString().lower()
