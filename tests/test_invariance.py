"""Results do not depend on the shuffle partition count or on input order."""

import pytest

from tradewind.registry import QUERIES
from tradewind.sources.prices import attach_source_id, validate_price_history

from .conftest import SF_SMALL


@pytest.mark.parametrize("key", ["price_features", "daily_news_features", "dedup_two_keys",
                                 "drift_decisions"])
def test_partition_count_invariance(spark, key):
    out = []
    for n in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        out.append(sorted(map(tuple, QUERIES[key](spark, SF_SMALL).collect()), key=repr))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert out[0] == out[1]


def test_price_guards(spark):
    p = QUERIES["price_features"].__globals__["_prices"](spark, SF_SMALL)
    with pytest.raises(ValueError):
        validate_price_history(p.drop("low_price"))
    with pytest.raises(ValueError):
        validate_price_history(p.filter("1 = 0"))
    src = spark.createDataFrame([("a", 1)], "source_name string, source_id int")
    rows = spark.createDataFrame([("a",), ("b",)], "source_name string")
    with pytest.raises(ValueError):
        attach_source_id(rows, src)
    assert attach_source_id(rows.filter("source_name = 'a'"), src).first().source_id == 1
