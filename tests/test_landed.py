"""Landed price files (A6), stored payloads (I8), ordered reports."""

import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from tradewind.plans import serving as SV
from tradewind.registry import QUERIES
from tradewind.session import scratch_path
from tradewind.sources.feeds import stored_payloads
from tradewind.sources.prices import PRICE_FILE, read_price_files

from .conftest import SF_SMALL

HEAD = ",".join(c.split()[0] for c in PRICE_FILE.split(", "))


@pytest.fixture()
def land(spark):
    d = scratch_path(spark, f"prices-{uuid.uuid4().hex[:8]}").removeprefix("file:")
    os.makedirs(d)

    def write(name, *lines):
        os.makedirs(os.path.dirname(f"{d}/{name}"), exist_ok=True)
        with open(f"{d}/{name}", "w") as fh:
            fh.write("".join(x + "\n" for x in lines))
        return d
    return write


def test_price_files(spark, land):
    land("a/one.csv", HEAD, "A,2024-01-02,1.5,2,1,1.25,10", "A,2024-01-03,,,,0.1,", "A,2024-13-03,1,2,3,4,5")
    d = land("two.csv", HEAD, "B,2024-01-02,1,2,1,x,7", ",2024-01-04,1,1,1,1,1", "B,2024-01-05,9,9,9,9,9")
    land("notes.txt", "not a price file")
    prices, rejected = read_price_files(spark, d)
    got = sorted((r.benchmark_code, str(r.price_date), r.close_price, r.volume) for r in prices.collect())
    assert got == [("A", "2024-01-02", 1.25, 10), ("A", "2024-01-03", 0.1, None), ("B", "2024-01-05", 9.0, 9)]
    bad = sorted((r.path.rsplit("/", 1)[1], r.line) for r in rejected.collect())
    assert [n for n, _ in bad] == ["one.csv", "two.csv", "two.csv"]
    assert "A,2024-13-03,1,2,3,4,5" in [x for _, x in bad]


@pytest.mark.parametrize("lines,message", [
    ((HEAD.replace(",close_price", ""), "A,2024-01-02,1,2,1,10"), r"\['close_price'\] are missing"),
    ((HEAD,), "no rows"),
    ((",".join(reversed(HEAD.split(","))), "1,1,1,1,1,2024-01-02,A"), "another order"),
])
def test_broken_price_files_raise(spark, land, lines, message):
    land("good.csv", HEAD, "A,2024-01-02,1,2,1,1,1")
    d = land("broken.csv", *lines)
    with pytest.raises(ValueError, match=message):
        read_price_files(spark, d)


def test_nothing_but_empty_price_files(spark, land):
    """Spark's readers pass over files of no bytes: alone they are an empty history."""
    with pytest.raises(ValueError, match="empty"):
        read_price_files(spark, land("broken.csv"))


def test_payloads_keep_their_text(spark):
    payloads = ['{"a":1,"b":[true,null,"x"],"c":{"d":1.5}}', '{"e":"ü \\" \\\\n"}', "[1,2]", None]
    items = spark.createDataFrame([("s", "f", i, p) for i, p in enumerate(payloads)],
                                  "source_id string, feed_file string, position long, raw_payload string")
    held = stored_payloads(items, scratch_path(spark, f"payload-{uuid.uuid4().hex}"))
    assert dict(held.dtypes)["payload"] == "variant"
    got = {r.position: r.j for r in held.select("position", F.to_json("payload").alias("j")).collect()}
    assert [None if got[i] is None else json.loads(got[i]) for i in range(4)] == [
        None if p is None else json.loads(p) for p in payloads]
    assert [r[0] for r in held.orderBy("position").select(
        F.try_variant_get("payload", "$.c.d", "double")).collect()] == [1.5, None, None, None]


def test_newest_rows_with_ties(spark):
    df = spark.createDataFrame([("a", 3, x) for x in "dbca"] + [("a", 4, "z"), ("b", 1, "y")],
                               "k string, at int, x string")
    got = sorted(tuple(r) for r in SV.latest_rows(df.repartition(4), "k", "at", 3).collect())
    assert got == [("a", 3, "a"), ("a", 3, "b"), ("a", 4, "z"), ("b", 1, "y")]


REPORTS = {"daily_news_features": "daily_news_features", "daily_topic_features": "daily_topic_features",
           "predictions": "serve_pred_vs_actual", "latest_flags": "latest_flags"}


@pytest.mark.parametrize("report", sorted(SV.REPORT_ORDER))
def test_reports_are_written_in_order(spark, report):
    order = SV.REPORT_ORDER[report]
    df = QUERIES[REPORTS[report]](spark, SF_SMALL)
    path = scratch_path(spark, f"report-{uuid.uuid4().hex}").removeprefix("file:")
    n = df.count()
    SV.write_report(df, path, order, rows_per_file=max(1, n // 4))
    files = sorted(f for f in os.listdir(path) if f.startswith("part-"))
    assert len(files) > 1
    rows = [tuple(r) for f in files for r in spark.read.parquet(f"{path}/{f}").select(*order).collect()]
    assert len(rows) == n and rows == sorted(rows)


def test_a_reader_lands_its_own_files_only(spark):
    from tradewind.registry import _landing
    path = _landing(spark, f"{SF_SMALL}/.", "rss").removeprefix("file:")
    assert os.listdir(path) == ["rss"]


def test_landed_rss_of_repeated_and_missing_ids(spark):
    """A page stands once per row of the page whose url it may reuse; every file has its
    items between one head and one end."""
    import glob
    import re
    from tradewind import bindings as B
    rows = [(i, f"u{i}", f"<title>t{i}</title>") for i in (0, 3, 12, 12, 19, 19, 20, 160, 320)]
    pages = spark.createDataFrame([*rows, (313, None, "n"), (None, "u", "h")],
                                  "page_id long, url string, html string")
    path = scratch_path(spark, f"rss-{uuid.uuid4().hex[:8]}").removeprefix("file:")
    B.land_rss(pages, path)
    got = []
    for name in glob.glob(f"{path}/source_id=*/chunk=*/part-*"):
        lines = open(name).read().splitlines()
        if "HIVE_DEFAULT" not in name:
            assert lines[0].startswith("<?xml") and "<item>" not in lines[0]
            assert lines[-1] == "</channel></rss>"
        at = [x for x in lines if x.startswith("<item>")]
        got += [(re.findall("<link>(.*?)</link>", x), re.findall("<guid>(.*?)</guid>", x)) for x in at]
    want = [([r.url] if r.url else [], [r.guid] if r.guid else [])
            for r in B.rss_item_keys(pages).collect()]
    assert sorted(got) == sorted(want) and len(got) == 13
