"""Upsert, insert-if-absent and the two-key first-wins rule."""

import random

from pyspark.sql import functions as F

from tradewind.operators import dedup as D
from tradewind.operators.dedup import first_wins_two_keys
from tradewind.operators.sinks import insert_if_absent, upsert


def sequential(rows):
    """The reference's row-at-a-time insertion with two unique keys."""
    urls, guids, out = set(), set(), []
    for pos, u, g in rows:
        if u in urls or (g is not None and g in guids):
            continue
        urls.add(u)
        if g is not None:
            guids.add(g)
        out.append(pos)
    return out


def run_dedup(spark, rows):
    df = spark.createDataFrame(rows, "pos long, u string, g string")
    acc = first_wins_two_keys(df, "pos", "u", "g")
    return sorted(r.pos for r in acc.collect())


def test_dedup_tiny(spark):
    rows = [(1, "u1", "g1"), (2, "u2", "g1"), (3, "u2", "g3"), (4, "u4", None),
            (5, "u4", None), (6, "u6", "g3")]
    assert run_dedup(spark, rows) == sequential(rows) == [1, 3, 4]


def test_dedup_random_against_sequential(spark):
    rnd = random.Random(7)
    for _ in range(3):
        rows = [(i, f"u{rnd.randrange(25)}", None if rnd.random() < 0.2 else f"g{rnd.randrange(25)}")
                for i in range(60)]
        assert run_dedup(spark, rows) == sequential(rows)


def _steps(monkeypatch):
    """Counts the written steps of a call."""
    n = []
    put = D._Steps.put
    monkeypatch.setattr(D._Steps, "put", lambda self, df: n.append(1) or put(self, df))
    return n


def test_dedup_long_chain(spark, monkeypatch):
    """Rows that each share a key with the one before: 10,000 settle in few rounds."""
    steps = _steps(monkeypatch)
    rows = [(i, f"u{(i + 1) // 2}", f"g{i // 2}") for i in range(10_000)]
    assert run_dedup(spark, rows) == sequential(rows) == list(range(0, 10_000, 2))
    assert len(steps) < 30           # rounds and doublings together


def test_dedup_chains_of_larger_groups(spark, monkeypatch):
    """Every key of the chain also has a late row, with and without a second key; two
    chains end in one row; equal pairs."""
    steps = _steps(monkeypatch)
    rows = [(i, f"u{(i + 1) // 2}", f"g{i // 2}") for i in range(600)]
    rows += [(1000 + i, f"u{i}", None if i % 3 else f"x{i}") for i in range(300)]
    rows += [(2000 + i, f"y{i}", f"g{i}") for i in range(300)]
    rows += [(3000 + i, f"a{(i + 1) // 2}", f"b{i // 2}") for i in range(301)]
    rows += [(4000, "u300", "b150"), (4001, "a150", "g299"), (4002, "u0", "g0"), (4003, "u0", "g0")]
    assert run_dedup(spark, rows) == sequential(rows)
    assert len(steps) < 40


def test_dedup_chains_against_sequential(spark):
    rnd = random.Random(11)
    for _ in range(3):
        n = rnd.randrange(40, 120)
        rows = [(i, f"u{(i + rnd.randrange(2)) // 2}", rnd.choice([None, f"g{i // 2}", f"g{i // 3}"]))
                for i in range(n)]
        assert run_dedup(spark, rows) == sequential(rows)


def test_upsert_tiny(spark):
    target = spark.createDataFrame(
        [(1, "k1", 10.0, "2000-01-01"), (2, "k2", 20.0, "2000-01-01")],
        "id long, k string, v double, created string")
    updates = spark.createDataFrame([(7, "k2", 21.0, "2001-01-01"), (8, "k3", 30.0, "2001-01-01")],
                                    "id long, k string, v double, created string")
    out = {r.k: r for r in upsert(target, updates, ["k"], preserve=["id", "created"]).collect()}
    assert (out["k1"].v, out["k1"].id) == (10.0, 1)                     # untouched
    assert (out["k2"].v, out["k2"].id, out["k2"].created) == (21.0, 2, "2000-01-01")
    assert (out["k3"].v, out["k3"].id) == (30.0, 8)                     # new key
    again = upsert(upsert(target, updates, ["k"], ["id", "created"]), updates, ["k"],
                   ["id", "created"])
    assert sorted(again.collect()) == sorted(out.values())              # idempotent


def test_insert_if_absent(spark):
    hist = spark.createDataFrame([("a",)], "key string")
    batch = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b"), (4, None)],
                                  "pos long, key string")
    got = sorted((r.pos, r.key) for r in insert_if_absent(hist, batch, "key", ["pos"]).collect())
    assert got == [(2, "b"), (4, None)]
    assert batch.filter(F.col("key") == "b").count() == 2
