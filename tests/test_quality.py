"""Constraint rules: every kind by hand, and one scan per table."""

import re

import pytest

from tradewind.operators import quality as Q


@pytest.fixture()
def tables(spark):
    child = spark.createDataFrame(
        [(1, "a", 10, "x", 5), (1, "a", 11, "y", -1), (1, None, 11, None, 0), (2, "b", 99, "zzzz", None),
         (2, "b", None, "x", -7), (2, "b", 12, "q", 3), (None, "c", 98, "x", 1)],
        "id long, code string, parent long, kind string, n int")
    parent = spark.createDataFrame([(10, "p"), (11, "q"), (11, "q"), (12, None)], "pid long, name string")
    return {"child": child, "parent": parent, "unused": parent}


RULES = [
    Q.unique("u_id", "id", table="child"), Q.unique("u_pair", "id", "code", table="child"),
    Q.foreign_key("fk", "parent", "parent", "pid", table="child"),
    Q.domain("kinds", "kind", ["x", "y"], table="child"), Q.not_null("code", "code", table="child"),
    Q.non_negative("n", "n", table="child"), Q.longest("kind_length", "kind", 3, table="child"),
    Q.unique("u_parent", "pid", table="parent"), Q.not_null("name", "name", table="parent"),
    Q.unique("u_name", "name", table="parent"), Q.unique("holds", "pid", "name", table="unused"),
]


def test_violations_by_hand(tables):
    got = {r.rule: r.violations for r in Q.validate_tables(tables, RULES).collect()}
    assert got == {"u_id": 4, "u_pair": 3, "fk": 2, "kinds": 2, "code": 1, "n": 2, "kind_length": 1,
                   "u_parent": 1, "name": 1, "u_name": 1, "holds": 1}
    empty = {k: t.where("false") for k, t in tables.items()}
    assert {r.violations for r in Q.validate_tables(empty, RULES).collect()} == {0}


def test_one_table(tables):
    rules = [Q.unique("u", "id"), Q.foreign_key("f", "parent", tables["parent"], "pid"), Q.not_null("c", "code")]
    assert {tuple(r) for r in Q.validate(tables["child"], rules).collect()} == {("u", 4), ("f", 2), ("c", 1)}
    assert Q.validate(tables["child"], []).count() == 0


def test_every_table_is_scanned_once(spark, tables, tmp_path):
    stored = {}
    for name, t in tables.items():
        t.write.parquet(str(tmp_path / name))
        stored[name] = spark.read.parquet(str(tmp_path / name))
    out = Q.validate_tables(stored, RULES)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Relation", plan)) == 3
    read = out._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan parquet", read)) == 3


def test_schema_rules_cover_every_table():
    rules = Q.schema_rules(["A"])
    assert len(rules) == len({r.name for r in rules}) == 41
    assert len({r.table for r in rules}) == 12
