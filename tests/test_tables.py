"""Run partitions and the partition-pruned upsert."""

import os
import uuid

import pytest

from tradewind.operators import tables as TB
from tradewind.operators.sinks import upsert
from tradewind.session import scratch_path


@pytest.fixture()
def path(spark):
    return scratch_path(spark, f"table-{uuid.uuid4().hex[:8]}").removeprefix("file:")


def _files(path):
    return {os.path.join(d, n): os.stat(os.path.join(d, n)).st_mtime_ns
            for d, _, names in os.walk(path) for n in names if n.endswith(".parquet")}


def _prices(spark, days, close, month=lambda d: int(d[:4] + d[5:7])):
    return spark.createDataFrame([(s, d, close, month(d), f"{s}{d}") for s in "AB" for d in days],
                                 "series string, day string, close double, month int, note string")


def test_upsert_reads_and_writes_touched_partitions_only(spark, path):
    old = _prices(spark, [f"2024-{m:02d}-{d:02d}" for m in range(1, 9) for d in (1, 2)], 1.0)
    TB.write_partitions(old, path, "month")
    before = _files(path)
    new = _prices(spark, ["2024-03-02", "2024-03-05", "2024-07-01", "2024-09-01"], 2.0)
    got = TB.upsert_partitioned(path, new, ["series", "day"], "month", preserve=["note"])
    want = upsert(old, new, ["series", "day"], preserve=["note"])
    assert sorted(got.select(want.columns).collect()) == sorted(want.collect())
    after = _files(path)
    kept = {n for n in before if after.get(n) == before[n]}
    assert {n.split("month=")[1][:6] for n in set(before) - kept} == {"202403", "202407"}
    assert {n.split("month=")[1][:6] for n in set(after) - kept} == {"202403", "202407", "202409"}
    # the same batch again changes no row, and no file where only changes are written
    files = _files(path)
    again = TB.upsert_partitioned(path, new, ["series", "day"], "month", only_changed=True,
                                  preserve=["note"])
    assert sorted(again.select(want.columns).collect()) == sorted(want.collect())
    assert _files(path) == files


def test_touched_scan_is_pruned_dynamically(spark, path):
    TB.write_partitions(_prices(spark, [f"2024-{m:02d}-01" for m in range(1, 9)], 1.0), path, "month")
    new = _prices(spark, ["2024-03-02", "2024-07-01"], 2.0)
    touched = TB.touched_rows(spark.read.parquet(path), new, "month")
    assert touched.count() == 4
    plan = touched._jdf.queryExecution().executedPlan().toString()
    filters = [x for x in plan.splitlines() if "PartitionFilters" in x and "parquet" in x.lower()]
    assert any("dynamicpruning" in x and "202403" in x for x in filters), plan


def test_upsert_of_an_empty_batch_and_into_nothing(spark, path):
    new = _prices(spark, ["2024-03-02"], 2.0)
    assert TB.upsert_partitioned(path, new, ["series", "day"], "month").count() == 2
    files = _files(path)
    assert TB.upsert_partitioned(path, new.where("false"), ["series", "day"], "month").count() == 2
    assert _files(path) == files


def test_runs_are_appended_once_and_retried_alone(spark, path):
    rows = lambda *ids: spark.createDataFrame([(i, f"v{i}") for i in ids], "id long, v string")
    TB.append_new(rows(1, 2), path, "2024-01-01", "id")
    first = _files(path)
    got = TB.append_new(rows(2, 3), path, "2024-01-02 10:00:00", "id")
    assert sorted(r.id for r in got.collect()) == [1, 2, 3]
    assert {n: t for n, t in _files(path).items() if n in first} == first
    # a retry replaces its own rows only, a run without rows is a run
    got = TB.append_new(rows(2, 3, 4), path, "2024-01-02 10:00:00", "id")
    assert sorted(r.id for r in got.collect()) == [1, 2, 3, 4]
    assert TB.append_new(rows(1), path, "2024-01-03", "id").count() == 4
    assert TB.runs(spark, path) == ["2024-01-01", "2024-01-02-10-00-00", "2024-01-03"]
    # an unfinished run does not count
    os.makedirs(f"{path}/run=2024-01-04")
    with open(f"{path}/run=2024-01-04/part-0.parquet", "w") as fh:
        fh.write("broken")
    assert TB.read_runs(spark, path).count() == 4
    assert TB.read_runs(spark, f"{path}-none") is None
