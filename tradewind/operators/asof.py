"""Forward as-of mapping (D5): each probe date goes to the first key date on
or after it, per series; probes after a series' last key date drop out.

Spark has no as-of join.  Instead of crossing probe dates with every series
(a cross product) or a range join, each key row is expanded into the
calendar days it covers, ``(previous key date, key date]``, and the probes
are equi-joined on the calendar day.  The expansion is linear in the
calendar span of each series, and the join is a plain hash join on a date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def covering_days(keys: DataFrame, probe_dates: Column, series: str = "benchmark_code",
                  key_date: str = "price_date") -> DataFrame:
    """(series, cal_date, mapped_date): every calendar day mapped to its key date.

    ``probe_dates`` is the array of distinct probe dates.  A series' first key
    takes the probe dates before it from there instead of every day back to the
    earliest one, so one stray early date adds one row per series.
    """
    w = Window.partitionBy(series).orderBy(key_date)
    with_prev = keys.select(series, key_date, F.lag(key_date, 1).over(w).alias("_prev"))
    with_prev = with_prev.withColumn("_dates", probe_dates)
    first = F.col("_prev").isNull()
    start = F.when(first, F.col(key_date)).otherwise(F.date_add("_prev", 1))
    early = F.when(first, F.filter("_dates", lambda d: d < F.col(key_date))).otherwise(
        F.array().cast("array<date>"))
    return with_prev.select(
        F.col(series),
        F.explode(F.concat(early, F.sequence(start, F.col(key_date)))).alias("cal_date"),
        F.col(key_date).alias("mapped_date"))


def forward_asof(keys: DataFrame, probes: DataFrame, series: str = "benchmark_code",
                 key_date: str = "price_date", probe_date: str = "feature_date") -> DataFrame:
    """Probes (keyed by date only) with ``series`` and ``mapped_date`` attached.

    ``probes`` has no series column: it applies to every series, as news does
    to every benchmark.  Probes after a series' last key date get no row.
    """
    # distinct dates: bounded by the calendar
    dates = probes.select(F.collect_set(probe_date)).scalar()
    days = covering_days(keys.select(series, key_date), dates, series, key_date)
    return probes.join(days, probes[probe_date] == days["cal_date"]).drop("cal_date")
