"""Rounding rules shared by the Spark plans and their DuckDB oracles.

Two kinds of rounding are needed:

* Means of values stored at 4 decimals (scores, daily means) are exact
  rationals S / n.  They are rounded half away from zero in integer
  arithmetic on the values scaled by 10^4, so no binary fraction ever
  decides a tie: ``sign(S) * ((2|S| + n) div (2n))``.
* Window statistics over prices (means, stddev, returns) are doubles.  They
  are rounded with ``sign(x) * floor(|x| * 10^d + 0.5) / 10^d``, written with
  the same IEEE operations in both engines so the result is bit-identical.

Each helper has a Spark form (Column) and a SQL-text form (for oracles).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE4 = 10_000


def rnd(col: Column | str, digits: int) -> Column:
    """Half-away-from-zero rounding of a double to ``digits`` places."""
    c = F.col(col) if isinstance(col, str) else col
    p = float(10 ** digits)
    return (F.signum(c) * F.floor(F.abs(c) * F.lit(p) + F.lit(0.5)).cast("double")
            / F.lit(p))


def rnd_sql(expr: str, digits: int) -> str:
    p = f"CAST({10 ** digits} AS DOUBLE)"
    return (f"(sign({expr}) * CAST(floor(abs({expr}) * {p} + CAST(0.5 AS DOUBLE)) AS DOUBLE)"
            f" / {p})")


def ratio_half_up(num: str, den: str, scale: int = SCALE4) -> Column:
    """round(num / den) half away from zero, for integer ``num`` and ``den`` > 0,
    returned as a double divided by ``scale`` (num is already scaled).

    ``num``/``den`` are SQL expressions over columns of the frame; integer
    ``div`` has no Column operator in PySpark, hence the expression text.
    """
    return F.expr(
        f"CAST(signum({num}) * ((2 * abs({num}) + ({den})) div (2 * ({den}))) AS DOUBLE)"
        f" / {float(scale)}")


def ratio_half_up_sql(num: str, den: str, scale: int = SCALE4) -> str:
    return (f"(CAST(sign({num}) * ((2 * abs({num}) + ({den})) // (2 * ({den}))) AS DOUBLE)"
            f" / CAST({scale} AS DOUBLE))")


def to_e4(col: Column | str) -> Column:
    """A 4-decimal value held as a long count of 10^-4 units."""
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c * F.lit(float(SCALE4))).cast("long")


def to_e4_sql(expr: str) -> str:
    return f"CAST(round(({expr}) * CAST({SCALE4} AS DOUBLE)) AS BIGINT)"
