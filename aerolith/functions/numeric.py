"""Numeric helpers shared by operators."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exact_avg_round(c, d: int) -> Column:
    """The mean rounded to ``d`` digits, half away from zero, exactly.

    The double mean ``sum / count`` is rounded first; near a tie it can be one
    unit off (the mean 61.85 is the double 61.849999999999994). The exact DECIMAL
    sum is then compared with ``count * (r -/+ half a unit)`` in decimal, which
    moves ``r`` to the correctly rounded value. Values hold six digits after and fourteen before the point. Every part is a mergeable
    aggregate, so the result does not depend on summation order or engine.
    """
    x = col_(c)
    return exact_ratio_round(F.sum(x.cast("decimal(20,6)")), F.count(x), d)


def exact_ratio_round(s: Column, count: Column, d: int) -> Column:
    """``s / count`` rounded as in :func:`exact_avg_round`, from a DECIMAL sum with six digits and a count that are there already."""
    n = count.cast("decimal(20,0)")
    r = F.round(s.cast("double") / count, d).cast(f"decimal(18,{d})")
    u = F.lit(str(Decimal(1).scaleb(-d))).cast(f"decimal(18,{d})")
    h = F.lit(str(Decimal(5).scaleb(-(d + 1)))).cast(f"decimal(18,{d + 1})")
    lo, hi = n * (r - h), n * (r + h)
    pos = F.when(s < lo, r - u).when(s >= hi, r + u).otherwise(r)
    neg = F.when(s <= lo, r - u).when(s > hi, r + u).otherwise(r)
    return F.when(s >= 0, pos).otherwise(neg).cast("double")


def exact_avg_round_sql(x: str, d: int) -> str:
    s = f"sum(CAST({x} AS DECIMAL(20,6)))"
    n = f"CAST(count({x}) AS DECIMAL(20,0))"
    r = f"CAST(round(CAST({s} AS DOUBLE) / count({x}), {d}) AS DECIMAL(18,{d}))"
    u = f"CAST('{Decimal(1).scaleb(-d)}' AS DECIMAL(18,{d}))"
    h = f"CAST('{Decimal(5).scaleb(-(d + 1))}' AS DECIMAL(18,{d + 1}))"
    lo, hi = f"({n} * ({r} - {h}))", f"({n} * ({r} + {h}))"
    return (f"CAST(CASE WHEN {s} >= 0 THEN (CASE WHEN {s} < {lo} THEN {r} - {u} WHEN {s} >= {hi} THEN {r} + {u} "
            f"ELSE {r} END) ELSE (CASE WHEN {s} <= {lo} THEN {r} - {u} WHEN {s} > {hi} THEN {r} + {u} "
            f"ELSE {r} END) END AS DOUBLE)")


def safe_double(c) -> Column:
    """Unparseable or NaN -> null (pandas ``safe_float``)."""
    v = F.expr(f"try_cast({c} AS double)") if isinstance(c, str) else c.try_cast("double")
    return F.when(F.isnan(v), F.lit(None).cast("double")).otherwise(v)


def safe_int(c) -> Column:
    """Unparseable or NaN -> null; fractional values truncate toward zero."""
    return safe_double(c).try_cast("int")
