"""Weather formulas and rule expressions, one definition per rule, profile-driven.

Each builder returns a Spark ``Column``; the ``*_sql`` twin renders the same rule
as ANSI SQL text for the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aerolith.constants import HEAT_INDEX_COEFFS, WIND_CHILL_COEFFS
from aerolith.functions.numeric import col_
from aerolith.profiles import Profile

T = "temperature_fahrenheit"
H = "humidity_percent"
W = "wind_speed_mph"


def _rothfusz(t: Column, h: Column) -> Column:
    c = HEAT_INDEX_COEFFS
    return (F.lit(c[0]) + c[1] * t + c[2] * h + c[3] * t * h + c[4] * t * t
            + c[5] * h * h + c[6] * t * t * h + c[7] * t * h * h + c[8] * t * t * h * h)


def dlit(x: float) -> str:
    """A DOUBLE literal for SQL text (bare decimals are DECIMAL in Spark SQL)."""
    r = repr(float(x))
    return f"({r if 'e' in r else r + 'e0'})"


def _rothfusz_sql(t: str, h: str) -> str:
    c = [dlit(x) for x in HEAT_INDEX_COEFFS]
    return (f"({c[0]} + {c[1]}*{t} + {c[2]}*{h} + {c[3]}*{t}*{h} + {c[4]}*{t}*{t} "
            f"+ {c[5]}*{h}*{h} + {c[6]}*{t}*{t}*{h} + {c[7]}*{t}*{h}*{h} + {c[8]}*{t}*{t}*{h}*{h})")


def heat_index(p: Profile, t=T, h=H) -> Column:
    t, h = col_(t), col_(h)
    gate = (t >= 80) & (h >= 40) if p.hi_needs_humidity else (t >= 80)
    other = F.round(t, 2) if p.hi_round_else else t
    return F.when(gate, F.round(_rothfusz(t, h), p.hi_digits)).otherwise(other)


def heat_index_sql(p: Profile, t=T, h=H) -> str:
    gate = f"{t} >= 80 AND {h} >= 40" if p.hi_needs_humidity else f"{t} >= 80"
    other = f"round({t}, 2)" if p.hi_round_else else t
    return f"CASE WHEN {gate} THEN round({_rothfusz_sql(t, h)}, {p.hi_digits}) ELSE {other} END"


def wind_chill(p: Profile, t=T, w=W) -> Column:
    a, b, c, d, e = WIND_CHILL_COEFFS
    t, w = col_(t), col_(w)
    we = F.pow(w, F.lit(e))
    return F.when((t <= 50) & (w > 3),
                  F.round(F.lit(a) + b * t - c * we + d * t * we, p.wc_digits)).otherwise(t)


def wind_chill_sql(p: Profile, t=T, w=W) -> str:
    a, b, c, d, e = (dlit(x) for x in WIND_CHILL_COEFFS)
    we = f"pow({w}, {e})"
    return (f"CASE WHEN {t} <= 50 AND {w} > 3 THEN round({a} + {b}*{t} - {c}*{we} "
            f"+ {d}*{t}*{we}, {p.wc_digits}) ELSE {t} END")


def flag(cond: Column) -> Column:
    """Boolean rule -> 0/1 int; unknown (null) counts as 0, like ``when(..).otherwise(0)``."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def flag_sql(cond: str) -> str:
    return f"CASE WHEN {cond} THEN 1 ELSE 0 END"


# --- extreme-weather flags -------------------------------------------------

def extreme_flags_a() -> dict[str, Column]:
    """Gold A: heatwave HI>=105, cold WC<=0, wind>=40, precip>=7.6; extreme = any."""
    hw = flag(F.col("heat_index") >= 105)
    ec = flag(F.col("wind_chill") <= 0)
    hwind = flag(F.col(W) >= 40)
    hp = flag(F.col("precipitation_mm") >= 7.6)
    return {"is_heatwave": hw, "is_extreme_cold": ec, "is_high_wind": hwind,
            "is_heavy_precipitation": hp,
            "is_extreme_weather": flag((hw == 1) | (ec == 1) | (hwind == 1) | (hp == 1))}


def extreme_flags_a_sql() -> dict[str, str]:
    hw, ec = "heat_index >= 105", "wind_chill <= 0"
    hwind, hp = f"{W} >= 40", "precipitation_mm >= 7.6"
    return {"is_heatwave": flag_sql(hw), "is_extreme_cold": flag_sql(ec),
            "is_high_wind": flag_sql(hwind), "is_heavy_precipitation": flag_sql(hp),
            "is_extreme_weather": flag_sql(f"({hw}) OR ({ec}) OR ({hwind}) OR ({hp})")}


def extreme_flags_b(has_precip: bool = True) -> dict[str, Column]:
    """Gold B: T>100, T<10, wind>50, precip>10; extreme = T>100|T<10|wind>50|score>2.5."""
    t = F.col(T)
    return {
        "is_extreme_weather": flag((t > 100) | (t < 10) | (F.col(W) > 50)
                                   | (F.col("temp_anomaly_score") > 2.5)),
        "is_heatwave": flag(t > 100),
        "is_extreme_cold": flag(t < 10),
        "is_high_wind": flag(F.col(W) > 50),
        "is_heavy_precipitation": flag(F.col("precipitation_mm") > 10) if has_precip else F.lit(0),
    }


def extreme_flags_b_sql() -> dict[str, str]:
    return {
        "is_extreme_weather": flag_sql(f"{T} > 100 OR {T} < 10 OR {W} > 50 OR temp_anomaly_score > 2.5"),
        "is_heatwave": flag_sql(f"{T} > 100"),
        "is_extreme_cold": flag_sql(f"{T} < 10"),
        "is_high_wind": flag_sql(f"{W} > 50"),
        "is_heavy_precipitation": flag_sql("precipitation_mm > 10"),
    }


def extreme_event_c(t="temperature", w="wind_speed") -> Column:
    return flag((col_(t) > 95) | (col_(w) > 50))


def extreme_event_c_sql(t="temperature", w="wind_speed") -> str:
    return flag_sql(f"{t} > 95 OR {w} > 50")


# --- serving rules ---------------------------------------------------------

def risk_level(score="temp_anomaly_score", t=T) -> Column:
    s, t = col_(score), col_(t)
    return (F.when((s > 2.5) | (t > 100) | (t < 10), F.lit("HIGH"))
            .when((s > 1.5) | (t > 90) | (t < 20), F.lit("MODERATE"))
            .otherwise(F.lit("LOW")))


def risk_level_sql(score="temp_anomaly_score", t=T) -> str:
    return (f"CASE WHEN {score} > 2.5 OR {t} > 100 OR {t} < 10 THEN 'HIGH' "
            f"WHEN {score} > 1.5 OR {t} > 90 OR {t} < 20 THEN 'MODERATE' ELSE 'LOW' END")


def extreme_reasons(t=T, w=W, score="temp_anomaly_score") -> Column:
    """Reason strings for an extreme reading, in rule order, joined by '; '."""
    t, w, s = col_(t), col_(w), col_(score)
    parts = F.array(
        F.when(t > 100, F.format_string("High temperature (%s°F > 100°F)", F.round(t, 1).cast("string"))),
        F.when(t < 10, F.format_string("Low temperature (%s°F < 10°F)", F.round(t, 1).cast("string"))),
        F.when(w > 50, F.format_string("High wind (%s mph > 50 mph)", F.round(w, 1).cast("string"))),
        F.when(s > 2.5, F.format_string("High anomaly score (%s > 2.5)", F.round(s, 2).cast("string"))),
    )
    return F.concat_ws("; ", F.filter(parts, lambda x: x.isNotNull()))


def extreme_reasons_sql(t=T, w=W, score="temp_anomaly_score") -> str:
    return ("concat_ws('; ', "
            f"CASE WHEN {t} > 100 THEN 'High temperature (' || CAST(round({t}, 1) AS VARCHAR) || '°F > 100°F)' END, "
            f"CASE WHEN {t} < 10 THEN 'Low temperature (' || CAST(round({t}, 1) AS VARCHAR) || '°F < 10°F)' END, "
            f"CASE WHEN {w} > 50 THEN 'High wind (' || CAST(round({w}, 1) AS VARCHAR) || ' mph > 50 mph)' END, "
            f"CASE WHEN {score} > 2.5 THEN 'High anomaly score (' || CAST(round({score}, 2) AS VARCHAR) || ' > 2.5)' END)")
