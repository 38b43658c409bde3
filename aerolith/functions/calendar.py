"""Calendar features of a reading timestamp."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aerolith.functions.numeric import col_
from aerolith.profiles import Profile


def hour_floor(ts) -> Column:
    """Start of the hour as TIMESTAMP_NTZ, independent of the session time zone
    (``date_trunc`` returns a zoned timestamp)."""
    t = col_(ts)
    return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.lit(0), F.lit(0))


def season(month) -> Column:
    m = col_(month)
    return (F.when(m.isin(12, 1, 2), F.lit("Winter"))
            .when(m.isin(3, 4, 5), F.lit("Spring"))
            .when(m.isin(6, 7, 8), F.lit("Summer"))
            .otherwise(F.lit("Fall")))


def season_sql(m: str) -> str:
    return (f"CASE WHEN {m} IN (12, 1, 2) THEN 'Winter' WHEN {m} IN (3, 4, 5) THEN 'Spring' "
            f"WHEN {m} IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END")


def daytime(p: Profile, hour) -> Column:
    h = col_(hour)
    return F.when((h >= p.daytime_start) & (h < p.daytime_end), F.lit(1)).otherwise(F.lit(0))


def daytime_sql(p: Profile, h: str) -> str:
    return f"CASE WHEN {h} >= {p.daytime_start} AND {h} < {p.daytime_end} THEN 1 ELSE 0 END"


def time_features_a(ts="timestamp") -> dict[str, Column]:
    """hour, day of week (1 = Sunday), month, quarter, season, daytime 6..18."""
    from aerolith.profiles import PROFILE_A
    t = col_(ts)
    return {"hour_of_day": F.hour(t), "day_of_week": F.dayofweek(t),
            "month_of_year": F.month(t), "quarter": F.quarter(t),
            "season": season(F.month(t)), "is_daytime": daytime(PROFILE_A, F.hour(t))}


def time_features_a_sql(ts="timestamp") -> dict[str, str]:
    from aerolith.profiles import PROFILE_A
    return {"hour_of_day": f"CAST(hour({ts}) AS INTEGER)",
            "day_of_week": f"CAST(dayofweek({ts}) + 1 AS INTEGER)",
            "month_of_year": f"CAST(month({ts}) AS INTEGER)",
            "quarter": f"CAST(quarter({ts}) AS INTEGER)",
            "season": season_sql(f"month({ts})"),
            "is_daytime": daytime_sql(PROFILE_A, f"hour({ts})")}


def time_features_b(ts="timestamp") -> dict[str, Column]:
    """hour, day of week, month, daytime 6 <= h < 20."""
    from aerolith.profiles import PROFILE_B
    t = col_(ts)
    return {"hour_of_day": F.hour(t), "day_of_week": F.dayofweek(t), "month": F.month(t),
            "is_daytime": daytime(PROFILE_B, F.hour(t))}


def time_features_b_sql(ts="timestamp") -> dict[str, str]:
    from aerolith.profiles import PROFILE_B
    return {"hour_of_day": f"CAST(hour({ts}) AS INTEGER)",
            "day_of_week": f"CAST(dayofweek({ts}) + 1 AS INTEGER)",
            "month": f"CAST(month({ts}) AS INTEGER)",
            "is_daytime": daytime_sql(PROFILE_B, f"hour({ts})")}
