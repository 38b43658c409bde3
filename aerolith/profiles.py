"""Business-rule variants as frozen constant sets.

The application implements several rules two or three times with different
thresholds and rounding. Each rule is written once in ``aerolith.functions`` and
parameterised by a profile:

* ``A`` - the standalone Spark batch jobs (Silver/Gold),
* ``B`` - the orchestrated DAG (range filter + clamp, 2-digit rounding),
* ``C`` - the JSON row processor (clamping, heat index only).
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Profile:
    name: str
    # heat index: gate also on humidity >= 40?  digits of the polynomial branch
    hi_needs_humidity: bool
    hi_digits: int
    hi_round_else: bool          # C rounds the "else T" branch as well
    wc_digits: int               # wind chill rounding
    stats_digits: int            # city avg/min/max rounding
    anomaly_digits: int          # temperature_anomaly rounding
    score_from_rounded_anomaly: bool
    daytime_start: int           # is_daytime: start <= hour < daytime_end
    daytime_end: int


PROFILE_A = Profile("A", hi_needs_humidity=True, hi_digits=1, hi_round_else=False,
                    wc_digits=1, stats_digits=1, anomaly_digits=1,
                    score_from_rounded_anomaly=False, daytime_start=6, daytime_end=19)
PROFILE_B = Profile("B", hi_needs_humidity=False, hi_digits=2, hi_round_else=False,
                    wc_digits=2, stats_digits=2, anomaly_digits=2,
                    score_from_rounded_anomaly=True, daytime_start=6, daytime_end=20)
PROFILE_C = Profile("C", hi_needs_humidity=True, hi_digits=2, hi_round_else=True,
                    wc_digits=2, stats_digits=2, anomaly_digits=2,
                    score_from_rounded_anomaly=True, daytime_start=6, daytime_end=20)
