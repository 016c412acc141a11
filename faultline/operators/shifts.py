"""Work shifts and what happens in them.

A day's shifts start at 06:00, 14:00 and 22:00; the night shift crosses
midnight and belongs to the day on which it began. So an instant's shift
follows from the instant less six hours: its date is the shift's day and its
hour, in steps of eight, the shift.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.functions.timecols import US_PER_HOUR, micros_to_ntz

# --- fixed values ---
SHIFTS = ["morning", "afternoon", "night"]
DAY_START_HOUR = 6
SHIFT_HOURS = 8
# --------------------


def shift_of(u: str = "ts_us") -> tuple[Column, Column]:
    """(day on which the shift began as yyyy-MM-dd, shift) of an instant."""
    moved = F.col(u) - F.lit(DAY_START_HOUR * US_PER_HOUR)
    hour = F.pmod(F.call_function("div", moved - F.pmod(moved, F.lit(US_PER_HOUR)), F.lit(US_PER_HOUR)), F.lit(24))
    name = F.lit(SHIFTS[-1])
    for k, s in reversed(list(enumerate(SHIFTS[:-1]))):
        name = F.when(hour < (k + 1) * SHIFT_HOURS, F.lit(s)).otherwise(name)
    return F.date_format(micros_to_ntz(moved), "yyyy-MM-dd"), F.when(F.col(u).isNotNull(), name)


def alarms_by_shift(df: DataFrame, alarms: list[str], key: str = "TAG", alarm: str = "Alarme", u: str = "ts_us") -> DataFrame:
    """Events per equipment, shift day and shift, one column for each of
    ``alarms`` (0 where none; other alarms have no column). The given list
    spares the pass that would collect the alarm names, and bounds the width."""
    day, shift = shift_of(u)
    # an equipment's whole shift is one row per alarm before the shuffle
    wide = (df.select(key, day.alias("shift_day"), shift.alias("shift"), alarm)
              .groupBy(key, "shift_day", "shift").pivot(alarm, alarms).agg(F.count(F.lit(1))))
    return wide.na.fill(0, alarms)
