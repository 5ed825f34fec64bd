"""Time-of-day and calendar expressions over seconds-since-midnight and day names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from wattspan.functions.columns import map_lookup

# Day names in number order.
DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
DAY_NUMBERS = {name: i for i, name in enumerate(DAY_NAMES)}
WEEKEND_NAMES = ["Saturday", "Sunday"]

SECONDS_PER = {"minute": 60, "hour": 3600, "day": 86400}


def hour_of(nsm: Column, clamp: bool = True) -> Column:
    """Hour of seconds since midnight. With ``clamp`` 86400 belongs to hour 23."""
    hour = F.floor(nsm / 3600).cast("int")
    return F.when(nsm >= 86400, F.lit(23)).otherwise(hour) if clamp else hour


def minute_of(nsm: Column) -> Column:
    return F.floor((nsm % 3600) / 60).cast("int")


def day_number(name: Column) -> Column:
    return map_lookup(DAY_NUMBERS, name)


def day_name(number: Column) -> Column:
    return map_lookup({i: n for i, n in enumerate(DAY_NAMES)}, number)


def weekend_flag(number: Column) -> Column:
    return number >= 5


def weekend_flag_of_name(name: Column) -> Column:
    return name.isin(*WEEKEND_NAMES).cast("int")


def week_status(number: Column) -> Column:
    return F.when(number < 5, "Weekday").when(number >= 5, "Weekend")


def cyclical(c: Column, period: float) -> tuple[Column, Column]:
    if period <= 0:
        raise ValueError(f"period must be positive, got {period}")
    angle = F.lit(2.0) * F.pi() * c / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def seconds_since_midnight(ts: Column) -> Column:
    return (F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)).cast("bigint")


def day_name_of(ts: Column) -> Column:
    return day_name(F.weekday(ts))


def is_night(hour: Column) -> Column:
    return ((hour >= 22) | (hour <= 6)).cast("int")


def is_peak(hour: Column, first: int = 9, last: int = 18) -> Column:
    return hour.between(first, last).cast("int")


def part_of_day(hour: Column) -> Column:
    """Bins [0,6], (6,12], (12,18], (18,24]."""
    return (
        F.when(hour.between(0, 6), "night")
        .when(hour <= 12, "morning")
        .when(hour <= 18, "afternoon")
        .when(hour <= 24, "evening")
    )
