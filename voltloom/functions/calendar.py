"""Calendar columns: season, hour group, holidays, time-of-use flags."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..core.frames import _c


def season(month: Column | str, unknown: str = "Unknown") -> Column:
    m = _c(month)
    return (F.when(m.isin(12, 1, 2), "Winter").when(m.isin(3, 4, 5), "Spring")
            .when(m.between(6, 9), "Summer").when(m.isin(10, 11), "Fall").otherwise(unknown))


def hour_group(hour: Column | str) -> Column:
    h = _c(hour)
    return (F.when(h.between(0, 5), "Overnight").when(h.between(6, 9), "Morning").when(h.between(10, 15), "Midday")
            .when(h.between(16, 20), "Peak").otherwise("LateEvening"))


# Week days counted from Monday, as ``F.weekday`` does, and the names ``next_day`` wants.
_DAY_NAMES = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")


def nth_weekday(year: Column, month: int, weekday: int, n: int) -> Column:
    """The n-th given week day of a month (Monday = 0)."""
    before_first = F.date_sub(F.make_date(year, F.lit(month), F.lit(1)), 1)
    return F.date_add(F.next_day(before_first, _DAY_NAMES[weekday]), 7 * (n - 1))


def last_weekday(year: Column, month: int, weekday: int) -> Column:
    """The last given week day of a month."""
    end = F.last_day(F.make_date(year, F.lit(month), F.lit(1)))
    return F.date_sub(F.next_day(end, _DAY_NAMES[weekday]), 7)


def observed_fixed(year: Column, month: int, day: int) -> Column:
    """A fixed-date holiday, moved off Saturday to Friday and off Sunday to Monday."""
    d = F.make_date(year, F.lit(month), F.lit(day))
    wd = F.weekday(d)
    return F.when(wd == 5, F.date_sub(d, 1)).when(wd == 6, F.date_add(d, 1)).otherwise(d)


# The utility's holidays.
FIXED_HOLIDAYS = ((1, 1), (7, 4), (11, 11), (12, 25))
NTH_HOLIDAYS = ((1, 0, 3), (2, 0, 3), (9, 0, 1), (10, 0, 2), (11, 3, 4))  # month, week day, n
LAST_HOLIDAYS = ((5, 0),)  # month, week day


def holidays_of_year(year: Column) -> Column:
    """Array with the ten holiday dates of a year column."""
    return F.array(*[observed_fixed(year, m, d) for m, d in FIXED_HOLIDAYS],
                   *[nth_weekday(year, m, wd, n) for m, wd, n in NTH_HOLIDAYS],
                   *[last_weekday(year, m, wd) for m, wd in LAST_HOLIDAYS])


def holiday_table(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """One row per holiday of a range of years."""
    years = spark.range(first_year, last_year + 1).select(F.col("id").cast("int").alias("Year"))
    return years.select("Year", F.explode(holidays_of_year(F.col("Year"))).alias("Holiday")).distinct()


def is_holiday(date: Column) -> Column:
    """Whether a date is a holiday of its own or a neighbouring year; no join, no year range to know."""
    y = F.year(date)
    near = F.concat(*[holidays_of_year(y + k) for k in (-1, 0, 1)])
    return F.array_contains(near, date)


def add_holiday_flags(df: DataFrame, date_col: str = "Date") -> DataFrame:
    """Holiday, day-before, day-after and any-of flags.

    Flags are computed on the distinct dates (bounded by the calendar) and
    joined back, so the date arithmetic does not run per row.
    """
    days = df.select(F.col(date_col).alias("_d")).distinct()
    flag = is_holiday(F.col("_d"))
    pre, post = is_holiday(F.date_add("_d", 1)), is_holiday(F.date_sub("_d", 1))
    days = days.select("_d", flag.cast("int").alias("IsHoliday"), pre.cast("int").alias("IsPreHoliday"),
                       post.cast("int").alias("IsPostHoliday"), (flag | pre | post).cast("int").alias("IsHolidayAdjacent"))
    return df.join(days, df[date_col].eqNullSafe(days["_d"]), "left").drop("_d")


def _cycle(x: Column, period: float, fn) -> Column:
    return fn(x * F.lit(2.0 * math.pi / period))


def add_time_features(df: DataFrame, dt_col: str = "DT") -> DataFrame:
    """Calendar, cyclic, season and tariff-window columns of an hourly frame."""
    dt = F.col(dt_col)
    out = df.withColumns({
        "Date": F.to_date(dt), "Year": F.year(dt), "Month": F.month(dt), "Day": F.dayofmonth(dt),
        "DayOfYear": F.dayofyear(dt), "WeekOfYear": F.weekofyear(dt), "Hour": F.hour(dt), "DOW": F.weekday(dt),
    })
    out = add_holiday_flags(out)
    h, dow, m = F.col("Hour"), F.col("DOW"), F.col("Month")
    weekend, holiday, business = F.col("IsWeekend") == 1, F.col("IsHoliday") == 1, F.col("IsBusinessDay") == 1
    out = out.withColumns({
        "IsWeekend": (dow >= 5).cast("int"), "IsMonday": (dow == 0).cast("int"), "IsFriday": (dow == 4).cast("int"),
        "Season": season(m), "HourGroup": hour_group(h),
        "IsSummerSeason": m.between(6, 9).cast("int"), "IsWinterSeason": (~m.between(6, 9)).cast("int"),
        **{f"{n}{s}": _cycle(F.col(c), p, fn)
           for n, c, p in (("Hour", "Hour", 24), ("DOW", "DOW", 7), ("Month", "Month", 12), ("DayOfYear", "DayOfYear", 366))
           for s, fn in (("Sin", F.sin), ("Cos", F.cos))},
    })
    out = out.withColumn("IsBusinessDay", (~weekend & ~holiday).cast("int"))
    off = weekend | holiday | (h < 7) | (h >= 22)
    sup = business & h.between(16, 18)
    return out.withColumns({
        "IsOffPeak": off.cast("int"), "IsSuperPeak": sup.cast("int"),
        "IsOnPeak": (business & ~off & ~sup).cast("int"),
        "IsLikelySystemPeakHour": (business & h.between(16, 20)).cast("int"),
    })
