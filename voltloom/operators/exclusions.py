"""Drop configured (date, hour range) intervals from an hourly frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hour_bounds(event: dict) -> tuple[int, int]:
    """Inclusive hours of an event; both bounds absent means the whole day, a swapped pair is put in order."""
    lo, hi = event.get("he_start"), event.get("he_end")
    if lo is None and hi is None:
        return 0, 23
    lo, hi = sorted((0 if lo is None else int(lo), 23 if hi is None else int(hi)))
    return max(0, lo), min(23, hi)


def excluded(dt: Column, events: Sequence[dict]) -> Column:
    """True inside any event; an unreadable time is never inside."""
    inside = F.lit(False)
    for e in events:
        lo, hi = hour_bounds(e)
        inside = inside | ((F.to_date(dt) == F.lit(str(e["date"])).cast("date")) & F.hour(dt).between(lo, hi))
    return F.coalesce(inside, F.lit(False))


def drop_excluded(df: DataFrame, events: Sequence[dict], dt_col: str = "DT") -> DataFrame:
    """For an event list known when the job is built."""
    return df.where(~excluded(F.col(dt_col), events)) if events else df


def drop_excluded_table(df: DataFrame, events: DataFrame, dt_col: str = "DT") -> DataFrame:
    """For an event table (date, he_start, he_end): hours are listed out, then an anti join on (date, hour)."""
    both_absent = F.col("he_start").isNull() & F.col("he_end").isNull()
    a, b = F.coalesce("he_start", F.lit(0)), F.coalesce("he_end", F.lit(23))
    lo, hi = F.greatest(F.least(a, b), F.lit(0)), F.least(F.greatest(a, b), F.lit(23))
    hours = F.when(both_absent, F.sequence(F.lit(0), F.lit(23))).otherwise(F.sequence(lo, hi))
    # a range that ends before it starts after clamping covers nothing
    hours = F.filter(hours, lambda h: (h >= 0) & (h <= 23))
    ev = events.select(F.col("date").cast("date").alias("_xd"), F.explode(hours).alias("_xh")).distinct()
    cond = (F.to_date(df[dt_col]) == ev["_xd"]) & (F.hour(df[dt_col]) == ev["_xh"])
    return df.join(ev, cond, "left_anti")
