"""Local clocks, text timestamps, codes and token lists."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..core.frames import _c

OFFSET_TEXT = r"(?:[+-]\d{2}:?\d{2}|Z)$"  # a trailing UTC offset


def wall_clock(text: Column | str) -> Column:
    """Keep the written local time: the offset text is dropped, not applied."""
    return F.try_to_timestamp(F.regexp_replace(F.trim(_c(text)), OFFSET_TEXT, ""))


def zone_clock(text: Column | str, tz: str) -> Column:
    """Apply the written offset, then read the clock of ``tz`` (needs a UTC session)."""
    return F.from_utc_timestamp(_c(text).try_cast("timestamp"), tz)


def localize(local: Column | str, tz: str) -> Column:
    """Local wall-clock time to an instant; null where the clock skips or repeats the time."""
    l = _c(local)
    u = F.to_utc_timestamp(l, tz)
    hour = F.expr("INTERVAL 1 HOUR")
    skipped = F.from_utc_timestamp(u, tz) != l
    repeated = (F.from_utc_timestamp(u + hour, tz) == l) | (F.from_utc_timestamp(u - hour, tz) == l)
    return F.when(~skipped & ~repeated, u)


def utc_offset_hours(instant: Column | str, tz: str) -> Column:
    i = _c(instant)
    return (F.unix_seconds(F.from_utc_timestamp(i, tz)) - F.unix_seconds(i)) / 3600.0


def hour_ending(start: Column | str) -> Column:
    """1..24 from an interval's start."""
    return F.hour(_c(start)) + 1


def to_number(text: Column | str) -> Column:
    """Number of a text; bad text and NaN are null."""
    x = _c(text).try_cast("double")
    return F.when(~F.isnan(x), x)


def column_slug(name: str) -> str:
    """Plan-time column name: lower case, runs of other signs to one underscore."""
    return re.sub(r"[^0-9a-z]+", "_", name.lower()).strip("_")


def slug(text: Column | str) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(_c(text)), "[^0-9a-z]+", "_"), "^_+|_+$", "")


def token_list(*pairs: tuple[Column, str], sep: str = "+", empty: str = "none") -> Column:
    """Names of the true conditions, in order, joined; ``empty`` when none holds."""
    names = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for cond, name in pairs]))
    return F.when(F.size(names) > 0, F.array_join(names, sep)).otherwise(F.lit(empty))


def tokens(text: Column | str, sep: str = "+") -> Column:
    """Array of the non-empty tokens of a joined list; 'none' is empty."""
    parts = F.split(_c(text), re.escape(sep))
    return F.filter(parts, lambda t: (t != "") & (t != "none"))
