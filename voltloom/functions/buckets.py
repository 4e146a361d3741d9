"""Fixed-bin, data-driven and horizon buckets.

Bins marked "right" are ``(a, b]``, "left" are ``[a, b)``; the two families give
different labels on the edges and are kept apart.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..core.frames import _c, cut_left, cut_right, join_small, null_safe_join
from ..core.quantiles import group_quantiles

INF = float("inf")

# Bin edges and labels.
DAILY_MAX_EDGES = (-999, 65, 75, 85, 90, 95, 100, 105, 999)
DAILY_MAX_LABELS = ("<65", "65-75", "75-85", "85-90", "90-95", "95-100", "100-105", "105+")
BAND_TEMP_EDGES = (-INF, 70.0, 80.0, 88.0, 94.0, 98.0, INF)
TEMP_EDGES = (-999, 45, 55, 65, 75, 80, 85, 90, 95, 100, 999)
CLOUD_EDGES = (-0.001, 0.20, 0.40, 0.60, 0.80, 1.001)
CLOUD_LABELS = ("Clear/Low", "Some Clouds", "Partly Cloudy", "Mostly Cloudy", "Overcast")
SOLAR_PROXY_EDGES = (-0.001, 1, 5, 10, 15, 20, 30, 9999)


def _codes(edges: Sequence[float]) -> list[float]:
    return [float(i) for i in range(len(edges) - 1)]


def temp_bin(temp: Column | str) -> Column:
    return cut_right(temp, TEMP_EDGES, _codes(TEMP_EDGES))


def daily_max_bin(temp: Column | str, scheme: str = "lookup") -> Column:
    """Numeric daily-max bin; ``lookup`` and ``band`` use different edges."""
    edges = {"lookup": DAILY_MAX_EDGES, "band": BAND_TEMP_EDGES}[scheme]
    return cut_right(temp, edges, _codes(edges))


def daily_max_bucket(temp: Column | str) -> Column:
    return cut_right(temp, DAILY_MAX_EDGES, DAILY_MAX_LABELS)


def cloud_bucket(cloud: Column | str) -> Column:
    """Label of a cloud fraction (0..1)."""
    return cut_right(cloud, CLOUD_EDGES, CLOUD_LABELS)


def cloud_bin(cloud: Column | str) -> Column:
    c = _c(cloud)
    bounded = F.when(c > 1, 1.0).when(c < 0, 0.0).otherwise(c)  # greatest/least would turn null into a bound
    return cut_right(bounded, CLOUD_EDGES, _codes(CLOUD_EDGES))


def solar_proxy_bin(mw: Column | str) -> Column:
    return cut_right(F.coalesce(_c(mw), F.lit(0.0)), SOLAR_PROXY_EDGES, _codes(SOLAR_PROXY_EDGES))


# Left-closed daily-max bands, cloud, anchor-state, load-level and capture bins.
PEAK_TEMP_EDGES = (-999, 75, 85, 90, 92.5, 95, 98, 100, 105, 999)
PEAK_TEMP_LABELS = ("<75", "75-85", "85-90", "90-92.5", "92.5-95", "95-98", "98-100", "100-105", "105+")
PEAK_CLOUD_EDGES = (-0.001, 0.10, 0.35, 0.60, 1.001)
PEAK_CLOUD_LABELS = ("Clear/Low", "Some/Partly", "Cloudy", "Overcast")
ANCHOR_EDGES = (-999, -10, 10, 25, 50, 999)
ANCHOR_LABELS = ("<-10", "-10..10", "10..25", "25..50", ">50")
LOAD_LEVEL_EDGES = (-999, 105, 115, 125, 135, 150, 170, 9999)
LOAD_LEVEL_LABELS = ("<=105", "105-115", "115-125", "125-135", "135-150", "150-170", "170+")


def peak_daily_max_band(temp: Column | str) -> Column:
    return cut_left(temp, PEAK_TEMP_EDGES, PEAK_TEMP_LABELS)


def peak_cloud_band(cloud_fraction: Column | str) -> Column:
    return cut_right(cloud_fraction, PEAK_CLOUD_EDGES, PEAK_CLOUD_LABELS)


def anchor_state_band(delta: Column | str) -> Column:
    return cut_right(delta, ANCHOR_EDGES, ANCHOR_LABELS)


def load_level_bucket(mwh: Column | str) -> Column:
    return cut_right(mwh, LOAD_LEVEL_EDGES, LOAD_LEVEL_LABELS)


def weight_temp_bucket(temp: Column | str) -> Column:
    """Left-closed daily-max bucket of the training-weight table; null is 'unknown'."""
    return F.coalesce(cut_left(temp, (-INF, *PEAK_TEMP_EDGES[1:-1], INF), PEAK_TEMP_LABELS), F.lit("unknown"))


def capture_temp_bucket(temp: Column | str) -> Column:
    t = _c(temp)
    return (F.when(t.isNull(), "Unknown").when(t < 95, "90-95").when(t < 100, "95-100")
            .when(t < 105, "100-105").otherwise("105+"))


# The horizon label sets, (highest day, label) from the nearest day up.
HORIZON_SCHEMES = {
    "replay": ((1, "Day1"), (7, "Days2to7"), (16, "Days8to16"), (None, "Days17Plus")),
    "capture": ((1, "Day1"), (7, "Days2to7"), (16, "Days8to16"), (None, "Day17Plus")),
    "diagnostic": ((1, "Day1"), (3, "Days2-3"), (7, "Days4-7"), (16, "Days8-16"), (999, "Day17+")),
    "scenario": ((1, "Day1"), (3, "Days2to3"), (7, "Days4to7"), (16, "Days8to16"), (None, "Informational")),
    "day_state": ((1, "day1"), (3, "days2to3"), (7, "days4to7"), (None, "days8plus")),
}


def horizon_bucket(day: Column | str, scheme: str) -> Column:
    """Label of a forecast day; the five schemes differ in bounds, labels and null handling."""
    d = _c(day)
    steps = HORIZON_SCHEMES[scheme]
    if scheme == "diagnostic":
        return cut_right(d, (0, *[s[0] for s in steps]), [s[1] for s in steps])
    out = F.when(d.isNull(), F.lit({"capture": "Unknown", "scenario": "Informational"}.get(scheme)))
    if scheme == "scenario":
        out = out.when(d < 1, "Informational")
    for hi, label in steps[:-1]:
        out = out.when(d <= hi, label)
    return out.otherwise(steps[-1][1])


def with_cloud_fraction(df: DataFrame, cloud_col: str, out_col: str, keys: Sequence[str] = ()) -> DataFrame:
    """Divide by 100 when the greatest value of the group exceeds 1.5 (a per-group scale test).

    The test is an aggregate joined back on ``keys``; with no keys it is a scalar subquery.
    """
    if keys:
        top = df.groupBy(*keys).agg((F.max(cloud_col) > 1.5).alias("_pct"))
        joined = null_safe_join(df, top, keys)
    else:
        top = df.agg((F.max(cloud_col) > 1.5).alias("_pct"))
        joined = df.withColumn("_pct", top.scalar())
    c = F.col(cloud_col)
    return joined.withColumn(out_col, F.when(F.col("_pct"), c / 100.0).otherwise(c)).drop("_pct")


# Label sets of the quartile buckets, from the lowest positive quarter up.
LOSS_LABELS = ("Low", "Medium", "High", "Extreme")
SOLAR_LABELS = ("Low", "Medium-Low", "Medium-High", "High")


def with_quartile_bucket(df: DataFrame, value_col: str, out_col: str, keys: Sequence[str] = (),
                         labels: Sequence[str] = LOSS_LABELS, min_rows: int = 10, min_distinct: int = 4) -> DataFrame:
    """Quartile bucket of the positive values of each group.

    With fewer than ``min_rows`` positives or ``min_distinct`` distinct ones the
    group is split at its median; values that are not positive give 'None'.
    """
    v = F.coalesce(F.col(value_col), F.lit(0.0))
    stats = group_quantiles(df.where(v > 0), keys, value_col, {"_q1": 0.25, "_q2": 0.5, "_q3": 0.75}, count_as="_n", distinct_as="_nd")
    if keys:
        out = join_small(df, stats, keys)
    else:  # one row: a scalar subquery is computed once per query however often the frame is read
        names = ("_q1", "_q2", "_q3", "_n", "_nd")
        out = df.withColumn("_st", stats.select(F.struct(*names)).scalar()).withColumns({n: F.col(f"_st.{n}") for n in names}).drop("_st")
    fine = (F.col("_n") >= min_rows) & (F.col("_nd") >= min_distinct)
    quart = (F.when(v <= F.col("_q1"), labels[0]).when(v <= F.col("_q2"), labels[1])
             .when(v <= F.col("_q3"), labels[2]).otherwise(labels[3]))
    half = F.when(v <= F.col("_q2"), "Low/Medium").otherwise("High")
    bucket = F.when(~(v > 0), "None").when(fine, quart).otherwise(half)
    return out.withColumn(out_col, bucket).drop("_n", "_nd", "_q1", "_q2", "_q3")
