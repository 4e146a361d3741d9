"""Recent-residual corrections: profile at an origin, causal simulation, AR and day-state carry-over.

All states are taken per key (series, or origin and series) from rows the
caller has already limited to before the origin.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..core import chunk_window, chunked, epoch_hour, epoch_second, join_small, null_safe_join, own_rows, safe_div
from ..core.scratch import materialise
from ..functions.weather import clip
from .lags import CHUNK_HOURS, with_row_number
from .lookups import weigh_levels

RES = "Residual_MWH"

# Weights of the ten correction sources, in order.
WEIGHTS = {
    "recent_mean": 0.35, "last24_mean": 0.20, "same_hour": 0.16, "hourgroup": 0.06, "global": 0.03, "temp_hourgroup": 0.08,
    "cloud_hourgroup": 0.05, "solar_hourgroup": 0.03, "solar_loss_hourgroup": 0.03, "temp_cloud_hourgroup": 0.01,
}
# Columns that make the category of each grouped source.
CATEGORIES = {
    "same_hour": ("Hour",), "hourgroup": ("HourGroup",), "temp_hourgroup": ("DailyMaxTempBucket", "HourGroup"),
    "cloud_hourgroup": ("CloudCoverBucket", "HourGroup"), "solar_hourgroup": ("BTMSolarBucket", "HourGroup"),
    "solar_loss_hourgroup": ("SolarLossBucket", "HourGroup"), "temp_cloud_hourgroup": ("DailyMaxTempBucket", "CloudCoverBucket", "HourGroup"),
}


def category(cols: Sequence[str]) -> Column:
    """Joined category text; null when any part is null."""
    return F.concat(*[x for i, col in enumerate(cols) for x in ([F.lit("|")] if i else []) + [F.col(col).cast("string")]])


def last_rows(df: DataFrame, keys: Sequence[str], order: str, n: int, chunk_hours: int = CHUNK_HOURS) -> DataFrame:
    """The last n rows of each key by time.

    Rows per hour tell from which hour on a key has n rows, and only rows from then on
    are ordered: each time chunk first gives its own last n, then the few survivors of a
    key are ranked, so no task orders a whole key.
    """
    hour = F.coalesce(epoch_hour(order), F.lit(-(2**62)))  # rows without a time are the earliest
    per = df.groupBy(*keys, hour.alias("_h")).agg(F.count("*").alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy(*keys).orderBy(F.desc("_h")))  # one row per key and hour
    start = per.withColumn("_upto", upto).where(F.col("_upto") - F.col("_n") < n).groupBy(*keys).agg(F.min("_h").alias("_from"))
    c = chunked(join_small(df, start, keys).where(hour >= F.col("_from")).drop("_from"), epoch_hour(order), chunk_hours)
    local = Window.partitionBy(*keys, "_chunk").orderBy(F.desc(order))
    kept = c.withColumn("_r", F.row_number().over(local)).where(F.col("_r") <= n)
    w = Window.partitionBy(*keys).orderBy(F.desc(order))
    return kept.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r", "_chunk", "_ct")


def recent_profile(work: DataFrame, keys: Sequence[str] = ("series",), residual: str = RES, cap: float = 10.0, recent_hours: int = 48,
                   same_hour_days: int = 7, min_bucket_count: int = 6, last24: bool = True) -> DataFrame:
    """Long profile (keys, source, category, value) at the last time of each key; ``last24`` is off where that source has no weight."""
    w = work.where(F.col(residual).isNotNull())
    end = w.groupBy(*keys).agg(F.max(epoch_second("DT")).alias("_end"))
    j = w.join(materialise(end), list(keys)).withColumn("_age", (F.col("_end") - epoch_second("DT")) / 3600.0)
    recent, week = F.col("_age") <= recent_hours, F.col("_age") <= same_hour_days * 24
    parts = [F.struct(F.lit("global").alias("source"), F.lit("all").alias("category")),
             F.when(recent, F.struct(F.lit("recent_mean").alias("source"), F.lit("all").alias("category")))]
    parts += [F.when(week & category(cols).isNotNull(), F.struct(F.lit(n).alias("source"), category(cols).alias("category"))) for n, cols in CATEGORIES.items()]
    long = j.select(*keys, F.col(residual).alias("_r"), F.inline(F.array(*parts))).where("source is not null")  # not by array_compact, which is not compiled
    if last24:
        tail = last_rows(w, keys, "DT", 24).select(*keys, F.col(residual).alias("_r"), F.lit("last24_mean").alias("source"), F.lit("all").alias("category"))
        long = long.unionByName(tail)
    g = long.groupBy(*keys, "source", "category").agg(F.avg("_r").alias("_m"), F.count("*").alias("n"))
    need = F.when(F.col("source").isin("global", "recent_mean", "last24_mean", "same_hour", "hourgroup"), 1).otherwise(min_bucket_count)
    return g.where(F.col("n") >= need).select(*keys, "source", "category", clip("_m", -cap, cap).alias("value"), "n")


def apply_profile(frame: DataFrame, profile: DataFrame, keys: Sequence[str] = ("series",), weights: dict[str, float] | None = None, cap: float = 10.0,
                  blend: float = 0.85, decay_hours: float = 96.0, min_decay: float = 0.25, day1_scale: float = 1.0, lead: str = "Forecast_Lead_Hour",
                  scale: Column | None = None, base: str = "Raw_Forecast_MWH") -> DataFrame:
    """Weighted mean of the sources that exist for a row, blended, decayed with the lead, scaled and capped.

    The sources meet the rows where they lie (``weigh_levels``), so the frame is not shuffled for it.
    """
    wts = {**WEIGHTS, **(weights or {})}
    out = weigh_levels(frame, profile, {n: CATEGORIES.get(n, ()) for n in WEIGHTS if wts[n] > 0}, wts, keys, "value", None, "_raw", "Recent_Correction_Source", "source", "category", missing=None)
    out = out.withColumn("Recent_Correction_Source", F.nullif("Recent_Correction_Source", F.lit("")))
    h = F.greatest(F.coalesce(F.col(lead), F.lit(1)), F.lit(1))
    decay = F.greatest(F.lit(float(min_decay)), F.exp(-(h - 1) / F.lit(max(1.0, decay_hours))))
    decay = decay * F.when(h <= 24, F.lit(float(day1_scale))).otherwise(1.0)
    corr = clip(F.col("_raw") * blend * decay * (scale if scale is not None else F.lit(1.0)), -cap, cap)
    out = out.withColumns({"Recent_Level_Correction_MWH": F.coalesce(corr, F.lit(0.0)), "Recent_Correction_Source": F.coalesce("Recent_Correction_Source", F.lit("no_match"))})
    return out.withColumn("Recent_Corrected_Forecast_MWH", clip(F.col(base) + F.col("Recent_Level_Correction_MWH"), lo=0.0)).drop("_raw")


def regime_scale(season_scales: dict[str, float] | None = None, day_scales: dict[str, float] | None = None, hot: dict | None = None) -> Column:
    """Season factor on hot-peak rows times the horizon factor (and the clear-hot one), the latter bounded to 0..2."""
    hours = F.col("Hour").isin(16, 17, 18, 19, 20) & (F.col("Temperature_DailyMax") >= 90.0)
    peak = F.lit(1.0)
    for s, v in (season_scales or {}).items():
        peak = F.when(hours & (F.col("Season") == s), F.lit(float(v))).otherwise(peak)
    ds, d = day_scales or {}, F.greatest(F.coalesce(F.col("Forecast_Day"), F.lit(1)), F.lit(1))
    horizon = (F.when(d >= 8, float(ds.get("days8plus", 1.0))).when(d >= 4, float(ds.get("days4to7", 1.0)))
               .when(d >= 2, float(ds.get("days2to3", 1.0))).otherwise(1.0))
    if hot:
        clear = d.between(2, 7) & (F.col("Season") == "Summer") & (F.col("Temperature_DailyMax") >= float(hot.get("min_maxtemp_f", 90.0))) & (
            F.col("CloudCover_Norm") <= float(hot.get("max_cloud_cover_norm", 0.20)))
        horizon = F.when(F.coalesce(clear, F.lit(False)), horizon * float(hot.get("scale", 1.0))).otherwise(horizon)
    return F.coalesce(peak, F.lit(1.0)) * clip(horizon, 0.0, 2.0)


def prior_sums(df: DataFrame, keys: Sequence[str], value: str, prefix: str, chunk_hours: int = CHUNK_HOURS) -> DataFrame:
    """Running sum and count of strictly earlier values of a key.

    Chunk totals give the carry of each chunk; only those few totals are windowed by key.
    """
    c = chunked(df, epoch_hour("DT"), chunk_hours)
    tot = c.groupBy(*keys, "_chunk").agg(F.sum(value).alias("_s"), F.count(value).alias("_n"))
    w = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = tot.select(*keys, "_chunk", F.coalesce(F.sum("_s").over(w), F.lit(0.0)).alias("_cs"), F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_cn"))
    inner = Window.partitionBy(*keys, "_chunk").orderBy("DT").rowsBetween(Window.unboundedPreceding, -1)
    j = null_safe_join(c, carry, [*keys, "_chunk"])
    return j.withColumns({f"{prefix}_sum": F.coalesce(F.sum(value).over(inner), F.lit(0.0)) + F.col("_cs"),
                          f"{prefix}_n": F.count(value).over(inner) + F.col("_cn")}).drop("_cs", "_cn", "_chunk", "_ct")


def causal_means(df: DataFrame, keys: Sequence[str] = ("series",), residual: str = RES, recent_rows: int = 48, window_days: int = 7, cap: float = 10.0,
                 categories: dict[str, Sequence[str]] | None = None, chunk_hours: int = CHUNK_HOURS) -> DataFrame:
    """For every row the mean of strictly earlier residuals: last rows, all rows, and per category over a time window.

    Adds one ``src_<name>`` column per source.  A window without any earlier row widens to the whole past.  Rows must be
    unique per (key, time).  Category windows run in long form (one row per
    source), partitioned by (key, source, category, time chunk).
    """
    cats = categories or CATEGORIES
    size, back = chunk_hours, window_days * 24
    base = with_row_number(df.withColumn("_res", F.col(residual)), keys, "DT", chunk_hours)
    # positions count valid residuals only
    ranked = prior_sums(base, keys, "_res", "_all", chunk_hours).withColumn("_pos", F.col("_all_n"))
    pos = chunked(ranked, F.col("_pos"), 24 * 365, back=recent_rows)
    w = Window.partitionBy(*keys, "_chunk").orderBy("_pos")
    pos = own_rows(pos.withColumns({"src_recent_mean": F.avg("_res").over(w.rangeBetween(-recent_rows, -1)), "src_last24_mean": F.avg("_res").over(w.rangeBetween(-24, -1))}), 24 * 365)
    t = chunked(pos, epoch_hour("DT"), size, back=back)
    in_window = F.count("_res").over(chunk_window(keys).rangeBetween(-back, -1))
    core = own_rows(t.withColumn("_wn", in_window), size)

    items = F.array_compact(F.array(*[F.when(category(c).isNotNull(), F.struct(F.lit(n).alias("_src"), category(c).alias("_cat"))) for n, c in cats.items()]))
    long = core.select(*keys, "DT", "_res", "_wn", F.inline(items))
    lk = [*keys, "_src", "_cat"]
    past = prior_sums(long, lk, "_res", "_c", chunk_hours)
    lw = chunked(past, epoch_hour("DT"), size, back=back)
    win = own_rows(lw.withColumn("_win", F.avg("_res").over(chunk_window(lk).rangeBetween(-back, -1))), size)
    value = F.when(F.col("_wn") > 0, F.col("_win")).otherwise(safe_div(F.col("_c_sum"), F.col("_c_n").cast("double")))
    wide = win.withColumn("_v", clip(value, -cap, cap)).groupBy(*keys, "DT").agg(*[F.max(F.when(F.col("_src") == n, F.col("_v"))).alias(f"src_{n}") for n in cats])
    out = core.join(wide, [*keys, "DT"], "left")
    means = {"src_recent_mean": clip("src_recent_mean", -cap, cap), "src_last24_mean": clip("src_last24_mean", -cap, cap),
             "src_global": clip(safe_div(F.col("_all_sum"), F.col("_all_n").cast("double")), -cap, cap)}
    return out.withColumns(means).drop("_res", "_rn", "_pos", "_wn", "_all_sum", "_all_n")


def causal_correction(means: DataFrame, weights: dict[str, float] | None = None, blend: float = 0.85, cap: float = 10.0, scale: Column | None = None) -> DataFrame:
    """Weighted mean of the causal means present on a row, blended, scaled and capped."""
    wts = {n: w for n, w in {**WEIGHTS, **(weights or {})}.items() if w > 0 and f"src_{n}" in means.columns}
    num = sum((F.coalesce(F.col(f"src_{n}") * w, F.lit(0.0)) for n, w in wts.items()), F.lit(0.0))
    den = sum((F.when(F.col(f"src_{n}").isNotNull(), w).otherwise(0.0) for n, w in wts.items()), F.lit(0.0))
    names = F.array_join(F.array_compact(F.array(*[F.when(F.col(f"src_{n}").isNotNull(), F.lit(n)) for n in WEIGHTS if n in wts])), "+")
    corr = clip(safe_div(num, den) * blend * (scale if scale is not None else F.lit(1.0)), -cap, cap)
    return means.withColumns({"Recent_Level_Correction_MWH": F.coalesce(corr, F.lit(0.0)), "Recent_Correction_Source": F.when(names == "", "insufficient_prior_residuals").otherwise(names)})


def ar_state(work: DataFrame, keys: Sequence[str] = ("series",), residual: str = RES, lookback_hours: int = 168, max_gap_hours: float = 1.5,
             min_pairs: int = 24, shrink_k: float = 72.0, phi_cap: float = 0.40, allow_negative: bool = False) -> DataFrame:
    """AR(1) carry-over: phi from neighbouring residuals of the look-back, shrunk and capped, and the latest residual.

    The look-back bounds the rows of a key, so the lag window stays small.
    """
    w = work.where(F.col(residual).isNotNull())
    end = w.groupBy(*keys).agg(F.max(epoch_second("DT")).alias("_end"), F.max_by(residual, "DT").alias("latest_residual"))
    rec = w.join(end, list(keys)).where(epoch_second("DT") >= F.col("_end") - lookback_hours * 3600)
    o = Window.partitionBy(*keys).orderBy("DT")
    pairs = rec.select(*keys, "latest_residual", F.col(residual).alias("_x"), F.lag(residual).over(o).alias("_p"), ((epoch_second("DT") - F.lag(epoch_second("DT")).over(o)) / 3600.0).alias("_gap"))
    ok = F.col("_p").isNotNull() & (F.col("_gap") > 0) & (F.col("_gap") <= max_gap_hours)
    g = pairs.groupBy(*keys, "latest_residual").agg(F.count(F.when(ok, 1)).alias("n_pairs"), F.sum(F.when(ok, F.col("_p") * F.col("_x"))).alias("_xy"), F.sum(F.when(ok, F.col("_p") * F.col("_p"))).alias("_xx"))
    raw = F.when((F.col("n_pairs") >= min_pairs) & (F.col("_xx") > 1e-9), F.col("_xy") / F.col("_xx")).otherwise(0.0)
    if not allow_negative:
        raw = F.greatest(raw, F.lit(0.0))
    shrink = F.when(F.col("n_pairs") > 0, F.col("n_pairs") / (F.col("n_pairs") + F.lit(float(shrink_k)))).otherwise(0.0)
    return g.select(*keys, "n_pairs", raw.alias("phi_raw"), shrink.alias("phi_shrink"), clip(raw * shrink, -phi_cap, phi_cap).alias("phi"), "latest_residual")


# Lead factors of the two carry-overs.
AR_DAY_SCALE = {"day1": 1.0, "days2to3": 0.45, "days4to7": 0.15, "days8plus": 0.0}
STATE_DAY_SCALE = {"day1": 0.35, "days2to3": 0.45, "days4to7": 0.25, "days8plus": 0.08}


def day_scale(scales: dict[str, float], day: str = "Forecast_Day") -> Column:
    d = F.col(day)
    return (F.when(d <= 1, float(scales["day1"])).when(d <= 3, float(scales["days2to3"])).when(d <= 7, float(scales["days4to7"]))
            .otherwise(float(scales["days8plus"])))


def ar_correction(same_hour_blend: float = 0.0, blend: float = 0.35, decay_hours: float = 36.0, min_decay: float = 0.0, cap: float = 2.0,
                  lead: str = "Forecast_Lead_Hour", scales: dict[str, float] | None = None) -> Column:
    """Correction of a row from ``phi``, ``latest_residual`` and, when blended, ``same_hour_mean``."""
    raw = F.col("phi") * F.col("latest_residual")
    live = (F.abs("phi") > 1e-12) & (F.abs("latest_residual") > 1e-12)
    if same_hour_blend > 0:
        raw = F.when(F.col("same_hour_mean").isNotNull(), (1 - same_hour_blend) * raw + same_hour_blend * F.col("same_hour_mean")).otherwise(raw)
    h = F.greatest(F.col(lead), F.lit(1))
    decay = F.greatest(F.lit(float(min_decay)), F.exp(-(h - 1) / F.lit(max(1.0, decay_hours))))
    return F.coalesce(F.when(live, clip(raw * blend * decay * day_scale({**AR_DAY_SCALE, **(scales or {})}), -cap, cap)), F.lit(0.0))


def same_sign_run(work: DataFrame, target: DataFrame, keys: Sequence[str] = ("series",), residual: str = RES, threshold: float = 0.25, value: str = "state_raw") -> DataFrame:
    """Hours at the end of each key whose residual keeps the sign of ``value`` and reaches the threshold.

    The last breaking time is an aggregate; the run is the count of rows after it.
    """
    j = work.where(F.col(residual).isNotNull()).join(target.select(*keys, value), list(keys))
    stop = (F.abs(residual) < threshold) | (F.signum(residual) != F.signum(value))
    last = j.groupBy(*keys).agg(F.max(F.when(stop, F.col("DT"))).alias("_stop"))
    k = j.join(last, list(keys))
    n = k.groupBy(*keys).agg(F.count(F.when(F.col("_stop").isNull() | (F.col("DT") > F.col("_stop")), 1)).alias("_n"), F.max(F.abs(value)).alias("_a"))
    return n.select(*keys, F.when(F.col("_a") <= 1e-12, 0).otherwise(F.col("_n")).alias("same_sign_run_hours"))


def day_state(work: DataFrame, keys: Sequence[str] = ("series",), residual: str = RES, lookback_days: int = 7, min_day_hours: int = 12, min_days: int = 2,
              min_total_hours: int = 36, latest_weight: float = 0.65, same_sign: bool = True, shrink_days: float = 6.0, shrink_hours: float = 96.0, state_cap: float = 4.0) -> DataFrame:
    """Day-level residual state of each key: latest and weighted mean of eligible days, blended, shrunk and capped."""
    w = work.where(F.col(residual).isNotNull())
    end = w.groupBy(*keys).agg(F.max(epoch_second("DT")).alias("_end"))
    rec = w.join(end, list(keys)).where(epoch_second("DT") >= F.col("_end") - lookback_days * 86400)
    days = rec.groupBy(*keys, F.to_date("DT").alias("_d")).agg(F.avg(residual).alias("_m"), F.count("*").alias("_n"))
    any_ok = F.bool_or(F.col("_n") >= min_day_hours).over(Window.partitionBy(*keys))  # at most lookback_days + 1 rows a key
    days = days.withColumn("_any", any_ok).where((F.col("_n") >= min_day_hours) | ~F.col("_any"))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("_d")))
    days = days.withColumn("_r", rank).where(F.col("_r") <= lookback_days)
    g = days.groupBy(*keys).agg(F.count("*").alias("n_days"), F.sum("_n").alias("n_hours"), F.max_by("_m", "_d").alias("latest_day_mean"),
                                (F.sum(F.col("_m") * F.sqrt("_n")) / F.sum(F.sqrt("_n"))).alias("recent_day_mean"))
    g = g.where((F.col("n_days") >= min_days) & (F.col("n_hours") >= min_total_hours))
    raw = F.lit(latest_weight) * F.col("latest_day_mean") + F.lit(1.0 - latest_weight) * F.col("recent_day_mean")
    if same_sign:
        raw = F.when(F.col("latest_day_mean") * F.col("recent_day_mean") < 0, 0.0).otherwise(raw)
    shrink = F.col("n_days") / (F.col("n_days") + shrink_days) * (F.col("n_hours") / (F.col("n_hours") + shrink_hours))
    g = g.withColumn("state_raw", raw)
    return g.withColumns({"state_shrink": shrink, "state_mwh": clip(F.col("state_raw") * shrink, -state_cap, state_cap)})


def day_state_correction(hourgroup_blend: float = 0.15, same_hour_blend: float = 0.10, min_run: int = 4, short_run_scale: float = 0.5, decay_days: float = 5.0,
                         blend: float = 0.45, cap: float = 2.0, min_abs_state: float = 0.50, scales: dict[str, float] | None = None) -> Column:
    """Correction of a row from ``state_mwh``, ``hourgroup_mean``, ``same_hour_mean`` and ``same_sign_run_hours``."""
    def mix(base: Column, other: Column, share: float) -> Column:
        fits = other.isNotNull() & ~((F.abs(base) > 1e-12) & (F.abs(other) > 1e-12) & (F.signum(base) != F.signum(other)))
        return F.when(fits, (1 - share) * base + share * other).otherwise(base) if share > 0 else base

    raw = mix(mix(F.col("state_mwh"), F.col("hourgroup_mean"), hourgroup_blend), F.col("same_hour_mean"), same_hour_blend)
    run = F.when(F.col("same_sign_run_hours") < min_run, short_run_scale).otherwise(1.0)
    decay = F.exp(-(F.col("Forecast_Day") - 1) / F.lit(max(1.0, decay_days)))
    corr = clip(raw * blend * decay * day_scale({**STATE_DAY_SCALE, **(scales or {})}) * run, -cap, cap)
    return F.coalesce(F.when(F.abs("state_mwh") >= min_abs_state, corr), F.lit(0.0))


def add_in_order(base: Column, ar: Column, day: Column, cap: float = 10.0) -> Column:
    """Recent, AR and day-state corrections added in that order, the sum capped after each step."""
    return clip(clip(base + ar, -cap, cap) + day, -cap, cap)


__all__ = [n for n in globals() if not n.startswith("_")]
