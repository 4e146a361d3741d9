"""Peak corrections: risk uplift, live ramp, heat anchor, peak capture, streak and magnitude lifts.

Lifts are one-sided and capped.  Day-level work groups by (keys, day), at most
24 rows; origin-level states are aggregates joined back on the keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..core import epoch_second, join_small, null_safe_join
from ..functions.buckets import capture_temp_bucket, horizon_bucket
from ..functions.clock import token_list
from ..functions.weather import clip
from .bands import first_match
from .lookups import Level, level_rows
from .metrics import ACTUAL

c = F.col
PEAK_HOURS = (16, 17, 18, 19, 20)


def yes(x: Column) -> Column:
    return F.coalesce(x, F.lit(False))


def hot_scope(min_temp: float = 90.0, hours: Sequence[int] = PEAK_HOURS, max_temp: float | None = None) -> Column:
    t = c("Temperature_DailyMax")
    ok = c("Hour").isin(*hours) & (t >= min_temp)
    return yes(ok if max_temp is None else ok & (t <= max_temp))


def peak_risk(df: DataFrame, base: str, gaps: Mapping[str, tuple[str, float, float]], hours: Sequence[int] = (14, 15, 16, 17, 18), min_temp: float = 85.0,
              blend: float = 0.5, cap: float = 6.0, min_recent: float = 0.0, extreme: Mapping | None = None) -> DataFrame:
    """Greatest benchmark gap over its threshold, weighted, blended and capped on warm peak hours.

    ``gaps``: source name to (forecast column, threshold, strength).
    """
    ok = hot_scope(min_temp, hours)
    if min_recent > 0 and "Recent_Level_Correction_MWH" in df.columns:
        ok = ok & (F.coalesce(c("Recent_Level_Correction_MWH"), F.lit(0.0)) >= min_recent)
    over = {n: clip(F.coalesce(c(col) - c(base), F.lit(0.0)) - thr, lo=0.0) for n, (col, thr, _) in gaps.items()}
    signal = F.greatest(F.lit(0.0), *[v * gaps[n][2] for n, v in over.items()]) if over else F.lit(0.0)
    limit = F.lit(float(cap))
    if extreme:
        far = ok & c("Hour").isin(*extreme["hours"]) & yes(c("Temperature_DailyMax") >= extreme["min_temp"]) & yes(c("Forecast_Day").between(extreme["min_day"], extreme["max_day"]))
        limit = F.when(far, F.greatest(limit, F.lit(float(extreme["cap"])))).otherwise(limit)
    corr = F.when(ok, F.least(signal * blend, limit)).otherwise(0.0)
    src = token_list(*[(ok & (v > 0), n) for n, v in over.items()])
    return df.withColumns({"Peak_Risk_Cal_MWH": corr, "Peak_Risk_Source": src, "Peak_Risk_Adjusted_Forecast_MWH": clip(c(base) + corr, lo=0.0)})


def hot_ramp_gate(hours: Sequence[int] = (17, 18, 19, 20), min_temp: float = 100.0, max_temp: float = 109.9, days: tuple[int, int] = (1, 16), consec95: float | None = 2.0,
                  consec100: float | None = 2.0, min_ramp: float | None = None, min_prior: float = 95.0, mean3: float | None = None) -> Column:
    """Hot day, hour and horizon, and any of the heat-persistence signs."""
    signs = []
    if consec95 is not None:
        signs.append(yes(c("ConsecutiveVeryHotDays95") >= consec95))
    if consec100 is not None:
        signs.append(yes(c("ConsecutiveExtremeHotDays100") >= consec100))
    if mean3 is not None:
        signs.append(yes(c("DailyMaxTemp_3DayMean") >= mean3))
    if min_ramp is not None:
        signs.append(yes((c("DailyMaxTemp_Ramp_1Day") >= min_ramp) & (c("PriorDay_DailyMaxTemp") >= min_prior)))
    persist = reduce(lambda a, b: a | b, signs, F.lit(False))
    return hot_scope(min_temp, hours, max_temp) & yes(c("Forecast_Day").between(*days)) & persist


def scenario_override(df: DataFrame, base: str, scenario: str, gate: Column, blend: float = 0.40, lift_cap: float = 8.0, total_cap: float = 8.0, prior: str | None = None) -> DataFrame:
    """Share of the hot-scenario gap, bounded by the lift cap and by the total cap less earlier lift."""
    left = clip(F.lit(float(total_cap)) - clip(F.coalesce(c(prior), F.lit(0.0)), lo=0.0), lo=0.0) if prior else F.lit(float(total_cap))
    gap = clip(F.coalesce(c(scenario) - c(base), F.lit(0.0)), lo=0.0)
    lift = F.when(gate, F.least(gap * blend, F.lit(float(lift_cap)), left)).otherwise(0.0)
    return df.withColumns({"Hot_Ramp_Scenario_Lift_MWH": lift, "Hot_Ramp_Forecast_MWH": clip(c(base) + lift, lo=0.0)})


def live_ramp_state(history: DataFrame, keys: Sequence[str] = ("series",), value: str = "MWH", min_hour: int = 6, tail_hours: int = 3, min_pairs: int = 3,
                    stat: str = "latest", min_delta: float = 15.0) -> DataFrame:
    """Today against yesterday at the same hours, per key: the observed delta and whether it is large enough.

    Only the last two days of a key take part (at most 48 rows).
    """
    h = history.where(c(value).isNotNull() & c("DT").isNotNull()).withColumns({"_d": F.to_date("DT"), "_h": F.hour("DT")})
    last = h.groupBy(*keys).agg(F.max("_d").alias("_last"))
    two = h.join(last, list(keys)).where(c("_d") >= F.date_sub("_last", 1))
    day = two.groupBy(*keys, "_last", "_h").agg(F.max(F.when(c("_d") == c("_last"), c(value))).alias("_a"), F.max(F.when(c("_d") < c("_last"), c(value))).alias("_p"))
    latest_hour = F.max(F.when(c("_a").isNotNull(), c("_h"))).over(Window.partitionBy(*keys))
    pairs = day.withColumn("_lh", latest_hour).where("_a is not null and _p is not null").withColumn("_delta", c("_a") - c("_p"))
    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("_h")))
    tail = pairs.withColumn("_r", rn).where(c("_r") <= tail_hours)
    obs = {"latest": F.max_by("_delta", "_h"), "mean": F.avg("_delta"), "max": F.max("_delta"), "median": F.percentile("_delta", 0.5)}[stat]
    g = tail.groupBy(*keys).agg(obs.alias("observed_delta_mwh"), F.count("*").alias("pair_count"), F.max("_lh").alias("latest_hour"))
    return g.withColumn("enabled", (c("latest_hour") >= min_hour) & (c("pair_count") >= min_pairs) & (c("observed_delta_mwh") >= min_delta))


def live_ramp_override(df: DataFrame, state: DataFrame, base: str, keys: Sequence[str] = ("series",), yesterday: str = "MWH_Lag24", hours: Sequence[int] = PEAK_HOURS,
                       min_temp: float = 100.0, max_temp: float = 115.0, days: tuple[int, int] = (1, 1), carry: float = 0.90, cap: float = 16.0) -> DataFrame:
    """Yesterday's load plus the carried delta as a target for today's peak hours."""
    out = join_small(df, state.select(*keys, c("observed_delta_mwh").alias("Day1_Live_Ramp_Observed_Delta_MWH"), c("enabled").alias("_on")), keys)
    gate = yes(c("_on")) & hot_scope(min_temp, hours, max_temp) & yes(c("Forecast_Day").between(*days)) & c(yesterday).isNotNull()
    target = c(yesterday) + c("Day1_Live_Ramp_Observed_Delta_MWH") * carry
    lift = F.when(gate, clip(F.coalesce(target - c(base), F.lit(0.0)), 0.0, cap)).otherwise(0.0)
    out = out.withColumns({"Day1_Live_Ramp_Gate": gate.cast("int"), "Day1_Live_Ramp_Cal_MWH": lift})
    return out.withColumn("Day1_Live_Ramp_Forecast_MWH", clip(c(base) + c("Day1_Live_Ramp_Cal_MWH"), lo=0.0)).drop("_on")


def heat_anchor_override(df: DataFrame, base: str, keys: Sequence[str] = ("series",), hours: Sequence[int] = PEAK_HOURS, anchor_hours: Sequence[int] = (16, 17, 18, 19), min_temp: float = 102.0,
                         max_temp: float = 115.0, days: tuple[int, int] = (2, 7), min_observed: float = 20.0, min_live_lift: float = 8.0, anchor_discount: float = 5.0, lead_decay: float = 0.75,
                         shortfall: float = 1.75, excess: float = 1.0, weekend: float = 8.0, sunday: float = 6.0, max_target: float = 365.0, cap: float = 14.0,
                         offsets: Mapping[int, float] | None = None, live: str = "Day1_Live_Ramp_Cal_MWH", observed: str = "Day1_Live_Ramp_Observed_Delta_MWH") -> DataFrame:
    """Day-1 hot peak level carried to later hot days with lead, temperature and weekend adjustments."""
    d1 = c("Forecast_Day") == 1
    at = d1 & c("Hour").isin(*anchor_hours) & (c("Temperature_DailyMax") >= min_temp) & c(base).isNotNull() & (F.coalesce(c(live), F.lit(0.0)) >= min_live_lift)
    anchor = df.groupBy(*keys).agg(F.max(F.when(at, c(base))).alias("_peak"), F.max(F.when(d1, c("Temperature_DailyMax"))).alias("_temp"), F.max(observed).alias("_obs"))
    out = join_small(df, anchor, keys)
    wd, t = F.weekday("DT"), c("Temperature_DailyMax")
    off = F.when(wd >= 5, weekend).otherwise(0.0) + F.when(wd == 6, sunday).otherwise(0.0)
    hour_off = F.lit(0.0)
    for h, v in (offsets or {}).items():
        hour_off = F.when(c("Hour") == h, F.lit(float(v))).otherwise(hour_off)
    target = (c("_peak") - anchor_discount - (c("Forecast_Day") - 1) * lead_decay - clip(c("_temp") - t, lo=0.0) * shortfall + clip(t - c("_temp"), lo=0.0) * excess - off + hour_off)
    gate = yes((c("_obs") >= min_observed) & c("_peak").isNotNull() & c("_temp").isNotNull()) & hot_scope(min_temp, hours, max_temp) & yes(c("Forecast_Day").between(*days)) & c(base).isNotNull()
    lift = F.when(gate, clip(F.coalesce(clip(target, hi=max_target) - c(base), F.lit(0.0)), 0.0, cap)).otherwise(0.0)
    out = out.withColumns({"MultiDay_Heat_Anchor_Gate": gate.cast("int"), "MultiDay_Heat_Anchor_Cal_MWH": lift})
    return out.withColumn("MultiDay_Heat_Anchor_Forecast_MWH", clip(c(base) + c("MultiDay_Heat_Anchor_Cal_MWH"), lo=0.0)).drop("_peak", "_temp", "_obs")


def streak_lift(df: DataFrame, base: str, onset: float = 5.0, rate: float = 1.5, cap: float = 20.0, min_temp: float = 90.0) -> DataFrame:
    """Growing lift with the depth of a very-hot run beyond its onset."""
    depth = F.coalesce(c("ConsecutiveVeryHotDays95"), F.lit(0.0))
    lift = F.when(hot_scope(min_temp) & (depth > onset), F.least((depth - onset) * rate, F.lit(float(cap)))).otherwise(0.0)
    return df.withColumns({"Escalating_Heat_Persistence_Correction_MWH": lift, "Escalated_Forecast_MWH": c(base) + lift})


def magnitude_lift(df: DataFrame, base: str, threshold: float = 98.0, rate: float = 4.0, cap: float = 30.0, max_streak: float | None = None) -> DataFrame:
    """Lift per degree above a threshold on short-streak hot rows."""
    ok = hot_scope(threshold)
    if max_streak is not None:
        ok = ok & (F.coalesce(c("ConsecutiveVeryHotDays95"), F.lit(0.0)) <= max_streak)
    lift = F.when(ok, F.least((c("Temperature_DailyMax") - threshold) * rate, F.lit(float(cap)))).otherwise(0.0)
    return df.withColumns({"Extreme_Heat_Magnitude_Correction_MWH": lift, "Magnitude_Forecast_MWH": c(base) + lift})


def cooling_underway(cfg: Mapping) -> Column:
    """Any (or all) of the configured minimum drops, then the hour and cloud limits; nothing configured is never."""
    cols = {"min_drop_from_dailymax_f": c("Temperature_DailyMax") - c("Temperature"), "min_forecast_drop_next1hr_f": "TempDrop_Next1Hr_F", "min_forecast_drop_next2hr_f": "TempDrop_Next2Hr_F",
            "min_forecast_drop_next3hr_f": "TempDrop_Next3Hr_F", "min_delta_breeze_cooling_signal": "DeltaBreeze_Cooling_Signal",
            "min_delta_breeze_post_peak_load_decay_signal": "DeltaBreeze_PostPeak_LoadDecay_Signal", "min_post_peak_load_decay_1hr_mwh": "PostPeak_LoadDecay_1Hr_MWH",
            "min_post_peak_load_decay_2hr_mwh": "PostPeak_LoadDecay_2Hr_MWH"}
    tests = [yes((c(v) if isinstance(v, str) else v) >= float(cfg[k])) for k, v in cols.items() if k in cfg]
    if not tests:
        return F.lit(False)
    out = reduce((lambda a, b: a & b) if cfg.get("mode") in ("all", "and") else (lambda a, b: a | b), tests)
    for k, col, op in (("min_hour", "Hour", "ge"), ("max_hour", "Hour", "le"), ("max_cloud_cover_norm", "CloudCover_Norm", "le")):
        if cfg.get(k) is not None:
            out = out & yes(c(col) >= float(cfg[k]) if op == "ge" else c(col) <= float(cfg[k]))
    return out


# Test name, column of each evidence gate.
GATE_COLUMNS = {
    "raw": "Raw_Forecast_MWH", "lag1": "MWH_Lag1", "lag24": "MWH_Lag24", "same_hour_7day": "MWH_SameHour7DayMean", "maxtemp": "Temperature_DailyMax", "ramp": "DailyMaxTemp_Ramp_1Day",
    "cloud": "CloudCover_Norm", "forecast_day": "Forecast_Day", "hour": "Hour",
}


def evidence_gate(cfg: Mapping[str, tuple[float | None, float | None]], extra: Mapping[str, Column] | None = None, unconfigured: bool = False) -> Column:
    """AND of (min, max) tests by name; a null fails; without tests the gate is ``unconfigured``."""
    cols = {**{k: c(v) for k, v in GATE_COLUMNS.items()}, **(extra or {})}
    tests = []
    for name, (lo, hi) in cfg.items():
        if lo is not None:
            tests.append(yes(cols[name] >= lo))
        if hi is not None:
            tests.append(yes(cols[name] <= hi))
    return reduce(lambda a, b: a & b, tests) if tests else F.lit(unconfigured)


def lag1_or_rebuilt(day_diff: str = "Lag1_Minus_SameHourYesterday_MWH") -> Column:
    """Lag 1, rebuilt as lag 24 plus the day difference where it is missing."""
    return F.coalesce(c("MWH_Lag1"), c("MWH_Lag24") + c(day_diff))


def daily_peak_rows(df: DataFrame, keys: Sequence[str], base: str, actual: str = ACTUAL, carry: Sequence[str] = (), max_cols: Sequence[str] = ()) -> DataFrame:
    """Per day the base-peak row, the actual peak and its hour, and column maxima; days need both peaks."""
    early = -epoch_second("DT")
    row = F.struct(c("Hour").alias("Base_PeakHour"), c(base).alias("Base_DailyPeak_MWH"), *carry)
    b, a = c(base), c(actual)
    g = df.groupBy(*keys).agg(F.max_by(F.when(b.isNotNull(), row), F.when(b.isNotNull(), F.struct(b, early))).alias("_b"), F.max(a).alias("Actual_DailyPeak_MWH"),
                              F.max_by("Hour", F.when(a.isNotNull(), F.struct(a, early))).alias("Actual_PeakHour"), *[F.max(m).alias(f"Max_{m}") for m in max_cols])
    return g.where("_b is not null and Actual_DailyPeak_MWH is not null").select(*keys, "_b.*", "Actual_DailyPeak_MWH", "Actual_PeakHour", *[f"Max_{m}" for m in max_cols])


# Capture lookup levels, most specific first.
CAPTURE_LEVELS = (
    Level("HorizonBucket+Month+DailyMaxTempBucket+CloudCoverBucket", ("HorizonBucket", "Month", "DailyMaxTempBucket", "CloudCoverBucket")),
    Level("HorizonBucket+DailyMaxTempBucket+CloudCoverBucket", ("HorizonBucket", "DailyMaxTempBucket", "CloudCoverBucket")), Level("HorizonBucket+DailyMaxTempBucket", ("HorizonBucket", "DailyMaxTempBucket")),
    Level("DailyMaxTempBucket+CloudCoverBucket", ("DailyMaxTempBucket", "CloudCoverBucket")), Level("DailyMaxTempBucket", ("DailyMaxTempBucket",)), Level("HorizonBucket", ("HorizonBucket",)), Level("global", ()),
)


def capture_cloud_bucket(cloud: str) -> Column:
    x = c(cloud)
    return (F.when(x.isNull(), "Unknown").when(x <= 0.20, "Clear/Low").when(x <= 0.40, "Some Clouds").when(x <= 0.60, "Partly Cloudy").when(x <= 0.80, "Mostly Cloudy").otherwise("Overcast"))


def capture_days(df: DataFrame, keys: Sequence[str], base: str, scope: Column, actual: str = ACTUAL) -> DataFrame:
    """Daily training rows of the capture: peaks, anchors at the base-peak hour, buckets and residual targets."""
    w = df.where(scope)
    d = daily_peak_rows(w, keys, base, actual, ("Month", "Forecast_Day", "MWH_SameHour7DayMean", "MWH_Lag24"), ("Temperature_DailyMax", "CloudCover_Norm", "DailyMaxTemp_Ramp_1Day"))
    d = d.withColumns({"HorizonBucket": horizon_bucket("Forecast_Day", "capture"), "DailyMaxTempBucket": capture_temp_bucket("Max_Temperature_DailyMax"), "CloudCoverBucket": capture_cloud_bucket("Max_CloudCover_Norm")})
    peak = c("Actual_DailyPeak_MWH")
    slope = F.when(c("Max_DailyMaxTemp_Ramp_1Day") > 0, (peak - c("MWH_Lag24")) / c("Max_DailyMaxTemp_Ramp_1Day"))
    return d.withColumns({"PeakResidual": peak - c("Base_DailyPeak_MWH"), "SameHour7Residual": peak - c("MWH_SameHour7DayMean"), "Lag24Residual": peak - c("MWH_Lag24"), "Lag24RampSlope": slope})


def capture_lookup(days: DataFrame, by: Sequence[str] = (), min_days: int = 3) -> DataFrame:
    """Mean peak residual (and anchors' residuals) per level; levels below the day count are left out, the global one is kept."""
    vals = ("PeakResidual", "SameHour7Residual", "Lag24Residual", "Lag24RampSlope")
    long = days.select(*by, *vals, F.inline(level_rows(CAPTURE_LEVELS)))
    g = long.groupBy(*by, "level", "key").agg(F.count("*").alias("count"), *[F.avg(v).alias(v) for v in vals])
    return g.where((c("count") >= min_days) | (c("level") == "global")).withColumn("hit", F.struct(*vals))


def select_timing(df: DataFrame, keys: Sequence[str], base: str, scope: Column, sources: Mapping[str, str], hours: Sequence[int] = PEAK_HOURS, min_margin: float = 1.0, consensus: int = 1,
                  max_spread: float = 0.0, required: str | None = None, blocked: Column | None = None) -> DataFrame:
    """The peak hour of each day (``keys``) that several forecasts agree on, else the base forecast's own.

    A source (name to column, by falling priority) votes for the hour of its highest value among ``hours``; its
    confidence is the lead over its second hour, and below ``min_margin`` it does not vote.  Votes within ``max_spread`` hours of one another
    form a cluster, which needs ``consensus`` votes and that of ``required``, if named.  The largest cluster wins, then the one whose least confidence is
    greatest, then priority; its hour is that of its source of highest priority.  ``blocked`` days keep the base hour.

    Columns: ``Base_PeakHour, Timing_Hour, Timing_Source, Timing_Override, Timing_Confidence``.  A day has at most 24 hours, so its votes are one small array.
    """
    live = df.where(scope & c(base).isNotNull())
    per_hour = live.groupBy(*keys, "Hour").agg(F.max(base).alias("_b"), F.max(F.coalesce(blocked, F.lit(False)) if blocked is not None else F.lit(False)).alias("_stop"), *[F.max(col).alias(f"_v{i}") for i, col in enumerate(sources.values())])
    early = -c("Hour")
    day = per_hour.groupBy(*keys).agg(F.max_by("Hour", F.struct("_b", early)).alias("Base_PeakHour"), F.max("_stop").alias("_stop"), *[
        F.array_sort(F.collect_list(F.when(c(f"_v{i}").isNotNull() & c("Hour").isin(*hours), F.struct((-c(f"_v{i}")).alias("v"), c("Hour").alias("h"))))).alias(f"_l{i}") for i in range(len(sources))])
    votes = []
    for i, name in enumerate(sources):
        ranked = c(f"_l{i}")
        margin = F.when(F.size(ranked) > 1, F.try_element_at(ranked, F.lit(2))["v"] - ranked[0]["v"]).otherwise(F.lit(1e18))
        vote = F.struct(F.lit(i).alias("p"), F.lit(name).alias("s"), F.try_element_at(ranked, F.lit(1))["h"].alias("h"), margin.alias("m"))
        votes.append(F.when((F.size(ranked) > 0) & (margin >= min_margin), vote))
    day = day.withColumn("_votes", F.array_compact(F.array(*votes)))

    def cluster(x: Column) -> Column:
        near = F.filter("_votes", lambda y: F.abs(y["h"] - x["h"]) <= max_spread)
        return F.struct(F.size(near).alias("n"), F.array_min(F.transform(near, lambda y: y["m"])).alias("m"), (-F.array_min(F.transform(near, lambda y: y["p"]))).alias("p"), (-x["p"]).alias("own"),
                        F.exists(near, lambda y: y["s"] == required if required else F.lit(True)).alias("has"), F.array_min(near).alias("best"))

    found = F.filter(F.transform("_votes", cluster), lambda k: (k["n"] >= consensus) & k["has"])
    day = day.withColumn("_top", F.array_max(F.transform(found, lambda k: F.struct(k["n"].alias("n"), k["m"].alias("m"), k["p"].alias("p"), k["own"].alias("own"), k["best"].alias("best")))))
    use = ~c("_stop") & c("_top").isNotNull()
    hour = F.when(use, c("_top.best.h")).otherwise(c("Base_PeakHour"))
    moved = use & (c("_top.best.h") != c("Base_PeakHour"))
    why = F.when(c("_stop"), "base_strong_hot_ramp_fallback").when(F.size("_votes") == 0, "base_no_timing_candidate").when(c("_top").isNull(), "base_no_timing_consensus")
    label = F.coalesce(why, F.concat(c("_top.best.s"), F.when(moved, "_consensus").otherwise("_aligned")))
    return day.select(*keys, "Base_PeakHour", hour.alias("Timing_Hour"), label.alias("Timing_Source"), moved.alias("Timing_Override"), F.when(use, c("_top.m")).alias("Timing_Confidence"))


def apply_capture(df: DataFrame, keys: Sequence[str], lookup: DataFrame, base: str, scope: Column, by: Sequence[str] = (), hours: Sequence[int] = PEAK_HOURS, cooling: Column | None = None,
                  strong: Column | None = None, cap: float = 9.0, strong_cap: float = 9.0, floor: float = 0.0, strong_floor: float = 4.0, min_abs: float = 0.25, spread: float = 1.0,
                  block_negative: bool = True, anchor_min_learned: float = 4.0, anchor_min_temp: float = 105.0, slope_cap: float = 4.0, warmer: str | None = None, warmer_fraction: float = 0.25,
                  recent_anchor: DataFrame | None = None, timing: DataFrame | None = None, max_extra: float | None = None) -> DataFrame:
    """Day targets from the learned, same-hour and lag-24 anchors, spread over the peak hours by Gaussian weights of greatest value 1.

    ``keys`` name a day; ``lookup`` comes from ``capture_lookup``.  With ``timing`` (from ``select_timing``) the weights lie around the selected hour;
    where that is not the base forecast's, the selected hour is raised to the day's target, by ``max_extra`` beyond the day's lift at most, and no other hour beyond the target.
    """
    live = scope & ~(cooling if cooling is not None else F.lit(False)) & c(base).isNotNull()
    early = -epoch_second("DT")
    wd = clip(F.coalesce(c(warmer) - c(base), F.lit(0.0)), lo=0.0) if warmer else F.lit(0.0)
    top = F.max_by(F.struct("Hour", c(base).alias("peak"), "Month", "Forecast_Day", "MWH_SameHour7DayMean", "MWH_Lag24"), F.struct(c(base), early))
    d = df.where(live).groupBy(*keys).agg(top.alias("_t"), F.max("Temperature_DailyMax").alias("_temp"), F.max("DailyMaxTemp_Ramp_1Day").alias("_ramp"), F.max("CloudCover_Norm").alias("_cloud"), F.max(wd).alias("_wd"),
                                          F.bool_or(strong if strong is not None else F.lit(False)).alias("_strong"),
                                          F.collect_set(F.when(c("Hour").isin(*hours), c("Hour"))).alias("_hours"))  # at most 24 values
    d = d.select(*keys, c("_t.Hour").alias("_hour"), c("_t.peak").alias("_peak"), c("_t.Month").alias("Month"), c("_t.Forecast_Day").alias("_fd"), c("_t.MWH_SameHour7DayMean").alias("_s7"), c("_t.MWH_Lag24").alias("_l24"),
                 "_temp", "_ramp", "_wd", "_strong", "_hours", capture_temp_bucket("_temp").alias("DailyMaxTempBucket"), capture_cloud_bucket("_cloud").alias("CloudCoverBucket"))
    d = d.withColumn("HorizonBucket", horizon_bucket("_fd", "capture"))
    d = first_match(d, lookup, CAPTURE_LEVELS, "hit", by, "_hit", "Capture_Level")
    learned = F.coalesce(c("_hit.PeakResidual"), F.lit(0.0))
    slope = clip(F.coalesce(c("_hit.Lag24RampSlope"), F.lit(0.0)), -slope_cap, slope_cap)
    hist = [c("_s7") + F.coalesce(c("_hit.SameHour7Residual"), learned), c("_l24") + F.coalesce(c("_hit.Lag24Residual"), learned), c("_l24") + slope * clip(F.coalesce(c("_ramp"), F.lit(0.0)), lo=0.0)]
    if recent_anchor is not None:
        d = null_safe_join(d, recent_anchor, by) if by else d.withColumn("_recent", recent_anchor.scalar())
        hist.append(c("_recent"))
    supported = (learned >= anchor_min_learned) | yes(c("_temp") >= anchor_min_temp)
    anchors = F.greatest(*hist)
    target = F.greatest(c("_peak") + clip(learned, lo=0.0), F.when(supported, anchors), F.when(c("_wd") > 0, c("_peak") + c("_wd") * warmer_fraction))
    raw = target - c("_peak")
    lowest = F.when(c("_strong"), F.lit(float(strong_floor))).otherwise(F.lit(float(floor)))
    thin = (lowest > 0) & ~supported & (raw < lowest)
    amount = clip(F.when(lowest > 0, F.greatest(raw, lowest)).otherwise(raw), lo=0.0)
    amount = F.least(amount, F.when(c("_strong"), F.lit(float(strong_cap))).otherwise(F.lit(float(cap))))
    blocked = (learned < 0) if block_negative else F.lit(False)
    day = d.select(*keys, c("_hour").alias("_ph"), c("_peak").alias("_bp"), learned.alias("_lr"), "Capture_Level",
                   F.when(blocked, "negative_learned_residual").when(thin, "insufficient_anchor_support").when(amount < min_abs, "below_min_correction").otherwise("applied").alias("_why"), amount.alias("_amt"), "_hours")
    out = null_safe_join(df, day, keys)
    use = live & yes(c("_why") == "applied") & c("Hour").isin(*hours)
    if timing is not None:
        out = null_safe_join(out, timing.select(*keys, c("Timing_Hour").alias("_th"), c("Timing_Override").alias("_move")), keys)
        at = out.where(live & (c("Hour") == c("_th")) & c("Hour").isin(*hours)).groupBy(*keys).agg(F.max(base).alias("_sb"))
        out = null_safe_join(out, at, keys).withColumn("_ph", F.coalesce("_th", "_ph"))

    def bell(h: Column) -> Column:
        return F.exp(-0.5 * F.pow((h - c("_ph")) / F.lit(max(float(spread), 1e-6)), F.lit(2.0)))

    # the day's greatest weight comes from its set of live hours, so no window runs over the day's rows
    scaled = bell(c("Hour")) / F.array_max(F.transform("_hours", bell))
    lift = c("_amt") * scaled
    if timing is not None:
        goal = c("_bp") + c("_amt")
        raised = F.greatest(c("_amt"), goal - c("_sb"))
        if max_extra is not None:
            raised = F.least(raised, c("_amt") + max_extra)
        moved = F.coalesce(c("_move") & c("_sb").isNotNull() & (raised > c("_amt") + 1e-9), F.lit(False))
        other = F.when(c("Hour") != c("_ph"), F.least(raised * scaled, clip(goal - c(base), lo=0.0))).otherwise(raised * scaled)
        lift = F.when(moved, clip(other, lo=0.0)).otherwise(lift)
    out = out.withColumn("Peak_Capture_MWH", F.when(use, lift).otherwise(0.0)).drop("_th", "_move", "_sb")
    return out.withColumns({"Peak_Capture_Source": F.when(live, F.coalesce(c("_why"), F.lit("out_of_scope"))).otherwise("out_of_scope"),
                            "Peak_Capture_Forecast_MWH": clip(c(base) + c("Peak_Capture_MWH"), lo=0.0)}).drop("_ph", "_bp", "_lr", "_why", "_amt", "_hours", "Capture_Level")


def targeted_rules(df: DataFrame, rules: Sequence[Mapping], correction: str, blocked: Column | None = None) -> DataFrame:
    """Static lifts of the first matching rule on rows without a learned correction."""
    lift, name = F.lit(0.0), F.lit("none")
    for r in reversed(list(rules)):
        hit = hot_scope(float(r.get("min_maxtemp_f", -999.0)), r.get("hours", PEAK_HOURS), r.get("max_maxtemp_f"))
        if r.get("months"):
            hit = hit & c("Month").isin(*r["months"])
        if r.get("min_forecast_day") is not None or r.get("max_forecast_day") is not None:
            hit = hit & yes(c("Forecast_Day").between(int(r.get("min_forecast_day", 0)), int(r.get("max_forecast_day", 999))))
        if r.get("max_cloud_cover_norm") is not None:
            hit = hit & yes(c("CloudCover_Norm") <= float(r["max_cloud_cover_norm"]))
        lift, name = F.when(hit, F.lit(float(r["lift_mwh"]))).otherwise(lift), F.when(hit, F.lit(r["name"])).otherwise(name)
    free = (c(correction) == 0.0) & ~(blocked if blocked is not None else F.lit(False))
    out = df.withColumns({"Targeted_Lift_MWH": F.when(free, lift).otherwise(0.0), "Targeted_Source": F.when(free & (lift != 0.0), name).otherwise("none")})
    return out.withColumn(correction, c(correction) + c("Targeted_Lift_MWH"))


def capture_summary(df: DataFrame, base: str, correction: str, scope: Column, actual: str = ACTUAL) -> DataFrame:
    """Rows applied, mean lift, and scope error before and after."""
    e0, e1 = F.abs(c(actual) - c(base)), F.abs(c(actual) - clip(c(base) + c(correction), lo=0.0))
    on = c(correction) != 0.0
    return df.where(scope).agg(F.count("*").alias("scope_rows"), F.count(F.when(on, 1)).alias("applied_rows"), F.avg(F.when(on, c(correction))).alias("mean_lift"), F.avg(e0).alias("mae_before"), F.avg(e1).alias("mae_after"))
