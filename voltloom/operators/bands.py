"""Uncertainty bands: conditional residual quantiles, risk multipliers, conformal widths."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..core import group_quantiles, join_small, null_safe_join
from ..core.scratch import materialise
from ..functions.clock import token_list
from ..functions.weather import clip
from .lookups import Level, all_keys, level_rows, resolve

c = F.col

# Band levels, most specific first.
BAND_LEVELS = (
    Level("Hour+CloudCoverBucket+SolarLossBucket", ("Hour", "CloudCoverBucket", "SolarLossBucket")), Level("Hour+SolarLossBucket", ("Hour", "SolarLossBucket")),
    Level("HourGroup+SolarLossBucket", ("HourGroup", "SolarLossBucket")), Level("HourGroup+DailyMaxTempBin", ("HourGroup", "DailyMaxTempBin")),
    Level("HourGroup", ("HourGroup",)), Level("Hour", ("Hour",)),
)
GLOBAL = Level("global", ())
CONFORMAL_LEVELS = (Level("risk_horizon", ("Weather_Input_Risk_Class", "Replay_Horizon_Bucket")), Level("risk_class", ("Weather_Input_Risk_Class",)),
                    Level("horizon", ("Replay_Horizon_Bucket",)), Level("global", ()))


def band_lookup(work: DataFrame, residual: str, floor: float = 4.0, by: Sequence[str] = (), levels: Sequence[Level] = (*BAND_LEVELS, GLOBAL)) -> DataFrame:
    """Long lookup (by, level, key): p50, p80 and p90 of the absolute residual, its mean and count, and the floored band."""
    long = work.where(c(residual).isNotNull()).select(*by, F.abs(residual).alias("_ae"), F.inline(level_rows(levels)))
    keys = [*by, "level", "key"]
    q = group_quantiles(long, keys, "_ae", {"p50": 0.5, "p80": 0.8, "p90": 0.9}, count_as="count", mean_as="mean")
    return q.withColumn("band_mwh", F.greatest(F.lit(float(floor)), c("p80")))


def first_match(frame: DataFrame, lookup: DataFrame, levels: Sequence[Level], value: str, by: Sequence[str] = (), out: str = "_band", source: str = "_level", min_n: Mapping[str, int] | None = None) -> DataFrame:
    """Value of the first level, in order, that has the row's keys (and enough rows)."""
    lk = lookup.where(c(value).isNotNull())
    if min_n is not None:
        need = F.element_at(F.create_map(*[x for k, v in min_n.items() for x in (F.lit(k), F.lit(int(v)))]), c("level"))
        lk = lk.where(c("count") >= need)
    best = F.min_by(F.struct(c(value).alias("v"), c("level").alias("l")), "_order")
    got = resolve(frame, lk, levels, by, [best.alias("_fm")])
    return join_small(frame, got, [*by, *all_keys(levels)]).withColumns({out: c("_fm.v"), source: c("_fm.l")}).drop("_fm")


def _is(col: str, *values: str) -> Column:
    return F.coalesce(c(col).isin(*values), F.lit(False))


def _ge(col: str, x: float) -> Column:
    return F.coalesce(c(col) >= x, F.lit(False))


# Factors of the band risk multiplier.
HOUR_FACTORS = {14: 1.35, 15: 1.45, 16: 1.55, 17: 1.45, 18: 1.25}
HOT_FACTORS = ((95.0, ("Overnight",), 1.55), (95.0, ("Morning",), 3.25), (95.0, ("Midday",), 2.05), (95.0, ("Peak",), 1.25),
               (105.0, ("Morning",), 1.25), (105.0, ("Midday",), 1.20), (112.0, ("Morning", "Midday", "Peak"), 1.10))
CORE_EVENTS = ("weekday_core_highimpact_solar_loss", "weekday_core_solar_loss", "weekday_core_hour14_solar_loss")


def risk_multiplier(event_class: bool = False) -> Column:
    """Product of hour, cloud/loss, event and heat factors, bounded to 0.65..5."""
    cloudy, lossy = _is("CloudCoverBucket", "Mostly Cloudy", "Overcast"), _is("SolarLossBucket", "High", "Extreme")
    factors = [(_is("HourGroup", "Overnight", "Morning"), 0.78), *[(c("Hour") == h, f) for h, f in HOUR_FACTORS.items()], (_is("HourGroup", "Peak"), 1.12),
               (cloudy & lossy, 1.35), (c("Hour").between(16, 18) & cloudy, 1.15)]
    if event_class:
        factors.append((_is("CloudSolarEventClass", *CORE_EVENTS), 1.20))
    factors += [(_ge("Temperature_DailyMax", t) & _is("HourGroup", *groups), f) for t, groups, f in HOT_FACTORS]
    out = F.lit(1.0)
    for cond, f in factors:
        out = out * F.when(cond, F.lit(f)).otherwise(1.0)
    return clip(out, 0.65, 5.00)


def hot_floor(rules: Sequence[dict]) -> Column:
    """Greatest minimum band of the matching hot-bucket rules; null when none matches."""
    parts = []
    for r in rules:
        cond = F.lit(True)
        if r.get("min_daily_max_temp_f") is not None:
            cond = cond & _ge("Temperature_DailyMax", float(r["min_daily_max_temp_f"]))
        if r.get("max_daily_max_temp_f") is not None:
            cond = cond & F.coalesce(c("Temperature_DailyMax") <= float(r["max_daily_max_temp_f"]), F.lit(False))
        if r.get("hour_groups"):
            cond = cond & _is("HourGroup", *r["hour_groups"])
        if r.get("hours"):
            cond = cond & c("Hour").isin(*r["hours"])
        parts.append(F.when(cond, F.lit(float(r["min_band_mwh"]))))
    if not parts:
        return F.lit(None).cast("double")
    return parts[0] if len(parts) == 1 else F.greatest(*parts)


# Default lead and regime multipliers of the weather-input risk.
WEATHER_RISK = {"max_day": 7, "day1": 1.20, "days2to3": 1.40, "days4to7": 1.60, "days8to16": 1.60, "cloudy_solar": 1.15, "hot_peak": 1.10,
                "shoulder_heat": 1.0, "high_temp": 1.0, "high_temp_min": 95.0, "cap": 2.25}


def add_weather_risk(df: DataFrame, cfg: Mapping[str, float] | None = None, day: str = "Forecast_Day") -> DataFrame:
    """Multiplier, joined reasons and most actionable class of the weather-input risk."""
    p = {**WEATHER_RISK, **(cfg or {})}
    d, h, t = F.coalesce(c(day), F.lit(999)), F.coalesce(c("Hour"), F.lit(-1)), c("Temperature_DailyMax")
    top = int(p["max_day"])
    scope = d.between(1, top)
    d1, d23, d47, d8 = scope & (d == 1), scope & d.between(2, 3), scope & d.between(4, min(top, 7)), scope & d.between(8, top) & F.lit(top >= 8)
    cloudy = scope & h.between(10, 16) & (_is("CloudCoverBucket", "Mostly Cloudy", "Overcast") | _is("SolarLossBucket", "High", "Extreme"))
    if "CloudSolarEventClass" in df.columns:
        cloudy = scope & h.between(10, 16) & (_is("CloudCoverBucket", "Mostly Cloudy", "Overcast") | _is("SolarLossBucket", "High", "Extreme")
                                              | F.coalesce(F.lower("CloudSolarEventClass").contains("solar_loss"), F.lit(False)))
    hot = scope & h.between(16, 20) & _ge("Temperature_DailyMax", 90.0)
    shoulder = scope & _is("Season", "Spring", "Fall") & h.between(12, 22) & F.coalesce(t.between(75.0, 93.0), F.lit(False))
    high = scope & _ge("Temperature_DailyMax", float(p["high_temp_min"]))
    mult = F.lit(1.0)
    for cond, k in ((d1, "day1"), (d23, "days2to3"), (d47, "days4to7"), (d8, "days8to16"), (cloudy, "cloudy_solar"), (hot, "hot_peak"), (shoulder, "shoulder_heat"), (high, "high_temp")):
        mult = mult * F.when(cond, F.lit(float(p[k]))).otherwise(1.0)
    reason = token_list((d1, "weather_day1"), (d23, "weather_days2to3"), (d47, "weather_days4to7"), (d8, "weather_days8to16"), (cloudy, "cloud_solar"), (hot, "hot_peak"),
                        (shoulder, "shoulder_heat"), (high, "high_temp"))
    lead = (F.when(d1, "day1_weather_error").when(d23, "days2to3_weather_error").when(d47, "days4to7_weather_error").when(d8, "days8to16_weather_error").otherwise("none"))
    cls = (F.when(high & ~hot, "high_temp_weather_error").when(hot, "hot_peak_weather_error").when(shoulder, "shoulder_heat_weather_error")
           .when(cloudy, "cloudy_solar_loss_weather_error").otherwise(lead))
    any_regime = cloudy | hot | shoulder | high
    cls = F.when(d47 & any_regime, F.concat(F.lit("days4to7_"), cls)).when(d8 & any_regime, F.concat(F.lit("days8to16_"), cls)).otherwise(cls)
    return df.withColumns({"Weather_Input_Risk_Multiplier": clip(mult, 1.0, float(p["cap"])), "Weather_Input_Risk_Reason": reason, "Weather_Input_Risk_Class": cls})


def add_caution_labels(df: DataFrame, day: str = "Forecast_Day") -> DataFrame:
    """Operator caution flag, reasons, confidence label and risk code; later rules win."""
    d, h = c(day), F.coalesce(c("Hour"), F.lit(-1))
    hot, window = h.between(16, 20) & _ge("Temperature_DailyMax", 90.0), h.between(14, 18)
    cloudy = h.between(10, 16) & (_is("CloudCoverBucket", "Mostly Cloudy", "Overcast") | _is("SolarLossBucket", "High", "Extreme"))
    if "CloudSolarEventClass" in df.columns:
        cloudy = h.between(10, 16) & (_is("CloudCoverBucket", "Mostly Cloudy", "Overcast") | _is("SolarLossBucket", "High", "Extreme")
                                      | F.coalesce(F.lower("CloudSolarEventClass").contains("solar_loss"), F.lit(False)))
    risky = (F.coalesce(c("Weather_Input_Risk_Multiplier"), F.lit(1.0)) > 1.0) | (F.coalesce(c("Weather_Input_Risk_Class"), F.lit("none")) != "none")
    far = F.coalesce(d.between(8, 16), F.lit(False))
    bias = F.abs(F.coalesce(c("Recent_Level_Correction_MWH"), F.lit(0.0))) >= 4.0 if "Recent_Level_Correction_MWH" in df.columns else F.lit(False)
    reason = token_list((window, "peak_window_data_limited"), (hot, "hot_peak_data_limited"), (cloudy, "cloudy_solar_midday_risk"), (risky, "weather_input_risk"),
                        (far, "days8to16_low_confidence"), (bias, "recent_bias_risk"))
    regime = window | hot | cloudy | risky
    label = (F.when(far & regime, "Low confidence caution").when(far, "Low confidence").when(bias, "Caution: recent bias").when(hot, "Caution: hot peak")
             .when(window, "Caution: peak window").when(cloudy, "Caution: solar/cloud").when(risky, "Weather risk").otherwise("Normal"))
    code = (F.when(hot, "HOT_PEAK_RISK").when(cloudy, "SOLAR_CLOUD_RISK").when(window, "PEAK_WINDOW_RISK").when(risky, "WEATHER_INPUT_RISK")
            .when(far, "LONG_HORIZON_RISK").when(bias, "RECENT_BIAS_RISK").otherwise("NORMAL"))
    code = F.when(far & regime, F.concat(code, F.lit("+LONG_HORIZON_RISK"))).otherwise(code)
    return df.withColumns({"Production_Caution_Reason": reason, "Production_Caution_Flag": (reason != "none").cast("int"),
                           "Production_Confidence_Label": label, "Production_Risk_Code": code})


def interval_columns(base: str, band: str = "Band") -> dict[str, Column]:
    b, w = c(base), c(band)
    lo = clip(b - w, lo=0.0)
    return {"Upper_Band": b + w, "Lower_Band": lo, "P10_Forecast_MWH": lo, "P50_Forecast_MWH": clip(b, lo=0.0), "P90_Forecast_MWH": b + w}


def apply_bands(df: DataFrame, base: str, percent: float = 0.055, floor: float = 4.0, lookup: DataFrame | None = None, scale: float = 1.0, by: Sequence[str] = (),
                weather_risk: Mapping[str, float] | None = None, hot_rules: Sequence[dict] = ()) -> DataFrame:
    """Band per row: first matching residual level (else global), risk multiplier, percent guard, weather multiplier, hot floor; then P10/P50/P90."""
    s = max(0.10, float(scale or 1.0))
    b = F.abs(c(base))
    if lookup is None:
        out = df.withColumns({"Band": F.greatest(F.lit(float(floor)), b * percent) * s, "Band_Method": F.lit("percent_floor")})
    else:
        out = first_match(df, lookup, (*BAND_LEVELS, GLOBAL), "band_mwh", by)
        hit = F.coalesce(c("_level"), F.lit("global"))
        method = F.when(hit == "global", "percent_floor").otherwise(hit)
        raw = F.greatest(F.lit(float(floor)), F.coalesce(c("_band"), F.lit(float(floor)))) * risk_multiplier("CloudSolarEventClass" in df.columns) * s
        out = out.withColumns({"Band": F.greatest(raw, F.lit(float(floor) * s), b * percent * 0.65 * s), "Band_Method": method}).drop("_band", "_level")
    if weather_risk is not None:
        out = add_weather_risk(out, weather_risk)
    else:
        out = out.withColumns({"Weather_Input_Risk_Multiplier": F.lit(1.0), "Weather_Input_Risk_Reason": F.lit("none"), "Weather_Input_Risk_Class": F.lit("none")})
    out = out.withColumn("Band", c("Band") * c("Weather_Input_Risk_Multiplier"))
    if hot_rules:
        fl = hot_floor(hot_rules)
        low = F.coalesce(c("Band") < fl, F.lit(False))
        out = out.withColumns({"Band_Method": F.when(low, F.concat(c("Band_Method"), F.lit("+hot_bucket_floor"))).otherwise(c("Band_Method")),
                               "Band": F.when(low, fl).otherwise(c("Band"))})
    return add_caution_labels(out).withColumns(interval_columns(base))


def conformal_lookup(detail: DataFrame, error: str = "AbsError_MWH", quantile: float = 0.80, by: Sequence[str] = ()) -> DataFrame:
    """Error quantile by risk and horizon, risk, horizon, and over all."""
    long = detail.where(c(error).isNotNull()).select(*by, c(error).alias("_ae"), F.inline(level_rows(CONFORMAL_LEVELS)))
    return group_quantiles(long, [*by, "level", "key"], "_ae", {"q": quantile}, count_as="count")


def conformal_bands(df: DataFrame, lookup: DataFrame, base: str, halfspread: Column | None = None, by: Sequence[str] = (), safety: Column | float = 1.0,
                    spread_multiplier: float = 1.0, min_fraction: float = 0.0, allow_narrowing: bool = True, min_n: Mapping[str, int] | None = None) -> DataFrame:
    """Widest of the un-multiplied band, the conformal quantile and the scenario half-spread, on risky rows; else the current band."""
    out = first_match(df.withColumn("Pre_Conformal_Band_MWH", c("Band")), lookup, CONFORMAL_LEVELS, "q", by, "Conformal_Weather_Band_MWH", "Conformal_Weather_Source", min_n)
    out = out.withColumn("Conformal_Weather_Source", F.coalesce("Conformal_Weather_Source", F.lit("insufficient_prior")))
    cur = c("Pre_Conformal_Band_MWH")
    mult = F.coalesce(F.nullif(c("Weather_Input_Risk_Multiplier"), F.lit(0.0)), F.lit(1.0))
    saf = safety if isinstance(safety, Column) else F.lit(float(safety))
    spread = F.coalesce(halfspread if halfspread is not None else F.lit(0.0), F.lit(0.0)) * spread_multiplier
    cand = F.greatest(cur / mult, c("Conformal_Weather_Band_MWH") * saf, spread)
    risky = (mult > 1.0) | (c("Weather_Input_Risk_Class") != "none")
    cand = F.when(risky & (c("Conformal_Weather_Source") != "insufficient_prior"), cand).otherwise(cur)
    if min_fraction > 0:
        cand = F.greatest(cand, cur * min_fraction)
    if not allow_narrowing:
        cand = F.greatest(cand, cur)
    return out.withColumn("Band", cand).withColumns(interval_columns(base))


def prior_origin_quantiles(errors: DataFrame, origin: str, error: str, by: Sequence[str] = (), quantile: float = 0.80, per_unit: float = 256.0) -> DataFrame:
    """Per origin and level, the error quantile over strictly earlier origins.

    Rows are never paired with origins.  Counts per (level, value bucket, origin),
    combined before the shuffle, are carried to the later origins; their number depends
    on buckets and origins, not on rows.  They place the wanted ranks in a bucket, and
    only the values of such buckets are then folded and counted per origin.
    """
    v = c(error).cast("double")
    bucket = F.floor(F.signum(v) * F.log1p(F.abs(v)) * F.lit(per_unit)).cast("long")
    long = errors.where(v.isNotNull()).select(*by, c(origin).alias("_o"), v.alias("_v"), bucket.alias("_b"), F.inline(level_rows(CONFORMAL_LEVELS)))
    k = [*by, "level", "key"]
    names = errors.select(*by, origin).distinct().groupBy(*by).agg(F.array_sort(F.collect_set(origin)).alias("_all"))  # origins of a replay
    cells = long.groupBy(*k, "_b", "_o").agg(F.count("*").alias("_n"))
    cells = null_safe_join(cells, names, by) if by else cells.withColumn("_all", names.scalar())
    later = cells.withColumn("_t", F.explode(F.filter("_all", lambda t: t > c("_o"))))
    hist = later.groupBy(*k, "_t", "_b").agg(F.sum("_n").alias("_bn"))
    w = Window.partitionBy(*k, "_t")
    hist = hist.withColumns({"_end": F.sum("_bn").over(w.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)), "_tot": F.sum("_bn").over(w)})
    pos = (c("_tot") - 1) * F.lit(float(quantile))
    lo, hi = F.floor(pos).cast("long"), F.ceil(pos).cast("long")
    before = c("_end") - c("_bn")
    want = F.filter(F.array_distinct(F.array(lo, hi)), lambda r: (r < c("_end")) & (r >= before))
    target = materialise(hist.select(*k, "_t", "_b", "_tot", before.alias("_before"), want.alias("_want")).where(F.size("_want") > 0))
    folded = long.join(target.select(*k, "_b").distinct(), [*k, "_b"], "left_semi").groupBy(*k, "_b", "_v", "_o").agg(F.count("*").alias("_n"))
    inside = folded.join(target, [*k, "_b"]).where(c("_o") < c("_t")).groupBy(*k, "_t", "_b", "_v").agg(
        F.sum("_n").alias("_n"), F.first("_tot").alias("_tot"), F.first("_before").alias("_before"), F.first("_want").alias("_want"))
    run = inside.withColumn("_to", F.sum("_n").over(Window.partitionBy(*k, "_t", "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)) + c("_before"))
    hit = F.filter("_want", lambda r: (r < c("_to")) & (r >= c("_to") - c("_n")))
    found = run.select(*k, "_t", "_v", "_tot", F.explode(hit).alias("_r"))
    at = lambda r: F.max(F.when(c("_r") == r, c("_v")))
    out = found.groupBy(*k, "_t").agg((at(lo) + (at(hi) - at(lo)) * F.max(pos - F.floor(pos))).alias("q"), F.max("_tot").alias("count"))
    return out.withColumnRenamed("_t", origin)
