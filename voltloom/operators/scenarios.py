"""Weather scenarios: fan-out, delta caps, stress summary, uncertainty hedge."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..core import group_quantiles
from ..functions import buckets as B
from ..functions.weather import clip
from .metrics import explode_slices
from .weather_features import HEAT_STEPS, add_daily_temperature, add_evening_cooling, add_heat_persistence

c = F.col

# The default scenarios.
SCENARIOS = (
    {"name": "warmer", "temperature_delta_f": 3.0}, {"name": "cooler", "temperature_delta_f": -3.0},
    {"name": "cloudier_solar_loss", "cloud_cover_delta_norm": 0.30, "ghi_multiplier": 0.65},
    {"name": "clearer_high_solar", "cloud_cover_delta_norm": -0.30, "ghi_multiplier": 1.15},
)


def fan_out(frame: DataFrame, scenarios: Sequence[Mapping] = SCENARIOS) -> DataFrame:
    """Every row once per scenario, with the scenario's deltas; a literal array is inlined, no join."""
    parts = F.array(*[F.struct(F.lit(s["name"]).alias("Weather_Scenario_Name"), F.lit(float(s.get("temperature_delta_f") or 0.0)).alias("_dt"),
                               F.lit(float(s.get("cloud_cover_delta_norm") or 0.0)).alias("_dc"), F.lit(float(s.get("ghi_multiplier") or 1.0)).alias("_gm"))
                      for s in scenarios])
    return frame.select("*", F.inline(parts))


def scenario_frame(frame: DataFrame, keys: Sequence[str] = ("series",), scenarios: Sequence[Mapping] = SCENARIOS) -> DataFrame:
    """Shifted temperature, cloud and irradiance, and every column that depends on them, for all scenarios in one job.

    A temperature shift resets the heat index to the temperature itself; a
    scenario without a shift keeps the base columns.
    """
    out = fan_out(frame, scenarios)
    ks = [*keys, "Weather_Scenario_Name"]
    cols = set(frame.columns)
    hot, sun = c("_dt") != 0.0, (c("_dc") != 0.0) | (c("_gm") != 1.0)
    out = out.withColumn("Temperature", c("Temperature") + c("_dt"))
    out = add_daily_temperature(out, ks)
    t, tmax, tmean = c("Temperature"), c("Temperature_DailyMax"), c("Temperature_DailyMean")
    new: dict[str, Column] = {
        "CDD": clip(t - 65.0, lo=0), "HDD": clip(65.0 - t, lo=0), "Temp_Squared": t * t, "Daily_CDD": clip(tmean - 65.0, lo=0),
        "Daily_HDD": clip(65.0 - tmean, lo=0), "DailyMaxTempBin": B.daily_max_bin("Temperature_DailyMax"), "Temp_Bin": B.temp_bin("Temperature"),
        **{f"Extreme_Heat_{s}": F.coalesce(t >= float(s), F.lit(False)).cast("int") for s in HEAT_STEPS},
    }
    if "HeatIndexF" in cols:
        new["HeatIndexF"] = F.when(hot, t).otherwise(c("HeatIndexF"))
    out = out.withColumns(new)
    deps: dict[str, Column] = {"CDD_Squared": c("CDD") * c("CDD"), "HDD_Squared": c("HDD") * c("HDD")}
    if "HeatIndexF" in cols:
        deps["HeatIndex_CDD"] = clip(c("HeatIndexF") - 65.0, lo=0)
    if "IsLikelySystemPeakHour" in cols:
        deps |= {"Cooling_Stress": c("CDD") * c("IsLikelySystemPeakHour"), "DailyMax_x_PeakHour": tmax * c("IsLikelySystemPeakHour")}
    if "Humidity_Norm" in cols:
        deps["Humidity_x_Temp"] = F.coalesce("Humidity_Norm", F.lit(0.0)) * t
    if "WindSpeed_Mph" in cols:
        deps["Wind_x_Temp"] = F.coalesce("WindSpeed_Mph", F.lit(0.0)) * t
    cloud = clip(F.coalesce("CloudCover_Norm", F.lit(0.0)) + c("_dc"), 0.0, 1.0)
    ghi = clip(F.coalesce("GHI_Wm2", F.lit(0.0)) * c("_gm"), lo=0)
    deps |= {"CloudCover_Norm": F.when(sun, cloud).otherwise(c("CloudCover_Norm")), "GHI_Wm2": F.when(sun, ghi).otherwise(c("GHI_Wm2"))}
    out = out.withColumns(deps)
    if {"Solar_Hour_Shape", "Impact_Cap_MW", "BTM_ClearSky_Proxy_MW"} <= cols:
        proxy = clip(F.coalesce("Impact_Cap_MW", F.lit(0.0)) * (c("GHI_Wm2") / 950.0) * F.coalesce("Solar_Hour_Shape", F.lit(0.0)), lo=0)
        out = out.withColumn("BTM_Solar_Proxy_MW", F.when(sun, proxy).otherwise(c("BTM_Solar_Proxy_MW")))
        loss = clip(F.coalesce("BTM_ClearSky_Proxy_MW", F.lit(0.0)) - c("BTM_Solar_Proxy_MW"), lo=0)
        out = out.withColumn("BTM_Solar_Loss_From_ClearSky_MW", F.when(sun, loss).otherwise(c("BTM_Solar_Loss_From_ClearSky_MW")))
    if "WindSpeed_Mph" in cols and "Hour" in cols:
        out = add_evening_cooling(out, ks)
    if "IsLikelySystemPeakHour" in cols:
        heat = [x for x in out.columns if x.startswith(("PriorDay_", "DailyMaxTemp_", "DailyMinTemp_", "DailyMeanTemp_", "Consecutive", "HeatPersistence", "OvernightHeat")) or x == "DailyMax3DayMean_x_PeakHour"]
        out = add_heat_persistence(out.drop(*heat), ks)
    return out.drop("_dt", "_dc", "_gm")


def delta_cap(default: float = 18.0, hot_peak: float | None = None, cloud_solar: float | None = None, long_horizon: float | None = None) -> Column:
    """Largest allowed scenario delta of a row; the long horizon only narrows."""
    h = c("Hour")
    hot, cloudy = h.between(16, 20) & (c("Temperature_DailyMax") >= 90.0), h.between(10, 16) & ((c("CloudCover_Norm") >= 0.60) | (c("BTM_Solar_Loss_From_ClearSky_MW") >= 1.25))
    cap = F.when(cloudy, F.lit(float(default if cloud_solar is None else cloud_solar))).when(hot, F.lit(float(default if hot_peak is None else hot_peak))).otherwise(F.lit(float(default)))
    far = F.lit(float(default if long_horizon is None else long_horizon))
    return F.greatest(F.when(c("Forecast_Day").between(8, 16), F.least(cap, far)).otherwise(cap), F.lit(0.0))


def cap_deltas(df: DataFrame, scenario_cols: Sequence[str], base: str, cap: Column) -> DataFrame:
    """Bound each scenario to base +- cap (never below 0) and flag rows where any was bounded."""
    out = df.withColumn("_cap", cap)
    d = {x: c(x) - c(base) for x in scenario_cols}
    bounded = {x: F.least(F.greatest(v, -c("_cap")), c("_cap")) for x, v in d.items()}
    hit = F.lit(False)
    for x in scenario_cols:
        hit = hit | F.coalesce(F.abs(d[x]) > c("_cap") + 1e-9, F.lit(False))
    new = {x: F.when(c(x).isNotNull(), clip(c(base) + bounded[x], lo=0.0)) for x in scenario_cols}
    return out.withColumns({**new, "WeatherScenario_Cap_Applied": hit.cast("int")}).drop("_cap")


def add_scenario_summary(df: DataFrame, scenario_cols: Sequence[str], base: str) -> DataFrame:
    xs = [c(x) for x in scenario_cols]
    lo, hi = F.least(*xs), F.greatest(*xs)
    return df.withColumns({"WeatherScenario_Min_P50_MWH": lo, "WeatherScenario_Max_P50_MWH": hi, "WeatherScenario_Spread_MWH": hi - lo, "WeatherScenario_HalfSpread_MWH": (hi - lo) / 2.0,
                           "WeatherScenario_MaxAbsDelta_MWH": F.coalesce(F.greatest(*[F.abs(x - c(base)) for x in xs]), F.lit(0.0))})


def half_spread(scenario_cols: Sequence[str]) -> Column:
    xs = [c(x) for x in scenario_cols]
    return F.coalesce((F.greatest(*xs) - F.least(*xs)) / 2.0, F.lit(0.0))


def stress_slices() -> dict[str, Column]:
    h, d = c("Hour"), c("Forecast_Day")
    return {"Overall": F.lit(True), "PeakWindow_HE14to18": h.between(14, 18), "HotPeak_HE16to20_90FPlus": h.between(16, 20) & (c("Temperature_DailyMax") >= 90.0),
            "CloudSolarMidday": h.between(10, 16) & ((c("CloudCover_Norm") >= 0.60) | (c("BTM_Solar_Loss_From_ClearSky_MW") >= 1.25)), "LongHorizon_Days8to16": d.between(8, 16),
            "Horizon_Day1": d == 1, "Horizon_Days2to3": d.between(2, 3), "Horizon_Days4to7": d.between(4, 7), "Horizon_Days8to16": d.between(8, 16)}


def stress_summary(df: DataFrame, scenarios: Mapping[str, str], base: str) -> DataFrame:
    """Mean, mean absolute, P90 and largest delta per scenario and slice, and capped rows."""
    s = explode_slices(df, stress_slices())
    parts = F.array(*[F.struct(F.lit(n).alias("Scenario"), (c(x) - c(base)).alias("_d")) for n, x in scenarios.items()])
    long = s.select("Slice", "WeatherScenario_Cap_Applied", F.inline(parts)).where("_d is not null").withColumn("_ad", F.abs("_d"))
    g = long.groupBy("Scenario", "Slice").agg(F.count("*").alias("N"), F.avg("_d").alias("MeanDelta_MWH"), F.avg("_ad").alias("MeanAbsDelta_MWH"), F.max("_ad").alias("MaxAbsDelta_MWH"),
                                              F.count(F.when(c("WeatherScenario_Cap_Applied") > 0, 1)).alias("CapHitRows"))
    return g.join(group_quantiles(long, ["Scenario", "Slice"], "_ad", {"P90AbsDelta_MWH": 0.9}), ["Scenario", "Slice"])


# Daily-max temperature MAE by lead day, and MAE to standard deviation.
MAE_BY_LEAD_F = {1: 1.94, 2: 1.00, 3: 1.92, 4: 2.36, 5: 4.11, 6: 4.69, 7: 6.30}
MAE_TO_SIGMA = 1.2533


def robustness_hedge(df: DataFrame, base: str, warmer: str, cooler: str, lead: str = "Forecast_Day", mae_by_lead: Mapping[int, float] | None = None, bias_by_lead: Mapping[int, float] | None = None,
                     hours: Sequence[int] = tuple(range(13, 22)), min_temp: float = 88.0, min_day: int = 1, max_day: int = 16, delta_f: float = 3.0, jensen_scale: float = 2.0,
                     upper_blend: float = 0.30, cap: float = 16.0, warmer_bound: float = 1.25, ref_lead: int = 7, min_damping: float = 0.35) -> DataFrame:
    """One-sided peak hedge from the scenario curvature and the lead's temperature uncertainty; never negative, bounded by cap and warmer uplift."""
    mae = dict(mae_by_lead or MAE_BY_LEAD_F)
    far = max(mae)
    ref = mae.get(ref_lead, mae[far]) * MAE_TO_SIGMA

    def by_lead(table: Mapping[int, float], default: float) -> Column:
        m = F.create_map(*[x for k, v in table.items() for x in (F.lit(int(k)), F.lit(float(v)))])
        return F.coalesce(F.try_element_at(m, F.round(c(lead)).cast("int")), F.lit(float(default)))

    sigma = by_lead(mae, mae[far]) * MAE_TO_SIGMA
    bias = by_lead(bias_by_lead, bias_by_lead.get(far, 0.0)) if bias_by_lead else F.lit(0.0)
    damp = clip(1.0 - F.greatest(bias, F.lit(0.0)) / sigma, min_damping, 1.0)
    wd, cd = c(warmer) - c(base), c(cooler) - c(base)
    up = F.greatest(wd, F.lit(0.0))
    jensen = 0.5 * sigma * sigma * ((wd + cd) / (delta_f**2)) * jensen_scale * damp
    upper = upper_blend * (sigma / ref) * up * damp
    gate = c("Hour").isin(*hours) & (c("Temperature_DailyMax") >= min_temp) & c("Forecast_Day").between(min_day, max_day)
    raw = F.least(F.greatest(jensen + upper, F.lit(0.0)), F.lit(float(cap)), up * warmer_bound)
    ok = F.coalesce(gate, F.lit(False)) & wd.isNotNull() & cd.isNotNull()
    out = df.withColumn("Weather_Robustness_Hedge_MWH", F.when(ok, raw).otherwise(0.0))
    h = c("Weather_Robustness_Hedge_MWH")
    return out.withColumns({"Weather_Robustness_Hedge_Source": F.when(h > 0, "weather_uncertainty_peak_hedge").otherwise("none"), "Hedged_Forecast_MWH": clip(c(base) + h, lo=0.0)})
