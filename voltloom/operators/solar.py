"""Solar export chain: capacity, shapes, physics, quality, calibration factors, slice metrics.

Sign here is forecast - actual (the load side uses the opposite).
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..core import cut_right, group_quantiles, join_small, keep_last, null_safe_join, safe_div
from ..core.scratch import materialise
from ..functions.clock import utc_offset_hours
from ..functions.weather import clip

c = F.col
INTERVAL_HOURS = 0.25


def segment_of(meter_type: Column | str, rate: Column | str) -> Column:
    """Customer segment from meter type and rate schedule."""
    m = F.upper(F.trim(F.coalesce(c(meter_type) if isinstance(meter_type, str) else meter_type, F.lit(""))))
    r = F.upper(F.trim(F.coalesce(c(rate) if isinstance(rate, str) else rate, F.lit(""))))
    nem = m.isin("AMI_NET", "AMI_NET_D")
    solar = m.contains("SLR2") | m.contains("TSL2") | r.startswith("E2") | r.contains("SL")
    return F.when(nem, "NEM").when(solar, "SOLAR_2_0").otherwise("OTHER")


# ---- position and physics -----------------------------------------------------------------------

# Fourier terms of the equation of time (minutes, times 229.18) and the declination (radians): constant, then (cos, sin) per harmonic.
EQ_TIME = (0.000075, ((0.001868, -0.032077), (-0.014615, -0.040849)))
DECLINATION = (0.006918, ((-0.399912, 0.070257), (-0.006758, 0.000907), (-0.002697, 0.00148)))
GROUND_ALBEDO, PV_TEMP_COEF, PV_NOCT_C, PV_WIND_COOLING = 0.20, -0.004, 45.0, 0.35


def _fourier(terms, g: Column) -> Column:
    out = F.lit(terms[0])
    for k, (a, b) in enumerate(terms[1], 1):
        out = out + a * F.cos(g * k) + b * F.sin(g * k)
    return out


def solar_position(local_start: Column, lat: Column | float, lon: Column | float, utc_offset: Column) -> tuple[Column, Column]:
    """(elevation, azimuth) in degrees at the middle of a quarter hour that starts at a local clock time."""
    lat = lat if isinstance(lat, Column) else F.lit(float(lat))
    lon = lon if isinstance(lon, Column) else F.lit(float(lon))
    mid = local_start + F.expr("INTERVAL 450 SECONDS")
    hours = F.hour(mid) + F.minute(mid) / 60.0 + F.second(mid) / 3600.0
    g = F.lit(2.0 * math.pi / 365.0) * (F.dayofyear(mid) - 1.0 + (hours - 12.0) / 24.0)
    eqt, dec = F.lit(229.18) * _fourier(EQ_TIME, g), _fourier(DECLINATION, g)
    tst = F.pmod(hours * 60.0 + eqt + 4.0 * lon - 60.0 * utc_offset, F.lit(1440.0))
    ha, la = F.radians(tst / 4.0 - 180.0), F.radians(lat)
    elev = F.asin(F.sin(la) * F.sin(dec) + F.cos(la) * F.cos(dec) * F.cos(ha))
    az = F.pmod(F.atan2(F.sin(ha), F.cos(ha) * F.sin(la) - F.tan(dec) * F.cos(la)) + math.pi, F.lit(2.0 * math.pi))
    return F.degrees(elev), F.degrees(az)


def local_utc_offset(local_start: Column, tz: str) -> Column:
    """Offset of ``tz`` at a local clock time, in hours."""
    return utc_offset_hours(F.to_utc_timestamp(local_start, tz), tz)


def zero_low_sun(df: DataFrame, elevation: str, min_elevation: float, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({x: F.when(c(elevation) < min_elevation, 0.0).otherwise(c(x)) for x in cols})


def default_weather(df: DataFrame, keys: Sequence[str] = ("series",)) -> DataFrame:
    """Fill unit pairs from each other, bound the ranges, and take the key's median and constants for what is left."""
    med = group_quantiles(df, keys, "Temperature2m_C", {"_median_c": 0.5})
    ghi = clip(F.coalesce(c("GHI_kWh_per_m2"), c("WeatherGHI_Wm2") / 1000.0), lo=0)
    out = null_safe_join(df, med, keys).withColumns({"GHI_kWh_per_m2": ghi, "Temperature2m_C": F.coalesce(c("Temperature2m_C"), c("_median_c"), F.lit(25.0)), "WindSpeed10m_mps": F.coalesce(clip("WindSpeed10m_mps", lo=0), F.lit(0.0)),
                          "CloudCoverPct": F.coalesce(clip("CloudCoverPct", 0, 100), F.lit(0.0))})
    return out.withColumn("WeatherGHI_Wm2", F.coalesce(c("WeatherGHI_Wm2"), c("GHI_kWh_per_m2") * 1000.0)).drop("_median_c")


def add_physics(df: DataFrame, tilt: float = 25.0, azimuth: float = 180.0) -> DataFrame:
    """Clear-sky index, plane-of-array irradiance, cell temperature, derate and kWh per kW; needs sun position and irradiance columns."""
    zc = clip(F.sin(F.radians("SolarElevationDeg")), lo=0)
    sky = F.when(zc > 0, 1098.0 * zc * F.exp(-0.059 / F.greatest(zc, F.lit(0.065)))).otherwise(0.0)
    out = df.withColumns({"ClearSkyGHI_Wm2": sky, "_zc": zc})
    out = out.withColumn("ClearSkyIndex", F.coalesce(clip(safe_div(c("WeatherGHI_Wm2"), c("ClearSkyGHI_Wm2")), 0, 1.6), F.lit(0.0)))
    ghi = F.coalesce(clip("WeatherGHI_Wm2", lo=0), F.lit(0.0))
    share = clip(0.25 + 0.55 * (1.0 - clip("ClearSkyIndex", 0, 1)), 0.20, 0.85)
    diffuse = F.coalesce(clip("DiffuseRadiation_Wm2", lo=0), ghi * share)
    direct = F.coalesce(clip("DirectRadiation_Wm2", lo=0), clip(ghi - diffuse, lo=0))
    t, a = math.radians(tilt), math.radians(azimuth)
    zen = F.radians(90.0 - c("SolarElevationDeg"))
    inc = clip(F.cos(zen) * math.cos(t) + F.sin(zen) * math.sin(t) * F.cos(F.radians("SolarAzimuthDeg") - a), 0, 1)
    geo = F.coalesce(clip(safe_div(inc, c("_zc")), 0, 4), F.lit(0.0))
    dni = clip("DirectNormalIrradiance_Wm2", lo=0)
    out = out.withColumns({"IncidenceAngleCos": inc, "DirectPOA_Wm2": F.coalesce(dni * inc, direct * geo), "DiffusePOA_Wm2": diffuse * (1.0 + math.cos(t)) / 2.0})
    poa = c("DirectPOA_Wm2") + c("DiffusePOA_Wm2") + ghi * GROUND_ALBEDO * (1.0 - math.cos(t)) / 2.0
    out = out.withColumn("PlaneOfArrayIrradiance_Wm2", clip(F.coalesce(clip("GlobalTiltedIrradiance_Wm2", lo=0), clip(poa, lo=0)), lo=0))
    p = c("PlaneOfArrayIrradiance_Wm2")
    cell = c("Temperature2m_C") + (p / 800.0) * (PV_NOCT_C - 20.0) - clip("WindSpeed10m_mps", lo=0) * PV_WIND_COOLING
    out = out.withColumns({"PlaneOfArray_kWh_per_m2": p / 1000.0, "CellTemperature_C": F.coalesce(cell, c("Temperature2m_C"), F.lit(25.0))})
    out = out.withColumn("TemperatureDerate", clip(1.0 + PV_TEMP_COEF * (c("CellTemperature_C") - 25.0), 0.70, 1.08))
    return out.withColumn("PVWatts_kWh_per_kW", clip(c("PlaneOfArray_kWh_per_m2") * c("TemperatureDerate"), lo=0)).drop("_zc")


# ---- rollups ------------------------------------------------------------------------------------

def weighted_by_capacity(weather: DataFrame, weights: DataFrame, key: str, time: str, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Capacity-weighted mean per time of each column, nulls skipped column by column; the plain mean where no weight is positive."""
    w = weights.groupBy(key).agg(F.sum(F.when(c("capacity_kw") > 0, c("capacity_kw"))).alias("_w"))
    j = weather.join(w, key, "left")
    ok = c("_w") > 0

    def mean(x: str) -> Column:
        num, den = F.sum(F.when(ok, c(x) * c("_w"))), F.sum(F.when(ok & c(x).isNotNull(), c("_w")))
        return F.when(F.max(F.when(ok, 1)).isNull(), F.avg(x)).otherwise(safe_div(num, den)).alias(x)

    return j.groupBy(*by, time).agg(*[mean(x) for x in cols])


def hourly_mean(weather: DataFrame, time: str, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    return weather.groupBy(*by, time).agg(*[F.avg(x).alias(x) for x in cols])


def collapse_segments(segmented: DataFrame, time: str = "IntervalStartDT", energy: str = "Export_kWh", source: str = "ExportSource") -> DataFrame:
    """Segments summed to one series; the distinct source names, sorted, joined with '+'."""
    return segmented.groupBy(time).agg(F.sum(energy).alias(energy), F.array_join(F.array_sort(F.collect_set(source)), "+").alias(source))


def to_hourly(intervals: DataFrame, by: Sequence[str] = (), energy: str = "Forecast_kWh", power: str = "Forecast_kW", fill_gaps: bool = False) -> DataFrame:
    """Quarter-hours to hours: energy summed, power averaged and its maximum, MW; optionally every hour of each span."""
    g = intervals.groupBy(*by, F.date_trunc("hour", "IntervalStartDT").alias("HourDT")).agg(F.sum(energy).alias(energy), F.avg(power).alias(power), F.max(power).alias(f"Max_{power}"))
    g = g.withColumn("MW", c(energy) / 1000.0)
    if not fill_gaps:
        return g
    span = g.groupBy(*by).agg(F.explode(F.sequence(F.min("HourDT"), F.max("HourDT"), F.expr("INTERVAL 1 HOUR"))).alias("HourDT")) if by else g.agg(
        F.explode(F.sequence(F.min("HourDT"), F.max("HourDT"), F.expr("INTERVAL 1 HOUR"))).alias("HourDT"))
    return span.join(g, [*by, "HourDT"], "left").withColumns({energy: F.coalesce(energy, F.lit(0.0)), "MW": F.coalesce("MW", F.lit(0.0))})


def active_capacity(dates: DataFrame, sites: DataFrame, by: Sequence[str] = (), first: str = "_first") -> DataFrame:
    """Capacity in service per date: sites count from their interconnection date, none earlier than the first date; bounded by the total."""
    span = dates.groupBy(*by).agg(F.min("Date").alias(first)) if by else dates.agg(F.min("Date").alias(first))
    s = sites.where(c("capacity_kw") > 0)
    s = s.join(span, list(by)) if by else s.withColumn(first, span.scalar())
    eff = F.when(c("InterconnectionDate").isNull() | (c("InterconnectionDate") < c(first)), c(first)).otherwise(c("InterconnectionDate"))
    inc = s.groupBy(*by, eff.alias("Date")).agg(F.sum("capacity_kw").alias("_add"))
    days = dates.select(*by, "Date").distinct().withColumn("_want", F.lit(1))
    grid = days.join(inc, [*by, "Date"], "full_outer")
    # one row per date (and key): bounded by the calendar
    w = Window.partitionBy(*(by or [F.lit(0)])).orderBy("Date").rowsBetween(Window.unboundedPreceding, 0)
    return grid.withColumn("ActiveCapacity_kW", F.coalesce(F.sum("_add").over(w), F.lit(0.0))).where("_want = 1").select(*by, "Date", "ActiveCapacity_kW")


def daily_shape(intervals: DataFrame, power: str, by: Sequence[str] = (), method: str = "upper-quantile", q: float = 0.75) -> DataFrame:
    """Power by quarter-hour slot: each day over its own peak, mean, median or upper quantile per slot, scaled to the reference peak; all 96 slots."""
    p = {"median": 0.5, "upper-quantile": q}.get(method)
    x = intervals.select(*by, F.to_date("IntervalStartDT").alias("_d"), (F.hour("IntervalStartDT") * 4 + F.floor(F.minute("IntervalStartDT") / 15)).cast("int").alias("slot"), F.coalesce(c(power), F.lit(0.0)).alias("_v"))
    slots = x.select(*by).distinct().select(*by, F.explode(F.sequence(F.lit(0), F.lit(95))).alias("slot")) if by else x.sparkSession.range(96).select(c("id").cast("int").alias("slot"))
    if method == "mean":
        m = x.groupBy(*by, "slot").agg(F.avg("_v").alias("Average_kW"))
        return slots.join(m, [*by, "slot"], "left").withColumn("Average_kW", F.coalesce("Average_kW", F.lit(0.0)))
    peaks = x.groupBy(*by, "_d").agg(F.max("_v").alias("_peak")).where("_peak > 0")
    norm = null_safe_join(x, peaks, [*by, "_d"], "inner").withColumn("_n", c("_v") / c("_peak"))
    per_slot = group_quantiles(norm, [*by, "slot"], "_n", {"_q": p})
    ref = group_quantiles(peaks, by, "_peak", {"_ref": p})
    full = slots.join(per_slot, [*by, "slot"], "left")
    top = F.max("_q").over(Window.partitionBy(*(by or [F.lit(0)])))  # 96 rows a key
    full = full.withColumn("_top", top)
    full = full.join(ref, list(by), "left") if by else full.withColumn("_ref", ref.scalar())
    val = F.when(c("_top") > 0, F.coalesce(c("_q"), F.lit(0.0)) / c("_top") * c("_ref")).otherwise(0.0)
    return full.select(*by, "slot", F.coalesce(val, F.lit(0.0)).alias("Average_kW"))


def intrahour_shape(intervals: DataFrame, energy: str, by: Sequence[str] = (), method: str = "upper-quantile", q: float = 0.75) -> DataFrame:
    """Share of each quarter in its hour's energy by hour of day; shares of an hour sum to one, 0.25 each where unknown."""
    dt = c("IntervalStartDT")
    x = intervals.select(*by, F.date_trunc("hour", dt).alias("_h"), F.hour(dt).alias("hour"), (F.floor(F.minute(dt) / 15) * 15).cast("int").alias("minute"), F.coalesce(c(energy), F.lit(0.0)).alias("_v"))
    tot = x.groupBy(*by, "_h").agg(F.sum("_v").alias("_t")).where("_t > 0")
    share = null_safe_join(x, tot, [*by, "_h"], "inner").withColumn("_s", c("_v") / c("_t"))
    k = [*by, "hour", "minute"]
    obs = share.groupBy(*k).agg(F.avg("_s").alias("_q")) if method == "mean" else group_quantiles(share, k, "_s", {"_q": 0.5 if method == "median" else q})
    spark = intervals.sparkSession
    quarters = F.explode(F.array(*[F.lit(m) for m in (0, 15, 30, 45)])).alias("minute")
    if by:
        grid = intervals.select(*by).distinct().select(*by, F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour")).select(*by, "hour", quarters)
    else:
        grid = spark.range(24).select(c("id").cast("int").alias("hour"), quarters)
    full = grid.join(obs, k, "left")
    s = F.sum("_q").over(Window.partitionBy(*by, "hour"))
    return full.withColumn("_sum", s).select(*k, F.when(c("_sum") > 0, F.coalesce(c("_q"), F.lit(0.0)) / c("_sum")).otherwise(0.25).alias("IntraHourCoefficient"))


# Shape of high-output hours and its share.
PEAK_SHAPE = {0: 0.20, 15: 0.24, 30: 0.27, 45: 0.29}
PEAK_SHAPE_SHARE = 0.4


def fan_to_quarters(hourly: DataFrame, shape: DataFrame, by: Sequence[str] = (), peak_quantile: float | None = 0.90, min_elevation: float = 25.0) -> DataFrame:
    """Hours to quarter-hours by the intra-hour shape; the hours with the highest output blend a fixed shape and are renormalised.

    The shape is gathered to one row per hour of day with an array of quarters,
    so the hours meet one small join and then inline four rows each.
    """
    arr = shape.groupBy(*by, "hour").agg(F.array_sort(F.collect_list(F.struct("minute", c("IntraHourCoefficient").alias("k")))).alias("_q"))
    j = hourly.withColumn("hour", F.hour("IntervalStartDT")).join(arr, [*by, "hour"], "left")
    if peak_quantile is not None:
        thr = group_quantiles(hourly, by, "Hourly_kWh", {"_thr": peak_quantile})
        j = null_safe_join(j, thr, by) if by else j.withColumn("_thr", thr.scalar())
        high = F.coalesce((c("_thr") > 0) & (c("Hourly_kWh") >= c("_thr")) & (c("SolarElevationDeg") >= min_elevation), F.lit(False))
        fixed = F.create_map(*[x for m, v in PEAK_SHAPE.items() for x in (F.lit(m), F.lit(v))])
        mixed = F.transform("_q", lambda x: F.struct(x["minute"].alias("minute"), ((1 - PEAK_SHAPE_SHARE) * x["k"] + PEAK_SHAPE_SHARE * F.element_at(fixed, x["minute"])).alias("k")))
        total = F.aggregate(mixed, F.lit(0.0), lambda acc, x: acc + x["k"])
        j = j.withColumn("_q", F.when(high, F.transform(mixed, lambda x: F.struct(x["minute"].alias("minute"), (x["k"] / total).alias("k")))).otherwise(c("_q"))).drop("_thr")
    out = j.select(*[x for x in j.columns if x not in ("_q",)], F.inline("_q"))
    e = c("Hourly_kWh") * c("k")
    return out.withColumns({"IntervalStartDT": c("IntervalStartDT") + F.make_dt_interval(mins=c("minute")), "Forecast_kWh": e, "Forecast_kW": e / INTERVAL_HOURS}).drop("k", "minute", "hour")


def export_intervals(readings: DataFrame, sites: DataFrame, lookup: DataFrame, start: str, end: str, by: Sequence[str] = ()) -> DataFrame:
    """Quarter-hour export of eligible sites.

    One file per (service point, source, month): most rows, then newest, then
    highest id.  Negative net readings are export.  Copies of an interval keep
    the last reading; energy is then summed over service points.
    """
    eligible = lookup.join(sites.select("location").distinct(), "location", "left_semi")
    best = keep_last(eligible, ["spid", "source", "month"], ["row_count", "modified", "file_id"]).select("spid", "source", "month", "file_id", "location")
    r = readings.withColumn("IntervalStartDT", c("EndDT") - F.expr("INTERVAL 15 MINUTES"))
    r = r.where((c("IntervalStartDT") >= F.lit(start).cast("timestamp")) & (c("IntervalStartDT") < F.lit(end).cast("timestamp")))
    r = r.join(best, ["spid", "source", "month", "file_id"], "inner")
    kwh = F.when(c("source") == "NET_NEGATIVE", clip(-c("kwh"), lo=0)).otherwise(clip("kwh", lo=0))
    one = keep_last(r.withColumn("Export_kWh", kwh).where("Export_kWh is not null").select("spid", "source", "IntervalStartDT", "Export_kWh", "seq", *[b for b in by if b != "source"]),
                    ["spid", "source", "IntervalStartDT"], ["seq"])
    g = one.groupBy("IntervalStartDT", *by).agg(F.sum("Export_kWh").alias("Export_kWh"), F.array_join(F.array_sort(F.collect_set("source")), "+").alias("ExportSource"))
    return g.withColumn("Export_kW", c("Export_kWh") / INTERVAL_HOURS)


# ---- quality ------------------------------------------------------------------------------------

def quality_flags(df: DataFrame, actual: str, expected: str, ratio_limit: float, reads: str | None = None, by: Sequence[str] = (), min_expected: float = 2500.0, min_ghi: float = 0.35,
                  min_csi: float = 0.55, min_bad_hours: int = 2, read_limit: float = 0.25) -> DataFrame:
    """Hours whose actual is implausibly low under high sun, and whole days with enough of them."""
    ratio = F.coalesce(c(actual), F.lit(0.0)) / F.when(c(expected) > 0, c(expected))
    sun = (c(expected) >= min_expected) & (c("GHI_kWh_per_m2") >= min_ghi)
    phys = F.coalesce(sun & (c("ClearSkyIndex") >= min_csi) & (ratio <= ratio_limit), F.lit(False))
    out = df.withColumns({"ActualToExpectedRatio": ratio, "_d": F.to_date("IntervalStartDT")})
    if reads is not None:
        typical = group_quantiles(df.where(c(reads) > 0), by, reads, {"_typ": 0.90})
        out = null_safe_join(out, typical, by) if by else out.withColumn("_typ", typical.scalar())
        out = out.withColumn("ActualReadCoverageRatio", safe_div(c(reads).cast("double"), c("_typ"))).drop("_typ")
        cov = F.coalesce(sun & (c("ActualReadCoverageRatio") <= read_limit), F.lit(False))
        sus = cov | (phys & (c("ActualToExpectedRatio") <= ratio_limit * 0.5))
    else:
        out, sus = out.withColumn("ActualReadCoverageRatio", F.lit(None).cast("double")), phys
    out = out.withColumn("ActualQualitySuspiciousHour", sus)
    day = out.groupBy(*by, "_d").agg(F.count(F.when(c("ActualQualitySuspiciousHour"), 1)).alias("_bad"))
    if reads is not None:
        day = null_safe_join(day, group_quantiles(out, [*by, "_d"], "ActualReadCoverageRatio", {"_med": 0.5}), [*by, "_d"])
    bad = c("_bad") >= max(1, min_bad_hours)
    if reads is not None:
        bad = bad & F.coalesce(c("_med") <= read_limit, F.lit(False))
    out = null_safe_join(out, day.select(*by, "_d", bad.alias("_badday")), [*by, "_d"])
    ex = c("ActualQualitySuspiciousHour") | c("_badday")
    return out.withColumns({"SolarBacktestExcluded": ex, "ActualQualityFlag": F.when(ex, "AMI_SUPPRESSED_ACTUAL").otherwise("OK")}).drop("_d", "_badday")


def usable_days(df: DataFrame, min_forecast_kwh: float, min_coverage: float, min_ratio: float, min_day_mwh: float, by: Sequence[str] = ()) -> DataFrame:
    """Rows of days with enough observed daylight hours and energy; a key whose days would all go keeps everything."""
    day = F.to_date("IntervalStartDT")
    lit = df.where(F.coalesce(c("Forecast_kWh"), F.lit(0.0)) >= min_forecast_kwh).groupBy(*by, day.alias("_d")).agg(
        F.count("Forecast_kWh").alias("_e"), F.count("Actual_kWh").alias("_o"), F.sum("Actual_kWh").alias("_a"), F.sum("Forecast_kWh").alias("_f"))
    ok = (c("_o") / c("_e") >= min_coverage) & ((c("_f") < min_day_mwh * 1000.0) | (F.coalesce(safe_div(c("_a"), c("_f")), F.lit(0.0)) >= min_ratio))
    flags = lit.select(*by, "_d", ok.alias("_ok"))
    rows = null_safe_join(df.withColumn("_d", day), flags, [*by, "_d"])
    any_ok = flags.groupBy(*by).agg(F.bool_or("_ok").alias("_any")) if by else flags.agg(F.bool_or("_ok").alias("_any"))
    rows = null_safe_join(rows, any_ok, by) if by else rows.withColumn("_any", any_ok.scalar())
    return rows.where(F.coalesce(c("_ok"), F.lit(False)) | ~F.coalesce(c("_any"), F.lit(False))).drop("_d", "_ok", "_any")


# ---- calibration factors ------------------------------------------------------------------------

# Regime bins and labels.
CSI_BINS, CSI_LABELS = (-0.01, 0.20, 0.50, 0.80, 1.05, 1.60), ("csi_000_020", "csi_020_050", "csi_050_080", "csi_080_105", "csi_105_160")
CLOUD_BINS, CLOUD_LABELS = (-1.0, 30.0, 70.0, 100.0), ("cloud_000_030", "cloud_030_070", "cloud_070_100")
ELEV_BINS, ELEV_LABELS = (-90.0, 15.0, 35.0, 90.0), ("elev_low", "elev_mid", "elev_high")


def add_regime_keys(df: DataFrame) -> DataFrame:
    csi = cut_right(clip(F.coalesce("ClearSkyIndex", F.lit(0.0)), 0, 1.6), CSI_BINS, CSI_LABELS)
    cloud = cut_right(clip(F.coalesce("CloudCoverPct", F.lit(0.0)), 0, 100), CLOUD_BINS, CLOUD_LABELS)
    elev = cut_right(clip(F.coalesce("SolarElevationDeg", F.lit(90.0)), -90, 90), ELEV_BINS, ELEV_LABELS)
    return df.withColumns({"RegimeKey": F.concat(F.lit("regime|"), csi, F.lit("|"), cloud, F.lit("|"), elev), "RegimeFallbackKey": F.concat(F.lit("csi|"), csi)})


def _keyed(df: DataFrame, by: Sequence[str], cols: Sequence[str]) -> DataFrame:
    return df.select(*by, *cols, F.explode(F.array("RegimeKey", "RegimeFallbackKey")).alias("key"))


def regime_factors(df: DataFrame, forecast: str, actual: str = "Actual_kWh", by: Sequence[str] = (), min_rows: int = 12, min_mwh: float = 10.0, prior_mwh: float = 50.0, lo: float = 0.85, hi: float = 1.15) -> DataFrame:
    """(actual + prior) / (forecast + prior) per regime and per clear-sky fallback, bounded; thin regimes are left out."""
    w = add_regime_keys(df.where((c(actual) >= 0) & (c(forecast) > 0)))
    g = _keyed(w, by, [actual, forecast]).groupBy(*by, "key").agg(F.count("*").alias("rows"), F.sum(actual).alias("_a"), F.sum(forecast).alias("_f"))
    p = prior_mwh * 1000.0
    return g.where((c("rows") >= min_rows) & (c("_f") >= min_mwh * 1000.0)).select(*by, "key", "rows", clip((c("_a") + p) / (c("_f") + p), lo, hi).alias("factor"))


def lookup_regime(df: DataFrame, factors: DataFrame, by: Sequence[str] = (), out: str = "RegimeCalibrationFactor") -> DataFrame:
    """Exact regime, then clear-sky fallback, then 1."""
    k = add_regime_keys(df)
    f = materialise(factors.select(*by, "key", "factor"))
    a = k.join(f.withColumnsRenamed({"key": "RegimeKey", "factor": "_x"}), [*by, "RegimeKey"], "left")
    b = a.join(f.withColumnsRenamed({"key": "RegimeFallbackKey", "factor": "_y"}), [*by, "RegimeFallbackKey"], "left")
    return b.withColumn(out, F.coalesce("_x", "_y", F.lit(1.0))).drop("_x", "_y", "RegimeKey", "RegimeFallbackKey")


def prune_factors(holdout: DataFrame, factors: DataFrame, forecast: str, actual: str = "Actual_kWh", by: Sequence[str] = (), min_rows: int = 12, min_mwh: float = 10.0, gain: float = 0.0005) -> DataFrame:
    """Factors that lower the weighted error of their own holdout rows by at least ``gain``."""
    w = add_regime_keys(holdout.where((c(actual) >= 0) & (c(forecast) > 0)))
    j = _keyed(w, by, [actual, forecast]).join(materialise(factors.select(*by, "key", "factor")), [*by, "key"])
    g = j.groupBy(*by, "key", "factor").agg(F.count("*").alias("_n"), F.sum(forecast).alias("_f"), F.sum(actual).alias("_a"), F.sum(F.abs(c(forecast) - c(actual))).alias("_e0"), F.sum(F.abs(c(forecast) * c("factor") - c(actual))).alias("_e1"))
    return g.where((c("_n") >= min_rows) & (c("_f") >= min_mwh * 1000.0) & (c("_a") > 0) & (c("_e1") / c("_a") <= c("_e0") / c("_a") - gain)).select(*by, "key", "factor")


def month_factors(df: DataFrame, forecast: str, actual: str = "Actual_kWh", by: Sequence[str] = (), prior_mwh: float = 100.0, lo: float = 0.9, hi: float = 1.1) -> DataFrame:
    """Month energy factors pulled to the bounded overall factor by a prior."""
    w = df.where((c(actual) >= 0) & (c(forecast) > 0))
    m = w.groupBy(*by, F.month("IntervalStartDT").alias("Month")).agg(F.sum(actual).alias("_a"), F.sum(forecast).alias("_f"))
    win = Window.partitionBy(*(by or [F.lit(0)]))  # at most 12 rows a key
    agg = clip(F.sum("_a").over(win) / F.sum("_f").over(win), lo, hi)
    p = prior_mwh * 1000.0
    return m.withColumn("aggregate_factor", agg).select(*by, "Month", clip((c("_a") + p * c("aggregate_factor")) / (c("_f") + p), lo, hi).alias("factor"), "aggregate_factor")


def lookup_month(df: DataFrame, factors: DataFrame, by: Sequence[str] = (), out: str = "SeasonalCalibrationFactor") -> DataFrame:
    """Factor of the row's month, or of the nearest month that has one (the earlier on ties)."""
    table = factors.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(c("Month").alias("m"), c("factor").alias("f")))).alias("_t"))
    j = null_safe_join(df, table, by) if by else df.withColumn("_t", table.scalar())
    near = F.array_min(F.transform("_t", lambda x: F.struct(F.abs(x["m"] - F.month("IntervalStartDT")).alias("d"), x["m"].alias("m"), x["f"].alias("f"))))
    return j.withColumn(out, F.coalesce(near["f"], F.lit(1.0))).drop("_t")


def peak_params(df: DataFrame, actual_kw: str, forecast_kw: str, capacity: str, q: float = 0.95, lo: float = 0.8, target: float = 1.0, min_rows: int = 12, min_mwh: float = 1.0, by: Sequence[str] = ()) -> DataFrame:
    """Upper-tail capacity-factor threshold and the peak factor; factor 1 and no threshold when the tail is thin or no cut is needed."""
    gk = list(by) or ["_all"]
    w = df.where((c(actual_kw) >= 0) & (c(forecast_kw) > 0) & (c(capacity) > 0)).withColumn("_cf", c(forecast_kw) / c(capacity))
    w = w if by else w.withColumn("_all", F.lit(1))
    thr = group_quantiles(w, gk, "_cf", {"threshold_cf": q})
    j = join_small(w, thr, gk)
    top = c("_cf") >= c("threshold_cf")
    g = j.groupBy(*gk, "threshold_cf").agg(F.count(F.when(top, 1)).alias("_n"), F.sum(F.when(top, c(forecast_kw))).alias("_f"), F.max(actual_kw).alias("_a"), F.max(forecast_kw).alias("_p"))
    raw = clip(target * c("_a") / c("_p"), lo, 1.0)
    use = (c("_n") >= min_rows) & (c("_f") / 1000.0 >= min_mwh) & (c("_a") > 0) & (c("_p") > 0) & (raw < 1.0 - 0.001)
    return g.select(*by, F.when(use, raw).otherwise(1.0).alias("peak_factor"), F.when(use, c("threshold_cf")).alias("threshold_cf"))


def apply_calibration(df: DataFrame, base_kwh: str = "Forecast_kWh", base_kw: str = "Forecast_kW", capacity: str = "ActiveCapacity_kW") -> DataFrame:
    """Product of residual, month, regime and peak factors on rows with energy; other rows become 0 with factor 1.

    ``peak_factor`` and ``threshold_cf`` are columns; the peak factor acts on the calibrated power.
    """
    live = F.coalesce(c(base_kwh), F.lit(0.0)) > 0
    mid = c("ResidualCalibrationFactor") * c("SeasonalCalibrationFactor") * c("RegimeCalibrationFactor")
    kw = F.coalesce(c(base_kw), F.lit(0.0)) * mid
    peak = F.when(F.coalesce(safe_div(kw, c(capacity)) >= c("threshold_cf"), F.lit(False)), c("peak_factor")).otherwise(1.0)
    total = F.when(live, mid * peak).otherwise(1.0)
    return df.withColumns({"PeakCalibrationFactor": F.when(live, peak).otherwise(1.0), "TotalCalibrationFactor": total,
                           "Calibrated_kWh": F.when(live, c(base_kwh) * total).otherwise(0.0), "Calibrated_kW": F.when(live, F.coalesce(c(base_kw), F.lit(0.0)) * total).otherwise(0.0)})


def same_day_correction(forecast: DataFrame, actuals: DataFrame, by: Sequence[str], min_intervals: int = 4, min_kwh: float = 0.0, lo: float = 0.7, hi: float = 1.3, half_life: float = 4.0, floor: float = 0.35) -> DataFrame:
    """Today's observed/forecast ratio carried to the rest of the day, halving with lead and damped by weather difference.

    ``by`` names the keys including the day column ``Date``.
    """
    j = forecast.join(actuals.select(*by, "IntervalStartDT", "Actual_kWh"), [*by, "IntervalStartDT"])
    w = clip("Forecast_kWh", lo=0)
    s = j.groupBy(*by).agg(F.count("*").alias("_n"), F.sum("Actual_kWh").alias("_a"), F.sum("Forecast_kWh").alias("_f"), F.max("IntervalStartDT").alias("_last"),
                           F.coalesce(safe_div(F.sum(w * F.coalesce("CloudCoverPct", F.lit(0.0))), F.sum(w)), F.avg("CloudCoverPct")).alias("_cloud"),
                           F.coalesce(safe_div(F.sum(w * F.coalesce("ClearSkyIndex", F.lit(0.0))), F.sum(w)), F.avg("ClearSkyIndex")).alias("_csi"))
    s = s.where((c("_n") >= min_intervals) & (c("_f") > min_kwh))
    out = null_safe_join(forecast, s, by)
    ratio = clip(c("_a") / c("_f"), lo, hi)
    lead = clip((F.unix_seconds("IntervalStartDT") - F.unix_seconds("_last")) / 3600.0, lo=0)
    sim = clip((clip(1.0 - F.abs(c("CloudCoverPct") - c("_cloud")) / 100.0, 0, 1) + clip(1.0 - F.abs(c("ClearSkyIndex") - c("_csi")), 0, 1)) / 2.0, floor, 1.0)
    eff = clip(1.0 + (ratio - 1.0) * F.pow(F.lit(0.5), lead / half_life) * F.coalesce(sim, F.lit(floor)), lo, hi)
    later = F.coalesce(c("IntervalStartDT") > c("_last"), F.lit(False))
    out = out.withColumn("SameDayCorrectionFactor", F.when(later, eff).otherwise(1.0))
    return out.withColumn("Corrected_kWh", c("Forecast_kWh") * c("SameDayCorrectionFactor")).drop("_n", "_a", "_f", "_last", "_cloud", "_csi")


# ---- backtest -----------------------------------------------------------------------------------

def hourly_backtest(actual: DataFrame, forecast: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join of hourly actuals and forecasts with errors; percentage error only where the actual is positive."""
    j = actual.select(*keys, "Actual_kWh", "Actual_MW").join(forecast.select(*keys, "Forecast_kWh", "Forecast_MW"), list(keys))
    e = c("Forecast_kWh") - c("Actual_kWh")
    return j.withColumns({"Error_kWh": e, "AbsError_kWh": F.abs(e), "Error_MW": c("Forecast_MW") - c("Actual_MW"), "APE": F.when(c("Actual_kWh") > 0, F.abs(e) / c("Actual_kWh"))})


def solar_aggs() -> dict[str, Column]:
    e = c("Forecast_MW") - c("Actual_MW")
    ak, fk = F.sum("Actual_kWh"), F.sum("Forecast_kWh")
    return {"N": F.count("*"), "Actual_MWh": ak / 1000.0, "Forecast_MWh": fk / 1000.0, "Bias_PCT": F.when(ak > 0, (fk - ak) / ak * 100.0), "MAE_MW": F.avg(F.abs(e)), "RMSE_MW": F.sqrt(F.avg(e * e)),
            "WMAPE": F.when(ak > 0, F.sum(F.abs(c("Forecast_kWh") - c("Actual_kWh"))) / ak), "ActualPeak_MW": F.max("Actual_MW"), "ForecastPeak_MW": F.max("Forecast_MW"),
            "Forecast_At_ActualPeak_MW": F.max_by("Forecast_MW", F.struct("Actual_MW", -F.unix_seconds("IntervalStartDT")))}


def solar_summary(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Totals, bias, errors and peaks of the rows kept, and counts and energy of the rows excluded for quality; one pass."""
    keep = ~F.coalesce(c("SolarBacktestExcluded"), F.lit(False))
    k = df.withColumns({x: F.when(keep, c(x)) for x in ("Actual_MW", "Forecast_MW")})
    k = k.withColumns({"_xa": F.when(~keep, c("Actual_kWh")), "Actual_kWh": F.when(keep, c("Actual_kWh")), "Forecast_kWh": F.when(keep, c("Forecast_kWh")), "_keep": keep})
    aggs = {**solar_aggs(), "N": F.count(F.when(c("_keep"), 1)), "ExcludedIntervals": F.count(F.when(~c("_keep"), 1)), "ExcludedActual_MWh": F.coalesce(F.sum("_xa"), F.lit(0.0)) / 1000.0}
    return k.groupBy(*keys).agg(*[v.alias(n) for n, v in aggs.items()])


def solar_slices(df: DataFrame, daylight_mw: float = 0.10, by: Sequence[str] = ()) -> DataFrame:
    """Metrics over named masks and buckets; the greatest daylight output of a key is an aggregate joined back."""
    day = F.coalesce(c("Actual_MW"), F.lit(0.0)) > daylight_mw
    live = day | (F.coalesce(c("Forecast_MW"), F.lit(0.0)) > daylight_mw)
    top = df.where(day).groupBy(*by).agg(F.max("Actual_MW").alias("_top")) if by else df.where(day).agg(F.max("Actual_MW").alias("_top"))
    j = null_safe_join(df, top, by) if by else df.withColumn("_top", top.scalar())
    h = F.hour("IntervalStartDT")
    inf = float("inf")
    masks: Mapping[str, Column] = {
        "Overall": F.lit(True), "DaylightActual": day, "ActiveSolar": live, "PeakSolarHours11to15": day & h.between(11, 15), "HighOutputActualGE75PctPeak": day & (c("Actual_MW") >= c("_top") * 0.75)}
    buckets = {"CloudCover": (live, cut_right("CloudCoverPct", (-inf, 20.0, 50.0, 80.0, inf), ("0-20", "20-50", "50-80", "80-100"))),
               "ClearSkyIndex": (live, cut_right("ClearSkyIndex", (-inf, 0.25, 0.50, 0.75, 1.00, inf), ("0-0.25", "0.25-0.50", "0.50-0.75", "0.75-1.00", ">1.00"))),
               "Hour": (day, h.cast("string")), "Month": (F.lit(True), F.date_format("IntervalStartDT", "yyyy-MM"))}
    names = F.array_compact(F.array(*[F.when(m, F.lit(n)) for n, m in masks.items()], *[F.when(m & b.isNotNull(), F.concat(F.lit(f"{n}:"), b)) for n, (m, b) in buckets.items()]))
    return j.withColumn("Slice", F.explode(names)).groupBy(*by, "Slice").agg(*[v.alias(n) for n, v in solar_aggs().items()])


