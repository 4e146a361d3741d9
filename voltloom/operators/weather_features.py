"""Weather features of an hourly frame: one projection from declarative tables.

The frame needs ``DT``, ``TempF``, ``HumidityPct``, ``CloudCoverPct`` and the
calendar columns of ``add_time_features``; the rest is optional.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..core import ensure_columns
from ..functions import buckets as B
from ..functions.weather import angle_delta, clip, heat_index_f

# Base temperature, thresholds, and daily-max bands [lo, hi).
BASE_TEMP = 65.0
HEAT_STEPS = (80, 85, 90, 95, 100)
BANDS = {
    "Below75": (None, 75.0), "75to85": (75.0, 85.0), "85to90": (85.0, 90.0), "90to92_5": (90.0, 92.5),
    "92_5to95": (92.5, 95.0), "95to98": (95.0, 98.0), "98to100": (98.0, 100.0), "100to105": (100.0, 105.0),
    "105Plus": (105.0, None),
}
COOL = ("Below75", "75to85", "85to90")
HOT = ("90to92_5", "92_5to95", "95to98", "98to100", "100to105", "105Plus")
# Which window column is crossed with which daily-max bands, and the result's prefix.
WINDOW_BANDS = (
    ("PeakWindowDailyMax", "IsPeakWindow14to18", COOL),
    ("ClearPeakDailyMax", "ClearPeakWindow14to18", COOL),
    ("OvercastPeakDailyMax", "OvercastPeakWindow14to18", COOL),
    ("PeakHE16to18DailyMax", "IsPeakWindow16to18", ("Below75",)),
    ("OvercastPeakHE16to18DailyMax", "OvercastPeakWindow16to18", ("Below75", "90to92_5")),
    ("ClearPeakHE16to18DailyMax", "ClearPeakWindow16to18", ("85to90", "95to98", "98to100", "100to105", "105Plus")),
    ("HotPeakDailyMax", "IsHotPeakWindow16to20", HOT),
    ("ClearHotPeakDailyMax", "ClearHotPeakWindow16to20", HOT),
    ("OvercastHotPeakDailyMax", "OvercastHotPeakWindow16to20", HOT),
)
# Products, result = left * right.
PRODUCTS = (
    ("DailyMax_x_PeakWindow14to18", "Temperature_DailyMax", "IsPeakWindow14to18"),
    ("DailyMax_x_PeakWindow16to18", "Temperature_DailyMax", "IsPeakWindow16to18"),
    ("CDD_x_PeakWindow14to18", "CDD", "IsPeakWindow14to18"),
    ("CDD_x_HotPeakWindow16to20", "CDD", "IsHotPeakWindow16to20"),
    ("DailyMaxExcess90_x_PeakWindow14to18", "DailyMaxTempExcess90", "IsPeakWindow14to18"),
    ("DailyMaxExcess90_x_PeakWindow16to18", "DailyMaxTempExcess90", "IsPeakWindow16to18"),
    ("DailyMaxExcess90_x_HotPeakWindow16to20", "DailyMaxTempExcess90", "IsHotPeakWindow16to20"),
    ("DailyMaxExcess95_x_HotPeakWindow16to20", "DailyMaxTempExcess95", "IsHotPeakWindow16to20"),
    ("HeatIndexCDD_x_HotPeakWindow16to20", "HeatIndex_CDD", "IsHotPeakWindow16to20"),
    ("CloudCover_x_PeakWindow14to18", "CloudCover_Norm", "IsPeakWindow14to18"),
    ("CloudCover_x_PeakWindow16to18", "CloudCover_Norm", "IsPeakWindow16to18"),
    ("CloudCover_x_HotPeakWindow16to20", "CloudCover_Norm", "IsHotPeakWindow16to20"),
    ("DailyMaxExcess90_x_NonBusinessHotPeak", "DailyMaxTempExcess90", "NonBusinessHotPeakWindow16to20"),
    ("ClearHotPeak_x_DailyMaxExcess90", "DailyMaxTempExcess90", "ClearHotPeakWindow16to20"),
    ("ClearHotPeak_x_DailyMaxExcess95", "DailyMaxTempExcess95", "ClearHotPeakWindow16to20"),
    ("ClearHotPeak_x_CDD", "CDD", "ClearHotPeakWindow16to20"),
    ("OvercastHotPeak_x_DailyMaxExcess90", "DailyMaxTempExcess90", "OvercastHotPeakWindow16to20"),
    ("OvercastHotPeak_x_DailyMaxExcess95", "DailyMaxTempExcess95", "OvercastHotPeakWindow16to20"),
    ("OvercastHotPeak_x_CDD", "CDD", "OvercastHotPeakWindow16to20"),
    ("Humidity_x_Temp", "Humidity_Norm", "Temperature"),
    ("Wind_x_Temp", "WindSpeed_Mph", "Temperature"),
    ("Cloud_x_GHI", "CloudCover_Norm", "GHI_Wm2"),
    ("Rain_x_IsWeekend", "Is_Raining", "IsWeekend"),
    ("Hot_Humid_Stress", "CDD", "Humidity_Norm"),
    ("Cooling_Stress", "CDD", "IsLikelySystemPeakHour"),
    ("DailyMax_x_PeakHour", "Temperature_DailyMax", "IsLikelySystemPeakHour"),
)
# Windows crossed with the month (all), and with month sine and cosine too.
MONTH_ONLY = ("OvercastPeakHE16to18DailyMaxBelow75", "OvercastPeakHE16to18DailyMax90to92_5", "ClearPeakHE16to18DailyMax85to90",
              "ClearPeakHE16to18DailyMax95to98", "ClearPeakHE16to18DailyMax98to100", "ClearPeakHE16to18DailyMax100to105",
              "ClearPeakHE16to18DailyMax105Plus")
MONTH_CYCLE = {"HotPeak": "IsHotPeakWindow16to20", "OvercastPeakWindow14to18": "OvercastPeakWindow14to18",
               "ClearHotPeak": "ClearHotPeakWindow16to20"}
MONTH_PLAIN = {"OvercastHotPeak": "OvercastHotPeakWindow16to20"}


def _flag(cond: Column) -> Column:
    """1.0 or 0.0; an unknown condition counts as 0."""
    return F.coalesce(cond, F.lit(False)).cast("double")


def in_band(temp: Column, band: str) -> Column:
    lo, hi = BANDS[band]
    c = F.lit(True)
    if lo is not None:
        c = c & (temp >= lo)
    if hi is not None:
        c = c & (temp < hi)
    return c


def add_daily_temperature(df: DataFrame, keys: Sequence[str] = ("series",)) -> DataFrame:
    """Daily max, min and mean of ``Temperature`` on every row of the day (at most 24 rows a group)."""
    w = Window.partitionBy(*keys, "Date")
    return df.withColumns({f"Temperature_Daily{n}": fn("Temperature").over(w)
                           for n, fn in (("Max", F.max), ("Min", F.min), ("Mean", F.avg))})


def add_weather_features(df: DataFrame, keys: Sequence[str] = ("series",)) -> DataFrame:
    d = "double"
    src = ensure_columns(df, {"TempF": d, "HumidityPct": d, "CloudCoverPct": d, "WindSpeedMph": d, "PrecipIn": d, "GHI_Wm2": d})
    zero = F.lit(0.0)
    base = src.withColumns({
        "Temperature": F.col("TempF").cast(d), "WindSpeed_Mph": F.coalesce("WindSpeedMph", zero),
        "PrecipIn": F.coalesce("PrecipIn", zero), "GHI_Wm2": F.coalesce("GHI_Wm2", zero),
        "Humidity_Norm": F.coalesce(clip(F.col("HumidityPct") / 100.0, 0, 1), zero),
        "CloudCover_Norm": F.coalesce(clip(F.col("CloudCoverPct") / 100.0, 0, 1), zero),
    })
    base = add_daily_temperature(base, keys)
    t, tmax, tmean, h = F.col("Temperature"), F.col("Temperature_DailyMax"), F.col("Temperature_DailyMean"), F.col("Hour")
    cloud = F.col("CloudCover_Norm")
    cdd, hdd = clip(t - BASE_TEMP, lo=0), clip(BASE_TEMP - t, lo=0)
    hot = _flag(h.between(16, 20) & (tmax >= 90.0))
    first = {
        "Is_Raining": (F.col("PrecipIn") > 0).cast("int"), "CDD": cdd, "HDD": hdd, "Temp_Squared": t * t,
        "CDD_Squared": cdd * cdd, "HDD_Squared": hdd * hdd,
        **{f"Extreme_Heat_{s}": F.coalesce(t >= float(s), F.lit(False)).cast("int") for s in HEAT_STEPS},
        "Temp_Bin": B.temp_bin("Temperature"), "DailyMaxTempBin": B.daily_max_bin("Temperature_DailyMax"),
        "Daily_CDD": clip(tmean - BASE_TEMP, lo=0), "Daily_HDD": clip(BASE_TEMP - tmean, lo=0),
        "HeatIndexF": heat_index_f("Temperature", F.coalesce("HumidityPct", zero)),
        "IsPeakWindow14to18": _flag(h.between(14, 18)), "IsPeakWindow16to18": _flag(h.between(16, 18)),
        "IsHotPeakWindow16to20": hot, "_clear": _flag(cloud <= 0.10), "_over": _flag(cloud >= 0.60),
        "NonBusinessHotPeakWindow16to20": hot * _flag(F.coalesce("IsLikelySystemPeakHour", F.lit(0)) == 0),
        "DailyMaxTempExcess90": clip(tmax - 90.0, lo=0), "DailyMaxTempExcess95": clip(tmax - 95.0, lo=0),
    }
    out = base.withColumns(first)
    clear, over, c = F.col("_clear"), F.col("_over"), F.col
    out = out.withColumns({
        "HeatIndex_CDD": clip(c("HeatIndexF") - BASE_TEMP, lo=0),
        "ClearHotPeakWindow16to20": c("IsHotPeakWindow16to20") * clear,
        "OvercastHotPeakWindow16to20": c("IsHotPeakWindow16to20") * over,
        "ClearHotPeakWindow16to18": c("IsHotPeakWindow16to20") * clear * c("IsPeakWindow16to18"),
        "ClearPeakWindow14to18": c("IsPeakWindow14to18") * clear, "OvercastPeakWindow14to18": c("IsPeakWindow14to18") * over,
        "ClearPeakWindow16to18": c("IsPeakWindow16to18") * clear, "OvercastPeakWindow16to18": c("IsPeakWindow16to18") * over,
    }).drop("_clear", "_over")
    crossed = {f"{p}{b}": c(w) * _flag(in_band(tmax, b)) for p, w, bands in WINDOW_BANDS for b in bands}
    crossed["OvercastCoolPeakWindow16to18"] = crossed["OvercastPeakHE16to18DailyMaxBelow75"]
    crossed |= {n: c(a) * c(b) for n, a, b in PRODUCTS}
    crossed |= {f"DailyMaxExcess90_x_HE{k}": c("DailyMaxTempExcess90") * _flag(h == k) for k in range(14, 21)}
    crossed |= {f"ClearHotPeak_x_HE{k}": c("ClearHotPeakWindow16to20") * _flag(h == k) for k in range(16, 21)}
    out = out.withColumns(crossed)
    month = {f"Month_x_{n}": F.coalesce(c("Month"), F.lit(0)) * c(w)
             for n, w in {**MONTH_CYCLE, **MONTH_PLAIN, **{m: m for m in MONTH_ONLY}}.items()}
    month |= {f"Month{s}_x_{n}": c(f"Month{s}") * c(w) for n, w in MONTH_CYCLE.items() for s in ("Sin", "Cos")}
    return out.withColumns(month)


def shift_in_day(value: str, n: int, keys: Sequence[str] = ("series",)) -> Column:
    """Value n rows earlier (later when negative) within the same day."""
    w = Window.partitionBy(*keys, "Date").orderBy("DT")
    return F.lag(value, n).over(w) if n > 0 else F.lead(value, -n).over(w)


def add_evening_cooling(df: DataFrame, keys: Sequence[str] = ("series",)) -> DataFrame:
    """Westerly flow, in-day temperature drops and wind ramps, and evening-cooling signals.

    All shifts share one window over (series, day), so one sort serves them.
    """
    src = ensure_columns(df, {"WindDirectionDeg": "double"})
    zero = F.lit(0.0)
    wind = F.coalesce("WindSpeed_Mph", zero)
    direc = F.pmod(F.col("WindDirectionDeg"), F.lit(360.0))
    known = direc.isNotNull()
    rad = F.radians(direc)
    west = wind * F.cos(F.radians(angle_delta(direc, 270.0)))
    out = src.withColumns({
        "WindDirection_Deg": direc, "WindDirection_Available_Flag": known.cast("double"),
        "WindDir_Sin": F.when(known, F.sin(rad)).otherwise(0.0), "WindDir_Cos": F.when(known, F.cos(rad)).otherwise(0.0),
        "Westerly_Wind_Component_Mph": F.when(known, west).otherwise(0.0),
        "Westerly_Flow_Mph": F.when(known, clip(west, lo=0)).otherwise(0.0), "_wind": wind,
    })
    out = out.withColumn("Westerly_Flow_Flag", _flag((F.abs(angle_delta("WindDirection_Deg", 270.0)) <= 45.0) & (F.col("Westerly_Flow_Mph") >= 3.0)))
    t, tmax = F.col("Temperature"), F.col("Temperature_DailyMax")
    shifts = {"Temperature_Drop_From_DailyMax_F": clip(tmax - t, lo=0)}
    for n in (1, 2, 3):
        shifts[f"TempDrop_{n}Hr_F"] = clip(shift_in_day("Temperature", n, keys) - t, lo=0)
        shifts[f"TempDrop_Next{n}Hr_F"] = clip(t - shift_in_day("Temperature", -n, keys), lo=0)
    for n in (1, 3):
        for col, past, future in (("_wind", "WindRamp_{}Hr_Mph", "WindRamp_Next{}Hr_Mph"),
                                  ("Westerly_Flow_Mph", "WesterlyFlow_Ramp_{}Hr_Mph", "WesterlyFlow_Next{}Hr_Ramp_Mph")):
            shifts[past.format(n)] = F.coalesce(F.col(col) - shift_in_day(col, n, keys), zero)
            shifts[future.format(n)] = F.coalesce(shift_in_day(col, -n, keys) - F.col(col), zero)
    out = out.withColumns(shifts).drop("_wind")
    c = F.col
    evening = c("Hour").between(18, 23)
    clear_hot = evening & (tmax >= 95.0) & (c("CloudCover_Norm") <= 0.20)
    cooling = clear_hot & ((c("Temperature_Drop_From_DailyMax_F") >= 5.0) | (c("TempDrop_Next3Hr_F") >= 6.0))
    flow = c("Westerly_Flow_Flag") == 1.0
    ramp = (c("WesterlyFlow_Ramp_1Hr_Mph") >= 2.0) | (c("WesterlyFlow_Ramp_3Hr_Mph") >= 3.0) | (
        c("WesterlyFlow_Next1Hr_Ramp_Mph") >= 2.0) | (c("WesterlyFlow_Next3Hr_Ramp_Mph") >= 3.0)
    ch = _flag(clear_hot)
    drop, nxt1, nxt3 = (F.coalesce(c(n), zero) for n in ("Temperature_Drop_From_DailyMax_F", "TempDrop_Next1Hr_F", "TempDrop_Next3Hr_F"))
    return out.withColumns({
        "IsPostPeakEvening18to23": _flag(evening), "ClearHotEvening_Flag": ch,
        "ClearVeryHotEvening_Flag": _flag(evening & (tmax >= 100.0) & (c("CloudCover_Norm") <= 0.20)),
        "ClearHotEvening_x_TempDropFromDailyMax": ch * drop, "ClearHotEvening_x_ForecastDropNext3Hr": ch * nxt3,
        "ClearHotEvening_x_WesterlyFlow": ch * c("Westerly_Flow_Mph"),
        "ClearHotEvening_x_WesterlyFlowRamp": ch * clip(c("WesterlyFlow_Ramp_3Hr_Mph"), lo=0),
        "DeltaBreeze_Westerly_Flow_Flag": _flag(clear_hot & flow),
        "DeltaBreeze_EveningWindRamp_Flag": _flag(clear_hot & flow & ramp), "DeltaBreeze_Cooling_Flag": _flag(cooling),
        "DeltaBreeze_Cooling_Signal": _flag(cooling) * c("Westerly_Flow_Mph") * (drop + nxt3),
        "DeltaBreeze_CoolingNoDirection_Signal": ch * (drop + nxt3),
        "DeltaBreeze_ClearHotEvening_Signal": ch * (drop + nxt1 + nxt3),
    })


def add_run_lengths(daily: DataFrame, flags: dict[str, Column], keys: Sequence[str] = ("series",), order: str = "Date") -> DataFrame:
    """Length of the current run of true flags, by row; gaps in the calendar do not end a run.

    ``daily`` holds one row per key and day, so a key has as many rows as days.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    out = daily.withColumn("_pos", F.row_number().over(w))
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    cols = {}
    for name, flag in flags.items():
        last_false = F.max(F.when(~F.coalesce(flag, F.lit(False)), F.col("_pos"))).over(upto)
        cols[name] = (F.col("_pos") - F.coalesce(last_false, F.lit(0))).cast("double")
    return out.withColumns(cols).drop("_pos")


def daily_heat(daily: DataFrame, keys: Sequence[str] = ("series",), first_ramp: float | None = 0.0) -> DataFrame:
    """Prior day, one-day ramp, 2/3-day means and hot-run lengths of a daily frame.

    ``first_ramp``: ramp of a key's first day, 0 for features, None for scorecards.
    """
    w = Window.partitionBy(*keys).orderBy("Date")
    cols = {}
    for kind in ("Max", "Min"):
        v, prior = F.col(f"Temperature_Daily{kind}"), F.lag(f"Temperature_Daily{kind}").over(w)
        filled = F.coalesce(prior, v) if first_ramp is not None else prior
        cols[f"PriorDay_Daily{kind}Temp"] = filled
        ramp = v - filled
        cols[f"Daily{kind}Temp_Ramp_1Day"] = F.coalesce(ramp, F.lit(first_ramp)) if first_ramp is not None else ramp
        for n in (2, 3):
            cols[f"Daily{kind}Temp_{n}DayMean"] = F.avg(v).over(w.rowsBetween(1 - n, 0))
    if "Temperature_DailyMean" in daily.columns:
        cols["DailyMeanTemp_3DayMean"] = F.avg("Temperature_DailyMean").over(w.rowsBetween(-2, 0))
    cols["OvernightHeatStress"] = clip(F.col("Temperature_DailyMin") - 70.0, lo=0)
    out = daily.withColumns(cols)
    mx = F.col("Temperature_DailyMax")
    return add_run_lengths(out, {"ConsecutiveHotDays90": mx >= 90.0, "ConsecutiveVeryHotDays95": mx >= 95.0,
                                 "ConsecutiveExtremeHotDays100": mx >= 100.0}, keys)


def add_heat_persistence(df: DataFrame, keys: Sequence[str] = ("series",)) -> DataFrame:
    """Daily heat fields joined back to the hours of each day."""
    stats = ("Temperature_DailyMax", "Temperature_DailyMin", "Temperature_DailyMean")
    days = df.groupBy(*keys, "Date").agg(*[F.max(s).alias(s) for s in stats])
    heat = daily_heat(days, keys).drop(*stats)
    peak = F.coalesce(F.col("IsLikelySystemPeakHour").cast("double"), F.lit(0.0))
    z = lambda n: F.coalesce(F.col(n), F.lit(0.0))
    return df.join(heat, [*keys, "Date"], "left").withColumns({
        "HeatPersistenceStress90": z("ConsecutiveHotDays90") * peak, "HeatPersistenceStress95": z("ConsecutiveVeryHotDays95") * peak,
        "DailyMax3DayMean_x_PeakHour": z("DailyMaxTemp_3DayMean") * peak, "OvernightHeatStress_x_PeakHour": z("OvernightHeatStress") * peak,
    })


def hot_streaks(daily: DataFrame, threshold: float, keys: Sequence[str] = ("series",)) -> DataFrame:
    """Start, end, length and maximum of every run of hot calendar days; a missing day ends a run."""
    hot = daily.where(F.col("Temperature_DailyMax") >= threshold)
    w = Window.partitionBy(*keys).orderBy("Date")
    island = hot.withColumn("_island", F.date_sub("Date", F.row_number().over(w)))
    return island.groupBy(*keys, "_island").agg(
        F.min("Date").alias("Start"), F.max("Date").alias("End"), F.count("*").alias("Length_Days"),
        F.max("Temperature_DailyMax").alias("Peak_Temp")).drop("_island")


# First day count of each depth bucket.
DEPTH_BUCKETS = {"0": 0, "1-3": 1, "4-7": 4, "8-12": 8, "13-18": 13, "19+": 19}


def depth_bucket(days: Column) -> Column:
    """Bucket of a run length in days; null counts as 0."""
    n = F.coalesce(days, F.lit(0))
    return F.coalesce(*[F.when(n >= first, F.lit(name)) for name, first in sorted(DEPTH_BUCKETS.items(), key=lambda x: -x[1])])
