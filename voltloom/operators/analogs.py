"""Hot peak rows against earlier hot hours of a similar daily maximum, with the analog statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..core import null_safe_join
from ..functions.weather import clip

c = F.col


def _mean(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, x: s + x["a"]) / F.nullif(F.size(values), F.lit(0))


def _quantile(values: Column, q: float) -> Column:
    """Linear quantile of values that lie in ascending order."""
    pos = q * (F.size(values) - 1)
    at = lambda i: F.get(values, i.cast("int"))["a"]
    lo = at(F.floor(pos))
    return F.when(F.size(values) > 0, lo + (at(F.ceil(pos)) - lo) * (pos - F.floor(pos)))


def heat_analog_columns(df: DataFrame, base: str, origin: str, keys: Sequence[str] = ("series",), min_temp: float = 105.0, window: float = 3.0, blend: float = 0.50, cap: float = 12.0, min_count: int = 3,
                        hours: Sequence[int] = tuple(range(14, 21)), months: Sequence[int] = (6, 7, 8, 9), actual: str = "Actual_MWH", first: Sequence[str] = ()) -> DataFrame:
    """Shadow forecast of hot peak rows with count, mean and P90 of their analogs.

    An analog is a row of the same key before the row's origin, with a daily maximum of
    ``min_temp`` or more that is within ``window`` of the row's. The same-hour columns use
    the first of three tiers with ``min_count`` analogs (same month, ``months``, any); the
    HE14-20 columns use hours 14 to 20 of ``months``. Rows without analogs or forecast keep
    their forecast, counts of 0 and null statistics.

    The source holds one row per (key, time), the first by ``first``. It is folded to one
    ascending list per (key, hour, band of temperature) and per (key, band) for the peak
    hours, three bands wide, so a target (distinct origin, hour, month, temperature) meets
    one list of each kind by equality: no target is paired with source rows. A list is
    bounded by the hot days of the calendar in its band, not by input rows.
    """
    t = c("Temperature_DailyMax")
    scope = F.coalesce((t >= min_temp) & c("Hour").isin(*hours) & c("Month").isin(*months), F.lit(False))
    one = df.where(c("DT").isNotNull()).groupBy(*keys, "DT").agg(F.min_by(F.struct("Hour", "Month", t.alias("t"), c(actual).cast("double").alias("a")), F.struct(*(first or (t, c(actual))))).alias("_s"))
    hot = one.select(*keys, c("DT").alias("d"), "_s.*").where((c("t") >= min_temp) & c("a").isNotNull() & c("Hour").isNotNull() & c("Month").isNotNull())
    width = max(window, 0.5)
    band = lambda x: F.floor(x / width)
    peak = c("Hour").between(14, 20) & c("Month").isin(*months)
    slots = F.array_compact(F.array(c("Hour").cast("int"), F.when(peak, F.lit(-1))))
    hot = hot.select(*keys, F.explode(slots).alias("_slot"), F.struct("a", "d", "t", c("Month").alias("m")).alias("_x"))
    lists = hot.select("*", F.explode(F.sequence(band(c("_x.t")) - 1, band(c("_x.t")) + 1)).alias("_band"))
    lists = lists.groupBy(*keys, "_slot", "_band").agg(F.sort_array(F.collect_list("_x")).alias("_l"))

    def met(targets: DataFrame) -> DataFrame:
        j = null_safe_join(targets.withColumn("_band", band(c("_t"))), lists, [*keys, "_slot", "_band"], "inner")
        return j.withColumn("_l", F.filter("_l", lambda x: (x["d"] < c(origin)) & (x["t"] >= c("_t") - window) & (x["t"] <= c("_t") + window)))

    wanted = df.where(scope & c(origin).isNotNull())
    same = met(wanted.select(*keys, origin, c("Hour").cast("int").alias("_slot"), "Month", t.alias("_t")).distinct())
    same = same.withColumns({"_lm": F.filter("_l", lambda x: x["m"] == c("Month")), "_ls": F.filter("_l", lambda x: x["m"].isin(*months))})
    tiers = (("_lm", "same_month_multi_summer"), ("_ls", "summer_months_multi_summer"), ("_l", "all_prior_same_hour_temp"))
    pick, name = F, F
    for col, label in tiers:
        pick, name = pick.when(F.size(col) >= min_count, c(col)), name.when(F.size(col) >= min_count, F.lit(label))
    same = same.withColumns({"_v": pick, "_name": name}).where(c("_name").isNotNull())
    same = same.select(*keys, origin, c("_slot").alias("Hour"), "Month", c("_t").alias("Temperature_DailyMax"), "_name", F.size("_v").alias("_n"), _mean(c("_v")).alias("_m"), _quantile(c("_v"), 0.9).alias("_p"))
    peaks = met(wanted.select(*keys, origin, F.lit(-1).alias("_slot"), t.alias("_t")).distinct())
    peaks = peaks.select(*keys, origin, c("_t").alias("Temperature_DailyMax"), F.size("_l").alias("_pn"), _mean(c("_l")).alias("_pm"), _quantile(c("_l"), 0.9).alias("_pp"))

    j = null_safe_join(df, same, [*keys, origin, "Hour", "Month", "Temperature_DailyMax"])
    j = null_safe_join(j, peaks, [*keys, origin, "Temperature_DailyMax"])
    use = scope & c("_name").isNotNull() & c(base).isNotNull()
    corr = (c("_m") - c(base)) * blend
    corr = clip(corr, -abs(cap), abs(cap)) if cap else corr
    given = lambda x: F.when(use, c(x))
    j = j.withColumn("Heat_Analog_Shadow_Correction_MWH", F.when(use, corr).otherwise(0.0))
    shadow = c(base) + c("Heat_Analog_Shadow_Correction_MWH")
    err, err_base = c(actual) - shadow, c(actual) - c(base)
    out = j.withColumns({
        "Heat_Analog_Model_Version": F.lit("multi_summer_v1"), "Heat_Analog_Shadow_Mode": F.lit("shadow_only"), "Heat_Analog_Production_Scope": F.lit("not_production"),
        "Heat_Analog_Temp_Window_F": F.lit(float(window)), "Heat_Analog_MinDailyMax_F": F.lit(float(min_temp)), "Heat_Analog_PeakHours": F.lit(",".join(str(h) for h in sorted(set(hours)))), "Heat_Analog_MinAnalogCount": F.lit(min_count),
        "Heat_Analog_Scope_Flag": scope.cast("int"), "Heat_Analog_Source": F.when(use, c("_name")).when(scope, "no_pre_origin_match").otherwise("out_of_scope"),
        "Heat_Analog_Base_Forecast_MWH": c(base), "Heat_Analog_Shadow_Forecast_MWH": shadow,
        "Heat_Analog_Shadow_Applied_Flag": (F.abs("Heat_Analog_Shadow_Correction_MWH") > 1e-9).cast("int"),
        "Heat_Analog_Count_SameHour_PreOrigin": F.coalesce(given("_n"), F.lit(0)).cast("long"), "Heat_Analog_Count_HE14_20_PreOrigin": F.coalesce(given("_pn"), F.lit(0)).cast("long"),
        "Heat_Analog_Actual_Mean_SameHour_PreOrigin_MWH": given("_m"), "Heat_Analog_Actual_P90_SameHour_PreOrigin_MWH": given("_p"),
        "Heat_Analog_Actual_Mean_HE14_20_PreOrigin_MWH": given("_pm"), "Heat_Analog_Actual_P90_HE14_20_PreOrigin_MWH": given("_pp"),
        "Heat_Analog_Base_Residual_MWH": err_base, "Heat_Analog_Base_AbsError_MWH": F.abs(err_base), "Heat_Analog_Shadow_Residual_MWH": err, "Heat_Analog_Shadow_AbsError_MWH": F.abs(err),
        "Heat_Analog_Delta_AbsError_MWH": F.abs(err) - F.abs(err_base), "Actual_Minus_Heat_Analog_SameHour_Mean_MWH": c(actual) - given("_m")})
    return out.drop("_name", "_n", "_m", "_p", "_pn", "_pm", "_pp")


def heat_analog_detail(df: DataFrame, base: str, origin: str, **kw) -> DataFrame:
    """The rows in scope with all analog columns."""
    return heat_analog_columns(df, base, origin, **kw).where("Heat_Analog_Scope_Flag = 1")
