"""Named slices, gates, coverage and comparison scorecards of a replay cube."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..core import group_quantiles, join_small, null_safe_join
from ..functions import buckets as B
from .metrics import ACTUAL, by_stage, explode_slices, grouped_metrics
from .weather_features import daily_heat

c = F.col


def hot_peak() -> Column:
    return c("Hour").between(16, 20) & (c("Temperature_DailyMax") >= 90.0)


def shoulder_heat() -> Column:
    return c("Season").isin("Spring", "Fall") & c("Hour").between(12, 22) & c("Temperature_DailyMax").between(75.0, 93.0)


def cloudy_midday() -> Column:
    return (c("HourGroup") == "Midday") & (
        c("CloudCoverBucket").isin("Mostly Cloudy", "Overcast") | c("SolarLossBucket").isin("High", "Extreme"))


def add_origin_heat(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One-day ramp and 100F run length of each (origin, series) day; null ramp on an origin's first day."""
    days = df.groupBy(*keys, "Date").agg(F.max("Temperature_DailyMax").alias("Temperature_DailyMax"))
    heat = daily_heat(days.withColumn("Temperature_DailyMin", F.lit(None).cast("double")), keys, first_ramp=None)
    heat = heat.select(*keys, "Date", "DailyMaxTemp_Ramp_1Day", "ConsecutiveExtremeHotDays100")
    return join_small(df, heat, [*keys, "Date"])


def event_slices() -> dict[str, Column]:
    """The thirteen overlapping event slices; needs bucket, ramp and run columns."""
    h, t = c("Hour"), c("Temperature_DailyMax")
    return {
        "PeakWindowHours14to18": h.between(14, 18), "PeakWindowHours14to20": h.between(14, 20),
        "LatePeakHours19to20": h.between(19, 20), "HE18to20CodeHours17to19": h.between(17, 19),
        "HotPeakDailyMax90Plus": (c("HourGroup") == "Peak") & (t >= 90.0),
        "HotRampPeak100PlusRamp2HE16to20": h.between(16, 20) & (t >= 100.0) & (c("DailyMaxTemp_Ramp_1Day") >= 2.0),
        "HeatPersistencePeak100PlusConsec3HE16to20": h.between(16, 20) & (t >= 100.0) & (c("ConsecutiveExtremeHotDays100") >= 3.0),
        "ExtremeHeat105PlusPeakWindowHours14to20": h.between(14, 20) & (t >= 105.0),
        "ShoulderSeasonHeatTransition": shoulder_heat(), "CloudSolarMidday": cloudy_midday(),
        "WeekendHours": c("IsWeekend") == 1, "HolidayHours": F.coalesce(c("IsHoliday"), F.lit(0)) == 1,
        "LongHorizonDays8to16": c("Forecast_Day").between(8, 16),
    }


def value_slices(by: Mapping[str, str]) -> list[Column]:
    """(prefix, column) to '<prefix>:<value>' slice names, missing values included."""
    return [F.concat(F.lit(f"{p}:"), F.coalesce(c(col).cast("string"), F.lit("<missing>"))) for p, col in by.items()]


def seasonal_scorecard(df: DataFrame, stages: Mapping[str, str], by: Mapping[str, str], slices: Mapping[str, Column] | None = None,
                       p90: bool = True) -> DataFrame:
    """Overall, event-slice and per-value metrics of every stage in one pass: rows repeat per slice, then one aggregate."""
    ev = slices if slices is not None else event_slices()
    names = F.array_compact(F.array(F.lit("Overall"), *[F.when(cond, F.lit(n)) for n, cond in ev.items()], *value_slices(by)))
    long = by_stage(df.withColumn("_slices", names), stages, [ACTUAL, "_slices"])
    return grouped_metrics(long.withColumn("Slice", F.explode("_slices")), ["Slice", "Stage"], p90=p90)


def gated(df: DataFrame, gates: Mapping[str, tuple[Column, Mapping[str, float]]], forecast: str, actual: str = ACTUAL) -> DataFrame:
    """One row per gate: metrics, its limits and whether all hold; a gate without rows fails with N = 0."""
    rows = explode_slices(df, {n: cond for n, (cond, _) in gates.items()}, "Test")
    m = grouped_metrics(rows, ["Test"], forecast, actual, p90=False)
    spec = df.sparkSession.createDataFrame(
        [(n, lim.get("mae"), lim.get("mape"), lim.get("abs_bias")) for n, (_, lim) in gates.items()],
        "Test string, Max_MAE double, Max_MAPE double, Max_AbsBias double")
    out = spec.join(m, "Test", "left").withColumn("N", F.coalesce("N", F.lit(0)))
    ok = F.lit(True)
    for lim, value in (("Max_MAE", c("MAE_MWH")), ("Max_MAPE", c("MAPE_PCT")), ("Max_AbsBias", F.abs("Bias_MWH"))):
        ok = ok & (c(lim).isNull() | F.coalesce(value <= c(lim), F.lit(False)))
    return out.withColumn("Pass", ok & (c("N") > 0))


def readiness_gates() -> dict[str, tuple[Column, dict[str, float]]]:
    """The production tests and their limits on a replay."""
    d, h, t = c("Forecast_Day"), c("Hour"), c("Temperature_DailyMax")
    return {
        "Seasonal rolling origins": (F.lit(True), {"mae": 4.5, "mape": 3.5, "abs_bias": 0.75}),
        "Day 1 only": (d == 1, {"mae": 3.5}), "Days 2-3": (d.between(2, 3), {"mae": 5.0}), "Days 4-7": (d.between(4, 7), {"mae": 5.0}),
        "Hot peak days": (h.between(16, 20) & (t >= 90.0), {"mae": 6.0}),
        "Cloud/solar midday": (h.between(10, 16) & ((c("CloudCover_Norm") >= 0.60) | (c("BTM_Solar_Loss_From_ClearSky_MW") >= 1.25)), {"mae": 7.0}),
        "Shoulder heat transition": (shoulder_heat(), {"mae": 7.0}),
        "Peak window hours 14-18": (h.between(14, 18), {"mae": 5.5}),
    }


# Test, purpose, basis, target and gate of the readiness scorecard.
READINESS_TEXT = (
    ("Last 45 days", "Recent behavior", "recent_45_day_backtest", "Recent MAE <= 3.0 MWh", "mae<=3.0"),
    ("Seasonal rolling origins", "General robustness", "seasonal_rolling_origin_replay", "MAE <= 4.5, MAPE <= 3.5%, abs bias <= 0.75", "mae<=4.5;mape<=3.5;abs_bias<=0.75"),
    ("Day 1 only", "Near-term operational forecast", "seasonal_rolling_origin_replay", "MAE <= 3.5 MWh", "mae<=3.5"),
    ("Days 2-3", "Short weather forecast horizon", "seasonal_rolling_origin_replay", "MAE <= 5.0 MWh", "mae<=5.0"),
    ("Days 4-7", "Weather uncertainty horizon", "seasonal_rolling_origin_replay", "MAE <= 5.0 MWh", "mae<=5.0"),
    ("Hot peak days", "Operational risk", "seasonal_rolling_origin_replay", "MAE <= 6.0 MWh", "mae<=6.0"),
    ("Cloud/solar midday", "BTM solar/cloud risk", "seasonal_rolling_origin_replay", "MAE <= 7.0 MWh", "mae<=7.0"),
    ("Shoulder heat transition", "Spring/fall load-response risk", "seasonal_rolling_origin_replay", "MAE <= 7.0 MWh", "mae<=7.0"),
    ("Peak window hours 14-18", "Peak planning risk", "seasonal_rolling_origin_replay", "MAE <= 5.5 MWh", "mae<=5.5"),
)


def last_days(df: DataFrame, days: int, time: str = "DT") -> DataFrame:
    """Rows of the last ``days`` before the latest time of the table."""
    return df.where(c(time) > df.agg((F.max(time) - F.make_dt_interval(F.lit(days))).alias("t")).scalar())


def readiness_scorecard(recent: DataFrame, replay: DataFrame, forecast: str, actual: str = ACTUAL) -> DataFrame:
    """All nine gates: the recent backtest and the replay's eight, with purpose, basis, target and gate; no rows is a fail."""
    both = gated(recent, {"Last 45 days": (F.lit(True), {"mae": 3.0})}, forecast, actual).unionByName(gated(replay, readiness_gates(), forecast, actual))
    text = replay.sparkSession.createDataFrame([(i, *t) for i, t in enumerate(READINESS_TEXT)], "Order int, Test string, Purpose string, Basis string, Target string, Gate string")
    return text.join(both, "Test")


def promotion_slices() -> dict[str, Column]:
    h, d = c("Hour"), c("Forecast_Day")
    return {
        "HotPeak": hot_peak(), "Peak14to18": h.between(14, 18), "Day1": d == 1, "Days2to7": d.between(2, 7),
        "CloudSolar": h.between(10, 16) & (c("CloudCover_Norm") >= 0.60) & (c("BTM_Solar_Loss_From_ClearSky_MW") >= 1.25),
    }


def promotion_audit(df: DataFrame, candidates: Mapping[str, str], final: str, max_bias: float = 0.75) -> DataFrame:
    """Each candidate stage against the final one, overall and on five slices.

    The peak window must improve, the other slices must not get worse, and the
    overall bias must stay within ``max_bias``.
    """
    slices = {"All": F.lit(True), **promotion_slices()}
    stages = {**candidates, "_final": final}
    names = F.array_compact(F.array(*[F.when(cond, F.lit(n)) for n, cond in slices.items()]))
    long = by_stage(df.withColumn("_s", names), stages, [ACTUAL, "_s"]).withColumn("Slice", F.explode("_s"))
    m = grouped_metrics(long, ["Slice", "Stage"], p90=False)
    fin = m.where("Stage = '_final'").select("Slice", c("MAE_MWH").alias("_fm"))
    j = m.where("Stage <> '_final'").join(fin, "Slice")
    delta = c("MAE_MWH") - c("_fm")
    pas = F.when(c("Slice") == "Peak14to18", delta < -1e-9).otherwise(delta <= 1e-9)
    g = j.groupBy("Stage").agg(
        F.max(F.when(c("Slice") == "All", c("MAE_MWH"))).alias("Candidate_MAE_MWH"), F.max(F.when(c("Slice") == "All", c("_fm"))).alias("Final_MAE_MWH"),
        F.max(F.when(c("Slice") == "All", c("Bias_MWH"))).alias("Candidate_Bias_MWH"), F.max(F.when(c("Slice") == "All", c("N"))).alias("N"),
        *[F.max(F.when(c("Slice") == s, delta)).alias(f"{s}_MAE_Delta_vs_Final_MWH") for s in promotion_slices()],
        *[F.coalesce(F.bool_and(F.when(c("Slice") == s, pas)), F.lit(True)).alias(f"{s}_Pass") for s in promotion_slices()])
    bias_ok = F.abs("Candidate_Bias_MWH") <= max_bias
    fails = F.array_compact(F.array(F.when(~bias_ok, F.lit("Seasonal_Abs_Bias")), *[F.when(~c(f"{s}_Pass"), F.lit(s)) for s in promotion_slices()]))
    gain = c("Final_MAE_MWH") - c("Candidate_MAE_MWH")
    return g.withColumns({
        "Candidate_MAE_Improvement_vs_Final_MWH": gain, "Beats_Final": gain > 1e-9, "Promotion_Gate_Pass": F.size(fails) == 0,
        "Promotion_Gate_Failures": F.when(F.size(fails) > 0, F.array_join(fails, ";")).otherwise("none"),
        "Meets_Promotion_Rule": (gain > 1e-9) & (F.size(fails) == 0),
    })


def candidate_scorecard(df: DataFrame, candidates: Mapping[str, str], final: str, keys: Sequence[str]) -> DataFrame:
    """Candidates against the final stage in every cell of ``keys``."""
    long = by_stage(df, {**candidates, "_final": final}, [*keys, ACTUAL])
    m = grouped_metrics(long, [*keys, "Stage"], p90=False)
    fin = m.where("Stage = '_final'").select(*keys, c("MAE_MWH").alias("Final_MAE_MWH"), c("Bias_MWH").alias("Final_Bias_MWH"))
    j = null_safe_join(m.where("Stage <> '_final'"), fin, keys, "inner")
    return j.withColumns({"Candidate_MAE_Improvement_vs_Final_MWH": c("Final_MAE_MWH") - c("MAE_MWH"),
                          "Candidate_Bias_Abs_Improvement_vs_Final_MWH": F.abs("Final_Bias_MWH") - F.abs("Bias_MWH")})


def peak_bias_scorecard(df: DataFrame, forecast: str, min_count: int = 5) -> DataFrame:
    """Peak-window cells of six keys with net, positive and negative residual sums."""
    w = df.where(c("Hour").between(14, 18)).withColumns({
        "Forecast_Day_Bucket": B.horizon_bucket("Forecast_Day", "diagnostic"),
        "Peak_Hour_Band": F.when(c("Hour").isin(14, 15), "HE14-15").otherwise("HE16-18"),
        "DailyMaxTempBiasBand": B.peak_daily_max_band("Temperature_DailyMax"), "CloudCoverBiasBand": B.peak_cloud_band("CloudCover_Norm"),
        "LagAnchorState": B.anchor_state_band(c("Raw_Forecast_MWH") - c("MWH_SameHour7DayMean")),
    })
    r, raw = c(ACTUAL) - c(forecast), c(ACTUAL) - c("Raw_Forecast_MWH")
    extra = {"Residual_Sum_MWH": F.sum(r), "Positive_Residual_Sum_MWH": F.sum(F.greatest(r, F.lit(0.0))),
             "Negative_Residual_Sum_MWH": F.sum(F.least(r, F.lit(0.0))), "Raw_Bias_MWH": F.avg(raw), "Raw_Residual_Sum_MWH": F.sum(raw),
             "Mean_RawMinusSameHour7_MWH": F.avg(c("Raw_Forecast_MWH") - c("MWH_SameHour7DayMean"))}
    keys = ["Month", "Forecast_Day_Bucket", "Peak_Hour_Band", "DailyMaxTempBiasBand", "CloudCoverBiasBand", "LagAnchorState"]
    out = grouped_metrics(w, keys, forecast, min_count=min_count, extra=extra)
    return out.withColumns({"Abs_Residual_Sum_MWH": F.abs("Residual_Sum_MWH"), "Bias_Delta_vs_Raw_MWH": c("Bias_MWH") - c("Raw_Bias_MWH")})


def weather_error_by_lead(df: DataFrame, pairs: Mapping[str, tuple[str, str]], lead: str, bucket: str) -> DataFrame:
    """Bias, MAE and P90 of forecast weather against realised weather, by variable, lead and horizon."""
    parts = F.array(*[F.struct(F.lit(n).alias("Weather_Variable"), c(real).cast("double").alias("Realized_Value"), c(prev).cast("double").alias("Previous_Run_Value"))
                      for n, (real, prev) in pairs.items()])
    long = df.select(lead, bucket, F.inline(parts)).where(f"Realized_Value is not null and Previous_Run_Value is not null and {lead} is not null")
    e = c("Previous_Run_Value") - c("Realized_Value")
    long = long.withColumn("_ae", F.abs(e))
    keys = ["Weather_Variable", lead, bucket]
    g = long.groupBy(*keys).agg(F.count("*").alias("N"), F.avg("Realized_Value").alias("Realized_Mean"), F.avg("Previous_Run_Value").alias("Previous_Run_Mean"),
                                F.avg(e).alias("Bias_PreviousMinusRealized"), F.avg("_ae").alias("MAE_PreviousVsRealized"))
    return null_safe_join(g, group_quantiles(long, keys, "_ae", {"P90_AbsError": 0.9}), keys)


def coverage(df: DataFrame, keys: Sequence[str], error: str, band: str) -> DataFrame:
    """Share of rows inside the band, mean band, mean and largest miss, P90 of the error."""
    e, b = F.abs(c(error)), c(band)
    miss = F.greatest(e - b, F.lit(0.0))
    work = df.where(c(error).isNotNull() & c(band).isNotNull())
    g = work.groupBy(*keys).agg(F.count("*").alias("N"), F.avg(F.when(e <= b, 100.0).otherwise(0.0)).alias("Coverage_PCT"), F.avg(b).alias("Avg_Band_MWH"),
                                F.avg(e).alias("Avg_AbsError_MWH"), F.avg(miss).alias("Avg_Band_Miss_MWH"), F.max(miss).alias("Max_Band_Miss_MWH"))
    return null_safe_join(g, group_quantiles(work.withColumn("_ae", e), keys, "_ae", {"P90_AbsError_MWH": 0.9}), keys)


def weather_event_label() -> Column:
    """First matching event of a row."""
    h, t = c("Hour"), c("Temperature_DailyMax")
    cloudy = (c("BTM_Solar_Loss_From_ClearSky_MW") >= 1.25) | (c("CloudCover_Norm") >= 0.60)
    return (F.when(c("Forecast_Day") >= 8, "long_horizon_days8to16").when((c("HourGroup") == "Peak") & (t >= 90.0), "hot_peak")
            .when((c("HourGroup") == "Midday") & cloudy, "cloudy_solar_loss_midday").when(shoulder_heat(), "shoulder_heat_transition")
            .when(F.coalesce(c("IsHoliday"), F.lit(0)) == 1, "holiday").when(F.coalesce(c("IsWeekend"), F.lit(0)) == 1, "weekend").otherwise("normal"))


def interval_event_slice() -> Column:
    """Event of a row when later rules overwrite earlier ones; no holiday or weekend labels.

    Precedence is therefore shoulder heat, cloudy midday, hot peak, long horizon:
    the reverse of ``weather_event_label``.
    """
    t = c("Temperature_DailyMax")
    cloudy = (c("CloudCover_Norm") >= 0.60) | (c("BTM_Solar_Loss_From_ClearSky_MW") >= 1.25)
    return (F.when(shoulder_heat(), "shoulder_heat_transition").when((c("HourGroup") == "Midday") & cloudy, "cloudy_solar_loss_midday")
            .when((c("HourGroup") == "Peak") & (t >= 90.0), "hot_peak").when(c("Forecast_Day") >= 8, "long_horizon_days8to16").otherwise("normal"))


def weather_error_driver(temp_error: Column, cloud_error: Column, loss_error: Column) -> Column:
    """Strong single or multiple trigger, else the largest moderate one, else low."""
    spec = (("temp", F.abs(temp_error), 5.0, 2.0), ("cloud", F.abs(cloud_error), 0.35, 0.20), ("solar_loss", F.abs(loss_error), 3.0, 1.25))
    strong = F.array_compact(F.array(*[F.when(v >= hi, F.lit(n)) for n, v, hi, _ in spec]))
    # the greatest ratio wins, the earlier variable on ties
    medium = F.array_compact(F.array(*[F.when(v >= lo, F.struct((v / lo).alias("r"), F.lit(-i).alias("i"), F.lit(f"{n}_moderate").alias("n")))
                                       for i, (n, v, _, lo) in enumerate(spec)]))
    return (F.when(F.size(strong) >= 2, "multi_weather_error").when(F.size(strong) == 1, F.element_at(strong, 1))
            .when(F.size(medium) == 0, "low_weather_error").otherwise(F.array_max(medium)["n"]))


def compare_grouped(a: DataFrame, b: DataFrame, key: str, value: str, label_a: str, label_b: str) -> DataFrame:
    """Full outer comparison of two grouped results."""
    j = a.select(key, c(value).alias(label_a)).join(b.select(key, c(value).alias(label_b)), key, "full_outer")
    return j.withColumn("delta", c(label_b) - c(label_a))


def weather_sensitivity(df: DataFrame, realized: str, previous: str, slices: Mapping[str, Sequence[str]]) -> DataFrame:
    """Error under realised and as-forecast weather, harm rate and P90, overall and per slice value; one pass."""
    def name(n, cols):
        return F.concat(F.lit(f"{n}:"), F.concat_ws("|", *[F.coalesce(c(x).cast("string"), F.lit("<missing>")) for x in cols]))

    names = F.array(F.lit("Overall"), *[name(n, cols) for n, cols in slices.items()])
    er, ep = F.abs(c(ACTUAL) - c(realized)), F.abs(c(ACTUAL) - c(previous))
    long = df.where(c(previous).isNotNull()).select(er.alias("_er"), ep.alias("_ep"), F.explode(names).alias("Slice"))
    g = long.groupBy("Slice").agg(F.count("*").alias("n"), F.avg("_er").alias("real_mae"), F.avg("_ep").alias("prev_mae"), F.avg(c("_ep") - c("_er")).alias("delta"),
                                  F.avg(F.when(c("_ep") > c("_er"), 100.0).otherwise(0.0)).alias("harm"))
    return g.join(group_quantiles(long, ["Slice"], "_ep", {"p90": 0.9}), "Slice")


def daily_peak_pairs(df: DataFrame, keys: Sequence[str], base: str, shadow: str, hours: Sequence[int]) -> DataFrame:
    """Base and shadow errors at the actual peak and peak to peak, per day."""
    from ..core import epoch_second

    a, b, s = c(ACTUAL), c(base), c(shadow)
    w = df.where(a.isNotNull() & b.isNotNull() & s.isNotNull() & c("Hour").isin(*hours))
    first = F.struct(a, -epoch_second("DT"))
    g = w.groupBy(*keys).agg(F.min("Forecast_Day").alias("Forecast_Day"), F.max(a).alias("ap"), F.max_by(b, first).alias("ba"), F.max_by(s, first).alias("sa"),
                             F.max(b).alias("bp"), F.max(s).alias("sp"), F.avg(F.abs(a - b)).alias("bm"), F.avg(F.abs(a - s)).alias("sm"))
    return g.select(*keys, "Forecast_Day", F.abs(c("ap") - c("ba")).alias("base_at"), F.abs(c("ap") - c("sa")).alias("shadow_at"), F.abs(c("ap") - c("bp")).alias("base_pk"),
                    F.abs(c("ap") - c("sp")).alias("shadow_pk"), (c("sm") - c("bm")).alias("d_mae"))


def daily_peak_window_summary(pairs: DataFrame, keys: Sequence[str]) -> DataFrame:
    means = [F.avg(x).alias(x) for x in ("base_at", "shadow_at", "base_pk", "shadow_pk", "d_mae")]
    return pairs.groupBy(*keys).agg(F.count("*").alias("days"), *means, F.count(F.when(c("shadow_at") < c("base_at"), 1)).alias("better"),
                                    F.count(F.when(c("shadow_at") > c("base_at"), 1)).alias("worse"))


# Weights of the search objective.
OBJECTIVE = {"overall": 0.40, "peak": 0.25, "peak_miss": 0.20, "warm_bias": 0.10, "cloud": 0.05}


def search_objective(df: DataFrame, forecast: str, weights: Mapping[str, float] = OBJECTIVE) -> DataFrame:
    """Weighted error a parameter search lowers; an empty slice falls back to the overall error."""
    r = c(ACTUAL) - c(forecast)
    e = F.abs(r)
    parts = {
        "overall": F.avg(e), "peak": F.avg(F.when(c("Hour").between(14, 18), e)),
        "peak_miss": F.avg(F.when(hot_peak(), F.greatest(r, F.lit(0.0)))), "warm_bias": F.abs(F.avg(F.when(c("Season") == "Summer", r))),
        "cloud": F.avg(F.when(c("Hour").between(10, 16) & (c("CloudCover_Norm") >= 0.60), e)),
    }
    g = df.agg(*[v.alias(n) for n, v in parts.items()])
    return g.select(sum((F.coalesce(c(n), c("overall")) * w for n, w in weights.items()), F.lit(0.0)).alias("objective"))
