"""Small reports: bias calibration, serial dependence, trends, records, grids, peak muting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..core import epoch_hour, epoch_second, group_quantiles, null_safe_join, rows_before
from ..functions.weather import clip
from .metrics import ACTUAL

c = F.col


def matched_bias(model: DataFrame, station: DataFrame, max_delta: float, keys: Sequence[str] = ("series",), tz: str = "UTC") -> DataFrame:
    """Station minus model temperature on common instants, outliers dropped, with local month and hour."""
    j = model.join(station, [*keys, "DT"]).withColumn("LocalStation_TempDelta_F", c("LocalStation_TempF") - c("TempF"))
    local = F.from_utc_timestamp("DT", tz)
    return j.where(F.abs("LocalStation_TempDelta_F") <= max_delta).withColumns({"Month": F.month(local), "Hour": F.hour(local)})


def bias_lookup(matched: DataFrame, min_count: int, by: Sequence[str] = ()) -> DataFrame:
    """Mean delta per month and hour with enough rows, else per month (the month mean is rolled up from the hours)."""
    g = matched.groupBy(*by, "Month", "Hour").agg(F.count("*").alias("N"), F.avg("LocalStation_TempDelta_F").alias("Bias_Delta_F"), F.stddev_samp("LocalStation_TempDelta_F").alias("Bias_Std_F"), F.sum("LocalStation_TempDelta_F").alias("_s"))
    w = Window.partitionBy(*by, "Month")  # 24 rows
    g = g.withColumn("Month_Delta_F", F.sum("_s").over(w) / F.sum("N").over(w))
    use = c("N") >= min_count
    return g.withColumns({"Bias_Source": F.when(use, "month_hour").otherwise("month"), "Applied_Delta_F": F.when(use, c("Bias_Delta_F")).otherwise(c("Month_Delta_F"))}).drop("_s")


def apply_bias(weather: DataFrame, lookup: DataFrame, matched: DataFrame, blend: float = 1.0, cap: float = 8.0, by: Sequence[str] = (), tz: str = "UTC") -> DataFrame:
    """Temperature plus the blended, capped delta of its month and hour; the overall mean where the lookup has none."""
    local = F.from_utc_timestamp("DT", tz)
    w = weather.withColumns({"Month": F.month(local), "Hour": F.hour(local)})
    j = null_safe_join(w, lookup.select(*by, "Month", "Hour", "Applied_Delta_F", "Bias_Source"), [*by, "Month", "Hour"])
    overall = matched.agg(F.avg("LocalStation_TempDelta_F")).scalar()
    d = clip(F.coalesce(c("Applied_Delta_F"), overall, F.lit(0.0)), -cap, cap) * blend
    return j.withColumns({"TempF": c("TempF") + d, "LocalWeather_TempCal_Source": F.coalesce("Bias_Source", F.lit("global"))}).drop("Applied_Delta_F", "Bias_Source")


def bias_summary(matched: DataFrame) -> DataFrame:
    """Overall and monthly count, mean, median, MAE and P90; both groupings from one expanded pass."""
    long = matched.select(c("LocalStation_TempDelta_F").alias("_d"), F.explode(F.array(F.lit("Overall"), F.concat(F.lit("Month "), c("Month").cast("string")))).alias("segment")).withColumn("_a", F.abs("_d"))
    g = long.groupBy("segment").agg(F.count("*").alias("n"), F.avg("_d").alias("mean"), F.avg("_a").alias("mae"))
    return g.join(group_quantiles(long, ["segment"], "_d", {"median": 0.5}), "segment").join(group_quantiles(long, ["segment"], "_a", {"p90": 0.9}), "segment")


def dynamic_bias(future: DataFrame, recent: DataFrame, keys: Sequence[str] = ("series",), decay_hours: float = 48.0, cap: float = 8.0) -> DataFrame:
    """Mean delta of a key's last matched rows, fading with exp(-h/decay) over its future rows."""
    m = recent.groupBy(*keys).agg(F.avg("LocalStation_TempDelta_F").alias("_m"))
    start = future.groupBy(*keys).agg(F.min(epoch_second("DT")).alias("_t0"))
    j = null_safe_join(null_safe_join(future, m, keys), start, keys)
    fade = F.exp(-((epoch_second("DT") - c("_t0")) / 3600.0) / decay_hours)
    return j.withColumn("TempF", c("TempF") + F.coalesce(clip("_m", -cap, cap) * fade, F.lit(0.0))).drop("_m", "_t0")


def serial_dependence(df: DataFrame, value: str, keys: Sequence[str], chunk_hours: int = 2160) -> DataFrame:
    """Lag-1 correlation and the sum of squared steps over the sum of squares, by row order across gaps of any length."""
    p = rows_before(df, keys, epoch_hour("DT"), chunk_hours, c(value), 1, "DT").withColumnRenamed("_before1", "_p")
    v = c(value)
    return p.groupBy(*keys).agg(F.corr(value, "_p").alias("acf1"), (F.sum((v - c("_p")) * (v - c("_p"))) / F.sum(v * v)).alias("dw"))


def autocorrelation(df: DataFrame, value: str, keys: Sequence[str], lags: Sequence[int], chunk_hours: int = 2160) -> DataFrame:
    """Per key and lag the correlation with the value so many rows before and the number of pairs; rows without a value are no rows.

    Null where fewer than two pairs exist or one side does not vary.
    """
    far = max(lags)
    p = rows_before(df.where(c(value).isNotNull()), keys, epoch_hour("DT"), chunk_hours, c(value), far, "DT")
    pairs = F.array(*[F.struct(F.lit(k).alias("lag"), c(f"_before{k}").alias("_p")) for k in lags])
    long = p.select(*keys, c(value).alias("_v"), F.inline(pairs)).where("_p is not null")
    g = long.groupBy(*keys, "lag").agg(F.count("*").alias("pairs"), F.corr("_v", "_p").alias("_c"), F.stddev_pop("_v").alias("_a"), F.stddev_pop("_p").alias("_b"))
    varies = (c("pairs") > 1) & (c("_a") >= 1e-9) & (c("_b") >= 1e-9)
    return g.select(*keys, "lag", "pairs", F.when(varies, c("_c")).alias("acf"))


def yearly_trend(daily: DataFrame, value: str, date: str = "Date") -> DataFrame:
    """Per year count, mean, median and max, and a linear trend fitted on the years before it (two at least)."""
    x = daily.withColumn("y", F.year(date))
    g = x.groupBy("y").agg(F.count("*").alias("n"), F.avg(value).alias("m"), F.percentile(value, 0.5).alias("md"), F.max(value).alias("mx"))  # at most 366 days a year
    w = Window.orderBy("y").rowsBetween(Window.unboundedPreceding, -1)  # one row per year
    t = g.withColumns({"_k": F.count("*").over(w), "_a": F.regr_intercept("m", "y").over(w), "_b": F.regr_slope("m", "y").over(w)})
    return t.select("y", "n", "m", "md", "mx", F.when(c("_k") >= 2, c("_a") + c("_b") * c("y")).alias("trend"))


def new_records(daily: DataFrame, features: Sequence[str], start: str, end: str, date: str = "Date") -> DataFrame:
    """Event days above the earlier 99th percentile of a feature, and whether they beat its earlier maximum."""
    u = daily.select(date, F.inline(F.array(*[F.struct(F.lit(f).alias("feature"), c(f).cast("double").alias("v")) for f in features])))
    past = u.where(c(date) < F.lit(start).cast("date"))
    ref = past.groupBy("feature").agg(F.max("v").alias("mx")).join(group_quantiles(past, ["feature"], "v", {"p99": 0.99}), "feature")
    e = u.where(c(date).between(F.lit(start).cast("date"), F.lit(end).cast("date"))).join(ref, "feature")
    return e.where(c("v") > c("p99")).withColumn("record", (c("v") > c("mx")).cast("int"))


def weight_search(df: DataFrame, parts: Sequence[str], step: float, max_peak_loss: float, actual: str = ACTUAL) -> DataFrame:
    """Best convex weights of three forecasts by MAE, among those whose peak under-forecast is near the lowest.

    Every grid point is an aggregate of the same pass, so rows are neither
    copied nor joined with the grid; one row of sums is then laid out.
    """
    k = round(1 / step)
    grid = [(a / k, b / k, (k - a - b) / k) for a in range(k + 1) for b in range(k + 1 - a)]
    y, peak = c(actual), c("Hour").between(14, 18)
    aggs = []
    for i, ws in enumerate(grid):
        r = y - sum((w * c(p) for w, p in zip(ws, parts, strict=True)), F.lit(0.0))
        aggs += [F.avg(F.abs(r)).alias(f"m{i}"), F.avg(F.when(peak, F.greatest(r, F.lit(0.0)))).alias(f"p{i}")]
    one = df.agg(*aggs)
    g = one.select(F.inline(F.array(*[F.struct(F.lit(a).alias("wa"), F.lit(b).alias("wb"), c(f"m{i}").alias("mae"), c(f"p{i}").alias("pu")) for i, (a, b, _) in enumerate(grid)])))
    low = F.min("pu").over(Window.partitionBy(F.lit(0)))  # one row per grid point
    return g.withColumn("_lo", low).where(c("pu") <= c("_lo") + max_peak_loss).orderBy("mae", "wa", "wb").limit(1).drop("_lo")


def guard_sweep(df: DataFrame, base: str, anchor: str, blends: Sequence[float], caps: Sequence[float], actual: str = ACTUAL) -> DataFrame:
    """Error of a capped pull toward an anchor for every (blend, cap), in one pass over the rows."""
    pts = [(float(b), float(k)) for b in blends for k in caps]
    e = [F.avg(F.abs(c(actual) - (c(base) + clip((c(anchor) - c(base)) * b, -k, k)))).alias(f"m{i}") for i, (b, k) in enumerate(pts)]
    one = df.agg(*e, F.avg(F.abs(c(actual) - c(base))).alias("base"))
    return one.select("base", F.inline(F.array(*[F.struct(F.lit(b).alias("blend"), F.lit(k).alias("cap"), c(f"m{i}").alias("mae")) for i, (b, k) in enumerate(pts)])))


def peak_muting(future: DataFrame, past: DataFrame, forecast: str, stress: str, keys: Sequence[str] = ("series",), actual: str = ACTUAL) -> DataFrame:
    """Per future day its forecast peak, the largest gap to a stress value, and the actual peaks of earlier days in the same 5-degree band."""
    f = future.groupBy(*keys, "Date").agg(F.max(forecast).alias("pk"), F.max_by("Hour", F.struct(forecast, -epoch_second("DT"))).alias("ph"), F.max("Temperature_DailyMax").alias("_t"),
                                          F.max(F.when(c("Hour").between(14, 20), c(stress) - c(forecast))).alias("gap")).withColumn("_b", F.floor(c("_t") / 5))
    days = past.groupBy(*keys, "Date").agg(F.max(actual).alias("_a"), F.floor(F.max("Temperature_DailyMax") / 5).alias("_b"))
    h = null_safe_join(days.groupBy(*keys, "_b").agg(F.avg("_a").alias("am"), F.max("_a").alias("mx")), group_quantiles(days, [*keys, "_b"], "_a", {"p90": 0.9}), [*keys, "_b"])
    j = f.join(h, [*keys, "_b"], "left")
    return j.select(*keys, "Date", "pk", "ph", "gap", "am", "p90", "mx", F.coalesce((c("pk") < c("am")) & (c("_t") >= 95), F.lit(False)).cast("int").alias("muted"))
