"""History assembly, analogs, interpolation, origins and small set operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..core import chunked, epoch_hour, epoch_second, group_quantiles, keep_last, null_safe_join
from ..functions.calendar import season
from ..functions.weather import clip
from .lags import CHUNK_HOURS, with_row_number

c = F.col


# ---- bounded interpolation ----------------------------------------------------------------------

def interpolate(df: DataFrame, value: str, keys: Sequence[str] = ("series",), limit: int = 3, chunk_hours: int = CHUNK_HOURS) -> DataFrame:
    """Time-linear fill of nulls within ``limit`` rows of a value on either side; edges take the nearest value.

    Neighbours may lie in other chunks, so each chunk is given the last value
    before it and the first after it from the chunk summaries.
    """
    n = with_row_number(df, keys, "DT", chunk_hours, name="_pos")
    ch = chunked(n, epoch_hour("DT"), chunk_hours)
    known = F.when(c(value).isNotNull(), F.struct(c("_pos").alias("p"), epoch_second("DT").alias("t"), c(value).alias("v")))
    ch = ch.withColumn("_k", known)
    ends = ch.groupBy(*keys, "_chunk").agg(F.max("_k").alias("_l"), F.min("_k").alias("_f"))
    w = Window.partitionBy(*keys).orderBy("_chunk")
    ends = ends.select(*keys, "_chunk", F.last("_l", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("_cl"), F.first("_f", ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing)).alias("_cf"))
    j = ch.join(ends, [*keys, "_chunk"])
    o = Window.partitionBy(*keys, "_chunk").orderBy("_pos")
    prev = F.coalesce(F.last("_k", ignorenulls=True).over(o.rowsBetween(Window.unboundedPreceding, 0)), c("_cl"))
    nxt = F.coalesce(F.first("_k", ignorenulls=True).over(o.rowsBetween(0, Window.unboundedFollowing)), c("_cf"))
    j = j.withColumns({"_a": prev, "_b": nxt})
    near = (c("_pos") - c("_a.p") <= limit) | (c("_b.p") - c("_pos") <= limit)
    line = c("_a.v") + (c("_b.v") - c("_a.v")) * (epoch_second("DT") - c("_a.t")) / (c("_b.t") - c("_a.t"))
    fill = F.when(c("_a").isNull(), c("_b.v")).when(c("_b").isNull(), c("_a.v")).otherwise(line)
    out = F.when(c(value).isNotNull(), c(value)).when(F.coalesce(near, F.lit(False)), fill)
    return j.withColumn(value, out).drop("_pos", "_chunk", "_ct", "_k", "_cl", "_cf", "_a", "_b")


# ---- frames -------------------------------------------------------------------------------------

def training_rows(load: DataFrame, weather: DataFrame, keys: Sequence[str] = ("series",), target: str = "MWH", temp: str = "TempF") -> DataFrame:
    """Load joined to weather on the time; rows without target or temperature are dropped."""
    return load.join(weather, [*keys, "DT"], "left").where(c(target).isNotNull() & c(temp).isNotNull())


def extend_with_forecast(archive: DataFrame, forecast: DataFrame, latest: DataFrame, keys: Sequence[str] = ("series",)) -> DataFrame:
    """Archive rows, and forecast rows up to the latest load where the archive has none."""
    f = null_safe_join(forecast, latest.select(*keys, c("latest").alias("_l")), keys, "inner").where(c("DT") <= c("_l")).drop("_l")
    both = archive.withColumn("_p", F.lit(1)).unionByName(f.withColumn("_p", F.lit(0)), allowMissingColumns=True)
    return keep_last(both, [*keys, "DT"], ["_p"]).drop("_p")


def to_cutoff(df: DataFrame, cutoff: str | Column, offset_hours: float = 0.0) -> DataFrame:
    """Rows at or before a cutoff; the comparison is on the bare column, so it reaches the scan."""
    cut = F.lit(cutoff).cast("timestamp") if isinstance(cutoff, str) else cutoff
    if offset_hours:
        cut = cut + F.make_dt_interval(hours=F.lit(int(offset_hours)), mins=F.lit(int(round(offset_hours % 1 * 60))))
    return df.where(c("DT") <= cut)


def until_incomplete(df: DataFrame, required: Sequence[str], keys: Sequence[str] = ("series",)) -> DataFrame:
    """Rows before a key's first row with a null in a required column: an aggregate and a filter, no ordering."""
    bad = F.lit(False)
    for r in required:
        bad = bad | c(r).isNull()
    first = df.groupBy(*keys).agg(F.min(F.when(bad, c("DT"))).alias("_bad"))
    return null_safe_join(df, first, keys).where(c("_bad").isNull() | (c("DT") < c("_bad"))).drop("_bad")


def require_complete(df: DataFrame, required: Sequence[str], context: str) -> DataFrame:
    """Fail the job on a null in a required column."""
    checks = {r: F.when(c(r).isNull(), F.raise_error(F.lit(f"{context}: {r} is null")).cast(dict(df.dtypes)[r])).otherwise(c(r)) for r in required}
    return df.withColumns(checks)


def display_rows(history: DataFrame, future: DataFrame, keys: Sequence[str] = ("series",), history_hours: int = 168, horizon_days: int = 16) -> DataFrame:
    """The last hours of history and the horizon of the future in one frame, measured from each key's last actual."""
    end = history.groupBy(*keys).agg(F.max("DT").alias("_end"))
    u = history.withColumn("Row_Type", F.lit("history")).unionByName(future.withColumn("Row_Type", F.lit("forecast")), allowMissingColumns=True)
    j = null_safe_join(u, end, keys)
    age = (epoch_second("_end") - epoch_second("DT")) / 3600.0
    keep = ((c("Row_Type") == "history") & (age < history_hours)) | ((c("Row_Type") == "forecast") & (age < 0) & (age >= -horizon_days * 24))
    return j.where(keep).drop("_end")


def smoothed_band(df: DataFrame, band: str, keys: Sequence[str], order: str = "DT", floor: float = 1.0, hi_quantile: float = 0.95) -> DataFrame:
    """Display band: centred 5-row median, then 3-row mean, capped at a quantile of the key's bands, floored.

    Keys name one displayed horizon, a few hundred rows.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    m = df.withColumn("_m", F.percentile(band, 0.5).over(w.rowsBetween(-2, 2)))
    m = m.withColumn("_s", F.avg("_m").over(w.rowsBetween(-1, 1)))
    q = group_quantiles(df, keys, band, {"_cap": hi_quantile})
    return null_safe_join(m, q, keys).withColumn("Display_Band", F.greatest(F.least("_s", "_cap"), F.lit(float(floor)))).drop("_m", "_s", "_cap")


def lead_days(df: DataFrame, candidates: Sequence[str], anchor: str, keys: Sequence[str] = ()) -> DataFrame:
    """First candidate lead column that has a value in the key; else days since the first date with a forecast, plus 1."""
    cols = [x for x in candidates if x in df.columns]
    first = F.coalesce(F.min(F.when(c(anchor).isNotNull(), F.to_date("DT"))), F.min(F.to_date("DT"))).alias("_d0")
    g = df.groupBy(*keys).agg(first, *[F.count(x).alias(f"_n_{x}") for x in cols]) if keys else df.agg(first, *[F.count(x).alias(f"_n_{x}") for x in cols])
    if keys:
        j = null_safe_join(df, g, keys)
    else:
        j = df.withColumn("_g", g.select(F.struct("*")).scalar()).select("*", "_g.*").drop("_g")
    lead = (F.datediff(F.to_date("DT"), "_d0") + 1).cast("double")
    for x in reversed(cols):
        lead = F.when(c(f"_n_{x}") > 0, c(x).cast("double")).otherwise(lead)
    return j.withColumn("Lead_Days", lead).drop("_d0", *[f"_n_{x}" for x in cols])


def config_value(col: str, table: Mapping, default: float) -> Column:
    """Value of a small fixed mapping, or the default."""
    m = F.create_map(*[x for k, v in table.items() for x in (F.lit(str(k)), F.lit(float(v)))])
    return F.coalesce(F.try_element_at(m, c(col).cast("string")), F.lit(float(default)))


def config_pair(a: str, b: str, table: Mapping[int, Mapping[int, float]], default: float) -> Column:
    """Value of a nested mapping keyed by two whole numbers, or the default."""
    m = F.create_map(*[x for k, inner in table.items() for k2, v in inner.items() for x in (F.lit(f"{int(k)}|{int(k2)}"), F.lit(float(v)))])
    key = F.concat_ws("|", F.round(c(a)).cast("int").cast("string"), F.round(c(b)).cast("int").cast("string"))
    return F.coalesce(F.try_element_at(m, key), F.lit(float(default)))


def select_stage(df: DataFrame, stages: Mapping[str, str], policies: Sequence[Mapping], default: str, uplift: Column | None = None) -> DataFrame:
    """Final forecast per row from the stage a policy names; later policies override earlier ones.

    Policies bound horizon day, hours, months and daily maximum, and carry a reason.
    """
    stage, reason = F.lit(default), F.lit("default")
    for p in policies:
        ok = F.lit(True)
        for lo, hi, col in (("min_day", "max_day", "Forecast_Day"), ("min_temp", "max_temp", "Temperature_DailyMax")):
            if p.get(lo) is not None:
                ok = ok & (c(col) >= p[lo])
            if p.get(hi) is not None:
                ok = ok & (c(col) <= p[hi])
        for k, col in (("hours", "Hour"), ("months", "Month")):
            if p.get(k):
                ok = ok & c(col).isin(*p[k])
        ok = F.coalesce(ok, F.lit(False))
        stage, reason = F.when(ok, F.lit(p["stage"])).otherwise(stage), F.when(ok, F.lit(p["reason"])).otherwise(reason)
    pick = F.lit(None).cast("double")
    for s, col in stages.items():
        pick = F.when(c("Stage_Source") == s, c(col)).otherwise(pick)
    out = df.withColumns({"Stage_Source": stage, "Stage_Reason": reason})
    value = F.coalesce(pick, c(stages[default]))
    return out.withColumn("Stage_Selected_Forecast_MWH", clip(value + (uplift if uplift is not None else F.lit(0.0)), lo=0.0))


# ---- origins ------------------------------------------------------------------------------------

def origin_grid(df: DataFrame, keys: Sequence[str], base: str, step_days: int, count: int, horizon_days: int) -> DataFrame:
    """Each row once per origin whose horizon holds it: origins are ``base`` + k*step, so membership is arithmetic, not a join."""
    d = F.datediff(F.to_date("DT"), F.lit(base).cast("date"))
    lo = F.greatest(F.ceil((d - horizon_days + 1) / step_days), F.lit(0)).cast("int")
    hi = F.least(F.floor(d / step_days), F.lit(count - 1)).cast("int")
    ks = F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))
    out = df.withColumn("_k", F.explode(ks))
    return out.withColumn("origin_dt", F.date_add(F.lit(base).cast("date"), c("_k") * step_days)).drop("_k")


def history_grid(df: DataFrame, base: str, step_days: int, count: int, history_days: int) -> DataFrame:
    """Each row once per origin it is history of: strictly before the origin, at most ``history_days`` earlier."""
    d = F.datediff(F.to_date("DT"), F.lit(base).cast("date"))
    lo = F.greatest(F.floor(d / step_days) + 1, F.lit(0)).cast("int")
    hi = F.least(F.floor((d + history_days) / step_days), F.lit(count - 1)).cast("int")
    ks = F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))
    out = df.withColumn("_k", F.explode(ks))
    return out.withColumn("origin_dt", F.date_add(F.lit(base).cast("date"), c("_k") * step_days)).drop("_k")


def rolling_origin_replay(load: DataFrame, base: str, step_days: int, count: int, horizon_days: int, history_days: int = 7, keys: Sequence[str] = ("series",), value: str = "MWH") -> DataFrame:
    """Seasonal-naive replay of all origins in one job: the mean of the hour over the days before the origin, scored on the horizon."""
    target = origin_grid(load.withColumn("Hour", F.hour("DT")), keys, base, step_days, count, horizon_days)
    hist = history_grid(load.withColumn("Hour", F.hour("DT")), base, step_days, count, history_days)
    prof = hist.groupBy("origin_dt", *keys, "Hour").agg(F.avg(value).alias("Raw_Forecast_MWH"), F.count(value).alias("history_n"))
    j = target.join(prof, ["origin_dt", *keys, "Hour"], "left")
    w = Window.partitionBy("origin_dt", *keys).orderBy("DT")  # at most horizon_days * 24 rows
    lead = F.row_number().over(w)
    return j.withColumns({"Forecast_Lead_Hour": lead}).withColumn("Forecast_Day", (F.floor((c("Forecast_Lead_Hour") - 1) / 24) + 1).cast("int")).withColumnRenamed(value, "Actual_MWH")


def seasonal_origins(dates: DataFrame, base: str, step_days: int, per_season: int, max_origins: int, min_rows: int, horizon_days: int) -> DataFrame:
    """Origins stepping back from ``base`` that have enough scored rows; the newest of each season first, then others up to the maximum."""
    d = F.datediff(F.lit(base).cast("date"), c("Date"))
    # a date is scored by origins base - k*step in (date - horizon, date]
    lo, hi = F.greatest(F.ceil(d / step_days), F.lit(0)).cast("int"), F.floor((d + horizon_days - 1) / step_days).cast("int")
    k = dates.where(F.datediff(F.lit(base).cast("date"), c("Date")) > -horizon_days).select(F.explode(F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))).alias("k"), c("n"))
    o = k.groupBy("k").agg(F.sum("n").alias("rows")).where(c("rows") >= min_rows).withColumn("origin", F.date_sub(F.lit(base).cast("date"), c("k") * step_days))
    first = dates.agg(F.min("Date")).scalar()
    o = o.where(c("origin") >= first).withColumn("season", season(F.month("origin")))
    order = F.array_position(F.array(*[F.lit(x) for x in ("Winter", "Spring", "Summer", "Fall")]), c("season"))
    r = F.row_number().over(Window.partitionBy("season").orderBy(F.desc("origin")))  # origins are few: one per step
    o = o.withColumns({"_r": r, "_s": order})
    picked = c("_r") <= per_season
    rank = F.row_number().over(Window.orderBy(F.when(picked, 0).otherwise(1), F.when(picked, c("_s")), F.desc("origin")))
    return o.withColumn("_rank", rank).where(c("_rank") <= max_origins).select("origin", "season", "rows")


def fixed_origins(origins: Sequence[str], df: DataFrame, horizon_days: int, min_rows: int = 24) -> DataFrame:
    """Listed origins, without repeats, that have at least ``min_rows`` scored rows."""
    arr = F.array(*[F.lit(o).cast("timestamp") for o in dict.fromkeys(origins)])
    end = F.make_dt_interval(days=F.lit(horizon_days))
    hit = df.select(F.explode(F.filter(arr, lambda o: (c("DT") >= o) & (c("DT") < o + end))).alias("origin"))
    return hit.groupBy("origin").agg(F.count("*").alias("rows")).where(c("rows") >= min_rows)


# ---- analogs ------------------------------------------------------------------------------------

def heat_analogs(df: DataFrame, base: str, origin: str, keys: Sequence[str] = ("series",), min_temp: float = 105.0, window: float = 3.0, blend: float = 0.50, cap: float = 12.0, min_count: int = 3,
                 hours: Sequence[int] = tuple(range(14, 21)), months: Sequence[int] = (6, 7, 8, 9), actual: str = "Actual_MWH", first: Sequence[str] = ()) -> DataFrame:
    """Blend hot peak rows toward the mean of earlier hot hours with a similar daily maximum.

    The source holds one hot row per (key, time), the first by ``first`` (by default by
    temperature and value, so the choice never depends on chance); both sides are reduced to the
    distinct (origin, hour, month, temperature) targets and the hot source rows
    of the same hour and whole-degree band before they meet, so the work is
    bounded by calendar hours, not by input rows.
    """
    t = c("Temperature_DailyMax")
    scope = (t >= min_temp) & c("Hour").isin(*hours) & c("Month").isin(*months) & c(base).isNotNull()
    src = df.where((t >= min_temp) & c(actual).isNotNull() & c("Hour").isNotNull())
    src = src.groupBy(*keys, "DT").agg(F.min_by(F.struct("Hour", "Month", t.alias("t"), c(actual).alias("a")), F.struct(*(first or (t, c(actual))))).alias("_s"))
    width = max(window, 0.5)
    band = F.floor(c("_s.t") / width)
    src = src.select(*keys, c("DT").alias("_sd"), c("_s.Hour").alias("Hour"), c("_s.Month").alias("_sm"), c("_s.t").alias("_st"), c("_s.a").alias("_sa"), F.explode(F.array(band - 1, band, band + 1)).alias("_band"))
    tg = df.where(scope).select(*keys, origin, "Hour", "Month", t.alias("_t")).distinct().withColumn("_band", F.floor(c("_t") / width))
    hit = tg.join(src, [*keys, "Hour", "_band"], "left")
    ok = (c("_sd") < c(origin)) & (F.abs(c("_st") - c("_t")) <= window)
    tiers = {"m": ok & (c("_sm") == c("Month")), "s": ok & c("_sm").isin(*months), "a": ok}
    g = hit.groupBy(*keys, origin, "Hour", "Month", "_t").agg(*[F.count(F.when(x, 1)).alias(f"_n{k}") for k, x in tiers.items()], *[F.avg(F.when(x, c("_sa"))).alias(f"_v{k}") for k, x in tiers.items()])
    pick = lambda p: F.when(c("_nm") >= min_count, c(f"{p}m")).when(c("_ns") >= min_count, c(f"{p}s")).when(c("_na") >= min_count, c(f"{p}a"))
    name = F.when(c("_nm") >= min_count, "same_month_multi_summer").when(c("_ns") >= min_count, "summer_months_multi_summer").when(c("_na") >= min_count, "all_prior_same_hour_temp")
    g = g.select(*keys, origin, "Hour", "Month", c("_t").alias("Temperature_DailyMax"), pick("_v").alias("Analog_Mean"), pick("_n").alias("Analog_Count"), name.alias("_name"))
    j = null_safe_join(df, g, [*keys, origin, "Hour", "Month", "Temperature_DailyMax"])
    use = F.coalesce(scope, F.lit(False)) & c("Analog_Mean").isNotNull()
    corr = clip((c("Analog_Mean") - c(base)) * blend, -cap, cap)
    j = j.withColumns({"Heat_Analog_Scope_Flag": F.coalesce(scope, F.lit(False)).cast("int"), "Heat_Analog_Source": F.when(use, c("_name")).when(F.coalesce(scope, F.lit(False)), "no_pre_origin_match").otherwise("out_of_scope"),
                       "Heat_Analog_Shadow_Correction_MWH": F.when(use, corr).otherwise(0.0)})
    return j.withColumn("Heat_Analog_Shadow_Forecast_MWH", c(base) + c("Heat_Analog_Shadow_Correction_MWH")).drop("_name")


# ---- sets and ranges ----------------------------------------------------------------------------

def contiguous_ranges(dates: DataFrame, keys: Sequence[str] = (), col: str = "Date") -> DataFrame:
    """Distinct dates to inclusive ranges; one row per key and day, so the window is bounded by the calendar."""
    d = dates.select(*keys, col).distinct()
    w = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(col)
    return d.withColumn("_i", F.date_sub(col, F.row_number().over(w))).groupBy(*keys, "_i").agg(F.min(col).alias("start"), F.max(col).alias("end"), F.count("*").alias("days")).drop("_i")


def chunk_ranges(ranges: DataFrame, days: int) -> DataFrame:
    """Ranges cut into pieces of at most ``days``."""
    keep = [x for x in ranges.columns if x not in ("start", "end", "days")]
    x = ranges.select(*keep, "end", F.explode(F.sequence("start", "end", F.expr(f"INTERVAL {days} DAYS"))).alias("_s"))
    return x.select(*keep, F.to_date("_s").alias("start"), F.least(F.date_add(F.to_date("_s"), days - 1), c("end")).alias("end"))


def months_touched(ranges: DataFrame) -> DataFrame:
    keep = [x for x in ranges.columns if x not in ("start", "end", "days")]
    return ranges.select(*keep, F.explode(F.sequence(F.trunc("start", "month"), F.trunc("end", "month"), F.expr("INTERVAL 1 MONTH"))).alias("month")).distinct()


def missing_dates(covered: DataFrame, expected: int, start: str, end: str, site: str = "site", date: str = "Date") -> DataFrame:
    """Dates of a window on which fewer than ``expected`` sites have rows."""
    full = covered.groupBy(date).agg(F.count_distinct(site).alias("_n")).where(c("_n") >= expected).select(date)
    spark = covered.sparkSession
    n = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias(date))
    return n.join(full, date, "left_anti")
