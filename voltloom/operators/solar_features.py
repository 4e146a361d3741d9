"""Behind-the-meter solar features of an hourly frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..core import ensure_columns, epoch_hour, rows_before, safe_div
from ..functions.weather import clip, solar_hour_shape, solar_season_factor

CAPACITY = ("Nameplate_MW", "Capacity_Ratio_To_Current", "Impact_Cap_MW")


def extend_capacity(monthly: DataFrame, keys: Sequence[str] = ("series",), months: int = 24, cap_share: float = 1.0) -> DataFrame:
    """Monthly kW capacity to MW, held flat for ``months`` more months, with its ratio to the newest value."""
    m = monthly.select(*keys, F.trunc("DT", "month").alias("PeriodStart"), (F.col("Nameplate_kW") / 1000.0).alias("Nameplate_MW"))
    last = m.groupBy(*keys).agg(F.max("PeriodStart").alias("_end"), F.max_by("Nameplate_MW", "PeriodStart").alias("_cur"))
    future = last.select(*keys, F.explode(F.sequence(F.add_months("_end", 1), F.add_months("_end", months), F.expr("INTERVAL 1 MONTH"))).alias("PeriodStart"),
                         F.col("_cur").alias("Nameplate_MW")).withColumn("PeriodStart", F.to_date("PeriodStart"))
    both = m.unionByName(future).join(last.drop("_end"), list(keys))
    return both.select(*keys, "PeriodStart", "Nameplate_MW", F.coalesce(safe_div(F.col("Nameplate_MW"), F.col("_cur")), F.lit(0.0)).alias("Capacity_Ratio_To_Current"),
                       (F.col("Nameplate_MW") * cap_share).alias("Impact_Cap_MW"))


def fill_forward_back(months: DataFrame, keys: Sequence[str], order: str, cols: Sequence[str]) -> DataFrame:
    """Last known value, else next known, else 0; for frames with one row per key and month."""
    w = Window.partitionBy(*keys).orderBy(order)
    prev, nxt = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    return months.withColumns({c: F.coalesce(F.last(c, ignorenulls=True).over(prev), F.first(c, ignorenulls=True).over(nxt), F.lit(0.0))
                               for c in cols})


def attach_capacity(df: DataFrame, capacity: DataFrame, keys: Sequence[str] = ("series",)) -> DataFrame:
    """Capacity of each row's month, gaps filled forward then back.

    Filling runs over the distinct months of the frame, not over its hours.
    """
    rows = df.withColumn("PeriodStart", F.trunc("DT", "month"))
    months = rows.select(*keys, "PeriodStart").distinct().join(capacity, [*keys, "PeriodStart"], "left")
    filled = fill_forward_back(months, keys, "PeriodStart", CAPACITY)
    return rows.join(filled, [*keys, "PeriodStart"], "left").drop("PeriodStart")


def add_solar_features(df: DataFrame, capacity: DataFrame, explicit: DataFrame | None = None,
                       keys: Sequence[str] = ("series",), chunk_hours: int = 24 * 90) -> DataFrame:
    """Clear-sky proxies, solar loss, daily totals and ramps.

    ``explicit`` (keys, DT, Solar_Forecast_MW) wins over the irradiance proxy.
    """
    out = attach_capacity(df, capacity, keys)
    if explicit is not None:
        out = out.drop("Solar_Forecast_MW").join(explicit.select(*keys, "DT", "Solar_Forecast_MW"), [*keys, "DT"], "left")
    out = ensure_columns(out, {"Solar_Forecast_MW": "double", "GHI_Wm2": "double", "CloudCover_Norm": "double"})
    hour, c, zero = F.hour("DT"), F.col, F.lit(0.0)
    out = out.withColumns({
        "Date": F.to_date("DT"), "Solar_Irradiance": clip(F.coalesce(c("GHI_Wm2"), zero), lo=0),
        "Solar_Hour_Shape": solar_hour_shape(hour), "Solar_Season_Factor": solar_season_factor(F.dayofyear("DT")),
        "_cloud": clip(F.coalesce(c("CloudCover_Norm"), zero), 0, 1),
    })
    sky = clip(1000.0 * c("Solar_Hour_Shape") * c("Solar_Season_Factor"), lo=0)
    out = out.withColumns({"ClearSky_GHI_Proxy_Wm2": sky})
    proxy = c("Impact_Cap_MW") * (c("Solar_Irradiance") / 950.0) * c("Solar_Hour_Shape")
    out = out.withColumns({
        "ClearSky_Index": F.coalesce(clip(safe_div(c("Solar_Irradiance"), c("ClearSky_GHI_Proxy_Wm2")), 0, 1.35), zero),
        "BTM_ClearSky_Proxy_MW": clip(c("Impact_Cap_MW") * (c("ClearSky_GHI_Proxy_Wm2") / 950.0) * c("Solar_Hour_Shape"), lo=0),
        "BTM_Solar_Proxy_MW": clip(F.coalesce(c("Solar_Forecast_MW"), clip(proxy, lo=0), zero), lo=0),
    })
    p, cloud = c("BTM_Solar_Proxy_MW"), c("_cloud")
    midday, evening = hour.between(10, 15).cast("int"), hour.between(16, 20).cast("int")
    out = out.withColumns({
        "BTM_Solar_Cloud_Adjusted_MW": p, "BTM_Solar_Loss_From_ClearSky_MW": clip(c("BTM_ClearSky_Proxy_MW") - p, lo=0),
        "Cloud_x_Solar_Hour": cloud * c("Solar_Hour_Shape"), "Cloud_x_ClearSky_GHI": cloud * c("ClearSky_GHI_Proxy_Wm2"),
        "BTM_x_GHI": p * c("Solar_Irradiance"), "BTM_x_Cloud": p * cloud, "Solar_Midday_Flag": midday,
        "Solar_Evening_Ramp_Flag": evening, "BTM_Midday_Impact": p * midday, "BTM_Evening_Ramp_Impact": p * evening,
    })
    loss = c("BTM_Solar_Loss_From_ClearSky_MW")
    day = Window.partitionBy(*keys, "Date")
    out = out.withColumns({
        "Midday_Overcast_Solar_Loss_MW": loss * midday * (cloud >= 0.60).cast("int"),
        "Daily_BTM_Solar_Proxy_Total_MWh": F.sum(p).over(day), "Daily_BTM_Solar_Proxy_Max_MW": F.max(p).over(day),
        "Daily_BTM_ClearSky_Max_MW": F.max("BTM_ClearSky_Proxy_MW").over(day),
        "Daily_BTM_Solar_Loss_MWh": F.sum(loss).over(day), "Daily_BTM_Solar_Loss_Max_MW": F.max(loss).over(day),
    }).drop("_cloud")
    return add_row_ramps(out, keys, chunk_hours)


def add_row_ramps(df: DataFrame, keys: Sequence[str], chunk_hours: int) -> DataFrame:
    """Ramps against the one and two rows before, however old; without one the ramp is 0."""
    p = F.col("BTM_Solar_Proxy_MW")
    j = rows_before(df, keys, epoch_hour("DT"), chunk_hours, p, 2, "DT")
    d1, d2 = p - F.col("_before1"), p - F.col("_before2")
    z = lambda x: F.greatest(F.coalesce(x, F.lit(0.0)), F.lit(0.0))
    return j.withColumns({"Solar_Ramp_Down_1hr": z(-d1), "Solar_Ramp_Down_2hr": z(-d2), "Solar_Ramp_Up_1hr": z(d1)}).drop("_before1", "_before2")
