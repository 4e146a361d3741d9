"""Record-heat climatology: prior years only, circular day-of-year window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Percentile, window, and years needed; months the feature is active in.
PERCENTILE = 95.0
WINDOW_DAYS = 10
MIN_YEARS = 3
ACTIVE_MONTHS = (6, 7, 8, 9)
YEAR_LENGTH = 366


def daily_max_reference(hourly: DataFrame, keys: Sequence[str] = ("series",), temp: str = "TempF") -> DataFrame:
    """One row per key and date with the day's highest temperature, year and day of year."""
    d = hourly.where(F.col("DT").isNotNull()).groupBy(*keys, F.to_date("DT").alias("Date")).agg(F.max(temp).alias("Temperature_DailyMax"))
    return d.where("Temperature_DailyMax is not null").withColumns({"Year": F.year("Date"), "DOY": F.dayofyear("Date")})


def climatology_lookup(reference: DataFrame, dates: DataFrame, keys: Sequence[str] = ("series",), percentile: float = PERCENTILE,
                       window_days: int = WINDOW_DAYS, min_years: int = MIN_YEARS) -> DataFrame:
    """Percentile of the daily maxima of strictly earlier years near the same day of year.

    Each reference day is copied to the 2w+1 days of year it can serve, which
    turns the range join into an equi join on (key, day of year).  A group holds
    one row per prior year and window day, so ``percentile`` stays small.
    """
    spread = F.transform(F.sequence(F.lit(-window_days), F.lit(window_days)), lambda k: F.pmod(F.col("DOY") - 1 + k, F.lit(YEAR_LENGTH)) + 1)
    ref = reference.select(*keys, F.col("Year").alias("_ry"), "Temperature_DailyMax", F.explode(spread).alias("DOY"))
    target = dates.select(*keys, "Date").distinct().withColumns({"Year": F.year("Date"), "DOY": F.dayofyear("Date")})
    hit = target.join(ref, [*keys, "DOY"], "left")
    prior = F.col("_ry") < F.col("Year")
    out = hit.groupBy(*keys, "Date").agg(
        F.count_distinct(F.when(prior, F.col("_ry"))).alias("Temp_Climatology_Reference_Years"),
        F.percentile(F.when(prior, F.col("Temperature_DailyMax")), percentile / 100.0).alias("_p"))
    enough = F.col("Temp_Climatology_Reference_Years") >= min_years
    return out.select(*keys, "Date", F.when(enough, F.col("_p")).alias("Climatology_Temp_PXX_F"), "Temp_Climatology_Reference_Years")


def add_record_heat(df: DataFrame, lookup: DataFrame, keys: Sequence[str] = ("series",), active_months: Sequence[int] = ACTIVE_MONTHS) -> DataFrame:
    """Excess of the daily maximum over its climatology; null outside the active months (all when empty)."""
    out = df.withColumn("_d", F.to_date("DT")).join(lookup.withColumnRenamed("Date", "_d"), [*keys, "_d"], "left").drop("_d")
    excess = F.col("Temperature_DailyMax") - F.col("Climatology_Temp_PXX_F")
    if active_months:
        excess = F.when(F.month("DT").isin(*active_months), excess)
    return out.withColumn("Temp_Excess_Over_Climatology_F", excess)
