"""Nested temporal holdout of the solar calibration: month, regime and peak steps learned before it and gated on it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..core import join_small, null_safe_join
from ..core.scratch import materialise
from .solar import lookup_regime, month_factors, peak_params, prune_factors, regime_factors

c = F.col


@dataclass(frozen=True)
class Gates:
    """Bounds of the steps and the tolerances of their gates."""

    month_prior_mwh: float = 100.0
    month: tuple[float, float] = (0.9, 1.1)
    regime_rows: int = 12
    regime_mwh: float = 10.0
    regime_prior_mwh: float = 50.0
    regime: tuple[float, float] = (0.85, 1.15)
    regime_gain: float = 0.0005
    regime_tolerance: float = 0.0005
    peak_quantile: float = 0.95
    peak_rows: int = 12
    peak_mwh: float = 1.0
    peak_floor: float = 0.8
    peak_target: float = 1.0
    peak_tolerance: float = 0.0015
    capture_tolerance: float = 0.001


def hold_out_latest(df: DataFrame, share: float = 0.2, min_rows: int = 12, min_train: int = 24, by: Sequence[str] = ("seg",), time: str = "IntervalStartDT") -> DataFrame:
    """``holdout`` flag of the latest ``share`` of each key's rows, ``min_rows`` at least; rows of one time stay together.

    A key that would keep fewer than ``min_train`` rows before it gives up rows of the
    holdout, and has none when fewer than ``min_rows`` would be left. Rows without a time
    are never held out. The window runs over distinct times, which the calendar bounds.
    """
    n = df.where(c(time).isNotNull()).groupBy(*by, c(time).alias("_ts")).agg(F.count("*").alias("_k"))
    w = Window.partitionBy(*by)
    n = n.withColumns({"_cum": F.sum("_k").over(w.orderBy(c("_ts").desc())), "_n": F.sum("_k").over(w)})
    want = F.least(F.greatest(F.ceil(c("_n") * share), F.lit(min_rows)), c("_n") - min_train)
    fits = (c("_cum") - c("_k") < want) & (want >= min_rows) & (c("_n") - c("_cum") >= min_train)
    cut = n.where(fits).groupBy(*by).agg(F.min("_ts").alias("_cut"))
    return join_small(df, cut, by).withColumn("holdout", F.coalesce(c(time) >= c("_cut"), F.lit(False))).drop("_cut")


def hold_out_days(df: DataFrame, days: int, time: str = "IntervalStartDT") -> DataFrame:
    """``holdout`` flag of the last ``days`` calendar days of the whole table, with their ``HoldoutStart``."""
    last = df.agg(F.to_date(F.max(time)).alias("d")).scalar()
    start = F.date_sub(last, days - 1)
    return df.withColumn("HoldoutStart", start).withColumn("holdout", F.coalesce(F.to_date(time) >= c("HoldoutStart"), F.lit(False)))


def with_month(df: DataFrame, months: DataFrame, by: Sequence[str], base: Column, out: str) -> DataFrame:
    """``base`` times the factor of the row's month, or the key's overall factor where the month has none."""
    months = materialise(months)
    whole = months.groupBy(*by).agg(F.max("aggregate_factor").alias("_all"))
    j = null_safe_join(df.withColumn("_m", F.month("IntervalStartDT")), months.select(*by, c("Month").alias("_m"), c("factor").alias("_f")), [*by, "_m"])
    j = null_safe_join(j, whole, by)
    return j.withColumn(out, base * F.coalesce("_f", "_all", F.lit(1.0))).drop("_m", "_f", "_all")


def _months(df: DataFrame, forecast: str, by: Sequence[str], g: Gates) -> DataFrame:
    return month_factors(df, forecast, by=by, prior_mwh=g.month_prior_mwh, lo=g.month[0], hi=g.month[1])


def _regimes(df: DataFrame, forecast: str, by: Sequence[str], g: Gates) -> DataFrame:
    return regime_factors(df, forecast, by=by, min_rows=g.regime_rows, min_mwh=g.regime_mwh, prior_mwh=g.regime_prior_mwh, lo=g.regime[0], hi=g.regime[1])


def _peaks(df: DataFrame, forecast: str, capacity: str, by: Sequence[str], g: Gates) -> DataFrame:
    return peak_params(df, "Actual_kWh", forecast, capacity, g.peak_quantile, g.peak_floor, g.peak_target, g.peak_rows, g.peak_mwh, by=by)


def with_peak(df: DataFrame, peaks: DataFrame, forecast: str, capacity: str, by: Sequence[str], out: str) -> DataFrame:
    """``forecast`` times the peak factor where its capacity factor reaches the threshold."""
    j = join_small(df, peaks.select(*by, c("peak_factor").alias("_pf"), c("threshold_cf").alias("_th")), by)
    hit = (c("_pf") < 1.0) & (c(forecast) / c(capacity) >= c("_th"))
    return j.withColumn(out, c(forecast) * F.when(hit, c("_pf")).otherwise(1.0)).drop("_pf", "_th")


def training_rows(df: DataFrame, min_forecast: float = 50.0) -> DataFrame:
    return df.where((c("Actual_kWh") >= 0) & (c("Forecast_kWh") >= min_forecast))


@dataclass
class Calibration:
    """The gates' verdicts and the tables that the gated steps are applied from."""

    gates: DataFrame
    months: DataFrame
    regimes: DataFrame
    peaks: DataFrame


def pruned_regimes(df: DataFrame, by: Sequence[str] = ("seg",), residual: Column | None = None, g: Gates = Gates()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows with ``Month_kWh``, candidate factors, kept factors): learned on rows outside the holdout, kept by what they do on it."""
    base = df.withColumn("_base", c("Forecast_kWh") * (residual if residual is not None else F.lit(1.0)))
    fit = base.where("not holdout")
    rows = with_month(base, _months(fit, "_base", by, g), by, c("_base"), "Month_kWh").drop("_base")
    found = materialise(_regimes(rows.where("not holdout"), "Month_kWh", by, g))
    kept = prune_factors(rows.where("holdout"), found, "Month_kWh", by=by, min_rows=g.regime_rows, min_mwh=g.regime_mwh, gain=g.regime_gain)
    return rows, found, materialise(kept)


def calibration_gates(df: DataFrame, capacity: str, by: Sequence[str] = ("seg",), residual: Column | None = None, g: Gates = Gates()) -> tuple[DataFrame, DataFrame]:
    """(one row per key with the holdout's errors after each step and which steps stay, kept regime factors).

    ``df`` holds training rows with a ``holdout`` flag; ``residual`` is the factor of a model
    that did not see the holdout. Month, regime and peak tables come from the other rows
    only. All errors of a key come from one aggregate over its holdout. A key without
    holdout keeps every step.
    """
    rows, found, kept = pruned_regimes(df, by, residual, g)
    peaks = materialise(_peaks(rows.where("not holdout"), "Month_kWh", capacity, by, g))
    v = lookup_regime(rows.where("holdout"), kept, by, "_r").withColumn("Regime_kWh", c("Month_kWh") * c("_r")).drop("_r")
    v = with_peak(v, peaks, "Regime_kWh", capacity, by, "Peak_kWh")
    wmape = lambda x: F.when(F.sum("Actual_kWh") > 0, F.sum(F.abs(c(x) - c("Actual_kWh"))) / F.sum("Actual_kWh"))
    capture = lambda x: F.when(F.max("Actual_kWh") > 0, F.max(x) / F.max("Actual_kWh"))
    m = v.groupBy(*by).agg(F.count("*").alias("Holdout_Rows"), wmape("Forecast_kWh").alias("WMAPE_Base"), wmape("Month_kWh").alias("WMAPE_Month"), wmape("Regime_kWh").alias("WMAPE_Regime"),
                           wmape("Peak_kWh").alias("WMAPE_Peak"), capture("Regime_kWh").alias("Capture_Before"), capture("Peak_kWh").alias("Capture_After"))
    out = null_safe_join(df.groupBy(*by).agg(F.count("*").alias("Rows")), m, by)
    for name, t in (("Regime_Candidates", found), ("Regime_Kept", kept)):
        out = null_safe_join(out, t.groupBy(*by).agg(F.count("*").alias(name)), by).fillna(0, [name])
    out = null_safe_join(out, peaks, by).withColumn("peak_factor", F.coalesce("peak_factor", F.lit(1.0))).fillna(0, ["Holdout_Rows"])
    excess = lambda x: F.greatest(c(x) - g.peak_target, F.lit(0.0))
    worse_regime = c("WMAPE_Regime") > c("WMAPE_Month") + g.regime_tolerance
    worse_peak = (c("peak_factor") < 1.0) & ((c("WMAPE_Peak") > c("WMAPE_Regime") + g.peak_tolerance) | (c("Capture_Before").isNotNull() & (excess("Capture_After") > excess("Capture_Before") + g.capture_tolerance)))
    off = lambda x: ~F.coalesce(x, F.lit(False))
    return out.withColumns({"Regime_On": off(worse_regime), "Peak_On": off(worse_peak)}), kept


def calibrate(df: DataFrame, capacity: str, by: Sequence[str] = ("seg",), residual: Column | None = None, final: Column | None = None, g: Gates = Gates()) -> Calibration:
    """Gate the steps on the holdout, then learn those that stay on all rows.

    Regime factors are learned again on all rows, but only for keys that were kept on the
    holdout; ``final`` is the factor of the model refitted on all rows (by default
    ``residual``). The small tables are written once, as several joins read them.
    """
    gates, kept = calibration_gates(df, capacity, by, residual, g)
    spark = df.sparkSession
    gates = materialise(gates, spark)
    last = final if final is not None else residual
    base = df.withColumn("_base", c("Forecast_kWh") * (last if last is not None else F.lit(1.0)))
    months = materialise(_months(base, "_base", by, g), spark)
    rows = with_month(base, months, by, c("_base"), "Month_kWh")
    regimes = null_safe_join(_regimes(rows, "Month_kWh", by, g), gates.select(*by, "Regime_On", "Holdout_Rows"), by, "inner")
    regimes = null_safe_join(regimes, kept.select(*by, "key", F.lit(True).alias("_kept")), [*by, "key"])
    regimes = materialise(regimes.where(c("Regime_On") & (c("_kept").isNotNull() | (c("Holdout_Rows") == 0))).select(*by, "key", "factor"), spark)
    r = lookup_regime(rows, regimes, by, "_r").withColumn("Regime_kWh", c("Month_kWh") * c("_r"))
    peaks = null_safe_join(_peaks(r, "Regime_kWh", capacity, by, g), gates.select(*by, "Peak_On"), by, "inner").where("Peak_On").drop("Peak_On")
    return Calibration(gates, months, regimes, materialise(peaks, spark))


def apply_calibration_tables(df: DataFrame, cal: Calibration, capacity: str, by: Sequence[str] = ("seg",), residual: Column | None = None) -> DataFrame:
    """``Calibrated_kWh``: the forecast through the steps that stayed."""
    base = c("Forecast_kWh") * (residual if residual is not None else F.lit(1.0))
    x = with_month(df, cal.months, by, base, "_mk")
    x = lookup_regime(x, cal.regimes, by, "_r").withColumn("_rk", c("_mk") * c("_r"))
    return with_peak(x, cal.peaks, "_rk", capacity, by, "Calibrated_kWh").drop("_mk", "_r", "_rk")


def temporal_holdout_status(df: DataFrame, days: int) -> DataFrame:
    """One row: status, start and row counts of the two sides; skipped when a side is empty."""
    g = hold_out_days(df, days).groupBy().agg(F.max("HoldoutStart").alias("HoldoutStart"), F.count(F.when(~c("holdout"), 1)).alias("TrainRows"), F.count(F.when(c("holdout"), 1)).alias("HoldoutRows"))
    ok = (c("TrainRows") > 0) & (c("HoldoutRows") > 0) & F.lit(days > 0)
    return g.select(F.lit("temporal_holdout").alias("Evaluation"), F.when(ok, "completed").otherwise("skipped").alias("Status"), F.when(ok, "").otherwise("insufficient train or holdout rows").alias("Reason"),
                    F.lit(days).alias("HoldoutDays"), "HoldoutStart", "TrainRows", "HoldoutRows")
