"""Accuracy metrics over groups, stages, segments and overlapping slices.

Residual = actual - forecast, positive when the forecast was too low.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..core import epoch_second, group_quantiles, null_safe_join, safe_div

ACTUAL = "Actual_MWH"
ALL = "_all"


def metric_aggs(actual: str = ACTUAL, forecast: str = "Forecast_MWH", peak_at: str | None = None) -> dict[str, Column]:
    """Name to aggregate; every one combines before the shuffle."""
    a, f = F.col(actual), F.col(forecast)
    r = a - f
    ape = F.when(F.abs(a) > 1e-9, F.abs(r) / F.abs(a) * 100.0)
    out = {
        "N": F.count("*"), "Actual_Mean_MWH": F.avg(a), "Forecast_Mean_MWH": F.avg(f), "Bias_MWH": F.avg(r),
        "MAE_MWH": F.avg(F.abs(r)), "RMSE_MWH": F.sqrt(F.avg(r * r)), "MAPE_PCT": F.avg(ape),
        "Underforecast_Rate_PCT": F.avg(F.when(r > 0, 100.0).otherwise(0.0)),
        "Max_Underforecast_MWH": F.max(r), "Max_Overforecast_MWH": F.greatest(F.max(-r), F.lit(0.0)),
    }
    if peak_at is not None:
        first_max = F.struct(a, -epoch_second(peak_at))
        at_peak = F.max_by(f, first_max)
        out |= {"Actual_Peak_MWH": F.max(a), "Forecast_At_Actual_Peak_MWH": at_peak,
                "Underforecast_At_Actual_Peak_MWH": F.max(a) - at_peak}
    return out


def metric_sums(actual: str = ACTUAL, forecast: str = "Forecast_MWH") -> dict[str, Column]:
    """What ``metrics_of_sums`` needs of a cell; sums of cells are the sums of the group they make up."""
    a, f = F.col(actual), F.col(forecast)
    r = a - f
    ape = F.when(F.abs(a) > 1e-9, F.abs(r) / F.abs(a) * 100.0)
    return {"_n": F.count("*"), "_a": F.sum(a), "_f": F.sum(f), "_r": F.sum(r), "_ar": F.sum(F.abs(r)), "_rr": F.sum(r * r), "_p": F.sum(ape), "_pn": F.count(ape),
            "_u": F.count(F.when(r > 0, 1)), "_under": F.max(r), "_over": F.max(-r)}


def metrics_of_sums() -> dict[str, Column]:
    """The metrics of ``metric_aggs`` from cells of ``metric_sums``."""
    n = F.sum("_n")
    mean = lambda x: F.sum(x) / n
    return {"N": n, "Actual_Mean_MWH": mean("_a"), "Forecast_Mean_MWH": mean("_f"), "Bias_MWH": mean("_r"), "MAE_MWH": mean("_ar"), "RMSE_MWH": F.sqrt(mean("_rr")),
            "MAPE_PCT": safe_div(F.sum("_p"), F.sum("_pn")), "Underforecast_Rate_PCT": F.sum("_u") * 100.0 / n,
            "Max_Underforecast_MWH": F.max("_under"), "Max_Overforecast_MWH": F.greatest(F.max("_over"), F.lit(0.0))}


def grouped_metrics(df: DataFrame, keys: Sequence[str], forecast: str = "Forecast_MWH", actual: str = ACTUAL,
                    min_count: int = 1, p90: bool = True, peak_at: str | None = None,
                    extra: Mapping[str, Column] | None = None) -> DataFrame:
    """Metrics per key (null keys are a group); ``extra`` adds user metrics by name."""
    gk = list(keys) or [ALL]
    work = df.where(F.col(actual).isNotNull() & F.col(forecast).isNotNull())
    if not keys:
        work = work.withColumn(ALL, F.lit(1))
    aggs = {**metric_aggs(actual, forecast, peak_at), **(extra or {})}
    out = work.groupBy(*gk).agg(*[c.alias(n) for n, c in aggs.items()]).where(F.col("N") >= min_count)
    if p90:
        q = group_quantiles(work.withColumn("_ae", F.abs(F.col(actual) - F.col(forecast))), gk, "_ae", {"P90_AbsError_MWH": 0.9})
        out = null_safe_join(out, q, gk)
    return out if keys else out.drop(ALL)


def by_stage(df: DataFrame, stages: Mapping[str, str], carry: Sequence[str]) -> DataFrame:
    """One row per row and stage: (``carry``..., Stage, Forecast_MWH); a single pass over the cube."""
    names = F.array(*[F.struct(F.lit(s).alias("Stage"), F.col(c).cast("double").alias("Forecast_MWH")) for s, c in stages.items()])
    return df.select(*carry, F.inline(names))


def stage_metrics(df: DataFrame, stages: Mapping[str, str], keys: Sequence[str] = (), **kw) -> DataFrame:
    carry = [*dict.fromkeys([*keys, ACTUAL, *([kw["peak_at"]] if kw.get("peak_at") else [])])]
    return grouped_metrics(by_stage(df, stages, carry), ["Stage", *keys], **kw)


def versus(metrics: DataFrame, keys: Sequence[str] = (), raw: str = "raw", final: str = "final_corrected") -> DataFrame:
    """Improvement and skill of each stage against the raw and the final stage of its group."""
    gk = list(keys) or [ALL]
    m = metrics if keys else metrics.withColumn(ALL, F.lit(1))
    pick = lambda s, c: F.max(F.when(F.col("Stage") == s, F.col(c)))
    ref = m.groupBy(*gk).agg(pick(raw, "MAE_MWH").alias("_rm"), pick(raw, "Bias_MWH").alias("_rb"), pick(final, "MAE_MWH").alias("_fm"))
    out = null_safe_join(m, ref, gk)
    gain = F.col("_rm") - F.col("MAE_MWH")
    out = out.withColumns({
        "MAE_Improvement_vs_Raw_MWH": gain, "Skill_vs_Raw_PCT": F.when(F.col("_rm") > 0, gain / F.col("_rm") * 100.0),
        "Bias_Abs_Improvement_vs_Raw_MWH": F.abs("_rb") - F.abs("Bias_MWH"), "MAE_Delta_vs_Final_MWH": F.col("MAE_MWH") - F.col("_fm"),
    })
    return out.drop("_rm", "_rb", "_fm", ALL)


def segment_rows(df: DataFrame, segments: Mapping[str, Sequence[str]], carry: Sequence[str]) -> DataFrame:
    """Each row once per segment, with the segment's key values joined into one text key."""
    def key(cols):
        return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("<missing>")) for c in cols])

    parts = F.array(*[F.struct(F.lit(n).alias("Segment"), F.lit("+".join(cols)).alias("SegmentKeys"), key(cols).alias("SegmentValue"))
                      for n, cols in segments.items()])
    return df.select(*carry, F.inline(parts))


def segment_metrics(df: DataFrame, segments: Mapping[str, Sequence[str]], stages: Mapping[str, str], min_count: int = 6, **kw) -> DataFrame:
    """Metrics of every stage in every segment cell: one expand and one aggregate for all key sets."""
    long = by_stage(df, stages, [ACTUAL, *dict.fromkeys(c for cols in segments.values() for c in cols)])
    rows = segment_rows(long, segments, ["Stage", ACTUAL, "Forecast_MWH"])
    return grouped_metrics(rows, ["Stage", "Segment", "SegmentKeys", "SegmentValue"], min_count=min_count, **kw)


def explode_slices(df: DataFrame, slices: Mapping[str, Column], name: str = "Slice") -> DataFrame:
    """Each row once per slice it is in (none: the row is dropped)."""
    hits = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in slices.items()]))
    return df.withColumn(name, F.explode(hits))


def marginal(metrics: DataFrame, order: Sequence[str], keys: Sequence[str] = ("Slice",)) -> DataFrame:
    """Change of MAE against the stage before, in chain order; one row per stage and slice, so the window is tiny."""
    from pyspark.sql.window import Window

    pos = F.array_position(F.array(*[F.lit(s) for s in order]), F.col("Stage"))
    m = metrics.withColumn("_pos", pos).where("_pos > 0")
    w = Window.partitionBy(*keys).orderBy("_pos")
    d = F.col("MAE_MWH") - F.lag("MAE_MWH").over(w)
    return m.withColumns({"Marginal_dMAE_MWH": d, "Worsens_Slice": F.coalesce(d > 0, F.lit(False))}).drop("_pos")


def stage_leader(metrics: DataFrame, final: str = "final_corrected", keys: Sequence[str] = ()) -> DataFrame:
    """Stage with the lowest MAE, and its gain on the final stage."""
    best = F.min_by("Stage", F.struct("MAE_MWH", "Stage"))
    fin = F.max(F.when(F.col("Stage") == final, F.col("MAE_MWH")))
    low = F.min("MAE_MWH")
    return metrics.groupBy(*keys).agg(best.alias("Best_Stage"), low.alias("Best_MAE_MWH"), fin.alias("Final_MAE_MWH"),
                                      (fin - low).alias("Best_Stage_MAE_Improvement_vs_Final_MWH"),
                                      (fin - low <= 1e-9).alias("Final_Is_Best_Stage_By_MAE"))


def top_errors(df: DataFrame, n: int, forecast: str, actual: str = ACTUAL, tie: str = "row_id") -> DataFrame:
    """The n largest under- and over-forecasts with their rank; two top-k sorts, no full sort."""
    r = F.col(actual) - F.col(forecast)
    work = df.withColumns({"Residual": r, "AbsError": F.abs(r)})
    parts = []
    for side, cond in (("under", F.col("Residual") > 0), ("over", F.col("Residual") < 0)):
        top = work.where(cond).orderBy(F.desc("AbsError"), tie).limit(n)
        parts.append(top.withColumn("Side", F.lit(side)))
    from pyspark.sql.window import Window

    w = Window.partitionBy("Side").orderBy(F.desc("AbsError"), tie)
    return parts[0].unionByName(parts[1]).withColumn("Rank", F.row_number().over(w))


def daily_peaks(df: DataFrame, keys: Sequence[str], forecast: str, actual: str = ACTUAL, carry: Sequence[str] = (),
                hours: Sequence[int] | None = None) -> DataFrame:
    """Actual-peak and forecast-peak rows of each key (first on ties), timing and energy errors, daily MAE and MAPE."""
    work = df.where(F.col(actual).isNotNull() & F.col(forecast).isNotNull())
    if hours:
        work = work.where(F.col("Hour").isin(*hours))
    early = -epoch_second("DT")
    a, f = F.col(actual), F.col(forecast)
    row = F.struct("DT", "Hour", a.alias("a"), f.alias("f"), *carry)
    ap, fp = F.max_by(row, F.struct(a, early)), F.max_by(row, F.struct(f, early))
    g = work.groupBy(*keys).agg(
        ap.alias("_a"), fp.alias("_f"), F.sum(a).alias("Daily_Energy_Actual_MWH"), F.sum(f).alias("Daily_Energy_Forecast_MWH"),
        F.avg(F.abs(a - f)).alias("Daily_MAE_MWH"), F.avg(F.when(F.abs(a) > 1e-9, F.abs((a - f) / a) * 100.0)).alias("Daily_MAPE_PCT"))
    hours_apart = (epoch_second("_f.DT") - epoch_second("_a.DT")) / 3600.0
    return g.select(
        *keys, F.col("_a.DT").alias("Actual_Peak_DT"), F.col("_a.Hour").alias("Actual_Peak_Hour"), F.col("_a.a").alias("Actual_Peak_MWH"),
        F.col("_a.f").alias("Forecast_At_Actual_Peak_MWH"), (F.col("_a.a") - F.col("_a.f")).alias("Underforecast_At_Actual_Peak_MWH"),
        F.col("_f.DT").alias("Forecast_Peak_DT"), F.col("_f.Hour").alias("Forecast_Peak_Hour"), F.col("_f.f").alias("Forecast_Peak_MWH"),
        hours_apart.alias("Daily_Peak_Timing_Error_Hours"), "Daily_Energy_Actual_MWH", "Daily_Energy_Forecast_MWH",
        (F.col("Daily_Energy_Forecast_MWH") - F.col("Daily_Energy_Actual_MWH")).alias("Daily_Energy_Error_MWH"), "Daily_MAE_MWH", "Daily_MAPE_PCT",
        *[F.col(f"_a.{c}").alias(c) for c in carry])


def weighted_objective(card: DataFrame, weights: Mapping[str, tuple[float, Column]]) -> DataFrame:
    """Weighted sum over a scorecard's conditional values."""
    total = sum((F.lit(w) * c for w, c in weights.values()), F.lit(0.0))
    return card.select(total.alias("Objective"), *[c.alias(n) for n, (_, c) in weights.items()])


def rate(num: Column, den: Column) -> Column:
    return safe_div(num * 100.0, den)
