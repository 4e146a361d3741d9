"""Queries: solar calibration steps gated on a nested temporal holdout."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..core.scratch import materialise
from ..models import learners as ML
from ..operators import solar as SO
from ..operators import solar_gates as SG
from .base import query
from .f_solar import W, intervals
from .h_flows import SOLF

GATES = SG.Gates(month=(0.5, 1.1), regime=(0.6, 1.15), peak_floor=0.5, peak_target=0.9)
CAPACITY = 7000.0

GATE_SQL = """,
rk AS (SELECT *, CASE WHEN coalesce(ClearSkyIndex,0) <= 0.2 THEN 'csi_000_020' WHEN ClearSkyIndex <= 0.5 THEN 'csi_020_050' WHEN ClearSkyIndex <= 0.8 THEN 'csi_050_080' WHEN ClearSkyIndex <= 1.05 THEN 'csi_080_105' ELSE 'csi_105_160' END AS ck,
 CASE WHEN coalesce(CloudCoverPct,0) <= 30 THEN 'cloud_000_030' WHEN CloudCoverPct <= 70 THEN 'cloud_030_070' ELSE 'cloud_070_100' END AS lk, CASE WHEN SolarElevationDeg <= 15 THEN 'elev_low' WHEN SolarElevationDeg <= 35 THEN 'elev_mid' ELSE 'elev_high' END AS ek FROM v_int WHERE Actual_kWh >= 0 AND Forecast_kWh >= 50),
r2 AS (SELECT *, month(IntervalStartDT) AS mo, 'regime|' || ck || '|' || lk || '|' || ek AS k1, 'csi|' || ck AS k2 FROM rk),
ct AS (SELECT seg, IntervalStartDT AS ts, count(*) AS k FROM r2 GROUP BY 1, 2),
cm AS (SELECT seg, ts, sum(k) OVER (PARTITION BY seg ORDER BY ts DESC) AS cum, sum(k) OVER (PARTITION BY seg) AS n FROM ct),
cu AS (SELECT seg, max(ts) AS cut FROM cm WHERE cum >= ceil(n * 0.2) GROUP BY 1),
sp AS (SELECT r2.*, IntervalStartDT >= cut AS ho FROM r2 JOIN cu USING (seg)),
ma AS (SELECT seg, mo, sum(Actual_kWh) AS a, sum(Forecast_kWh) AS f FROM sp WHERE NOT ho GROUP BY 1, 2),
mb AS (SELECT *, least(greatest(sum(a) OVER w / sum(f) OVER w, 0.5), 1.1) AS ag FROM ma WINDOW w AS (PARTITION BY seg)),
mf AS (SELECT seg, mo, least(greatest((a + 100000*ag)/(f + 100000), 0.5), 1.1) AS fac FROM mb), mg AS (SELECT seg, max(ag) AS ag FROM mb GROUP BY 1),
pr AS (SELECT sp.*, Forecast_kWh*coalesce(fac, ag) AS pre FROM sp LEFT JOIN mf USING (seg, mo) LEFT JOIN mg USING (seg)),
kx AS (SELECT k1 AS k, * FROM pr UNION ALL SELECT k2, * FROM pr),
fa AS (SELECT seg, k, least(greatest((sum(Actual_kWh)+50000)/(sum(pre)+50000),0.6),1.15) AS f FROM kx WHERE NOT ho AND pre > 0 GROUP BY 1, 2 HAVING count(*) >= 12 AND sum(pre) >= 10000),
hk AS (SELECT seg, k, f FROM kx JOIN fa USING (seg, k) WHERE ho AND pre > 0 GROUP BY 1, 2, 3 HAVING count(*) >= 12 AND sum(pre) >= 10000 AND sum(Actual_kWh) > 0 AND sum(abs(pre*f-Actual_kWh))/sum(Actual_kWh) <= sum(abs(pre-Actual_kWh))/sum(Actual_kWh) - 0.0005)"""


def rows(spark, d):
    """Training rows of the tables with their holdout, written once as every step reads them."""
    x = SG.training_rows(intervals(spark, d)).withColumn("ActiveCapacity_kW", F.lit(CAPACITY))
    return materialise(SG.hold_out_latest(x, 0.2), spark)


@query("sol02_factors_outside_holdout", W(GATE_SQL + """
SELECT fa.seg, fa.k AS key, fa.f AS factor, CAST(hk.k IS NOT NULL AS INT) AS kept FROM fa LEFT JOIN hk ON hk.seg = fa.seg AND hk.k = fa.k"""), r6=["factor"])
def _(spark, d):
    _, found, kept = SG.pruned_regimes(rows(spark, d), g=GATES)
    j = found.join(kept.select("seg", "key", F.lit(1).alias("kept")), ["seg", "key"], "left")
    return j.select("seg", "key", "factor", F.coalesce("kept", F.lit(0)).alias("kept"))


@query("mod10_calibration_gates", W(GATE_SQL + f""",
rg AS (SELECT pr.*, pre*coalesce(x.f, y.f, 1) AS reg FROM pr LEFT JOIN hk x ON x.seg = pr.seg AND x.k = k1 LEFT JOIN hk y ON y.seg = pr.seg AND y.k = k2),
th AS (SELECT seg, quantile_cont(pre/{CAPACITY}, 0.95) AS t FROM rg WHERE NOT ho AND pre > 0 GROUP BY 1),
pk AS (SELECT seg, t, count(*) FILTER (pre/{CAPACITY} >= t) AS n, sum(pre) FILTER (pre/{CAPACITY} >= t) AS fs, least(greatest(0.9*max(Actual_kWh) FILTER (pre/{CAPACITY} >= t)/max(pre) FILTER (pre/{CAPACITY} >= t), 0.5), 1.0) AS r FROM rg JOIN th USING (seg) WHERE NOT ho AND pre > 0 GROUP BY 1, 2),
pf AS (SELECT seg, t, CASE WHEN n >= 12 AND fs/1000 >= 1 AND r < 0.999 THEN r ELSE 1 END AS pf FROM pk),
z AS (SELECT rg.*, pf, reg*CASE WHEN pf < 1 AND reg/{CAPACITY} >= t THEN pf ELSE 1 END AS pea FROM rg JOIN pf USING (seg) WHERE ho),
e AS (SELECT seg, pf, count(*) AS n, sum(abs(Forecast_kWh-Actual_kWh))/sum(Actual_kWh) AS w0, sum(abs(pre-Actual_kWh))/sum(Actual_kWh) AS w1, sum(abs(reg-Actual_kWh))/sum(Actual_kWh) AS w2, sum(abs(pea-Actual_kWh))/sum(Actual_kWh) AS w3,
 max(reg)/max(Actual_kWh) AS c0, max(pea)/max(Actual_kWh) AS c1 FROM z GROUP BY 1, 2)
SELECT seg, CAST(n AS BIGINT) AS n, w0, w1, w2, w3, c0, c1, pf AS peak_factor, (SELECT CAST(count(*) AS BIGINT) FROM fa WHERE fa.seg = e.seg) AS candidates, (SELECT CAST(count(*) AS BIGINT) FROM hk WHERE hk.seg = e.seg) AS kept,
 CAST(NOT (w2 > w1 + 0.0005) AS INT) AS regime_on, CAST(NOT (pf < 1 AND (w3 > w2 + 0.0015 OR greatest(c1-0.9,0) > greatest(c0-0.9,0) + 0.001)) AS INT) AS peak_on FROM e"""), r6=["w0", "w1", "w2", "w3", "c0", "c1", "peak_factor"])
def _(spark, d):
    g, _ = SG.calibration_gates(rows(spark, d), "ActiveCapacity_kW", g=GATES)
    return g.select("seg", F.col("Holdout_Rows").alias("n"), F.col("WMAPE_Base").alias("w0"), F.col("WMAPE_Month").alias("w1"), F.col("WMAPE_Regime").alias("w2"), F.col("WMAPE_Peak").alias("w3"), F.col("Capture_Before").alias("c0"),
                    F.col("Capture_After").alias("c1"), "peak_factor", F.col("Regime_Candidates").alias("candidates"), F.col("Regime_Kept").alias("kept"), F.col("Regime_On").cast("int").alias("regime_on"), F.col("Peak_On").cast("int").alias("peak_on"))


@query("mod10_gated_calibration_with_model")
def _(spark, d):
    x = rows(spark, d)
    # the model behind the gates sees no actual of the holdout, the one that is applied sees all
    x = ML.performance_ratio(x.withColumn("_seen", F.when(~F.col("holdout"), F.col("Actual_kWh"))), SOLF, "Forecast_kWh", "_seen", lo=0.6, hi=1.2).withColumnRenamed("PerformanceRatio", "fit_ratio")
    x = materialise(ML.performance_ratio(x, SOLF, "Forecast_kWh", lo=0.6, hi=1.2).withColumnRenamed("PerformanceRatio", "all_ratio"), spark)
    cal = SG.calibrate(x, "ActiveCapacity_kW", residual=F.col("fit_ratio"), final=F.col("all_ratio"), g=GATES)
    o = SG.apply_calibration_tables(x, cal, "ActiveCapacity_kW", residual=F.col("all_ratio"))
    m = o.groupBy("seg").agg(F.count("*").alias("rows"), F.sum("Calibrated_kWh").alias("kwh"))
    return m.join(cal.gates.select("seg", "WMAPE_Base", "WMAPE_Month", "WMAPE_Regime", "WMAPE_Peak", "Regime_Kept", "Regime_On", "Peak_On"), "seg")


@query("sol07_temporal_holdout_status", W("""
, s AS (SELECT max(CAST(IntervalStartDT AS DATE)) - 89 AS st FROM v_int)
SELECT 'temporal_holdout' AS "Evaluation", 'completed' AS "Status", '' AS "Reason", 90 AS "HoldoutDays", CAST(st AS VARCHAR) AS "HoldoutStart", CAST(count(*) FILTER (IntervalStartDT < st) AS BIGINT) AS "TrainRows", CAST(count(*) FILTER (IntervalStartDT >= st) AS BIGINT) AS "HoldoutRows" FROM v_int, s GROUP BY st"""))
def _(spark, d):
    return SG.temporal_holdout_status(intervals(spark, d), 90).withColumn("HoldoutStart", F.col("HoldoutStart").cast("string"))


@query("sol07_temporal_holdout_scorecard")
def _(spark, d):
    x = materialise(SG.hold_out_days(intervals(spark, d), 90), spark)
    x = ML.performance_ratio(x.withColumn("_seen", F.when(~F.col("holdout"), F.col("Actual_kWh"))), SOLF, "Forecast_kWh", "_seen")
    o = x.where("holdout").withColumn("Forecast_MW", F.col("Forecast_MW") * F.col("PerformanceRatio"))
    status = SG.temporal_holdout_status(intervals(spark, d), 90).select(F.struct("*")).scalar()
    return SO.solar_slices(o).withColumn("_s", status).select("_s.*", "*").drop("_s")
