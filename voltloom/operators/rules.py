"""Rule tables: optional bounds that select rows, and stacked adjustments.

A rule is a plain mapping.  Every condition it names must hold; a null never
passes.  Upper bounds of daily maximum and forecast are exclusive, all others
inclusive.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.weather import clip
from .metrics import ACTUAL

# Rule field, context column, comparison.
BOUNDS = (
    ("min_forecast_day", "Forecast_Day", "ge"), ("max_forecast_day", "Forecast_Day", "le"),
    ("min_explicit_forecast_day", "Forecast_Day", "ge"), ("max_explicit_forecast_day", "Forecast_Day", "le"),
    ("min_maxtemp_f", "Temperature_DailyMax", "ge"), ("max_maxtemp_f", "Temperature_DailyMax", "lt"),
    ("min_forecast_mwh", "_forecast", "ge"), ("max_forecast_mwh", "_forecast", "lt"),
    ("min_raw_minus_samehour_7day_mean_mwh", "Raw_Minus_SameHour7DayMean_MWH", "ge"),
    ("max_raw_minus_samehour_7day_mean_mwh", "Raw_Minus_SameHour7DayMean_MWH", "le"),
    ("min_raw_minus_samehour_yesterday_mwh", "Raw_Minus_SameHourYesterday_MWH", "ge"),
    ("max_raw_minus_samehour_yesterday_mwh", "Raw_Minus_SameHourYesterday_MWH", "le"),
    ("min_cloud_cover_norm", "CloudCover_Norm", "ge"), ("max_cloud_cover_norm", "CloudCover_Norm", "le"),
    ("min_solar_loss_mw", "BTM_Solar_Loss_From_ClearSky_MW", "ge"), ("max_solar_loss_mw", "BTM_Solar_Loss_From_ClearSky_MW", "le"),
)
ALIASES = {
    "min_raw_minus_rolling7_samehour_mwh": "min_raw_minus_samehour_7day_mean_mwh", "max_raw_minus_rolling7_samehour_mwh": "max_raw_minus_samehour_7day_mean_mwh",
    "min_raw_minus_lag24_mwh": "min_raw_minus_samehour_yesterday_mwh", "max_raw_minus_lag24_mwh": "max_raw_minus_samehour_yesterday_mwh",
    "min_prior_guard_mwh": "min_prior_total_adjustment_mwh", "max_prior_guard_mwh": "max_prior_total_adjustment_mwh",
}
_CMP = {"ge": lambda a, b: a >= b, "le": lambda a, b: a <= b, "lt": lambda a, b: a < b}


def canonical(rule: dict) -> dict:
    """Rule with its alternative field names replaced."""
    return {ALIASES.get(k, k): v for k, v in rule.items() if v is not None}


def add_rule_context(df: DataFrame, forecast: str, raw: str = "Raw_Forecast_MWH", week_mean: str = "MWH_SameHour7DayMean", yesterday: str = "MWH_Lag24") -> DataFrame:
    """Columns every rule reads, derived once."""
    return df.withColumns({"_forecast": F.col(forecast), "Raw_Minus_SameHour7DayMean_MWH": F.col(raw) - F.col(week_mean),
                           "Raw_Minus_SameHourYesterday_MWH": F.col(raw) - F.col(yesterday)})


def matches(rule: dict) -> Column:
    """Whether a row meets the rule's own conditions."""
    r = canonical(rule)
    conds = [_CMP[op](F.col(col), F.lit(float(r[f]))) for f, col, op in BOUNDS if f in r]
    for f, col in (("months", "Month"), ("hours", "Hour"), ("seasons", "Season")):
        if f in r:
            conds.append(F.col(col).isin(*r[f]))
    for f, col in (("holiday", "IsHoliday"), ("weekend", "IsWeekend")):
        if f in r:
            conds.append((F.coalesce(F.col(col), F.lit(0)) == 1) == F.lit(bool(r[f])))
    return F.coalesce(reduce(lambda a, b: a & b, conds, F.lit(True)), F.lit(False))


def stack_gate(rule: dict, running: Column) -> Column:
    """Conditions on the adjustments that earlier rules already gave the row."""
    r, ok = canonical(rule), F.lit(True)
    if "min_prior_total_adjustment_mwh" in r:
        ok = ok & (running >= F.lit(float(r["min_prior_total_adjustment_mwh"])))
    if "max_prior_total_adjustment_mwh" in r:
        ok = ok & (running <= F.lit(float(r["max_prior_total_adjustment_mwh"])))
    return ok


def active(rules: Sequence[dict]) -> list[dict]:
    return [r for r in rules if r.get("enabled", True) and abs(float(r.get("adjustment_mwh", 0.0) or 0.0)) >= 1e-9]


def fired(rules: Sequence[dict], state: str = "_state") -> Column:
    """Fold over the rules of a row: running total, row cap and the names of the rules that fired, in order.

    Every rule's own test is evaluated once into a boolean array; the fold then
    walks that array with literal rule data, so the expression stays linear in
    the number of rules even when rules test the running total.
    """
    big = 1e300
    spec = []
    for r in rules:
        k = canonical(r)
        spec.append(F.struct(
            matches(r).alias("m"), F.lit(str(r.get("name", "rule"))).alias("name"), F.lit(float(r["adjustment_mwh"])).alias("adj"),
            F.lit(float(k.get("min_prior_total_adjustment_mwh", -big))).alias("lo"), F.lit(float(k.get("max_prior_total_adjustment_mwh", big))).alias("hi"),
            F.lit(abs(float(k.get("max_total_cap_mwh", 0.0)))).alias("cap")))
    start = F.struct(F.lit(0.0).alias("total"), F.lit(0.0).alias("cap"), F.lit("").alias("names"))

    def step(acc, x):
        hit = x["m"] & (acc["total"] >= x["lo"]) & (acc["total"] <= x["hi"])
        return F.struct(F.when(hit, acc["total"] + x["adj"]).otherwise(acc["total"]).alias("total"),
                        F.when(hit, F.greatest(acc["cap"], x["cap"])).otherwise(acc["cap"]).alias("cap"),
                        F.when(hit, F.concat(acc["names"], F.lit("+"), x["name"])).otherwise(acc["names"]).alias("names"))

    return F.aggregate(F.array(*spec), start, step).alias(state)


def apply_guard(df: DataFrame, rules: Sequence[dict], forecast: str, total_cap: float = 20.0, also_update: Sequence[str] = ()) -> DataFrame:
    """Stacked rule adjustments with a symmetric cap that single rules may raise for their rows."""
    use = active(rules)
    if not use:
        return df.withColumns({"Focused_Scorecard_Guard_MWH": F.lit(0.0), "Focused_Scorecard_Guard_Source": F.lit("none")})
    s = add_rule_context(df, forecast).withColumn("_state", fired(use))
    cap = F.greatest(F.lit(abs(float(total_cap))), F.col("_state.cap"))
    total = F.least(F.greatest(F.col("_state.total"), -cap), cap)
    out = s.withColumns({
        "Pre_Focused_Guard_Forecast_MWH": F.col(forecast), "Focused_Scorecard_Guard_MWH": total,
        "Focused_Scorecard_Guard_Source": F.when(F.col("_state.names") != "", F.expr("substring(_state.names, 2)")).otherwise("none"),
    })
    g = F.col("Focused_Scorecard_Guard_MWH")
    out = out.withColumns({"Focused_Guard_Applied_Flag": (g != 0.0).cast("int"),
                           **{x: clip(F.col(x) + g, lo=0.0) for x in (forecast, *also_update)}})
    return out.drop("_state", "_forecast")


def rule_audit(df: DataFrame, rules: Sequence[dict], forecast: str, actual: str = ACTUAL, min_rows: int = 1, max_delta: float = 0.0) -> DataFrame:
    """Each rule alone on the rows it matches: count, bias and MAE before and after, and whether it helps."""
    ctx = add_rule_context(df, forecast)
    hits = F.array_compact(F.array(*[F.when(matches(r), F.struct(F.lit(str(r["name"])).alias("RuleName"), F.lit(float(r.get("adjustment_mwh", 0.0))).alias("Adjustment_MWH")))
                                     for r in rules]))
    long = ctx.where(F.col(actual).isNotNull() & F.col(forecast).isNotNull()).select(actual, forecast, F.inline(hits))
    before = F.col(actual) - F.col(forecast)
    after = F.col(actual) - F.greatest(F.col(forecast) + F.col("Adjustment_MWH"), F.lit(0.0))
    g = long.groupBy("RuleName", "Adjustment_MWH").agg(
        F.count("*").alias("ScoredRows"), F.avg(before).alias("Baseline_Bias_MWH"), F.avg(after).alias("RuleOnly_Bias_MWH"),
        F.avg(F.abs(before)).alias("Baseline_MAE_MWH"), F.avg(F.abs(after)).alias("RuleOnly_MAE_MWH"))
    delta = F.col("RuleOnly_MAE_MWH") - F.col("Baseline_MAE_MWH")
    status = F.when(F.col("ScoredRows") < min_rows, "insufficient_rows").when(delta > max_delta, "fail").otherwise("pass")
    return g.withColumns({"RuleOnly_Delta_MAE_MWH": delta, "RuleHealth_Status": status})


def matched_names(rules: Sequence[dict]) -> Column:
    """Array with the names of all matching rules, stack conditions aside."""
    return F.array_compact(F.array(*[F.when(matches(r), F.lit(str(r["name"]))) for r in rules]))


def union_mask(rules: Sequence[dict]) -> Column:
    return reduce(lambda a, b: a | b, [matches(r) for r in active(rules)], F.lit(False))
