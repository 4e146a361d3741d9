"""Multi-level shrunk residual lookups: learn in one pass, apply with one join.

Learning: residual moments are taken per finest key combination (a map-side
combined aggregate whose size is the product of small domains), then rolled up
to every level.  Applying: the lookup is resolved on the distinct key
combinations of the frame and joined back once, so the frame itself meets a
single join however many levels there are.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..core import join_small, safe_div
from ..core.scratch import materialise, shared_dir
from ..functions import buckets as B
from ..functions.calendar import hour_group, season
from ..functions.weather import clip


@dataclass(frozen=True)
class Level:
    name: str
    keys: tuple[str, ...]
    weight: float = 1.0


# Levels, keys and weights of the learned, warm-ramp and cloud/solar lookups.
LEARNED = (
    Level("global", (), 0.05), Level("hour", ("Hour",), 0.08), Level("season_hour", ("Season", "Hour"), 0.12),
    Level("season_hourgroup_maxtemp", ("Season", "HourGroup", "DailyMaxTempBin"), 0.18),
    Level("season_hour_maxtemp", ("Season", "Hour", "DailyMaxTempBin"), 0.20),
    Level("season_month_hour_maxtemp", ("Season", "Month", "Hour", "DailyMaxTempBin"), 0.18),
    Level("season_cloud_hourgroup", ("Season", "CloudCoverBin", "HourGroup"), 0.09),
    Level("season_solar_hourgroup", ("Season", "BTMSolarProxyBin", "HourGroup"), 0.05),
    Level("temp_cloud_hourgroup", ("DailyMaxTempBin", "CloudCoverBin", "HourGroup"), 0.05),
)
WARM_RAMP = (
    Level("warm_season_hour_temp_cloud", ("Season", "Hour", "DailyMaxTempBin", "CloudCoverBin"), 0.24),
    Level("warm_weekend_hour_temp", ("IsWeekend", "Hour", "DailyMaxTempBin"), 0.16),
    Level("warm_hour_temp_cloud", ("Hour", "DailyMaxTempBin", "CloudCoverBin"), 0.14),
    Level("warm_season_hour_temp", ("Season", "Hour", "DailyMaxTempBin"), 0.18),
    Level("warm_season_hourgroup_temp", ("Season", "HourGroup", "DailyMaxTempBin"), 0.12),
    Level("warm_hour_temp", ("Hour", "DailyMaxTempBin"), 0.10),
    Level("warm_hourgroup_temp", ("HourGroup", "DailyMaxTempBin"), 0.06),
)
CLOUD_SOLAR = (
    Level("event_class_hour_loss", ("CloudSolarEventClass", "Hour", "SolarLossBucket"), 0.24),
    Level("weekday_hour_cloud_loss", ("IsWeekend", "Hour", "CloudCoverBucket", "SolarLossBucket"), 0.20),
    Level("event_class_hour_temp", ("CloudSolarEventClass", "Hour", "DailyMaxTempBin"), 0.14),
    Level("hour_cloud_loss", ("Hour", "CloudCoverBucket", "SolarLossBucket"), 0.14),
    Level("season_hour_cloud_loss", ("Season", "Hour", "CloudCoverBucket", "SolarLossBucket"), 0.10),
    Level("hour_base_loss", ("Hour", "CloudSolarBaseBucket", "SolarLossBucket"), 0.08),
    Level("hour_temp_loss", ("Hour", "DailyMaxTempBin", "SolarLossBucket"), 0.05),
    Level("hour_loss", ("Hour", "SolarLossBucket"), 0.03), Level("hour_cloud", ("Hour", "CloudCoverBucket"), 0.02),
)
MISSING = "<missing>"


def add_context(df: DataFrame) -> DataFrame:
    """Calendar columns and lookup bins, where the frame lacks them; cloud must be a fraction (``with_cloud_fraction``)."""
    have = set(df.columns)
    new: dict[str, Column] = {}
    month = F.col("Month") if "Month" in have else F.month("DT")
    hour = F.col("Hour") if "Hour" in have else F.hour("DT")
    options = {"Month": month, "Hour": hour, "Season": season(month), "HourGroup": hour_group(hour),
               "IsWeekend": (F.weekday("DT") >= 5).cast("int") if "DT" in have else F.lit(0)}
    if "Temperature_DailyMax" in have:
        options["DailyMaxTempBin"] = B.daily_max_bin("Temperature_DailyMax")
    for name, value in options.items():
        if name not in have:
            new[name] = value
    if "CloudCover_Norm" in have:
        new["CloudCoverBin"] = B.cloud_bin("CloudCover_Norm")
        if "CloudCoverBucket" not in have:
            new["CloudCoverBucket"] = B.cloud_bucket(clip("CloudCover_Norm", 0, 1))
    if "BTM_Solar_Proxy_MW" in have:
        new["BTMSolarProxyBin"] = B.solar_proxy_bin("BTM_Solar_Proxy_MW")
    return df.withColumns(new)


def _key_text(cols: Sequence[str], missing: str | None = MISSING) -> Column:
    if not cols:
        return F.lit("all")
    parts = [F.col(k).cast("string") for k in cols]
    if missing is None:  # null when any part is null
        return F.concat(*[x for i, p in enumerate(parts) for x in ([F.lit("|")] if i else []) + [p]])
    return F.concat_ws("|", *[F.coalesce(p, F.lit(missing)) for p in parts])


def _level_key(level: Level) -> Column:
    return _key_text(level.keys)


def level_rows(levels: Sequence[Level]) -> Column:
    """Array of (level, key) of a row, to be inlined."""
    return F.array(*[F.struct(F.lit(lv.name).alias("level"), _level_key(lv).alias("key")) for lv in levels])


def all_keys(levels: Sequence[Level]) -> list[str]:
    return list(dict.fromkeys(k for lv in levels for k in lv.keys))


def learn(work: DataFrame, levels: Sequence[Level], residual: str, by: Sequence[str] = (), blend: float = 1.0,
          cap: float = 12.0, shrink_k: float = 24.0) -> DataFrame:
    """Long lookup (by, level, key): shrunk, blended and capped mean residual, with count and sample std."""
    keys = all_keys(levels)
    r = F.col(residual)
    fine = work.groupBy(*by, *keys).agg(F.count(r).alias("_n"), F.avg(r).alias("_m"), (F.var_pop(r) * F.count(r)).alias("_m2")).where("_n > 0")
    long = fine.select(*by, "_n", "_m", "_m2", F.inline(level_rows(levels)))
    g = long.groupBy(*by, "level", "key").agg(*level_sums())
    return shrunk(g, [*by, "level", "key"], blend, cap, shrink_k)


def level_sums() -> list[Column]:
    """Moments of a level from those of its finest keys (``_n``, ``_m``, ``_m2``)."""
    return [F.sum("_n").alias("count"), F.sum(F.col("_n") * F.col("_m")).alias("_s"), F.sum("_m2").alias("_w"), F.sum(F.col("_n") * F.col("_m") * F.col("_m")).alias("_q")]


def shrunk(g: DataFrame, keep: Sequence[str], blend: float, cap: float, shrink_k: float) -> DataFrame:
    """Lookup rows from the sums of ``level_sums``: mean, sample std and the shrunk, blended, capped correction."""
    mean = F.col("_s") / F.col("count")
    spread = F.greatest(F.col("_w") + F.col("_q") - F.col("_s") * mean, F.lit(0.0))
    out = g.withColumns({"mean": mean, "std": F.when(F.col("count") > 1, F.sqrt(spread / (F.col("count") - 1))),
                         "shrink_weight": F.col("count") / (F.col("count") + F.lit(float(shrink_k)))})
    corr = clip(F.col("mean") * F.col("shrink_weight") * F.lit(float(blend)), -cap, cap)
    return out.select(*keep, corr.alias("correction"), "mean", "count", "std", "shrink_weight", F.abs(corr).alias("abs_correction"))


def resolve(frame: DataFrame, lookup: DataFrame, levels: Sequence[Level], by: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """``aggs`` over the matched lookup rows of each distinct key combination (columns: by + all keys + aggs)."""
    keys = all_keys(levels)
    combos = frame.select(*by, *keys).distinct()
    order = F.array_position(F.array(*[F.lit(lv.name) for lv in levels]), F.col("level"))
    weight = F.element_at(F.create_map(*[x for lv in levels for x in (F.lit(lv.name), F.lit(float(lv.weight)))]), F.col("level"))
    long = combos.select("*", F.inline(level_rows(levels))).withColumns({"_order": order, "_weight": weight})
    return long.join(lookup, [*by, "level", "key"]).groupBy(*by, *keys).agg(*aggs)


def apply_weighted(frame: DataFrame, lookup: DataFrame, levels: Sequence[Level], by: Sequence[str] = (), count_k: float | None = 24.0,
                   correction: str = "correction", matched: str = "matched") -> DataFrame:
    """Weighted mean of the matched levels' corrections, weights damped by count, and the matched level names in order.

    Null keys match null keys.  Without a match the correction is null and the
    list empty.
    """
    w = F.col("_weight")
    if count_k is not None:
        w = w * F.sqrt(F.col("count") / (F.col("count") + F.lit(float(count_k))))
    names = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_order", "level"))), lambda x: x["level"]), "+")
    got = resolve(frame, lookup, levels, by, [safe_div(F.sum(w * F.col("correction")), F.sum(w)).alias(correction), names.alias(matched)])
    return join_small(frame, got, [*by, *all_keys(levels)]).withColumn(matched, F.coalesce(matched, F.lit("")))


MOST = 2_000_000  # rows of a lookup that go to the Python workers; a larger one is joined


class _Table:
    """A lookup as arrays: a row of each ``by`` combination, and per level the texts it knows with value and weight."""

    def __init__(self, rows: pa.Table, by: Sequence[str], names: Sequence[str], weights: Mapping[str, float], count_k: float | None):
        self.by: dict[tuple, int] = {}
        at_by = np.zeros(rows.num_rows, np.int64)
        for k in by:  # combinations of the by columns are numbered column by column
            d = rows[k].combine_chunks().dictionary_encode()
            at_by = at_by * (len(d.dictionary) + 1) + np.asarray(d.indices.fill_null(len(d.dictionary)), np.int64)
        _, first, at_by = np.unique(at_by, return_index=True, return_inverse=True)
        for i, r in enumerate(zip(*[rows[k].take(pa.array(first)).to_pylist() for k in by]) if by else [()]):
            if None not in r:
                self.by[r] = i
        width = max(len(first), 1)
        at, key, v = np.asarray(rows["_at"]), rows["_k"].combine_chunks(), np.asarray(rows["_v"].combine_chunks().fill_null(0.0))
        self.levels = []
        for i, n in enumerate(names):
            mine = np.flatnonzero(at == i)
            d = key.take(pa.array(mine)).dictionary_encode()
            w = np.full(len(mine), float(weights[n]))
            if count_k is not None:
                c = np.asarray(rows["_n"])[mine]
                w = w * np.sqrt(c / (c + float(count_k)))
            size, place = len(d.dictionary), at_by[mine] * len(d.dictionary) + np.asarray(d.indices, np.int64)
            texts = {t: j for j, t in enumerate(d.dictionary.to_pylist())}
            if width * size <= 4 * len(mine) + 1000:  # nearly every combination is there: one place each
                vs, ws = np.zeros(width * size), np.full(width * size, np.nan)
                vs[place], ws[place] = v[mine], w
                self.levels.append((texts, None, vs, ws))
            else:
                order = np.argsort(place)
                self.levels.append((texts, place[order], v[mine][order], w[order]))


def _codes(arrays: Sequence[pa.Array], vocab: list[dict]) -> np.ndarray:
    """One whole number per row for the combination of its values; the same for the same values in every batch of a task."""
    bits, out = 62 // max(len(arrays), 1), None
    for a, seen in zip(arrays, vocab, strict=True):
        d = pc.dictionary_encode(a, null_encoding="encode")
        code = np.array([seen.setdefault(x, len(seen)) for x in d.dictionary.to_pylist()], np.int64)[np.asarray(d.indices)]
        if len(seen) >= 1 << bits:
            raise ValueError("a lookup column has too many values")
        out = code if out is None else (out << bits) | code
    return out


def _distinct(codes: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Distinct codes, a row of each, and where each row's code is among them."""
    d = pa.array(codes).dictionary_encode()
    where = np.asarray(d.indices)
    row = np.empty(len(d.dictionary), np.int64)
    row[where] = np.arange(len(codes))
    return d.dictionary.to_pylist(), row, where


def _meet(shared, n_by: int, columns: Sequence[str], keys: Sequence[Sequence[str]], missing: str | None, scoped: bool):
    """Arrow function: (by..., key columns..., scope?) of the rows to their weighted mean and a bit for every level met."""
    def text(values):
        parts = [missing if v is None else str(v) for v in values]
        return None if None in parts else "|".join(parts)

    def run(it: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        held: _Table = shared.value
        by_vocab, by_seen = [{} for _ in range(n_by)], {}
        vocab = [[{} for _ in ks] for ks in keys]
        seen: list[dict[int, int]] = [{} for _ in keys]
        place = {x: i + n_by for i, x in enumerate(columns)}
        for batch in it:
            rows = len(batch[0])
            use = np.flatnonzero(np.asarray(batch[-1].fill_null(False))) if scoped else None
            if use is not None:
                batch = [a.take(pa.array(use)) for a in batch[:-1]]
            n = len(batch[0])
            num, den, met = np.zeros(n), np.zeros(n), np.zeros(n, np.int64)
            if n:
                at = np.zeros(n, np.int64)
                if n_by:
                    us, row, inv = _distinct(_codes(batch[:n_by], by_vocab))
                    for u, r in zip(us, row.tolist()):
                        if u not in by_seen:
                            by_seen[u] = held.by.get(tuple(a[r].as_py() for a in batch[:n_by]), -1)
                    at = np.array([by_seen[u] for u in us], np.int64)[inv]
                for i, (ks, (texts, spots, vs, ws)) in enumerate(zip(keys, held.levels, strict=True)):
                    if not texts:
                        continue
                    if ks:
                        mine = [batch[place[k]] for k in ks]
                        us, row, inv = _distinct(_codes(mine, vocab[i]))
                        for u, r in zip(us, row.tolist()):
                            if u not in seen[i]:
                                seen[i][u] = texts.get(text([a[r].as_py() for a in mine]), -1)
                        t = np.array([seen[i][u] for u in us], np.int64)[inv]
                    else:
                        t = np.full(n, texts.get("all", -1), np.int64)
                    p, ok = at * len(texts) + t, (at >= 0) & (t >= 0)
                    if spots is None:
                        p = np.where(ok, p, 0)
                    else:
                        q = np.minimum(np.searchsorted(spots, p), len(spots) - 1)
                        ok, p = ok & (spots[q] == p), q
                    w = ws[p]
                    ok = ok & ~np.isnan(w)
                    num += np.where(ok, w * vs[p], 0.0)
                    den += np.where(ok, w, 0.0)
                    met |= ok.astype(np.int64) << i
            with np.errstate(divide="ignore", invalid="ignore"):
                mean, none = num / den, den == 0
            if use is not None:
                wide = np.zeros(rows), np.ones(rows, bool), np.zeros(rows, np.int64)
                for full, part in zip(wide, (mean, none, met)):
                    full[use] = part
                mean, none, met = wide
            yield pa.StructArray.from_arrays([pa.array(mean, pa.float64(), mask=none), pa.array(met)], ["v", "met"])

    return F.arrow_udf(run, "v double, met long")


def weigh_levels(frame: DataFrame, lookup: DataFrame, keys: Mapping[str, Sequence[str]], weights: Mapping[str, float], by: Sequence[str], value: str, count_k: float | None, out: str, matched: str,
                 level: str = "level", key: str = "key", missing: str | None = MISSING, where: Column | None = None) -> DataFrame:
    """Weighted mean (``out``) of ``value`` over the levels that have the row's ``by`` and key text, and their names in order.

    ``keys`` are the columns of each level's key text, in which ``missing`` stands for a null;
    without it a row with a null has no key. Rows outside ``where`` meet nothing. For frames
    whose key combinations are nearly as many as their rows: the rows stay where they are. The
    lookup is written once and goes to the Python workers as arrays; there a batch's distinct
    keys are looked up and its rows take their values by position. A lookup of over ``MOST``
    rows is joined, level by level (``_join_levels``). Nulls in ``by`` match nothing.
    """
    names = list(keys)
    at = F.array_position(F.array(*[F.lit(n) for n in names]), F.col(level)).cast("int") - 1
    count = F.col("count").cast("double") if count_k is not None else F.lit(0.0)
    held = materialise(lookup.where(F.col(level).isin(names)).select(*by, at.alias("_at"), F.col(key).alias("_k"), F.col(value).cast("double").alias("_v"), count.alias("_n")))
    texts = {n: _key_text(ks, missing) for n, ks in keys.items()}
    if held.count() > MOST:
        return _join_levels(frame, held, texts, weights, by, count_k, out, matched, where)
    table = frame.sparkSession.sparkContext.broadcast(_Table(held.toArrow(), by, names, weights, count_k))
    columns = list(dict.fromkeys(k for ks in keys.values() for k in ks))
    types = dict(frame.dtypes)
    args = [*by, *[F.col(k) if types[k] in ("string", "int", "bigint", "smallint", "tinyint") else F.col(k).cast("string") for k in columns], *([where] if where is not None else [])]
    if not by and not columns:
        args = [F.lit(True)]
    meet = _meet(table, len(by), columns, [list(ks) for ks in keys.values()], missing, where is not None)
    got = frame.withColumn("_lv", meet(*args))
    text = F.concat(*[F.when(F.col("_lv.met").bitwiseAND(F.lit(1 << i)) != 0, F.lit(f"+{n}")).otherwise("") for i, n in enumerate(names)])
    return got.withColumns({out: F.col("_lv.v"), matched: F.substring(text, 2, 1 << 20)}).drop("_lv")


def _join_levels(frame: DataFrame, held: DataFrame, texts: Mapping[str, Column], weights: Mapping[str, float], by: Sequence[str], count_k: float | None, out: str, matched: str,
                 where: Column | None = None, at_once: int = 3) -> DataFrame:
    """``weigh_levels`` by a join per level, each by its own measured size.

    The key texts of ``at_once`` levels are made by a higher-order function, which is not
    compiled with the joins: all joins in one method are too long for the JIT compiler.
    """
    spark, path, names = frame.sparkSession, shared_dir(frame.sparkSession), list(texts)
    kept = held.select(*by, "_k", F.struct(F.col("_v").alias("v"), F.col("_n").alias("n")).alias("_hit"), "_at")
    kept.write.partitionBy("_at").parquet(path)
    there = sorted(r[0] for r in spark.read.schema("_at int").parquet(path).distinct().collect())
    schema = kept.drop("_at").schema
    got = frame.withColumns({"_lv_num": F.lit(0.0), "_lv_den": F.lit(0.0), "_lv_names": F.lit("")})
    inside = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    for start in range(0, len(there), at_once):
        some = there[start:start + at_once]
        ks = F.transform(F.array(*[texts[names[i]] for i in some]), lambda x: x)
        got = got.withColumn("_ks", ks if where is None else F.when(inside, ks))
        for j, i in enumerate(some):
            one = spark.read.schema(schema).parquet(f"{path}/_at={i}").withColumnRenamed("_hit", f"_hit{j}")
            got = got.withColumn("_k", F.col("_ks")[j]).join(one, [*by, "_k"], "left").drop("_k")
        num, den, text = F.col("_lv_num"), F.col("_lv_den"), [F.col("_lv_names")]
        for j, i in enumerate(some):
            h, w = F.col(f"_hit{j}"), F.lit(float(weights[names[i]]))
            if count_k is not None:
                w = w * F.sqrt(h["n"] / (h["n"] + F.lit(float(count_k))))
            num, den = num + F.coalesce(w * h["v"], F.lit(0.0)), den + F.when(h.isNotNull(), w).otherwise(0.0)
            text.append(F.when(h.isNotNull(), F.lit(f"+{names[i]}")).otherwise(""))
        got = got.withColumns({"_lv_num": num, "_lv_den": den, "_lv_names": F.concat(*text)}).drop("_ks", *[f"_hit{j}" for j in range(len(some))])
    return got.withColumns({out: safe_div(F.col("_lv_num"), F.col("_lv_den")), matched: F.substring("_lv_names", 2, 1 << 20)}).drop("_lv_num", "_lv_den", "_lv_names")


def apply_levels(frame: DataFrame, lookup: DataFrame, levels: Sequence[Level], by: Sequence[str] = (), count_k: float | None = 24.0,
                 correction: str = "correction", matched: str = "matched", where: Column | None = None) -> DataFrame:
    """``apply_weighted`` that leaves the rows where they are (``weigh_levels``); rows outside ``where`` meet nothing."""
    return weigh_levels(frame, lookup, {lv.name: lv.keys for lv in levels}, {lv.name: lv.weight for lv in levels}, by, "correction", count_k, correction, matched, where=where)


def season_scale(cfg: dict | None) -> Column:
    """Multiplier of hot-peak rows by season; 1 (or the default) elsewhere."""
    cfg = cfg or {}
    out = F.lit(float(cfg.get("default_scale", 1.0)))
    hot = F.col("Hour").isin(*cfg.get("hours", [16, 17, 18, 19, 20])) & (F.col("Temperature_DailyMax") >= float(cfg.get("min_maxtemp_f", 90.0)))
    for name, scale in (cfg.get("season_scales") or {}).items():
        out = F.when(hot & (F.col("Season") == name), F.lit(float(scale))).otherwise(out)
    return out


def floor_at_zero(x: Column) -> Column:
    return clip(x, lo=0.0)


def apply_learned(frame: DataFrame, lookup: DataFrame, by: Sequence[str] = (), cap: float | None = None, base: str = "Raw_Forecast_MWH",
                  hot_peak: dict | None = None, levels: Sequence[Level] = LEARNED) -> DataFrame:
    out = apply_weighted(add_context(frame), lookup, levels, by, 24.0, "_corr", "Calibration_Matched_Levels")
    corr = F.coalesce("_corr", F.lit(0.0))
    if cap is not None:
        corr = clip(corr, -cap, cap)
    out = out.withColumn("Residual_Cal_MWH", corr * season_scale(hot_peak))
    out = out.withColumns({"Calibration_Level": F.when(F.col("_corr").isNotNull(), "weighted_fallback").otherwise("none"),
                           "Residual_Calibrated_Forecast_MWH": floor_at_zero(F.col(base) + F.col("Residual_Cal_MWH"))})
    return out.drop("_corr")


def apply_scoped(frame: DataFrame, lookup: DataFrame, levels: Sequence[Level], scope: Column, by: Sequence[str] = (),
                 cap: float | None = None, count_k: float | None = 10.0, base: str = "Calibrated_Forecast_MWH",
                 out_col: str = "Correction_MWH", forecast_col: str = "Adjusted_Forecast_MWH", source_col: str = "Correction_Source") -> DataFrame:
    """Weighted lookup applied inside a scope; zero and 'none' outside or without a match."""
    out = apply_weighted(frame, lookup, levels, by, count_k, "_corr", "_names")
    use = F.coalesce(scope, F.lit(False)) & F.col("_corr").isNotNull()
    corr = F.col("_corr") if cap is None else clip("_corr", -cap, cap)
    out = out.withColumns({out_col: F.when(use, corr).otherwise(0.0), source_col: F.when(use, F.col("_names")).otherwise("none")})
    return out.withColumn(forecast_col, floor_at_zero(F.col(base) + F.col(out_col))).drop("_corr", "_names")


def warm_ramp_scope(lo: float = 75.0, hi: float = 93.0, hours: Sequence[int] = tuple(range(12, 23))) -> Column:
    t = F.col("Temperature_DailyMax")
    return F.col("Season").isin("Spring", "Fall") & (t >= lo) & (t <= hi) & F.col("Hour").isin(*hours)


def heat_peak_scope(min_temp: float, hours: Sequence[int]) -> Column:
    return (F.col("Temperature_DailyMax") >= min_temp) & F.col("Hour").isin(*hours)


def lookup_table(lookup: DataFrame, levels: Sequence[Level], by: Sequence[str] = ()) -> DataFrame:
    """Lookup with its key text split back into named values, strongest correction first within a level."""
    names = F.create_map(*[x for lv in levels for x in (F.lit(lv.name), F.lit("|".join(lv.keys)))])
    cols = F.split(F.element_at(names, F.col("level")), r"\|")
    return lookup.select(*by, "level", F.map_from_arrays(cols, F.split("key", r"\|")).alias("keys"), "correction", "mean", "count", "std", "shrink_weight")
