"""Queries: one fitted model per series or origin, and recursion with it."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..core.scratch import materialise
from ..models import grouped as GM
from ..operators.replay import Origins
from .base import ctes, load, query, weather
from .h_flows import s


def solve_sql(src, keys, terms, label, ridge):
    """CTEs up to ``beta(keys, w)``: Gauss-Jordan elimination of the ridge equations, one step a term; ``w`` holds the coefficients, intercept first."""
    x = ["1e0", *terms]
    d, ks = len(x), ", ".join(keys)
    whole = " AND ".join(f"({t}) IS NOT NULL" for t in [*terms, label])
    cells = [f"{{'i': {i}, 'j': {j}, 'v': sum(({x[i]}) * ({x[j]})) + {ridge if i == j and i else 0.0}}}" for i in range(d) for j in range(d)]
    cells += [f"{{'i': {i}, 'j': {d}, 'v': sum(({x[i]}) * ({label}))}}" for i in range(d)]
    out = [f"m0 AS MATERIALIZED (SELECT {ks}, u.i AS i, u.j AS j, u.v AS v FROM (SELECT {ks}, unnest([{', '.join(cells)}]) AS u FROM {src} WHERE {whole} GROUP BY {ks}))"]
    for p in range(d):
        same = " AND ".join(f"{{t}}.{k} = a.{k}" for k in keys)
        on = [same.format(t=t) for t in ("p", "f", "r")]
        out.append(f"m{p + 1} AS MATERIALIZED (SELECT {', '.join('a.' + k for k in keys)}, a.i, a.j, CASE WHEN a.i = {p} THEN a.v / p.v ELSE a.v - f.v * r.v / p.v END AS v FROM m{p} a "
                   f"JOIN m{p} p ON {on[0]} AND p.i = {p} AND p.j = {p} JOIN m{p} f ON {on[1]} AND f.i = a.i AND f.j = {p} JOIN m{p} r ON {on[2]} AND r.i = {p} AND r.j = a.j)")
    out.append(f"beta AS (SELECT {ks}, list(v ORDER BY i) AS w FROM m{d} WHERE j = {d} GROUP BY {ks})")
    return ",\n".join(out)


def value_sql(terms):
    return " + ".join(["w[1]", *[f"w[{i}] * ({t})" for i, t in enumerate(terms, 2)]])


def waves(spec):
    """Fourier terms as (SQL, Spark): one sine and cosine per (clock, period, harmonics)."""
    out = []
    for sql, col, period, harmonics in spec:
        for k in range(1, harmonics + 1):
            a = 2 * math.pi * k / period
            out += [(f"sin({a!r} * {sql})", F.sin(F.lit(a) * col())), (f"cos({a!r} * {sql})", F.cos(F.lit(a) * col()))]
    return out


def trend_terms():
    """Trend, yearly, weekly and daily terms and two weather regressors, as (SQL, Spark)."""
    clocks = [("dayofyear(l.DT)", lambda: F.dayofyear("DT"), 365.25, 2), ("(isodow(l.DT) - 1)", lambda: F.weekday("DT"), 7.0, 1), ("hour(l.DT)", lambda: F.hour("DT"), 24.0, 2)]
    # hours since 2024-01-01 over 720
    return [("((l.eh - 473352) / 720e0)", (F.col("eh") - 473352) / F.lit(720.0)), *waves(clocks), ("coalesce(TempF, 75) / 100", F.coalesce("TempF", F.lit(75.0)) / 100), ("coalesce(CloudCoverPct, 50) / 100", F.coalesce("CloudCoverPct", F.lit(50.0)) / 100)]


TREND_SQL = [
    "((l.eh - 473352) / 720e0)",
    *[f"{f}({2 * math.pi * k / p!r} * {q})" for q, p, n in (("dayofyear(l.DT)", 365.25, 2), ("(isodow(l.DT) - 1)", 7.0, 1), ("hour(l.DT)", 24.0, 2)) for k in range(1, n + 1) for f in ("sin", "cos")],
    "coalesce(TempF, 75) / 100", "coalesce(CloudCoverPct, 50) / 100",
]
TRAIN_END = "2024-01-24"


def load_with_weather(spark, d):
    w = weather(spark, d).select("series", "DT", "TempF", "CloudCoverPct")
    return load(spark, d).join(w, ["series", "DT"], "left")


LW_SQL = "lw AS MATERIALIZED (SELECT l.*, TempF, CloudCoverPct FROM v_load l LEFT JOIN v_weather w ON w.series = l.series AND w.DT = l.DT)"


@query("mod04_trend_season_per_series", ctes("load", "weather") + f", {LW_SQL}, " + solve_sql(f"(SELECT * FROM lw WHERE DT < TIMESTAMP '{TRAIN_END}') l", ["series"], TREND_SQL, "MWH", 1.0) + f""",
f AS (SELECT l.series, l.DT, MWH, {value_sql(TREND_SQL)} AS p FROM lw l JOIN beta ON beta.series = l.series WHERE DT >= TIMESTAMP '{TRAIN_END}')
SELECT series, CAST(DT AS VARCHAR) AS DT, MWH AS a, p AS f FROM f""", r4=["a", "f"])
def _(spark, d):
    """Fitted on the days before ``TRAIN_END``, forecasts of the rest."""
    x = materialise(load_with_weather(spark, d), spark)
    terms = [t for _, t in trend_terms()]
    cut = F.lit(TRAIN_END).cast("timestamp")
    m = GM.fit_groups(x.where(F.col("DT") < cut), terms, "MWH", ["series"], 1.0)
    o = GM.predict_groups(x.where(F.col("DT") >= cut), m, terms, ["series"])
    return o.select("series", s("DT"), F.col("MWH").alias("a"), F.col("prediction").alias("f"))


ORIGINS = Origins("2024-01-08", 1, 20, 3, 7)
SHORT_SQL = [*[f"{f}({2 * math.pi * k / 24!r} * hour(l.DT))" for k in (1, 2) for f in ("sin", "cos")], "coalesce(TempF, 75) / 100"]


def short_terms():
    out = [f(F.lit(2 * math.pi * k / 24) * F.hour("DT")) for k in (1, 2) for f in (F.sin, F.cos)]
    return [*out, F.coalesce("TempF", F.lit(75.0)) / 100]


@query("rep21_model_of_every_origin", ctes("load", "weather") + f", {LW_SQL}, og AS (SELECT CAST(k AS INT) AS k, DATE '2024-01-08' + CAST(k AS INTEGER) AS o FROM range(0, 20) t(k)), "
       + solve_sql("(SELECT k, lw.* FROM og JOIN lw ON DT < o AND DT >= o - 7) l", ["k", "series"], SHORT_SQL, "MWH", 0.5) + f"""
SELECT og.k AS origin, l.series, CAST(l.DT AS VARCHAR) AS DT, CAST(datediff('hour', CAST(o AS TIMESTAMP), l.DT) + 1 AS INT) AS lead, MWH AS a, {value_sql(SHORT_SQL)} AS f
FROM og JOIN lw l ON l.DT >= o AND l.DT < o + 3 LEFT JOIN beta ON beta.k = og.k AND beta.series = l.series""", r4=["a", "f"])
def _(spark, d):
    """Each origin's own model, fitted on the week before it, over its three days."""
    from ..operators.replay import replay_frame

    x = materialise(load_with_weather(spark, d), spark)
    m = GM.fit_groups_by_origin(x, short_terms(), "MWH", ["series"], ORIGINS, 0.5)
    t = replay_frame(x, ORIGINS).where("Is_Target")
    o = GM.predict_groups(t, m, short_terms(), ["Origin", "series"])
    return o.select(F.col("Origin").alias("origin"), "series", s("DT"), F.col("Forecast_Lead_Hour").alias("lead"), F.col("MWH").alias("a"), F.col("prediction").alias("f"))


AR_SQL = ["l1 / 100", "l24 / 100", *[f"{f}({2 * math.pi / 24!r} * hr)" for f in ("sin", "cos")], "dm / 100"]


def ar_terms():
    return [F.col("lag_1") / 100, F.col("lag_24") / 100, *[f(F.lit(2 * math.pi / 24) * F.col("Hour")) for f in (F.sin, F.cos)], F.col("decayed") / 100]


HALF, MEMORY, STEPS = 12.0, 48, 24
_W = [0.5 ** (a / HALF) for a in range(MEMORY)]
_DM = "list_sum(list_transform(list_zip(ring, [" + ", ".join(repr(x / sum(_W)) for x in reversed(_W)) + "]), lambda z: z[1] * z[2]))"


def ar_rows(x):
    """Training rows: lags and the decayed mean of the ``MEMORY`` hours before; rows with a gap in those hours are left out."""
    w = GM.ring_rows(x, MEMORY)
    return w.withColumns({"lag_1": F.element_at("_ring", -1), "lag_24": F.element_at("_ring", -24), "Hour": F.hour("DT"), "decayed": GM.decayed_mean("_ring", MEMORY, HALF)})


@query("mod03_recursive_fitted_per_series", ctes("load").replace("WITH ", "WITH RECURSIVE ", 1) + f""",
t0 AS (SELECT series, hour(DT) AS hr, MWH, list(MWH) OVER q AS ring FROM v_load WINDOW q AS (PARTITION BY series ORDER BY eh RANGE BETWEEN {MEMORY} PRECEDING AND 1 PRECEDING)),
tr AS (SELECT *, ring[-1] AS l1, ring[-24] AS l24, {_DM} AS dm FROM t0 WHERE len(ring) = {MEMORY}), """ + solve_sql("tr", ["series"], AR_SQL, "MWH", 0.1) + f""",
e AS (SELECT series, max(eh) AS m FROM v_load GROUP BY 1), nr AS (SELECT l.series, e.m AS last, map_from_entries(list((e.m - l.eh, MWH))) AS m, avg(MWH) AS av FROM v_load l JOIN e ON e.series = l.series WHERE e.m - l.eh < {MEMORY} GROUP BY 1, 2),
st AS (SELECT series, last, [coalesce(m[{MEMORY} - 1 - a], av) for a in range({MEMORY})] AS ring FROM nr),
rc AS (SELECT series, last, 0 AS h, ring, NULL::DOUBLE AS y FROM st UNION ALL
  SELECT series, last, h + 1, list_concat(ring[2:], [p]), p FROM (SELECT *, {value_sql(AR_SQL)} AS p FROM (SELECT rc.*, w, ring[-1] AS l1, ring[-24] AS l24, (last + h + 1) % 24 AS hr, {_DM} AS dm FROM rc JOIN beta ON beta.series = rc.series) z WHERE h < {STEPS}) v)
SELECT series, CAST(h AS INT) AS lead, y FROM rc WHERE h > 0""", r4=["y"])
def _(spark, d):
    x = materialise(load(spark, d).select("series", "DT", "eh", "MWH"), spark)
    m = GM.fit_groups(ar_rows(x), ar_terms(), "MWH", ["series"], 0.1)
    o = GM.recursive_steps(x, lambda f: f.withColumn("prediction", GM.dot(ar_terms())), STEPS, lags=(1, 24), memory=MEMORY, carry=m.select("series", "coef"), decay={"decayed": HALF})
    return o.select("series", F.col("Forecast_Lead_Hour").alias("lead"), F.col("Raw_Forecast_MWH").alias("y"))
