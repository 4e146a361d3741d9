"""Query: the decayed residual of each series from a stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..streaming import decayed as DR
from ..streaming import jobs as J
from .base import ctes, load, query
from .h_flows import drained, s, staged


@query("str05_decayed_residuals", ctes("load") + """,
b AS (SELECT series, eh // 24 AS d, count(*) AS n, sum(pow(2, -((eh // 24 + 1) * 24 - eh) / 72.0)) AS w, sum((MWH - (50 + hour(DT))) * pow(2, -((eh // 24 + 1) * 24 - eh) / 72.0)) AS s FROM v_load GROUP BY 1, 2),
z AS (SELECT series, d, sum(n) OVER v AS n, sum(w * pow(2, (d - d0) / 3.0)) OVER v / pow(2, (d - d0) / 3.0) AS w, sum(s * pow(2, (d - d0) / 3.0)) OVER v / pow(2, (d - d0) / 3.0) AS s FROM (SELECT *, min(d) OVER (PARTITION BY series) AS d0 FROM b) WINDOW v AS (PARTITION BY series ORDER BY d))
SELECT series, CAST(TIMESTAMP '1970-01-01' + to_days(CAST(d + 1 AS INTEGER)) AS VARCHAR) AS DT, CAST(n AS BIGINT) AS n, w AS weight, s / w AS ewma FROM z WHERE (d + 1) * 24 <= (SELECT max(eh) FROM v_load) - 24""", r6=["weight", "ewma"])
def _(spark, d):
    l = load(spark, d).select("series", "DT", (F.col("MWH") - (50 + F.hour("DT"))).alias("Residual_MWH"))
    path, schema = staged(spark, l)
    with DR.keyed_state_store(spark):
        o = drained(spark, DR.decayed_residuals(J.file_stream(spark, path, schema)))
    return o.select("series", s("DT"), "n", "weight", "ewma")
