"""URL filters by dated lists.

List entries (list, pattern, action, dated) become validity intervals, and every
capture is judged by what was in force on the day it was fetched.  A pattern is a
domain (itself and all below it) or a domain with a path (all below that path).

The as-of join never sees a hot host: the captures' (pattern, day) pairs are made
distinct first, so its windows hold at most one row per day and entry date, however
many captures a domain has; the result comes back by an equi-join on (pattern, day).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voltloom.core.frames import null_safe_join
from voltloom.core.scratch import materialise
from voltloom.llm.base import query, table

_PARTS = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)(?::[0-9]*)?([^?#]*)"


def _with_patterns(captures: DataFrame, depth: int) -> DataFrame:
    """Each capture with every pattern that covers its URL: its domains, and the host with up to ``depth`` path segments."""
    cut = captures.withColumns({"_h": F.lower(F.regexp_extract("url", _PARTS, 1)), "_q": F.regexp_extract("url", _PARTS, 2)}).where("_h <> ''")
    cut = cut.withColumn("_l", F.split("_h", r"\.", -1))
    if depth:
        cut = cut.withColumn("_s", F.slice(F.array_remove(F.split("_q", "/", -1), ""), 1, depth))
    domains = F.transform(F.sequence(F.lit(1), F.size("_l")), lambda i: F.array_join(F.slice("_l", i, F.size("_l")), "."))
    patterns = domains
    if depth:
        paths = F.transform("_s", lambda x, i: F.concat("_h", F.lit("/"), F.array_join(F.slice("_s", 1, i + 1), "/")))
        patterns = F.concat(domains, paths)
    return cut.select("page_id", "url", "fetched", F.explode(patterns).alias("pattern"))


def intervals(entries: DataFrame) -> DataFrame:
    """``list, pattern, valid_from, valid_to, active``: what each entry says until the next one (open at the end).

    Of several entries for one pattern on one day an ``add`` wins.  Entries with a null
    list, pattern or date, or another action than add or remove, say nothing.
    """
    host = F.substring_index("pattern", "/", 1)
    written = F.concat(F.lower(host), F.expr("substring(pattern, length(substring_index(pattern, '/', 1)) + 1)"))
    e = entries.where(F.col("action").isin("add", "remove")).select(
        "list", F.regexp_replace(written, "/+$", "").alias("pattern"), F.to_date("dated").alias("valid_from"), (F.col("action") == "add").alias("active")).dropna()
    days = e.groupBy("list", "pattern", "valid_from").agg(F.max("active").alias("active"))
    by = Window.partitionBy("list", "pattern").orderBy("valid_from")
    return days.select("list", "pattern", "valid_from", F.lead("valid_from").over(by).alias("valid_to"), "active")


def evaluate(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """Captures (page_id, url, fetched) with ``blocked``, ``lists`` (sorted) and ``n_entries`` in force that day.

    A null or unreadable URL and a null fetch time meet no entry and pass.  Repeated
    rows each get the same verdict.  Hosts match in any case, paths only in the case of
    the pattern; query and fragment play no part.
    """
    spans = materialise(intervals(entries))
    depth = spans.agg(F.max(F.size(F.split("pattern", "/", -1)) - 1)).first()[0] or 0
    cap = captures.select("page_id", "url", F.to_date("fetched").alias("fetched"))
    listed = spans.select("list", "pattern").distinct()
    pairs = _with_patterns(cap.where("fetched IS NOT NULL").distinct(), depth)
    pairs = materialise(pairs.join(listed.select("pattern").distinct(), "pattern", "left_semi"))

    asked = pairs.select("pattern", F.col("fetched").alias("day")).distinct().join(listed, "pattern").select("list", "pattern", "day", F.lit(1).alias("side"), F.lit(None).cast("boolean").alias("active"))
    said = spans.select("list", "pattern", F.col("valid_from").alias("day"), F.lit(0).alias("side"), "active")
    upto = Window.partitionBy("list", "pattern").orderBy("day", "side").rowsBetween(Window.unboundedPreceding, 0)
    state = (asked.unionByName(said).withColumn("now", F.last("active", ignorenulls=True).over(upto))
             .where("side = 1 AND now").select("list", "pattern", F.col("day").alias("fetched")))
    hits = (pairs.join(state, ["pattern", "fetched"]).groupBy("page_id", "url", "fetched")
            .agg(F.sort_array(F.collect_set("list")).alias("lists"), F.count(F.lit(1)).alias("n_entries")))
    out = null_safe_join(cap, hits, ["page_id", "url", "fetched"])
    return out.select("page_id", "url", "fetched", F.col("n_entries").isNotNull().alias("blocked"),
                      F.coalesce("lists", F.array().cast("array<string>")).alias("lists"), F.coalesce("n_entries", F.lit(0).cast("long")).alias("n_entries"))


# The tables have no fetch time and no list, so both are read off the pages: the day from
# page_id, and dated entries for a tenth of the hosts (added, removed 60 days later, added
# again 120 days later) and for the registered domain of every seventieth.
def _sample_entries(pages: DataFrame) -> DataFrame:
    hosts = pages.select(F.lower(F.regexp_extract("url", _PARTS, 1)).alias("host")).where("host <> ''").distinct()
    num = F.conv(F.substring(F.md5("host"), 1, 8), 16, 10).cast("long")
    h = hosts.select("host", num.alias("n")).where("n % 10 = 0").withColumn("start", F.expr("date_add(DATE'2024-01-01', CAST(n DIV 10 % 300 AS INT))"))
    name = F.when(F.col("n") % 20 == 0, "spam").otherwise("malware")
    steps = F.array(*[F.struct(F.lit(a).alias("action"), F.date_add("start", d).alias("dated")) for a, d in (("add", 0), ("remove", 60), ("add", 180))])
    dated = h.select(name.alias("list"), F.col("host").alias("pattern"), F.explode(steps).alias("s")).select("list", "pattern", "s.action", "s.dated")
    domain = h.where("n % 70 = 0").select(F.lit("domains").alias("list"), F.regexp_extract("host", r"[^.]+\.[^.]+\.[^.]+$", 0).alias("pattern"), F.lit("add").alias("action"), F.col("start").alias("dated")).where("pattern <> ''")
    return dated.unionByName(domain)


SQL = r"""
WITH p AS (SELECT page_id, url, DATE '2024-01-01' + (page_id % 366)::INT fetched, lower(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)', 1)) host FROM pages),
h AS (SELECT host, n, DATE '2024-01-01' + (n // 10 % 300)::INT st FROM (SELECT DISTINCT host, ('0x' || substr(md5(host), 1, 8))::BIGINT n FROM p WHERE host <> '') WHERE n % 10 = 0),
e AS (SELECT CASE WHEN n % 20 = 0 THEN 'spam' ELSE 'malware' END list, host pattern, a, st + d dated FROM h, (VALUES ('add', 0), ('remove', 60), ('add', 180)) v(a, d)
  UNION ALL SELECT 'domains', regexp_extract(host, '[^.]+\.[^.]+\.[^.]+$'), 'add', st FROM h WHERE n % 70 = 0 AND regexp_matches(host, '[^.]+\.[^.]+\.[^.]+$')),
f AS (SELECT list, pattern, dated, max(a = 'add') act FROM e GROUP BY ALL),
v AS (SELECT *, lead(dated) OVER (PARTITION BY list, pattern ORDER BY dated) until FROM f),
r AS (SELECT rid, list FROM (SELECT *, row_number() OVER () rid FROM p) p JOIN v ON (host = pattern OR ends_with(host, '.' || pattern)) AND fetched >= dated AND (until IS NULL OR fetched < until) WHERE act),
g AS (SELECT rid, string_agg(DISTINCT list, ',' ORDER BY list) lists, count(*) n FROM r GROUP BY rid)
SELECT page_id, url, fetched, n IS NOT NULL blocked, coalesce(lists, '') lists, coalesce(n, 0) n_entries FROM (SELECT *, row_number() OVER () rid FROM p) LEFT JOIN g USING (rid)
"""


@query("op10_url_filters", SQL)
def op10_url_filters(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.withColumn("fetched", F.expr("date_add(DATE'2024-01-01', CAST(page_id % 366 AS INT))"))
    return evaluate(captures, _sample_entries(pages)).withColumn("lists", F.array_join("lists", ","))
