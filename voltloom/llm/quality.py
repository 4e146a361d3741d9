"""Quality rules whose cutoffs carry a guarantee.

Four measures of a text (share of symbols, of repeated lines, of words in repeated
three-word windows, of capitals) each get one cutoff per stratum.  The labelled
documents are the holdout: they play no part in defining the measures or the grid
of possible cutoffs.  A cutoff is certified when the exact binomial upper bound on
its rate of rejecting good documents lies under the allowed rate, and of the
certified cutoffs the one is taken that rejects most bad documents net of good ones.

* The rate ``max_false`` holds per stratum for all measures together: each measure
  gets an equal part of it.
* The confidence ``error`` is divided by (strata x measures).  Along the grid no
  further division is needed: cutoffs are tried from the loosest on and the bound
  only grows, so testing in that fixed order keeps the error (fixed-sequence test).

Everything is DataFrame expressions.  Texts are measured row by row without a
shuffle; the calibration shuffles numbers only, folded to (stratum, measure, cell)
counts before they move, so a hot stratum costs no more than a rare one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voltloom.core.scratch import materialise
from voltloom.llm.base import packed, query, table, words

MEASURES = ("symbol_share", "dup_line_share", "repeat_share", "capital_share")
GRID = 50            # cutoffs lie at j / GRID
MAX_FALSE = 0.05     # allowed share of good documents rejected, per stratum
ERROR = 0.05         # chance that any such guarantee fails
MIN_WORDS = 50
SMALL_SET = 64       # up to so many repeated windows are looked up, more are sorted; the result is the same

_HAS_WORD = r"[^\x20\x09-\x0D]"


def _covered(starts: Column) -> Column:
    """Words under three-word windows that begin at the ascending positions ``starts``."""
    zero = F.struct(F.lit(-3).alias("at"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(
        starts, zero,
        lambda a, i: F.struct(i.alias("at"), (a["n"] + F.least(F.lit(3), i - a["at"])).alias("n")),
        lambda a: a["n"])


def _with_repeat_words(rows: DataFrame) -> DataFrame:
    """Add ``n_repeat_words`` from the window hashes ``_g``.

    Every array a lambda looks into is a column of its own, computed once a row.
    """
    ordered = rows.withColumn("_o", F.sort_array("_g"))
    again = ordered.withColumn("_a", F.array_distinct(F.filter("_o", lambda g, i: g == F.get("_o", i - 1)))).drop("_o")
    many = F.size("_a") > SMALL_SET
    placed = again.withColumn("_p", F.when(many, F.array_sort(F.transform("_g", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))))
    starts = F.when(many, F.sort_array(F.transform(
        F.filter("_p", lambda p, k: (p["g"] == F.get("_p", k - 1)["g"]) | (p["g"] == F.get("_p", k + 1)["g"])), lambda p: p["i"])))
    few = F.filter(F.transform("_g", lambda g, i: F.when(F.array_contains("_a", g), i)), lambda i: i.isNotNull())
    starts = F.when(F.size("_a") == 0, F.array().cast("array<int>")).when(many, starts).otherwise(few)
    return placed.withColumn("_at", starts).withColumn("n_repeat_words", _covered(F.col("_at"))).drop("_g", "_a", "_p", "_at")


def measure(docs: DataFrame, text: str = "text", stratum: str = "lang") -> DataFrame:
    """One row per document: struct ``doc`` (the row as it came), ``stratum``, counts, shares and ``base_failed``.

    A null or empty text has no words and fails the base rule; a null stratum is the
    stratum ``(none)``.  Whole texts are measured, however long; repeated rows are
    measured each for itself.
    """
    t = F.coalesce(F.col("_t"), F.lit(""))
    base = packed(docs.withColumns({"_t": F.col(text), "_s": F.coalesce(F.col(stratum).cast("string"), F.lit("(none)"))}), "_t", "_s")
    base = base.withColumn("doc", F.col("doc").dropFields("_t", "_s"))
    split = base.select("doc", F.col("_s").alias("stratum"), "_t", words(F.col("_t")).alias("_w"),
                        F.filter(F.split(t, "\n", -1), lambda line: line.rlike(_HAS_WORD)).alias("_l"))
    grams = split.select(
        "doc", "stratum",
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.regexp_replace(t, r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        (F.length(t) - F.length(F.regexp_replace(t, r"[A-Z]+", ""))).cast("long").alias("n_capitals"),
        F.size("_l").cast("long").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("_w") >= 3, F.transform(
            F.sequence(F.lit(0), F.size("_w") - 3),
            lambda i: F.xxhash64(F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2))))
        .otherwise(F.array().cast("array<bigint>")).alias("_g"))
    out = _with_repeat_words(grams)
    share = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return out.withColumns({
        "symbol_share": share("n_symbols", "word_chars"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "capital_share": share("n_capitals", "word_chars"),
        "base_failed": (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
    })


def allowed_rejections(n: Column, rate: Column, error: Column) -> Column:
    """Largest k whose exact upper bound is within ``rate``: P(X <= k) <= error for X ~ Binomial(n, rate); -1 if none.

    The probabilities are folded in logarithms from k = 0 up to the mean, where the
    distribution function has passed any error below one half.
    """
    odds = F.log(rate) - F.log1p(-rate)
    first = n * F.log1p(-rate)
    start = F.struct(first.alias("p"), first.alias("c"), F.when(first <= F.log(error), 0).otherwise(-1).cast("long").alias("k"))

    def step(a, i):
        p = a["p"] + F.log((n - i + 1) / i) + odds
        c = F.greatest(a["c"], p) + F.log1p(F.exp(-F.abs(a["c"] - p)))
        return F.struct(p.alias("p"), c.alias("c"), F.when(c <= F.log(error), i).otherwise(a["k"]).alias("k"))

    upto = F.least(F.ceil(n * rate), n).cast("long")
    return F.aggregate(F.when(upto >= 1, F.sequence(F.lit(1).cast("long"), upto)).otherwise(F.array().cast("array<bigint>")),
                       start, step, lambda a: a["k"])


def calibrate(measured: DataFrame, labels: DataFrame, doc_id: str = "doc_id", max_false: float = MAX_FALSE, error: float = ERROR) -> DataFrame:
    """``stratum, cutoffs``: a map from measure to certified cutoff, for strata that have one.

    ``labels`` has (doc_id, quality 0/1).  Labels of one document are folded; if any
    says good, it is good.  Null ids and null labels take no part.  A document row
    without a label takes no part; repeated rows of a labelled document each count.
    Documents that fail the base rule are rejected anyway and take no part.
    """
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
             .groupBy(F.col("doc_id").alias("_id")).agg((F.max("quality") > 0).alias("good")))
    cells = F.array(*[F.struct(F.lit(m).alias("measure"), F.least(F.floor(F.col(m) * GRID), F.lit(GRID)).cast("int").alias("cell")) for m in MEASURES])
    rows = measured.where(~F.col("base_failed")).select(F.col(f"doc.{doc_id}").alias("_id"), "stratum", cells.alias("_c"))
    hist = (rows.join(known, "_id").select("stratum", "good", F.explode("_c").alias("x")).select("stratum", "good", "x.*")
            .groupBy("stratum", "measure", "cell")
            .agg(F.count(F.when(F.col("good"), 1)).alias("good"), F.count(F.when(~F.col("good"), 1)).alias("bad")))
    # a row is rejected by cutoff j / GRID when its cell is j or more; at most GRID + 1 cells per (stratum, measure)
    per = Window.partitionBy("stratum", "measure")
    above = per.orderBy(F.desc("cell"))
    cut = hist.select("stratum", "measure", "cell", F.sum("good").over(above).alias("good_out"), F.sum("bad").over(above).alias("bad_out"),
                      F.sum("good").over(per).alias("n_good"))
    cut = materialise(cut)
    n_tests = max(1, cut.select("stratum").distinct().count() * len(MEASURES))
    limits = (cut.groupBy("stratum", "measure").agg(F.max("n_good").alias("n"))
              .select("stratum", "measure", allowed_rejections(F.col("n"), F.lit(max_false / len(MEASURES)), F.lit(error / n_tests)).alias("allowed")))
    gain = F.col("bad_out") - F.col("good_out")
    best = (cut.join(limits, ["stratum", "measure"])
            .where((F.col("good_out") <= F.col("allowed")) & (gain > 0) & (F.col("cell") > 0))
            .groupBy("stratum", "measure").agg(F.max_by("cell", F.struct(gain, F.col("cell"))).alias("cell")))
    return best.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("measure", F.col("cell").cast("int")))).alias("cutoffs"))


def judge(measured: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Add ``failed`` (names of the rules broken) and ``kept``; without certified cutoffs only the base rule rejects."""
    c = cutoffs.select(F.col("stratum").alias("_s"), F.col("cutoffs").alias("_cut"))
    broken = [F.when(F.floor(F.col(m) * GRID) >= F.col("_cut")[m], F.lit(m)) for m in MEASURES]
    out = measured.join(c, F.col("stratum") == F.col("_s"), "left")
    out = out.withColumn("failed", F.array_compact(F.array(F.when(F.col("base_failed"), F.lit("base")), *broken)))
    return out.withColumn("kept", F.size("failed") == 0).drop("_s", "_cut")


def filter_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents kept, with their own columns.

    The measured rows are written once with their texts, as both the calibration and
    the verdict read them; the texts are never shuffled.  They lie on disk until the
    result has been read, so they are packed more tightly than other scratch tables.
    """
    measured = materialise(measure(docs), compression="zstd")
    cutoffs = materialise(calibrate(measured, labels))
    return judge(measured, cutoffs).where("kept").select("doc.*")


SQL = f"""
WITH w AS (SELECT doc_id, coalesce(lang, '(none)') stratum, coalesce(text, '') t,
    list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) ls, row_number() OVER () rid FROM documents),
g AS (SELECT rid, i, ws[i] || ' ' || ws[i+1] || ' ' || ws[i+2] gram FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) i FROM w WHERE len(ws) >= 3)),
gr AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) c FROM g) WHERE c > 1),
rw AS (SELECT rid, count(*) n FROM (SELECT DISTINCT rid, i + o p FROM gr, (VALUES (0), (1), (2)) v(o)) GROUP BY rid),
m AS (SELECT w.rid, doc_id, stratum, len(ws)::BIGINT n_words, length(array_to_string(ws, ''))::BIGINT word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT n_symbols,
    (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')))::BIGINT n_capitals, len(ls) n_lines,
    (len(ls) - len(list_distinct(ls)))::BIGINT n_dup_lines, coalesce(rw.n, 0)::BIGINT n_repeat_words FROM w LEFT JOIN rw USING (rid)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words base_failed,
    {{'symbol_share': n_symbols / greatest(word_chars, 1), 'dup_line_share': n_dup_lines / greatest(n_lines, 1),
      'repeat_share': n_repeat_words / greatest(n_words, 1), 'capital_share': n_capitals / greatest(word_chars, 1)}} s FROM m),
x AS (SELECT rid, doc_id, stratum, base_failed, unnest(['symbol_share', 'dup_line_share', 'repeat_share', 'capital_share']) measure,
    least(floor(unnest([s.symbol_share, s.dup_line_share, s.repeat_share, s.capital_share]) * 50), 50)::INT cell FROM b),
k AS (SELECT doc_id, max(quality) > 0 good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
h AS (SELECT stratum, measure, cell, count(*) FILTER (good) good, count(*) FILTER (NOT good) bad FROM x JOIN k USING (doc_id) WHERE NOT base_failed GROUP BY ALL),
c AS (SELECT *, sum(good) OVER a good_out, sum(bad) OVER a bad_out, sum(good) OVER (PARTITION BY stratum, measure) n FROM h
    WINDOW a AS (PARTITION BY stratum, measure ORDER BY cell DESC)),
lim AS (SELECT stratum, measure, coalesce(max(i) FILTER (cdf <= {ERROR} / (4 * (SELECT count(DISTINCT stratum) FROM c))), -1) allowed FROM (
    SELECT stratum, measure, i, sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({MAX_FALSE} / 4) + (n - i) * ln(1 - {MAX_FALSE} / 4)))
        OVER (PARTITION BY stratum, measure ORDER BY i) cdf
    FROM (SELECT stratum, measure, n::BIGINT n, unnest(range(0, (ceil(n * {MAX_FALSE} / 4) + 1)::BIGINT)) i FROM (SELECT DISTINCT stratum, measure, n FROM c))) GROUP BY ALL),
best AS (SELECT stratum, measure, max_by(cell, (bad_out - good_out) * 1000 + cell) cell FROM c JOIN lim USING (stratum, measure)
    WHERE good_out <= allowed AND bad_out > good_out AND cell > 0 GROUP BY ALL),
rej AS (SELECT DISTINCT rid FROM x JOIN best USING (stratum, measure) WHERE x.cell >= best.cell)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND rid NOT IN (SELECT rid FROM rej) kept FROM b
"""


@query("op1_quality_rules", SQL)
def op1_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    measured = measure(docs)
    numbers = materialise(measured.withColumn("doc", F.struct("doc.doc_id")))
    cutoffs = materialise(calibrate(numbers, table(spark, sf_dir, "labels")))
    return judge(numbers, cutoffs).select("doc.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
