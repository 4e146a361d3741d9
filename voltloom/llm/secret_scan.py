"""Secret scans with linking of multipart credentials.

Strong patterns (assignments, access keys, long hexadecimal strings) are reported as
they are.  Weak candidates (an account identifier, a random-looking string, an
endpoint) mean little alone: one is reported only when a complementary part lies
in the same scope, at any distance, and does not overlap it.  Python finds the
candidates and the scopes of a text; the linking is an interval join in Spark over
the candidates of all texts.

A scope is an interval of the text: it ends at a blank line and at a section header
in brackets on a line of its own.  Each part meets the interval that holds its start.  Of a
scope only the earliest end and the latest start of each kind matter: a part has a
disjoint partner of a kind if one ends before it or starts after it.  These are
ordinary aggregates, so a scope full of parts costs its length and not its square.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voltloom.core.frames import null_safe_join
from voltloom.core.scratch import materialise
from voltloom.llm.base import query, table

# The patterns of the base kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
# Weak parts of a multipart credential.
IDENT = re.compile(r"""(?:client_?id|account|user(?:name)?|login|access_?key_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{4,}|(?<![A-Z0-9])A(?:SIA|IDA|ROA)[A-Z0-9]{12,}""", re.I | re.A)
OPAQUE = re.compile(r"(?<![A-Za-z0-9+/=])(?=[A-Za-z0-9+/]*[0-9])(?=[A-Za-z0-9+/]*[A-Z])(?=[A-Za-z0-9+/]*[a-z])[A-Za-z0-9+/]{24,}={0,2}")
ENDPOINT = re.compile(r"""(?:https?|jdbc:[a-z]+|amqps?|mongodb|postgres(?:ql)?|redis|ftp)://[^\s"'<>]{4,}|(?:host|endpoint|server)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]{4,}""", re.I | re.A)
BLANK = re.compile(r"\n[ \t\r]*\n")
SECTION = re.compile(r"(?:^|\n)(?=[ \t]*\[[^\[\]\n]{1,80}\][ \t\r]*(?:\n|$))")

KINDS = ("assign", "access", "hex", "ident", "opaque", "endpoint")  # the order of kinds at one start
WEAK = KINDS[3:]
IDENTIFIERS, SECRETS, ENDPOINTS = ("access", "ident"), ("assign", "hex", "opaque"), ("endpoint",)
# which kinds complete a part; an endpoint completes a secret or an access key, not a mere account name
PARTNERS = {**dict.fromkeys(IDENTIFIERS, SECRETS), "access": (*SECRETS, *ENDPOINTS), **dict.fromkeys(SECRETS, (*IDENTIFIERS, *ENDPOINTS)), "endpoint": (*SECRETS, "access")}


def find_base(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the strong spans, in order."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def _random_looking(s: str) -> bool:
    """Base64 with a slash, plus or padding has a length that fits, and some run between slashes is no word or number."""
    if any(c in s for c in "/+=") and len(s) % 4:
        return False
    return any(len(p) >= 12 and re.search("[0-9]", p) and re.search("[A-Z]", p) and re.search("[a-z]", p) for p in s.rstrip("=").split("/"))


def find_weak(text: str, strong: list[tuple[int, int, int]] | None = None) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the weak candidates, in order; a random-looking string inside an endpoint or a strong span is part of that."""
    ends = [(m.start(), 5, m.end()) for m in ENDPOINT.finditer(text)]
    out = [(m.start(), 3, m.end()) for m in IDENT.finditer(text)]
    taken = iter(sorted((s, e) for s, _, e in ends + (find_base(text) if strong is None else strong)))
    upto, nxt = 0, next(taken, None)  # the furthest end of the spans that start before a string
    for m in OPAQUE.finditer(text):
        while nxt and nxt[0] < m.end():
            upto, nxt = max(upto, nxt[1]), next(taken, None)
        if upto <= m.start() and _random_looking(m[0]):
            out.append((m.start(), 4, m.end()))
    return sorted(out + ends)


def find_scopes(text: str) -> list[int]:
    """Starts of the scopes after the first, which starts at 0."""
    return sorted({m.start() + 1 for m in BLANK.finditer(text)} | {m.end() for m in SECTION.finditer(text) if m.end()})


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        base, parts, scopes = [], [], []
        for t in b["text"]:
            t = t or ""
            strong = find_base(t)
            weak = find_weak(t, strong)
            base.append([{"start": s, "kind": k, "end": e} for s, k, e in strong])
            several = len(strong) + len(weak) > 1  # a single part has no partner
            parts.append([{"start": s, "kind": k, "end": e} for s, k, e in strong + weak] if several else [])
            scopes.append([0, *find_scopes(t)] if several else [])
        yield pd.DataFrame({"doc_id": b["doc_id"], "text_hash": b["text_hash"], "base": base, "parts": parts, "scopes": scopes})


TEXT = ("doc_id", "text_hash")


def in_scopes(parts: DataFrame, scopes: DataFrame) -> DataFrame:
    """Every part with the start of the scope that holds it: the last one at or before the part.

    ``parts`` has (doc_id, text_hash, start, kind, end), ``scopes`` (doc_id, text_hash, scope).
    One pass over both sides in order of position within a text.
    """
    p = parts.select(*TEXT, F.col("start").alias("_at"), F.lit(None).cast("int").alias("scope"), F.struct("start", "kind", "end").alias("p"))
    c = scopes.select(*TEXT, F.col("scope").alias("_at"), F.col("scope").cast("int").alias("scope"), F.lit(None).cast("struct<start:int,kind:int,end:int>").alias("p"))
    by = Window.partitionBy(*TEXT).orderBy("_at", F.asc_nulls_last("scope")).rowsBetween(Window.unboundedPreceding, 0)  # one text's parts
    return p.unionByName(c).withColumn("scope", F.last("scope", ignorenulls=True).over(by)).where("p IS NOT NULL").select(*TEXT, "scope", "p.*")


def linked_parts(placed: DataFrame) -> DataFrame:
    """The parts, strong ones too, that have a disjoint partner of a complementary kind in their scope."""
    ends = [F.min(F.when(F.col("kind") == k, F.col("end"))).alias(f"_e{k}") for k in range(len(KINDS))]
    starts = [F.max(F.when(F.col("kind") == k, F.col("start"))).alias(f"_s{k}") for k in range(len(KINDS))]
    scope = placed.groupBy(*TEXT, "scope").agg(*ends, *starts)
    met = null_safe_join(placed, scope, [*TEXT, "scope"])
    ok = F.lit(False)
    for name, others in PARTNERS.items():
        apart = F.lit(False)
        for o in map(KINDS.index, others):
            apart = apart | F.coalesce(F.col(f"_e{o}") <= F.col("start"), F.lit(False)) | F.coalesce(F.col(f"_s{o}") >= F.col("end"), F.lit(False))
        ok = ok | ((F.col("kind") == KINDS.index(name)) & apart)
    return met.where(ok).select(*TEXT, "scope", "start", "kind", "end")


def _spans(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, base, linked, credentials`` for every row.

    ``base`` and ``linked`` are arrays of (start, kind, end), code points: the strong
    spans, and the weak ones with a partner.  ``credentials`` are arrays of (scope,
    parts): the linked parts of a scope, strong ones among them, belong together.
    Null and empty texts have none of these.  A text of any length is one value.  Rows
    equal in id and text get the same spans; an empty table gives no rows; other columns
    of ``docs`` are not read.
    """
    kind = "start:int,kind:int,end:int"
    found = materialise(docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInPandas(
        _scan, f"doc_id bigint, text_hash bigint, base array<struct<{kind}>>, parts array<struct<{kind}>>, scopes array<int>"))
    once = found.where(F.size("parts") > 1).select(*TEXT, "parts", "scopes").dropDuplicates(list(TEXT))
    parts = once.select(*TEXT, F.explode("parts").alias("p")).select(*TEXT, "p.*")
    scopes = once.select(*TEXT, F.explode("scopes").alias("scope"))
    part = F.struct("start", "kind", "end")
    per_scope = linked_parts(in_scopes(parts, scopes)).groupBy(*TEXT, "scope").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    linked = per_scope.groupBy(*TEXT).agg(F.array_sort(F.collect_list(F.struct("scope", "parts"))).alias("credentials"))
    out = null_safe_join(found.select(*TEXT, "base"), linked, list(TEXT))
    all_linked = F.coalesce(F.flatten(F.transform("credentials", lambda c: c["parts"])), F.array().cast(f"array<struct<{kind}>>"))
    weak = F.array_sort(F.filter(all_linked, lambda p: p["kind"] >= KINDS.index(WEAK[0])))
    return out.select("doc_id", "base", weak.alias("linked"), F.coalesce("credentials", F.array().cast(f"array<struct<scope:int,parts:array<struct<{kind}>>>>")).alias("credentials"))


@query("op4_secret_scan")
def op4_secret_scan(spark, sf_dir):
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    together = F.array_join(F.transform("credentials", lambda c: F.replace(_spans(c["parts"]), F.lit(","), F.lit("+"))), ",")
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(_spans(F.col("base")), 256).alias("base_sha256"), _spans(F.array_sort(F.concat("base", "linked"))).alias("spans"), together.alias("credentials"))
