"""Repair of conversation structure with the cheapest edits.

Rows of a conversation, by turn, are edited until their roles read
``(system? (user assistant)+)?``: a row is kept (K), given the role that fits (R) or
deleted (D), and empty rows are inserted (I).  Blank rows and repeats must go, a row
that breaks off costs extra when it stays.  Of the cheapest edits those whose letters
come first in ASCII are taken.  What a letter does follows from the state (nothing yet,
after a system, user or assistant row), so the letters determine the result.

The dynamic programme has one cost vector over the four states before each row.  Rows
are dealt by a range of (conversation, turn), so one conversation may lie in many
tasks, and cut into blocks of at most ``BLOCK``:

* a conversation of several blocks gets a (min, +) matrix per block; a scan over these
  matrices gives the cost vector behind each block, and the state in front of it once
  every block has been walked from all four;
* within a block the vectors of every sqrt(n)-th row only are stored on the way back;
  walking forward, the stretch up to the next checkpoint is computed again.

A block's rows travel as one byte each; texts are not part of it.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltloom.core.scratch import materialise
from voltloom.llm.base import query, table

BLOCK_BITS = 12      # rows of a block: at most 2**BLOCK_BITS
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 2, 3, 2, 1

START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)            # the state after a fitting role
FAR = 1 << 50
END = (0, 2 * INSERT, INSERT, 0)                # cost of ending in a state, missing rows inserted
SAID = (None, "system", "user", "assistant")
S, U, A, OTHER = range(4)                       # first letters of a role
MUST_GO, BREAKS_OFF = 8, 4
_WHITE = "\x20\x09\x0a\x0b\x0c\x0d"


# -- the programme over one block --------------------------------------------------------------------

def _kept(state: int, letter: int) -> int | None:
    """State after keeping a row, None if its role does not fit."""
    if letter == S:
        return SYSTEM if state == START else None
    if letter == U:
        return None if state == USER else USER
    return ASSISTANT if letter == A and state == USER else None


_KEPT = [[_kept(s, c) for c in range(4)] for s in range(4)]


def step_back(code: int, after) -> list[int]:
    """Costs before a row from the costs after it."""
    if code & MUST_GO:
        v = [DELETE + after[s] for s in range(4)]
    else:
        extra, v = CUT_OFF if code & BREAKS_OFF else 0, []
        for s in range(4):
            c = min(DELETE + after[s], REROLE + extra + after[NEXT[s]])
            to = _KEPT[s][code & 3]
            if to is not None:
                c = min(c, KEEP + extra + after[to])
            v.append(c)
    to_assistant = min(v[USER], INSERT + v[ASSISTANT])
    to_user = INSERT + to_assistant
    return [min(v[START], to_user), min(v[SYSTEM], to_user), to_assistant, min(v[ASSISTANT], INSERT + v[USER])]


def block_matrix(codes: bytes) -> list[list[int]]:
    """``m[j][s]``: the least cost from state ``s`` before the rows to state ``j`` behind them."""
    rows = []
    for j in range(4):
        v = [0 if s == j else FAR for s in range(4)]
        for c in reversed(codes):
            v = step_back(c, v)
        rows.append(v)
    return rows


def checkpoints(codes: bytes, after) -> tuple[int, list]:
    """Cost vectors before every ``gap``-th row, ``gap`` about the square root of the number of rows."""
    gap = max(1, math.isqrt(len(codes)))
    marks = [None] * (-(-len(codes) // gap))
    v = list(after)
    for i in range(len(codes) - 1, -1, -1):
        v = step_back(codes[i], v)
        if i % gap == 0:
            marks[i // gap] = v
    return gap, marks


def walk(codes: bytes, after, state: int, last: bool, kept=None) -> tuple[list[str], int]:
    """Letters per row (inserts in front of it first) and the state behind the rows.

    Of the cheapest the ASCII-least: at each step the least letter that still leads to
    the least cost.  The last block's last row also carries the inserts behind it.
    ``kept`` are the checkpoints, if known.
    """
    gap, marks = kept or checkpoints(codes, after)
    out = []
    for m in range(len(marks)):
        some = codes[m * gap:(m + 1) * gap]
        vectors = [marks[m + 1] if m + 1 < len(marks) else list(after)]
        for c in reversed(some):
            vectors.append(step_back(c, vectors[-1]))
        vectors.reverse()
        for c, here, then in zip(some, vectors, vectors[1:]):
            letters = ""
            while True:
                if DELETE + then[state] == here[state]:
                    letters += "D"
                    break
                if INSERT + here[NEXT[state]] == here[state]:
                    letters += "I"
                    state = NEXT[state]
                    continue
                to = _KEPT[state][c & 3]
                extra = CUT_OFF if c & BREAKS_OFF else 0
                if to is not None and KEEP + extra + then[to] == here[state]:
                    letters, state = letters + "K", to
                else:
                    letters, state = letters + "R", NEXT[state]
                break
            out.append(letters)
    if last and out:
        while END[state]:
            out[-1] += "I"
            state = NEXT[state]
    return out, state


def spelled(letters: list[str], codes: bytes, state: int) -> list[list[dict]]:
    """Per row its edits with the role that an inserted or rerolled row gets."""
    out = []
    for word, c in zip(letters, codes):
        edits = []
        for e in word:
            role = None
            if e in "IR":
                state = NEXT[state]
                role = SAID[state]
            elif e == "K":
                state = _KEPT[state][c & 3]
            edits.append({"edit": e, "role": role})
        out.append(edits)
    return out


# -- Spark --------------------------------------------------------------------------------------------

def _letter(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first == "s", S).when(first == "u", U).when(first == "a", A).otherwise(OTHER)


def numbered_rows(rows: DataFrame) -> DataFrame:
    """Rows in order with their faults: ``conv_id, conv, pos, turn, role, text, fault, code``, written to the shared folder.

    ``pos`` rises with (turn, role, text) within a conversation, ``conv`` is its id as
    text (null: one space).  The first fault of a row counts: blank, duplicate (role and
    text stand in an earlier row of the conversation), truncated.
    """
    text = {c: F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text")}
    base = rows.select("conv_id", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")).alias("conv"), "turn", text["role"].alias("role"), text["text"].alias("text"))
    said = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")))
    base = materialise(base.withColumns({"said": said, "tie": F.monotonically_increasing_id()}))
    at = F.struct("turn", "tie")
    again = base.groupBy("conv", "said").agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("conv", "said", "first")
    flagged = base.join(again, ["conv", "said"], "left").withColumn("repeat", F.col("first").isNotNull() & (at != F.col("first")))

    order = ["conv", F.asc_nulls_first("turn"), "role", "text", "tie"]  # rows that tie up to the last are equal
    dealt = flagged.repartitionByRange(*order).sortWithinPartitions(*order)
    end = F.right(F.rtrim(F.col("text"), F.lit(_WHITE)), F.lit(1))
    fault = F.when(end == "", "blank").when(F.col("repeat"), "duplicate").when(~end.isin(".", "!", "?"), "truncated")
    code = _letter(F.col("role")) + F.when(F.col("fault").isin("blank", "duplicate"), MUST_GO).when(F.col("fault") == "truncated", BREAKS_OFF).otherwise(0)
    out = dealt.withColumn("fault", fault).withColumn("code", code.cast("int")).withColumn("pos", F.monotonically_increasing_id())
    return materialise(out.select("conv_id", "conv", "pos", "turn", "role", "text", "fault", "code"))


def _blocks(numbered: DataFrame) -> DataFrame:
    """``conv, block, rows`` with the (pos, code) of at most 2**BLOCK_BITS neighbouring rows of one conversation."""
    cut = numbered.select("conv", F.shiftright("pos", BLOCK_BITS).alias("block"), F.struct("pos", "code").alias("r"))
    return cut.groupBy("conv", "block").agg(F.array_sort(F.collect_list("r")).alias("rows"))


def _matrices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        m = [sum(block_matrix(bytes(r["code"] for r in rows)), []) for rows in b["rows"]]
        yield pd.DataFrame({"conv": b["conv"], "block": b["block"], "matrix": m})


def _behind(blocks: pd.DataFrame) -> pd.DataFrame:
    """Cost vector behind every block of one conversation, from the last block's to the first's."""
    blocks = blocks.sort_values("block", ascending=False, ignore_index=True)
    v, out = list(END), []
    for m in blocks["matrix"]:
        out.append(v)
        v = [min(int(m[4 * j + s]) + v[j] for j in range(4)) for s in range(4)]
    return pd.DataFrame({"conv": blocks["conv"], "block": blocks["block"], "after": out, "last": [i == 0 for i in range(len(out))]})


def _walks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Every block walked from each state it may start in."""
    for b in batches:
        out = []
        for conv, block, rows, after, last, states in zip(b["conv"], b["block"], b["rows"], b["after"], b["last"], b["states"]):
            codes, after = bytes(r["code"] for r in rows), [int(c) for c in after]
            kept = checkpoints(codes, after)
            for s in states:
                letters, state = walk(codes, after, int(s), bool(last), kept)
                edits = spelled(letters, codes, int(s))
                out.append((conv, block, int(s), state, int(kept[1][0][s]), [{"pos": r["pos"], "edits": e} for r, e in zip(rows, edits)]))
        yield pd.DataFrame(out, columns=["conv", "block", "state", "to", "cost", "edits"])


def _entered(blocks: pd.DataFrame) -> pd.DataFrame:
    """The state in front of every block of one conversation."""
    state, out = START, []
    for block, to in sorted(zip(blocks["block"], blocks["to"])):
        out.append((blocks["conv"].iloc[0], block, state))
        state = int(to[state])
    return pd.DataFrame(out, columns=["conv", "block", "state"])


def edits(numbered: DataFrame) -> DataFrame:
    """``conv, block, cost, edits``: per block (pos, its edits in order); ``cost`` is that from the block on to the end."""
    blocks = materialise(_blocks(numbered))
    several = blocks.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("conv")
    parted = materialise(blocks.join(several, "conv", "left_semi"))
    # one row a block of a conversation that has more than one
    behind = parted.mapInPandas(_matrices, "conv string, block bigint, matrix array<bigint>").groupBy("conv").applyInPandas(_behind, "conv string, block bigint, after array<bigint>, last boolean")
    whole = blocks.join(several, "conv", "left_anti").select("conv", "block", "rows", F.array(*[F.lit(c).cast("bigint") for c in END]).alias("after"), F.lit(True).alias("last"), F.array(F.lit(START)).alias("states"))
    cut = parted.join(behind, ["conv", "block"]).select("conv", "block", "rows", "after", "last", F.array(*[F.lit(s) for s in range(4)]).alias("states"))
    form = "conv string, block bigint, state int, to int, cost bigint, edits array<struct<pos:bigint,edits:array<struct<edit:string,role:string>>>>"
    walked = materialise(whole.unionByName(cut).mapInPandas(_walks, form))
    ways = walked.join(several, "conv", "left_semi").groupBy("conv", "block").agg(F.array_sort(F.collect_list(F.struct("state", "to"))).alias("w"))
    entered = ways.select("conv", "block", F.col("w.to").alias("to")).groupBy("conv").applyInPandas(_entered, "conv string, block bigint, state int")
    chosen = walked.join(several, "conv", "left_anti").unionByName(walked.join(entered, ["conv", "block", "state"], "left_semi"))
    return chosen.select("conv", "block", "cost", "edits")


def lines(numbered: DataFrame, found: DataFrame) -> DataFrame:
    """``conv, pos, at, edit, role, text``: one row an edit, in order of (pos, at) within a conversation.

    Deleted rows are among them (edit D); the others are the repaired conversation.
    """
    each = found.select(F.explode("edits").alias("e")).select(F.col("e.pos").alias("pos"), F.col("e.edits").alias("edits"))
    rows = numbered.select("conv", "pos", "role", "text").join(each, "pos")
    rows = rows.select("conv", "pos", F.col("role").alias("_r"), F.col("text").alias("_t"), F.posexplode("edits").alias("at", "e"))
    return rows.select("conv", "pos", "at", F.col("e.edit").alias("edit"), F.coalesce("e.role", "_r").alias("role"), F.when(F.col("e.edit") == "I", "").otherwise(F.col("_t")).alias("text"))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audit and hash of conversations that arrive in order, one after the other."""
    conv, audit, text, begun = None, [], None, False

    def closed():
        return pa.record_batch({"conv": pa.array([conv]), "audit": pa.array(["".join(audit)]), "repaired_sha256": pa.array([text.hexdigest()])})

    for b in batches:
        for c, e, role, said in zip(*(b.column(n).to_pylist() for n in ("conv", "edit", "role", "text"))):
            if text is None or c != conv:
                if text is not None:
                    yield closed()
                conv, audit, text, begun = c, [], hashlib.sha256(), False
            audit.append(e)
            if e != "D":
                text.update((("\n" if begun else "") + f"{role}:{said}").encode("utf-8", "surrogatepass"))
                begun = True
    if text is not None:
        yield closed()


def _pairs(numbered: DataFrame) -> DataFrame:
    """``conv, illegal``: neighbouring rows whose roles may not follow each other, counted per block and across blocks."""
    b = _blocks(numbered).select("conv", "block", F.transform("rows", lambda r: r["code"].bitwiseAND(F.lit(3))).alias("k"))

    def wrong(x: Column, y: Column) -> Column:
        return ~(((y == U) & x.isin(S, A)) | ((x == U) & (y == A)))

    inner = F.size(F.filter(F.arrays_zip(F.expr("slice(k, 1, size(k) - 1)").alias("x"), F.expr("slice(k, 2, size(k) - 1)").alias("y")), lambda p: wrong(p["x"], p["y"])))
    ends = F.struct("block", F.element_at("k", 1).alias("first"), F.element_at("k", -1).alias("final"))
    g = b.select("conv", inner.alias("n"), ends.alias("e")).groupBy("conv").agg(F.sum("n").alias("n"), F.array_sort(F.collect_list("e")).alias("e"))
    across = F.size(F.filter(F.arrays_zip(F.expr("slice(e, 1, size(e) - 1)").alias("x"), F.expr("slice(e, 2, size(e) - 1)").alias("y")), lambda p: wrong(p["x"]["final"], p["y"]["first"])))
    return g.select("conv", (F.col("n") + across).cast("long").alias("illegal"))


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(``conv_id, gaps, blank, duplicate, truncated, illegal, cost`` per conversation, the ``lines`` of all).

    ``rows`` has (conv_id, turn, role, text); other columns are not read.  Null roles and
    texts are one space, so such rows are blank or fit nowhere; rows of a null conv_id
    are one conversation; a null turn comes first and does not count in the gaps; rows
    of one turn are ordered by role and text.  Repeated rows are duplicates.  Roles go by
    their first letter, so a kept row keeps its role as it is; an empty role fits nowhere.  A text of any length is
    one value.  An empty table gives empty results.
    """
    n = numbered_rows(rows)
    found = materialise(edits(n))
    distinct = F.count_distinct("turn")
    counts = n.groupBy("conv").agg(F.first("conv_id").alias("conv_id"), F.coalesce(F.max("turn") - F.min("turn") + 1 - distinct, F.lit(0)).cast("long").alias("gaps"),
                                   *[F.count_if(F.coalesce(F.col("fault") == f, F.lit(False))).alias(f) for f in ("blank", "duplicate", "truncated")])
    first = found.groupBy("conv").agg(F.min_by("cost", "block").alias("cost"))
    return counts.join(_pairs(n), "conv").join(first, "conv"), lines(n, found)


def damage(rows: DataFrame) -> DataFrame:
    """Conversations with the faults of ``crc32(conv_id:turn) % 20``: dropped, emptied, cut, repeated and rerolled rows."""
    def text(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    d = rows.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    said = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return d.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), said.alias("text"), copies.alias("_n")).drop("_n")


# -- SQL ----------------------------------------------------------------------------------------------

def _plus(x: str, n: int | str, letter: str) -> str:
    """A path (nine digits of cost, then letters) with one more edit; '~' is no path."""
    return f"(CASE WHEN {x} = '~' THEN '~' ELSE lpad((substr({x}, 1, 9)::INT + {n})::VARCHAR, 9, '0') || substr({x}, 10) || '{letter}' END)"


def _sql() -> str:
    f = ["p[1]", "p[2]", "p[3]", "p[4]"]
    user = f"least({f[2]}, {_plus(f'least({f[0]}, {f[1]}, {f[3]})', INSERT, 'I')})"
    grown = f"[{f[0]}, {f[1]}, {user}, {f[3]}]"
    grown2 = f"[{f[0]}, {f[1]}, {f[2]}, least({f[3]}, {_plus(f[2], INSERT, 'I')})]"
    ready, cut = f"least({f[0]}, {f[1]}, {f[3]})", "(r.c // 4) % 2"

    def kept(x, k):
        return f"(CASE WHEN r.c % 4 = {k} THEN {_plus(x, cut, 'K')} ELSE '~' END)"

    gone = [_plus(x, DELETE, "D") for x in f]
    stay = f"[{gone[0]}, least({gone[1]}, {kept(f[0], S)}), least({gone[2]}, {kept(ready, U)}, {_plus(ready, f'{REROLE} + {cut}', 'R')}), least({gone[3]}, {kept(f[2], A)}, {_plus(f[2], f'{REROLE} + {cut}', 'R')})]"
    use = f"CASE WHEN r.o = 0 THEN {grown} WHEN r.o = 1 THEN {grown2} WHEN r.c >= {MUST_GO} THEN [{', '.join(gone)}] ELSE {stay} END"
    nxt = "(CASE WHEN a.s = 2 THEN 3 ELSE 2 END)"
    letter = "(CASE substr(q[a.i + 1].role, 1, 1) WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END)"
    said = "(CASE WHEN a.s = 2 THEN 'assistant:' ELSE 'user:' END)"
    return f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, ' ') role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') k FROM conversations),
h AS (SELECT *, xor(list_reduce(list_transform(range(1, len(k) + 1), lambda i: unicode(k[i])::BIGINT),
  lambda x, y: list_reduce(range(8), lambda z, i: xor(z >> 1, CASE WHEN z % 2 = 1 THEN 3988292384 ELSE 0 END), xor(x, y)), 4294967295::BIGINT), 4294967295::BIGINT) % 20 d FROM c),
r AS MATERIALIZED (SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role, CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, n
  FROM h, LATERAL (SELECT unnest(range(CASE WHEN d = 3 THEN 2 ELSE 1 END)) n) WHERE d <> 0),
o AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) i, right(regexp_replace(text, '[\\x20\\x09-\\x0D]+$', ''), 1) z FROM r),
f AS MATERIALIZED (SELECT conv_id, turn, role, text, i, CASE WHEN z = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd' WHEN z NOT IN ('.', '!', '?') THEN 't' ELSE '' END e,
  CASE substr(role, 1, 1) WHEN 's' THEN {S} WHEN 'u' THEN {U} WHEN 'a' THEN {A} ELSE {OTHER} END l, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) || substr(role, 1, 1) t FROM o),
g AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) gaps, count(*) FILTER (e = 'b') blank, count(*) FILTER (e = 'd') duplicate, count(*) FILTER (e = 't') truncated,
  count(*) FILTER (t NOT IN ('su', 'ua', 'au')) illegal, list({{'role': role, 'text': text}} ORDER BY i) q,
  list({{'c': l + CASE WHEN e IN ('b', 'd') THEN {MUST_GO} WHEN e = 't' THEN {BREAKS_OFF} ELSE 0 END}} ORDER BY i) w FROM f GROUP BY conv_id),
x AS (SELECT *, list_concat(flatten(list_transform(w, lambda y: [{{'o': 0, 'c': 0}}, {{'o': 1, 'c': 0}}, {{'o': 2, 'c': y.c}}])), [{{'o': 0, 'c': 0}}, {{'o': 1, 'c': 0}}]) v FROM g),
y AS (SELECT *, list_reduce(v, lambda p, r: {use}, ['000000000', '~', '~', '~']) p FROM x),
z AS (SELECT *, least(p[1], p[4]) b FROM y),
u AS (SELECT *, list_reduce(list_transform(string_split(substr(b, 10), ''), lambda y: {{'i': 0::BIGINT, 's': 0, 'e': y, 't': ''}}), lambda a, l: CASE l.e
  WHEN 'D' THEN {{'i': a.i + 1, 's': a.s, 'e': '', 't': a.t}}
  WHEN 'I' THEN {{'i': a.i, 's': {nxt}, 'e': '', 't': a.t || chr(10) || {said}}}
  WHEN 'K' THEN {{'i': a.i + 1, 's': {letter}, 'e': '', 't': a.t || chr(10) || q[a.i + 1].role || ':' || q[a.i + 1].text}}
  WHEN 'R' THEN {{'i': a.i + 1, 's': {nxt}, 'e': '', 't': a.t || chr(10) || {said} || q[a.i + 1].text}}
  ELSE a END, {{'i': 0::BIGINT, 's': 0, 'e': '', 't': ''}}).t t FROM z)
SELECT k.conv_id, coalesce(gaps, 0)::BIGINT gaps, coalesce(blank, 0) blank, coalesce(duplicate, 0) duplicate, coalesce(truncated, 0) truncated, coalesce(illegal, 0) illegal,
  coalesce(substr(b, 1, 9)::BIGINT, 0) AS cost, coalesce(substr(b, 10), '') AS audit, sha256(coalesce(substr(t, 2), '')) repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) k LEFT JOIN u ON k.conv_id IS NOT DISTINCT FROM u.conv_id
"""


SQL = _sql()


@query("op13_turn_repair", SQL)
def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return audited(turns, damage(turns))


def audited(original: DataFrame, rows: DataFrame) -> DataFrame:
    """One row per conv_id of ``original``: faults, cost, letters and hash of the repaired ``rows``.

    A hash runs over a whole conversation, so this digest streams one through one task
    (a row at a time); ``repair`` itself does not.
    """
    counts, every = repair(rows)
    by = ["conv", "pos", "at"]
    streamed = every.repartition("conv").sortWithinPartitions(*by).select("conv", "edit", "role", "text")
    digest = streamed.mapInArrow(_digest, "conv string, audit string, repaired_sha256 string")
    found = counts.drop("conv_id").join(digest, "conv")
    every_id = original.select("conv_id", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")).alias("conv")).distinct()
    out = every_id.join(found, "conv", "left")
    zero = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
