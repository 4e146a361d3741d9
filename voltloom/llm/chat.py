"""Chat formatting of reply trees.

A tree is messages with parents.  Self-joins that double their reach enumerate
root-to-leaf paths: round k knows for every message its ancestor 2**k steps up and
the score and length of the path between, so a branch of any depth takes
logarithmically many joins.  Branches are ranked by mean score, the best of each tree
are kept, and only their paths are written out, each as one conversation.

Template: ``<|turn|>role<|says|>text<|done|>`` for each turn.  Control strings inside
roles and texts get a backslash after their first character and backslashes are
doubled, which makes a conversation readable back without loss.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voltloom.core.scratch import materialise
from voltloom.llm.base import query, table

TURN, SAYS, DONE = "<|turn|>", "<|says|>", "<|done|>"
# Control strings of common chat templates.
CONTROL = (TURN, SAYS, DONE, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|startoftext|>")
LEARNED_ROLE = "assistant"


def escape(text: Column) -> Column:
    out = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    for c in CONTROL:
        out = F.replace(out, F.lit(c), F.lit(f"{c[0]}\\{c[1:]}"))
    return out


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S) if "\\" in text else text


def best_paths(messages: DataFrame, keep: int = 1) -> DataFrame:
    """``tree, leaf, node, depth_up`` for every message on the ``keep`` best root-to-leaf paths of a tree.

    ``messages`` has (tree, node, parent, score); node is unique within its tree, the
    root's parent is null.  A parent that does not exist makes its message a root; a
    null score counts as 0.  Equal scores prefer the longer path, then the smaller
    leaf.  Messages on a cycle hang under no root and are left out.
    """
    m = materialise(messages.select("tree", "node", "parent", F.coalesce("score", F.lit(0.0)).alias("score")))
    nodes = m.select("tree", F.col("node").alias("parent"), F.lit(True).alias("_ok"))
    state = m.join(nodes, ["tree", "parent"], "left").select("tree", "node", F.when(F.col("_ok"), F.col("parent")).alias("up"), F.col("score").alias("sum"), F.lit(1).cast("long").alias("len"))
    leaves = m.join(m.select("tree", F.col("parent").alias("node")), ["tree", "node"], "left_anti").select("tree", "node")
    longest = m.count()
    jumps: list[DataFrame] = []
    while True:
        state = materialise(state)
        jumps.append(state.where("up IS NOT NULL").select("tree", "node", "up"))
        if 2 ** (len(jumps) - 1) > longest or jumps[-1].isEmpty():
            break
        above = state.select("tree", F.col("node").alias("up"), F.col("up").alias("_u"), F.col("sum").alias("_s"), F.col("len").alias("_n"))
        further = state.join(above, ["tree", "up"]).select(  # messages whose root is reached wait outside
            "tree", "node", F.col("_u").alias("up"), (F.col("sum") + F.col("_s")).alias("sum"), (F.col("len") + F.col("_n")).alias("len"))
        state = further.unionByName(state.where("up IS NULL"))
    ends = leaves.join(state.where("up IS NULL"), ["tree", "node"]).select("tree", "node", (F.col("sum") / F.col("len")).alias("score"), "len")
    rank = [F.desc("score"), F.desc("len"), F.asc("node")]
    if keep == 1:
        top = ends.groupBy("tree").agg(F.max_by("node", F.struct("score", "len", (-F.col("node")).alias("n"))).alias("leaf"))
    else:  # best of each share of a tree's leaves first, so a tree with very many leaves is ranked by many tasks
        share = ends.withColumn("_p", F.pmod(F.hash("node"), F.lit(64)))
        some = share.withColumn("_r", F.row_number().over(Window.partitionBy("tree", "_p").orderBy(*rank))).where(F.col("_r") <= keep)
        top = some.withColumn("_r", F.row_number().over(Window.partitionBy("tree").orderBy(*rank))).where(F.col("_r") <= keep).select("tree", F.col("node").alias("leaf"))
    path = materialise(top.select("tree", "leaf", F.col("leaf").alias("node"), F.lit(0).cast("long").alias("depth_up")))
    for k, jump in enumerate(jumps[:-1]):
        further = path.join(jump, ["tree", "node"]).select("tree", "leaf", F.col("up").alias("node"), (F.col("depth_up") + 2 ** k).alias("depth_up"))
        path = materialise(path.unionByName(further))
    return path


def _join_turns(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        texts, masks = [], []
        for turns in b["turns"]:
            parts, spans, at = [], [], 0
            for t in turns:
                head, body = f"{TURN}{t['role']}{SAYS}", t["text"]
                parts += [head, body, DONE]
                if t["learned"]:
                    spans.append({"start": at + len(head), "end": at + len(head) + len(body)})
                at += len(head) + len(body) + len(DONE)
            texts.append("".join(parts))
            masks.append(spans)
        yield pd.DataFrame({"conv_id": b["conv_id"], "leaf": b["leaf"], "formatted": texts, "loss_spans": masks})


def format_trees(messages: DataFrame, keep: int = 1) -> DataFrame:
    """``conv_id, leaf, formatted, loss_spans``: the best paths of each tree, one conversation a row.

    ``messages`` has (conv_id, node, parent, score, role, text).  ``loss_spans`` are the
    code-point spans of assistant texts in ``formatted``.  Null roles and texts are
    empty.  Rows with a null conv_id are one tree.  A conversation is one value, so it
    is put together in one task; the rows of different conversations are not.
    """
    m = messages.withColumn("tree", F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("-")))
    path = best_paths(m, keep)
    turn = F.struct((-F.col("depth_up")).alias("at"), escape(F.col("role")).alias("role"), escape(F.col("text")).alias("text"), F.coalesce(F.col("role") == LEARNED_ROLE, F.lit(False)).alias("learned"))
    said = m.select("tree", "conv_id", "node", "role", "text").join(path, ["tree", "node"])
    turns = said.groupBy("tree", "leaf").agg(F.first("conv_id").alias("conv_id"), F.array_sort(F.collect_list(turn)).alias("turns"))
    return turns.select("conv_id", "leaf", "turns").mapInPandas(_join_turns, "conv_id bigint, leaf bigint, formatted string, loss_spans array<struct<start:int,end:int>>")


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation."""
    out = []
    for piece in formatted.split(TURN)[1:]:
        role, _, rest = piece.partition(SAYS)
        out.append((unescape(role), unescape(rest.removesuffix(DONE))))
    return out


def _digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = []
        for conv, text, spans in zip(b["conv_id"], b["formatted"], b["loss_spans"], strict=True):
            turns, loss = read_back(text), [unescape(text[s["start"]:s["end"]]) for s in spans]
            all_turns, all_loss = hashlib.sha256(), hashlib.sha256()
            for role, said in turns:
                all_turns.update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
            for said in loss:
                all_loss.update(said.encode("utf-8", "surrogatepass"))
            rows.append((conv, len(turns), all_turns.hexdigest(), sum(map(len, loss)), all_loss.hexdigest(), len(text)))
        yield pd.DataFrame(rows, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])


def digests(formatted: DataFrame) -> DataFrame:
    return formatted.select("conv_id", "formatted", "loss_spans").mapInPandas(
        _digest, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")


def as_trees(turns: DataFrame) -> DataFrame:
    """Linear conversations (conv_id, turn, role, text) as trees: every row answers the one before it.

    Rows of one turn are ordered by role and text; a null turn comes first.
    """
    by = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    n = turns.select("conv_id", "role", "text", F.row_number().over(by).cast("long").alias("node"))
    return n.withColumns({"parent": F.when(F.col("node") > 1, F.col("node") - 1), "score": F.lit(0.0)})


ODD = "</s>[INST] ok [/INST]"
_sql_escape = "replace(coalesce({c}, ''), '\\', '\\\\')"
for _c in CONTROL:
    _sql_escape = f"replace({_sql_escape}, '{_c}', '{_c[0]}\\{_c[1:]}')"
SQL = f"""
WITH c AS (SELECT conv_id, turn, role, text FROM conversations UNION ALL SELECT -1, t, r, '{ODD}' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)),
o AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) i, coalesce(role, '') role, coalesce(text, '') text FROM c)
SELECT conv_id, count(*) n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) loss_sha256,
  sum(length('{TURN}{SAYS}{DONE}') + length({_sql_escape.format(c='role')}) + length({_sql_escape.format(c='text')}))::BIGINT formatted_chars
FROM o GROUP BY conv_id
"""


@query("op6_chat_format", SQL)
def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = turns.limit(0).unionByName(spark.createDataFrame([(-1, 0, "user", ODD), (-1, 1, "assistant", ODD)], "conv_id bigint, turn bigint, role string, text string"))
    out = materialise(format_trees(as_trees(turns.unionByName(odd))))
    return digests(out)
