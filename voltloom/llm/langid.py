"""Language identification of mixed-language texts.

Training counts, per language, letters-only words and the character trigrams of those
words in a bounded sample of labelled documents, and the scripts its words use.  To
predict, the script ranges of a word narrow the languages it may be in, each candidate
scores the word, and Viterbi with a penalty for every switch labels the words; runs of
one label are the spans.  A text's language is the one with most letters.

Counting is a Spark job; the tables it ends in are small and bounded (``TOP_GRAMS`` a
language), so they travel to the tasks in the function.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voltloom.core.scratch import materialise
from voltloom.llm.base import query, table, words

SAMPLE = 3000        # about so many training documents per language
TOP_GRAMS = 8000     # trigrams kept per language
TOP_WORDS = 4000     # whole words kept per language
MAX_LANGUAGES = 400
SWITCH = 9.0         # cost of a change of language between two words, in nats
WORD_GAIN = 0.5      # share of the whole-word score in the score of a known word
CACHE_WORDS = 200_000
UNKNOWN = "und"

# First and last code point of the blocks of common scripts.
SCRIPTS = {
    "latin": ((0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0x24F), (0x1E00, 0x1EFF)),
    "greek": ((0x370, 0x3FF), (0x1F00, 0x1FFF)),
    "cyrillic": ((0x400, 0x52F),),
    "armenian": ((0x530, 0x58F),),
    "hebrew": ((0x590, 0x5FF),),
    "arabic": ((0x600, 0x6FF), (0x750, 0x77F)),
    "devanagari": ((0x900, 0x97F),),
    "bengali": ((0x980, 0x9FF),),
    "thai": ((0xE00, 0xE7F),),
    "georgian": ((0x10A0, 0x10FF),),
    "hangul": ((0x1100, 0x11FF), (0xAC00, 0xD7AF)),
    "kana": ((0x3040, 0x30FF),),
    "han": ((0x3400, 0x4DBF), (0x4E00, 0x9FFF)),
}


class _Scripts(dict):
    """First letter to script."""

    def __missing__(self, c: str) -> str:
        p = ord(c)
        self[c] = next((name for name, ranges in SCRIPTS.items() if any(a <= p <= b for a, b in ranges)), "other")
        return self[c]


def letters(word: str) -> str:
    return word.lower() if word.isalpha() else "".join(filter(str.isalpha, word)).lower()


class Model:
    """Languages with their trigram and word log-probabilities and their scripts."""

    def __init__(self, languages: list[str], grams: dict, whole: dict, gram_floor: list[float], scripts: dict):
        n = max(len(languages), 1)
        self.languages, self.scripts = languages, scripts
        floor = np.array(gram_floor) if languages else np.zeros(1)
        self.gram_at = {g: k for k, g in enumerate(grams, 1)}  # row 0: a trigram never seen
        self.gram_rows = np.vstack([floor, *(self._row(p, floor) for p in grams.values())]).astype(np.float32)
        rare = np.full(n, math.log(1e-6))
        self.word_at = {w: k for k, w in enumerate(whole, 1)}  # row 0: no whole-word score
        rows = [self._row(p, rare) for p in whole.values()]
        self.word_rows = np.vstack([np.zeros(n), *(WORD_GAIN * (r - r.max()) for r in rows)]).astype(np.float32)

    @staticmethod
    def _row(known: dict[int, float], rest: np.ndarray) -> np.ndarray:
        row = rest.copy()
        for k, p in known.items():
            row[k] = p
        return row

    def scores(self, found: list[str]) -> np.ndarray:
        """(words x languages) scores of non-empty letters-only words."""
        at, first, n = [], [], 0
        for w in found:
            p = f"^{w}$"
            first.append(n)
            at += [self.gram_at.get(p[i:i + 3], 0) for i in range(len(w))]
            n += len(w)
        s = np.add.reduceat(self.gram_rows[at], first, axis=0)
        s -= s.max(axis=1, keepdims=True)
        s += self.word_rows[[self.word_at.get(w, 0) for w in found]]
        script = _Scripts()
        group: dict[str, list[int]] = {}
        for k, w in enumerate(found):
            group.setdefault(script[w[0]], []).append(k)
        for name, rows in group.items():
            if name in self.scripts:
                s[np.ix_(rows, ~self.scripts[name])] = -1e4
        return s


def label_batch(lengths: list[int], scores: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Viterbi over (words x languages) scores of many texts: step t advances every text that has a word t.

    A language falls behind the best by ``switch`` at most, as one may always have
    switched; where it had to, the way back goes to the best one.
    """
    total, n_lang = scores.shape
    order = np.argsort(-np.asarray(lengths), kind="stable")
    size = np.asarray(lengths)[order]
    start = np.concatenate([[0], np.cumsum(lengths)[:-1]])[order] if len(lengths) else np.empty(0, np.int64)
    stay, best = np.empty((total, n_lang), bool), np.empty(total, np.int64)
    v = np.zeros((len(size), n_lang), np.float32)
    live = np.searchsorted(-size, -np.arange(1, (size[0] if len(size) else 0) + 1), side="right")  # texts with a word t
    for t, m in enumerate(live):
        at = start[:m] + t
        w = v[:m]
        top = w.argmax(axis=1)
        limit = (w[np.arange(m), top] - switch)[:, None]
        best[at], stay[at] = top, w >= limit
        v[:m] = np.maximum(w, limit) + scores[at]
    out = np.empty(total, np.int64)
    k = v.argmax(axis=1) if len(size) else np.empty(0, np.int64)
    for t in range(len(live) - 1, -1, -1):
        m = live[t]
        at = start[:m] + t
        out[at] = k[:m]
        k[:m] = np.where(stay[at, k[:m]], k[:m], best[at])
    return out


def train(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """A model of the non-null languages of ``docs`` (doc_id, text, lang).

    About ``sample`` documents a language are drawn by a hash of the id.  More than
    ``MAX_LANGUAGES`` languages raise an error.  Without any labelled text the model
    has no language and every prediction is ``und``.
    """
    d = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["count"] for r in d.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not sizes:
        return Model([], {}, {}, [], {})
    share = F.coalesce(*[F.when(F.col("lang") == k, F.lit(min(1.0, sample / n))) for k, n in sizes.items()])
    drawn = d.where(F.pmod(F.xxhash64(F.col("doc_id"), F.lit("langid")), F.lit(1_000_000)) < share * 1_000_000)
    w = drawn.select("lang", F.explode(words(F.lower("text"))).alias("w")).select("lang", F.regexp_replace("w", r"\P{L}+", "").alias("w")).where("w <> ''")
    w = materialise(w.groupBy("lang", "w").agg(F.count(F.lit(1)).alias("n")))
    padded = F.concat(F.lit("^"), F.col("w"), F.lit("$"))
    g = w.select("lang", "n", F.explode(F.transform(F.sequence(F.lit(1), F.length(padded) - 2), lambda i: F.substring(padded, i, F.lit(3)))).alias("g"))
    g = g.groupBy("lang", "g").agg(F.sum("n").alias("n"))
    languages = sorted(sizes)
    index = {k: i for i, k in enumerate(languages)}

    def most(counts: DataFrame, key: str, top: int) -> tuple[dict, dict]:
        total = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
        rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), key))  # the limit is applied before the shuffle too
        found: dict[str, dict[int, float]] = {}
        for r in counts.withColumn("_r", rank).where(F.col("_r") <= top).collect():
            found.setdefault(r[key], {})[index[r["lang"]]] = math.log(r["n"] / total[r["lang"]])
        return found, total

    grams, gram_totals = most(materialise(g), "g", TOP_GRAMS)
    whole, _ = most(w, "w", TOP_WORDS)
    floor = [math.log(0.3 / gram_totals.get(k, 1)) for k in languages]
    letters_by_script = F.coalesce(*[F.when(F.col("w").rlike("^[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in r) + "]"), F.lit(s)) for s, r in SCRIPTS.items()], F.lit("other"))
    used = w.groupBy("lang", letters_by_script.alias("script")).agg(F.sum("n").alias("n")).collect()
    total = {k: sum(r["n"] for r in used if r["lang"] == k) for k in languages}
    scripts: dict[str, np.ndarray] = {}
    for r in used:
        if r["n"] >= 0.001 * total[r["lang"]]:
            scripts.setdefault(r["script"], np.zeros(len(languages), bool))[index[r["lang"]]] = True
    return Model(languages, grams, whole, floor, scripts)


class _Chunks:
    """Chunk to its row in a growing score table; chunks with the same letters share a row, -1 has none."""

    def __init__(self, model: Model):
        self.model = model
        self.row_of: dict[str, int] = {}
        self.letters_at: dict[str, int] = {}
        self.rows, self.sizes = np.empty((0, max(len(model.languages), 1)), np.float32), np.empty(0, np.int64)

    def learn(self, chunks: set[str]) -> None:
        new: list[str] = []
        for c in chunks:
            w = letters(c)
            if not w:
                self.row_of[c] = -1
                continue
            k = self.letters_at.get(w)
            if k is None:
                k = self.letters_at[w] = len(self.sizes) + len(new)
                new.append(w)
            self.row_of[c] = k
        if new:
            self.rows = np.vstack([self.rows, self.model.scores(new)])
            self.sizes = np.concatenate([self.sizes, np.fromiter(map(len, new), np.int64, len(new))])


_CHUNK = re.compile(r"[^\x20\x09-\x0D]+")
BATCH_CHARS = 5_000_000


def _labelled(texts: list[str], chunks: _Chunks) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(labels, letters) of the words with a letter, text by text."""
    cut = [_CHUNK.findall(t) for t in texts]
    chunks.learn({c for found in cut for c in found if c not in chunks.row_of})
    ids = [np.fromiter(map(chunks.row_of.__getitem__, found), np.int64, len(found)) for found in cut]
    ids = [i[i >= 0] for i in ids]
    flat = np.concatenate(ids) if ids else np.empty(0, np.int64)
    sizes = chunks.sizes
    labels = label_batch([len(i) for i in ids], chunks.rows[flat]) if len(flat) else flat
    at = 0
    for i in ids:
        yield labels[at:at + len(i)], sizes[i] if len(i) else i
        at += len(i)


def predictor(model: Model, spans: bool = False):
    names = model.languages

    def judge(label: np.ndarray, size: np.ndarray) -> tuple[str, float]:
        if not len(label) or not names:
            return UNKNOWN, 0.0
        share = np.bincount(label, weights=size, minlength=len(names))
        k = int(share.argmax())
        return names[k], float(share[k] / share.sum())

    def groups(column) -> Iterator[list[str]]:
        held, n = [], 0
        for t in column:
            held.append(t.as_py() or "")
            n += len(held[-1])
            if n * max(len(names), 4) >= 4 * BATCH_CHARS:
                yield held
                held, n = [], 0
        if held:
            yield held

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = _Chunks(model)
        for b in batches:
            lang, score, runs = [], [], []
            for texts in groups(b.column("text")):
                if len(chunks.row_of) > CACHE_WORDS:
                    chunks = _Chunks(model)
                for label, size in _labelled(texts, chunks):
                    k, s = judge(label, size)
                    lang.append(k)
                    score.append(s)
                    if spans:
                        cut = np.flatnonzero(np.diff(label)) + 1
                        edges = [0, *cut.tolist(), len(label)]
                        runs.append([{"first": a, "last": z - 1, "lang": names[label[a]]} for a, z in zip(edges, edges[1:], strict=False) if z > a])
            cols = {"doc_id": b.column("doc_id"), "lang_pred": pa.array(lang, pa.string()), "score": pa.array(score, pa.float64())}
            if spans:
                cols["spans"] = pa.array(runs, pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("lang", pa.string())])))
            yield pa.record_batch(cols)

    return predict


def predict(docs: DataFrame, model: Model, spans: bool = False) -> DataFrame:
    """``doc_id, lang_pred, score`` and, on request, ``spans`` of (first, last, lang) over the words with a letter.

    Only the text is read.  Null texts, texts without a letter and any text under a
    model without languages are ``und`` with score 0; ``score`` is the share of letters
    in spans of the predicted language.  Repeated rows each get a row.
    """
    schema = "doc_id bigint, lang_pred string, score double" + (", spans array<struct<first:int,last:int,lang:string>>" if spans else "")
    return docs.select("doc_id", "text").mapInArrow(predictor(model, spans), schema)


def fold(doc_id="doc_id"):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4


@query("op9_language_id")
def op9_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train(docs.where(F.coalesce(fold() != 2, F.lit(False))))
    out = predict(docs, model)
    return out.select("doc_id", F.coalesce(fold() == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")
