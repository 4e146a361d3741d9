"""Vector codes by parts, learned with anchors-hierarchy metric trees.

A vector is cut into ``PARTS`` equal consecutive parts; each part position has a codebook
of at most ``ENTRIES`` entries, and a vector's code is the index of the nearest entry of
each part.  Codebooks come from rounds of assignment and averaging in whole numbers.

Rows are dealt into blocks of at most ``BLOCK``.  Each block has one metric tree a part
position, built middle-out: anchors that take over the points nearer to them, furthest
points first, split what a node holds into about its square root of balls; balls whose
union is tightest are merged pairwise up to the node, and large balls are split in turn.
Every ball keeps its centre, radius, count and sum.  The trees are built once and
written to the shared folder.

A round walks down all trees of a block level by level.  A ball inherits its parent's
list of candidate entries and strikes out each entry that another one beats for every
point of the ball: its distance to the centre exceeds the least one by more than twice
the radius.  A ball left with one candidate is wholly owned, and its cached count and
sum go to that entry; only points of leaves that stay contested are compared, with the
candidates left.  Struck-out entries are strictly further away, so ties are decided
among exact distances only, to the lower index.

Sums travel as limbs of 2**40, so a sum over any number of rows is exact; only counts
and sums per (part, entry) go to the driver.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltloom.core.scratch import materialise
from voltloom.llm.base import query, table

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
BLOCK = 2048         # rows whose trees are built together
LEAF = 24            # points that a ball holds without being split
LIMB = 40
HUGE = 1e307
SMALL = 1 << 26      # squared distances of components below it fit 64 bits for up to 2**9 components

_TREE = ("pivot", "radius", "sums", "counts", "left", "right", "start", "stop", "order")


# -- exact distances --------------------------------------------------------------------------------

def fits(*arrays: np.ndarray) -> bool:
    """Whether 64-bit numbers hold the squared distances between these."""
    return all(a.dtype != object and (a.size == 0 or (-SMALL < a.min() and a.max() < SMALL)) and a.shape[-1] <= 512 for a in arrays)


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances between the rows of ``x`` and of ``y``; Python numbers where 64 bits are too few."""
    if not fits(x, y):
        x, y = x.astype(object), y.astype(object)
    out = np.zeros((len(x), len(y)), x.dtype)
    for k in range(x.shape[1]):
        d = x[:, k][:, None] - y[:, k][None, :]
        out += d * d
    return out


def _root(d: np.ndarray) -> np.ndarray:
    """Square roots as floats; beyond a float's range they stop at HUGE, which strikes out nothing."""
    if d.dtype != object:
        return np.sqrt(d.astype(float))
    roots = [float(v) ** 0.5 if v < 1 << 1000 else float(min(math.isqrt(v), int(HUGE))) for v in d.ravel().tolist()]
    return np.array(roots, float).reshape(d.shape)


# -- trees ------------------------------------------------------------------------------------------

def anchors(points: np.ndarray, wanted: int) -> list[np.ndarray]:
    """Indexes of the points of each anchor; every point belongs to its nearest anchor.

    Each new anchor is the point furthest from its own anchor in the widest ball.  An
    anchor's points lie sorted by falling distance; those nearer than half the way to the
    new anchor cannot change hands and are not looked at.
    """
    owned = [np.arange(len(points))]
    pivots = [points[0]]
    dist = [_root(squared(points, points[:1])[:, 0])]
    order = np.argsort(-dist[0], kind="stable")
    owned[0], dist[0] = owned[0][order], dist[0][order]
    while len(owned) < wanted:
        widest = max(range(len(owned)), key=lambda a: dist[a][0])
        if dist[widest][0] == 0:  # all equal within every ball
            break
        new = points[owned[widest][0]]
        gap = _root(squared(new[None, :], np.stack(pivots))[0])
        won, won_dist = [], []
        for a in range(len(owned)):
            seen = int(np.searchsorted(-dist[a], -gap[a] / 2, side="right"))  # points further than half the gap come first
            if not seen:
                continue
            to_new = _root(squared(points[owned[a][:seen]], new[None, :])[:, 0])
            moves = to_new < dist[a][:seen]
            if moves.any():
                won.append(owned[a][:seen][moves])
                won_dist.append(to_new[moves])
                stay = np.concatenate([~moves, np.ones(len(owned[a]) - seen, bool)])
                owned[a], dist[a] = owned[a][stay], dist[a][stay]
        ids, far = np.concatenate(won), np.concatenate(won_dist)
        order = np.argsort(-far, kind="stable")
        owned.append(ids[order])
        dist.append(far[order])
        pivots.append(new)
    return owned


class _Tree:
    """A metric tree over the rows of ``points`` as flat arrays; node 0 is the root.

    ``order[start:stop]`` are the points of a ball; leaves have no children (-1).
    """

    def __init__(self, points: np.ndarray):
        self.points = points
        self.nodes: list[list] = []   # pivot, radius, sum, count, left, right, start, stop
        self.order: list[int] = []
        if len(points):
            self._split(np.arange(len(points)))

    def _ball(self, idx: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
        x = self.points[idx]
        total = x.sum(axis=0)
        pivot = total // len(idx)
        return pivot, float(_root(squared(x, pivot[None, :])).max()), total

    def _node(self, idx: np.ndarray) -> int:
        pivot, radius, total = self._ball(idx)
        self.nodes.append([pivot, radius, total, len(idx), -1, -1, 0, 0])
        return len(self.nodes) - 1

    def _split(self, idx: np.ndarray) -> int:
        at = self._node(idx)
        groups = anchors(self.points[idx], max(2, int(np.sqrt(len(idx))))) if len(idx) > LEAF else []
        if len(groups) < 2:
            self.nodes[at][6:] = [len(self.order), len(self.order) + len(idx)]
            self.order.extend(idx.tolist())
            return at
        self._place(at, _merged([idx[g] for g in groups], self._ball))
        return at

    def _place(self, at: int, shape) -> None:
        """Lay out a merged pair below node ``at``."""
        start = len(self.order)
        for side, (idx, below) in enumerate(shape):
            if below is None:
                child = self._split(idx)
            else:
                child = self._node(idx)
                self._place(child, below)
            self.nodes[at][4 + side] = child
        self.nodes[at][6:] = [start, len(self.order)]

    def arrays(self) -> dict[str, np.ndarray]:
        n, dims = len(self.nodes), self.points.shape[1]
        kind = self.points.dtype
        cols = list(zip(*self.nodes)) if n else [[]] * 8
        out = {"pivot": np.array(cols[0], kind).reshape(n, dims), "radius": np.array(cols[1], float), "sums": np.array(cols[2], kind).reshape(n, dims)}
        for name, c in zip(("counts", "left", "right", "start", "stop"), cols[3:]):
            out[name] = np.array(c, np.int64)
        out["order"] = np.array(self.order, np.int64)
        return out


def _merged(groups: list[np.ndarray], ball):
    """Pairwise merges of balls, the pair with the tightest union first, up to the last pair.

    The union's radius is estimated from the two balls alone.
    """
    parts = [(g, None) for g in groups]
    made = [ball(g) for g in groups]
    scale = max(max((abs(int(c)) for b in made for c in b[0]), default=1), 1)
    centres = np.array([[int(c) / scale for c in b[0]] for b in made])
    radii, sizes = np.array([b[1] for b in made]) / min(scale, int(HUGE)), np.array([float(len(g)) for g in groups])
    alive = np.ones(len(parts), bool)

    def unions(i):
        gap = np.sqrt(((centres - centres[i]) ** 2).sum(axis=1))
        r = np.maximum((gap + radii + radii[i]) / 2, np.maximum(radii, radii[i]))
        r[~alive] = np.inf
        r[i] = np.inf
        return r

    cost = np.array([unions(i) for i in range(len(parts))])
    while alive.sum() > 2:
        i, j = np.unravel_index(int(np.argmin(cost)), cost.shape)
        parts[i] = (np.concatenate([parts[i][0], parts[j][0]]), (parts[i], parts[j]))
        centres[i] = (centres[i] * sizes[i] + centres[j] * sizes[j]) / (sizes[i] + sizes[j])
        radii[i], sizes[i] = cost[i, j], sizes[i] + sizes[j]
        alive[j] = False
        cost[j, :] = cost[:, j] = np.inf
        cost[i, :] = cost[:, i] = unions(i)
    return tuple(parts[i] for i in np.flatnonzero(alive))


def owners(tree: dict[str, np.ndarray], points: np.ndarray, book: np.ndarray, totals=None) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of ``book`` and exact squared distance for every point of a tree.

    With ``totals`` (an array of sums and one of counts) only these are filled: wholly
    owned balls give their cached sums and no point of theirs is touched.
    """
    n = len(points)
    index, error = np.zeros(n, np.int64), np.zeros(n, object if not fits(points, book) else np.int64)
    if not n:
        return index, error
    level = np.array([0])
    lists = np.ones((1, len(book)), bool)
    leaf = tree["left"] < 0

    def settle(ids, entry):
        if totals is None:
            index[ids] = entry
            d = points[ids].astype(error.dtype) - book[entry].astype(error.dtype)[None, :]
            error[ids] = (d * d).sum(axis=1)

    while len(level):
        d = _root(squared(tree["pivot"][level], book))
        d[~lists] = np.inf
        least = d.min(axis=1)
        reach = 2 * tree["radius"][level] + 1e-9 * (1 + least + tree["radius"][level])  # rounding strikes out nothing
        keep = d <= (least + reach)[:, None]
        whole = keep.sum(axis=1) == 1
        entry = np.argmax(keep, axis=1)
        if totals is None:
            for k in np.flatnonzero(whole):
                v = level[k]
                settle(tree["order"][tree["start"][v]:tree["stop"][v]], entry[k])
        else:
            np.add.at(totals[0], entry[whole], tree["sums"][level[whole]])
            np.add.at(totals[1], entry[whole], tree["counts"][level[whole]])
        for k in np.flatnonzero(~whole & leaf[level]):
            v = level[k]
            ids, cand = tree["order"][tree["start"][v]:tree["stop"][v]], np.flatnonzero(keep[k])
            sq = squared(points[ids], book[cand])
            near = np.argmin(sq, axis=1)  # the first of equal ones
            if totals is None:
                index[ids], error[ids] = cand[near], sq[np.arange(len(ids)), near]
            else:
                np.add.at(totals[0], cand[near], points[ids])
                np.add.at(totals[1], cand[near], 1)
        down = np.flatnonzero(~whole & ~leaf[level])
        level, lists = np.concatenate([tree["left"][level[down]], tree["right"][level[down]]]), np.concatenate([keep[down], keep[down]])
    return index, error


# -- blocks -----------------------------------------------------------------------------------------

def whole_numbers(rows: list[np.ndarray]) -> np.ndarray:
    """floor(SCALE * x); Python numbers where 64 bits are too few."""
    x = np.array(rows, float)
    if x.size == 0 or np.abs(x).max() < 2.0 ** 40:  # sums over a block fit too
        return np.floor(x * SCALE).astype(np.int64)
    return np.array([[int(v * SCALE // 1) if abs(v) < 2.0 ** 50 else int(v) * SCALE for v in r] for r in x.tolist()], object)


def _pack(a: np.ndarray) -> bytes:
    if a.dtype == object:
        return b"o" + ",".join(map(str, a.ravel().tolist())).encode()
    if a.dtype == np.int64 and a.size and -2**31 <= a.min() and a.max() < 2**31:
        return b"i" + a.astype(np.int32).tobytes()
    return (b"q" if a.dtype == np.int64 else b"f") + a.tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    kind, body = raw[:1], raw[1:]
    if kind == b"o":
        return np.array([int(v) for v in body.decode().split(",")] if body else [], object)
    return np.frombuffer(body, {b"i": np.int32, b"q": np.int64, b"f": np.float64}[kind]).astype(np.float64 if kind == b"f" else np.int64)


def _build(dims: int, parts: int):
    width = dims // parts

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, BLOCK):
                some = b.slice(at, BLOCK)
                flat = some.column("embedding").flatten().to_numpy(zero_copy_only=False)
                x = whole_numbers(flat.reshape(some.num_rows, dims))
                trees, points = [], []
                for p in range(parts):
                    mine = x[:, p * width:(p + 1) * width]
                    points.append(_pack(mine))
                    t = _Tree(mine).arrays()
                    trees.append([_pack(t[name]) for name in _TREE])
                yield pa.record_batch({"ids": pa.array([some.column("vec_id").to_pylist()], pa.list_(some.column("vec_id").type)),
                                       "labels": pa.array([some.column("label").to_pylist()], pa.list_(some.column("label").type)),
                                       "points": pa.array([points], pa.list_(pa.binary())), "trees": pa.array([trees], pa.list_(pa.list_(pa.binary())))})

    return build


def _opened(points: bytes, tree: list[bytes], width: int) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    t = {name: _unpack(raw) for name, raw in zip(_TREE, tree)}
    n = len(t["radius"])
    t["pivot"], t["sums"] = t["pivot"].reshape(n, width), t["sums"].reshape(n, width)
    return _unpack(points).reshape(len(t["order"]), width), t


def _round(books: list[np.ndarray], width: int):
    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((len(b), width), object) for b in books]
        counts = [np.zeros(len(b), np.int64) for b in books]
        for b in batches:
            for points, trees in zip(b.column("points"), b.column("trees")):
                for p, (raw, tree) in enumerate(zip(points.as_py(), trees.as_py())):
                    x, t = _opened(raw, tree, width)
                    kind = t["sums"].dtype
                    block = (np.zeros((len(books[p]), width), kind), np.zeros(len(books[p]), np.int64))
                    owners(t, x, books[p], block)
                    sums[p] += block[0].astype(object)
                    counts[p] += block[1]
        out = [(p, e, -1, 0, int(counts[p][e])) for p in range(len(books)) for e in np.flatnonzero(counts[p])]
        for p in range(len(books)):
            for e in np.flatnonzero(counts[p]):
                for k, v in enumerate(sums[p][e]):
                    v, limb = int(v), 0
                    while v:
                        low = ((v + (1 << (LIMB - 1))) & ((1 << LIMB) - 1)) - (1 << (LIMB - 1))
                        out.append((p, e, k, limb, low))
                        v, limb = (v - low) >> LIMB, limb + 1
        cols = list(zip(*out)) if out else [[]] * 5
        yield pa.record_batch({n: pa.array(list(map(int, c)), pa.int64()) for n, c in zip(("part", "entry", "place", "limb", "value"), cols)})

    return add_up


def _learned(blocks: DataFrame, books: list[np.ndarray], width: int) -> list[np.ndarray]:
    """The entries as the floored means of what they own; unused ones stay."""
    rows = blocks.select("points", "trees").mapInArrow(_round(books, width), "part bigint, entry bigint, place bigint, limb bigint, value bigint")
    rows = rows.groupBy("part", "entry", "place", "limb").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    counts, sums = {}, {}
    for p, e, k, limb, v in rows.collect():  # bounded by parts x entries x components
        if k < 0:
            counts[p, e] = int(v)
        else:
            sums[p, e, k] = sums.get((p, e, k), 0) + (int(v) << (LIMB * limb))
    new = [[[int(c) for c in entry] for entry in b] for b in books]
    for (p, e), n in counts.items():
        new[p][e] = [sums.get((p, e, k), 0) // n for k in range(width)]
    return [_book(b, width) for b in new]


def _book(entries: list[list[int]], width: int) -> np.ndarray:
    kind = np.int64 if all(abs(c) < 2**62 for e in entries for c in e) else object
    return np.array(entries, kind).reshape(len(entries), width)


def _codes(books: list[np.ndarray], width: int):
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for own, label, points, trees in zip(b.column("ids"), b.column("labels"), b.column("points"), b.column("trees")):
                index, error = [], 0
                for p, (raw, tree) in enumerate(zip(points.as_py(), trees.as_py())):
                    x, t = _opened(raw, tree, width)
                    i, e = owners(t, x, books[p])
                    index.append(i)
                    error = error + e.astype(object)
                codes = ["".join(f"{i:02x}" for i in c) for c in zip(*(i.tolist() for i in index))]
                yield pa.record_batch({"vec_id": own.values, "label": label.values, "code": pa.array(codes, pa.string()),
                                       "error": pa.array([e if e < 2**63 else None for e in map(int, error)], pa.int64())})

    return code


def kept_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id, label, embedding`` of the rows whose vector has neither null nor non-finite components."""
    x = F.col("embedding")
    sound = x.isNotNull() & F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    return vectors.where(sound).select("vec_id", "label", x.cast("array<double>").alias("embedding"))


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray]]:
    """(``vec_id, label, code, error`` per kept row, final codebooks); ``vectors`` has (vec_id, label, embedding).

    Rows whose vector is null or holds a null or non-finite component are dropped.  The
    length of the vector with the smallest vec_id holds for the table: rows of another
    length, and all rows if it is no multiple of ``parts``, are dropped too.  Codebooks
    start with the ``entries`` smallest vec_ids (null is the largest; of rows that share
    one the least vector); fewer rows give fewer entries.  Repeated rows count as often
    as they occur.  ``error`` is null where it exceeds a long.  An empty table gives no
    rows and empty codebooks; other columns are not read.
    """
    if entries > 256:
        raise ValueError("a code has two hexadecimal digits a part")
    rows = materialise(kept_vectors(vectors))
    first = rows.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    size = first.orderBy(F.asc_nulls_last("vec_id")).select(F.size("embedding")).first()
    dims = size[0] if size and size[0] % parts == 0 else -1
    rows = rows.where(F.size("embedding") == dims)
    head = rows.groupBy("vec_id").agg(F.min("embedding").alias("embedding")).orderBy(F.asc_nulls_last("vec_id")).limit(entries).collect()
    width = max(dims, 0) // parts
    start = whole_numbers([r["embedding"] for r in head]).reshape(len(head), width * parts)
    books = [_book([[int(c) for c in r] for r in start[:, p * width:(p + 1) * width]], width) for p in range(parts)]

    kinds = {n: rows.schema[n].dataType.simpleString() for n in ("vec_id", "label")}
    form = f"ids array<{kinds['vec_id']}>, labels array<{kinds['label']}>, points array<binary>, trees array<array<binary>>"
    blocks = materialise(rows.mapInArrow(_build(width * parts, parts), form))
    for _ in range(rounds if head else 0):
        books = _learned(blocks, books, width)
    out = blocks.mapInArrow(_codes(books, width), f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error bigint")
    return out, books


def book_digest(books: list[np.ndarray]) -> str:
    text = ",".join(str(int(c)) for b in books for e in b for c in e)
    return hashlib.sha256(text.encode()).hexdigest()


def with_label_errors(codes: DataFrame) -> DataFrame:
    """``codes`` with the errors summed over rows of an equal label, nulls together; null where a sum exceeds a long."""
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    sums = codes.groupBy("label").agg(F.when(F.count("error") == F.count(F.lit(1)), total).alias("_e"))
    sums = sums.select(F.col("label").alias("_label"), F.expr("try_cast(_e AS bigint)").alias("label_error"))
    return codes.join(sums, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")


def _sql() -> str:
    dist = "list_sum(list_transform(list_zip(v.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
    near = "SELECT v.i, v.p, min({{'d': " + dist + ", 'j': c.j}}) n FROM v JOIN c{r} c USING (p) GROUP BY v.i, v.p"
    steps = []
    for r in range(ROUNDS):
        steps.append(f"a{r} AS MATERIALIZED (SELECT i, p, n.j j FROM ({near.format(r=r)}))")
        steps.append(f"m{r} AS (SELECT p, j, list(m ORDER BY k) x FROM (SELECT p, j, k, floor(sum(x[k])::DOUBLE / count(*))::BIGINT m FROM a{r} JOIN v USING (i, p), "
                     f"(SELECT unnest(range(1, (SELECT max(len(x)) FROM v) + 1)) k) GROUP BY p, j, k) GROUP BY p, j)")
        steps.append(f"c{r + 1} AS MATERIALIZED (SELECT c.p, c.j, coalesce(m.x, c.x) x FROM c{r} c LEFT JOIN m{r} m USING (p, j))")
    last = f"f AS MATERIALIZED ({near.format(r=ROUNDS)})"
    return f"""
WITH k AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) e, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) i
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS MATERIALIZED (SELECT i, p, e[p * len(e) // {PARTS} + 1:(p + 1) * len(e) // {PARTS}] x FROM k, (SELECT unnest(range({PARTS})) p)),
s AS (SELECT min(i) i, row_number() OVER (ORDER BY min(i)) - 1 j FROM k GROUP BY vec_id),
c0 AS MATERIALIZED (SELECT v.p, s.j, v.x FROM v JOIN s USING (i) WHERE s.j < {ENTRIES}),
{', '.join(steps)}, {last},
b AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, j)) h FROM c{ROUNDS}),
o AS (SELECT i, string_agg(printf('%02x', n.j::INT), '' ORDER BY p) code, sum(n.d)::BIGINT error FROM f GROUP BY i)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT label_error, h codebooks_sha256 FROM k JOIN o USING (i), b
"""


SQL = _sql()


@query("op12_vector_codes", SQL)
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = compress(table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding"))
    out = with_label_errors(materialise(codes))
    return out.select("vec_id", "code", "error", "label_error", F.lit(book_digest(books)).alias("codebooks_sha256"))
