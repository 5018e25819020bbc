"""Hard negatives of embeddings, by an exact search in a multiway tree with distance ranges.

The tree has two levels of FANOUT split points (farthest-first over a sample of at most SAMPLE rows, those with the smallest hashes of their ids). Every
row goes to the nearest split point of each level, so a leaf is a cell between hyperplanes. For each leaf and each split point of the root and of the leaf's
parent, the least and the greatest distance of the leaf's rows is kept, as are the least and greatest norms of its rows (all over all rows). An anchor looks for
rows with scores in a window, an annulus around it: the triangle inequality over each range bounds the distances, and so the scores, that a leaf can
have, and a leaf whose bounds miss the window is not looked at. Leaves are scored exactly, in blocks of a batch of rows.

Anchors come in chunks of a bounded size (MOST_ANCHORS and MOST_CHUNK_BYTES), each broadcast; the table of rows, sorted by leaf, stays where it is. For a
chunk there are four passes: positives in the anchors' own leaves, which gives each anchor a score that the last of its positives reaches at least;
positives in all leaves from that score on; and the same for negatives, with one window for each positive. A task keeps only the best few rows for
each window, so its memory is bounded by the chunk, and no pair is ever written but those that a task found best.

Scores are integers: products are summed in single or double precision where the largest norm proves them exact there, else in 64-bit integers, else in
integers of any size (results beyond 64 bits are cut to 64 bits).

Defined cases. Rows with a null id, label or vector, or with a null or non-finite component, take no part. Rows that share an id count once, with
the least label and then the least vector. Shorter vectors are read as if zeros followed; an empty one has the score 0 with all. Ties go to the smaller id. Large
groups of equal vectors share a leaf, which may span any number of tasks. An empty table gives an empty result. Extra columns are not read, whatever
their names.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketloom.llm.common import gives_back, shared_path, staged, table

FANOUT, SAMPLE = 16, 4096
MOST_ANCHORS, MOST_CHUNK_BYTES = 16_384, 16 << 20
POSITIVES, NEGATIVES = 5, 3
#: Percent of the positive's score that a negative's score has at least and at most.
LOW, HIGH = 50, 95
#: Scores of one product of anchors and rows, and candidates held before they are cut to the best.
_CELLS, _HELD = 2_000_000, 300_000
_LEAST, _MOST = -(1 << 62), 1 << 62


def quantised(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, label, q): the rows that take part, one for each id, with components floor(256 * x)."""
    v = F.col(f"`{vector}`")
    rows = vectors.select(F.col(f"`{key}`").cast("long").alias("vec_id"), F.col(f"`{label}`").cast("long").alias("label"), v.cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    held = rows.filter(F.isnotnull("vec_id") & F.isnotnull("label") & F.isnotnull("v") & finite).withColumn("q", F.transform("v", lambda x: F.floor(x * 256)))
    return held.groupBy("vec_id").agg(F.min(F.struct("label", "q")).alias("x")).select("vec_id", "x.label", "x.q")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column, padded with zeros to width."""
    flat, ends = column.flatten().to_numpy(), column.offsets.to_numpy()
    sizes = np.diff(ends)
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), dtype=np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of rows of a to rows of b."""
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T), 0)


class Tree:
    """Split points: top (FANOUT at most), and below each of them its own."""

    def __init__(self, sample: np.ndarray):
        x = sample.astype(np.float64)
        self.top = self._chosen(x)
        near = _squares(x, self.top).argmin(1)
        self.below = [self._chosen(x[near == i]) if (near == i).any() else self.top[i : i + 1] for i in range(len(self.top))]
        self.norms: dict[int, tuple[float, float]] = {}
        self.ranges: dict[int, np.ndarray] = {}

    @staticmethod
    def _chosen(x: np.ndarray) -> np.ndarray:
        """Farthest-first points, from the one farthest from the mean on."""
        far = _squares(x, x.mean(0, keepdims=True))[:, 0]
        picked = []
        for _ in range(min(FANOUT, len(x))):
            i = int(far.argmax())
            if picked and far[i] == 0:
                break
            far = np.minimum(far, _squares(x, x[i : i + 1])[:, 0]) if picked else _squares(x, x[i : i + 1])[:, 0]
            picked.append(i)
        return x[picked]

    def leaves(self, x: np.ndarray) -> np.ndarray:
        x = x.astype(np.float64)
        first = _squares(x, self.top).argmin(1)
        second = np.zeros(len(x), dtype=np.int64)
        for i in np.unique(first):
            at = first == i
            second[at] = _squares(x[at], self.below[i]).argmin(1)
        return first * FANOUT + second

    def points(self, leaf: int) -> np.ndarray:
        return np.concatenate([self.top, self.below[leaf // FANOUT]])

    def bounds(self, x: np.ndarray, leaf: int) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest scores that rows of a leaf can have with each row of x."""
        d = np.sqrt(_squares(x, self.points(leaf)))
        near, far = self.ranges[leaf][:, 0], self.ranges[leaf][:, 1]
        least = np.maximum(0, np.maximum(d - far, near - d).max(1))
        most = (d + far).min(1)
        own, (low, high) = (x * x).sum(1), self.norms[leaf]
        slack = 1 + 1e-9 * (own + high)
        return (own + low - most**2) / 2 - slack, (own + high - least**2) / 2 + slack


_LEAVES = "vec_id long, label long, q array<long>, leaf int"
_LEAVES_ARROW = pa.schema([("vec_id", pa.int64()), ("label", pa.int64()), ("q", pa.list_(pa.int64())), ("leaf", pa.int32())])
_RANGES_ARROW = pa.schema([("leaf", pa.int32()), ("point", pa.int32()), ("low", pa.float64()), ("high", pa.float64())])


@gives_back
def _to_leaves(batches, tree, width: int):
    for batch in batches:
        leaf = tree.value.leaves(_matrix(batch.column(2), width)) if batch.num_rows else []
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf, pa.int32())], schema=_LEAVES_ARROW)


def _segments(leaves: np.ndarray):
    """(leaf, slice) of stretches of equal leaves."""
    cuts = np.flatnonzero(np.diff(leaves)) + 1
    for a, b in zip([0, *cuts], [*cuts, len(leaves)]):
        if b > a:
            yield int(leaves[a]), slice(int(a), int(b))


@gives_back
def _ranges(batches, tree, width: int):
    seen: dict[int, np.ndarray] = {}
    for batch in batches:
        x = _matrix(batch.column(0), width).astype(np.float64)
        for leaf, part in _segments(batch.column(1).to_numpy()):
            d = np.sqrt(_squares(x[part], tree.value.points(leaf)))
            d = np.column_stack([d, (x[part] ** 2).sum(1)])
            own = np.stack([d.min(0), d.max(0)], axis=1)
            if leaf in seen:
                own = np.stack([np.minimum(own[:, 0], seen[leaf][:, 0]), np.maximum(own[:, 1], seen[leaf][:, 1])], axis=1)
            seen[leaf] = own
    rows = [(leaf, i, *map(float, r)) for leaf, own in seen.items() for i, r in enumerate(own)]
    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * 4, _RANGES_ARROW)], schema=_RANGES_ARROW)


def indexed(rows: DataFrame, width: int) -> tuple[DataFrame, Tree]:
    """(rows with their leaf, sorted by leaf; the tree with ranges of all rows). rows: vec_id, label, q, staged and not empty."""
    context = rows.sparkSession.sparkContext
    drawn = rows.orderBy(F.xxhash64("vec_id"), "vec_id").select("q").limit(SAMPLE).toArrow().column(0).combine_chunks()
    tree = Tree(_matrix(drawn, width))
    sent = context.broadcast(tree)
    dealt = rows.mapInArrow(partial(_to_leaves, tree=sent, width=width), _LEAVES).repartitionByRange("leaf", F.xxhash64("vec_id")).sortWithinPartitions("leaf")
    held = staged(dealt, "negatives-leaves")
    found = held.select("q", "leaf").mapInArrow(partial(_ranges, tree=sent, width=width), "leaf int, point int, low double, high double")
    for r in found.groupBy("leaf", "point").agg(F.min("low").alias("low"), F.max("high").alias("high")).sort("leaf", "point").collect():  # 33 rows a leaf
        tree.ranges.setdefault(r.leaf, []).append((r.low, r.high))
    for leaf, own in tree.ranges.items():
        tree.norms[leaf], tree.ranges[leaf] = own[-1], np.array(own[:-1])
    return held, tree


class Chunk:
    """Anchors of one broadcast, with windows of scores for each: least, most and (so far reached by k rows) floor, all as integers."""

    def __init__(self, ids, labels, x, leaves, largest: float):
        self.ids, self.labels, self.x, self.leaves = ids, labels, x, leaves
        n = largest  # the largest squared norm of any row
        self.kind = np.float32 if n < 1 << 23 else np.float64 if n < 1 << 52 else np.int64 if n < 1 << 62 else object
        self.same, self.k = True, POSITIVES
        self.least = np.full((len(ids), 1), _LEAST, dtype=np.int64)
        self.most = np.full((len(ids), 1), _MOST, dtype=np.int64)
        self.marks = np.zeros((len(ids), 1, 2), dtype=np.int64)  # id and score of the positive of each window

    def scores(self, at: np.ndarray, rows: np.ndarray) -> np.ndarray:
        if self.kind in (np.float32, np.float64):
            return self.x[at].astype(self.kind) @ rows.astype(self.kind).T
        out = self.x[at].astype(self.kind) @ rows.astype(self.kind).T
        return out if self.kind is np.int64 else np.clip(out, -(1 << 63), (1 << 63) - 1).astype(np.int64)

    def windows(self, found: dict[int, list[tuple[int, int]]]) -> None:
        """Windows for negatives, from the positives (id, score) of each anchor."""
        self.same, self.k, shape = False, NEGATIVES, (len(self.ids), POSITIVES)
        self.least, self.most = np.full(shape, _MOST, dtype=np.int64), np.full(shape, _LEAST, dtype=np.int64)
        self.marks = np.zeros((*shape, 2), dtype=np.int64)
        for i, anchor in enumerate(self.ids.tolist()):
            for j, (other, score) in enumerate(found.get(anchor, ())):
                self.marks[i, j] = other, score
                self.least[i, j], self.most[i, j] = max(-(-LOW * score // 100), _LEAST), min(HIGH * score // 100, _MOST)


class _Best:
    """The k best rows of each window of a chunk: higher scores first, then smaller ids."""

    def __init__(self, chunk: Chunk):
        self.chunk, self.floor = chunk, chunk.least.copy()
        self.parts: list[np.ndarray] = []
        self.n = 0

    def add(self, slots: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        self.parts.append(np.stack([slots, scores, ids]))
        self.n += len(slots)
        if self.n > _HELD:
            self.cut()

    def cut(self) -> np.ndarray:
        if not self.parts:
            return np.zeros((3, 0), dtype=np.int64)
        slots, scores, ids = np.concatenate(self.parts, axis=1)
        order = np.lexsort([ids, ~scores, slots])  # ~x: higher first, without overflow
        slots, scores, ids = slots[order], scores[order], ids[order]
        starts = np.flatnonzero(np.concatenate([[True], slots[1:] != slots[:-1]]))
        rank = np.arange(len(slots)) - np.repeat(starts, np.diff([*starts, len(slots)]))
        last = rank == self.chunk.k - 1
        flat = self.floor.ravel()
        flat[slots[last]] = np.maximum(flat[slots[last]], scores[last])
        held = np.stack([slots, scores, ids])[:, rank < self.chunk.k]
        self.parts, self.n = [held], held.shape[1]
        return held


_FOUND = "anchor long, slot int, other long, score long, positive long, positive_score long"
_FOUND_ARROW = pa.schema([("anchor", pa.int64()), ("slot", pa.int32()), ("other", pa.int64()), ("score", pa.int64()), ("positive", pa.int64()), ("positive_score", pa.int64())])


@gives_back
def _scanned(batches, chunk, tree, own: bool, width: int):
    """The best rows of a task's leaves for each window. own: anchors look into their own leaves only."""
    chunk, tree = chunk.value, tree.value
    best = _Best(chunk)
    n_windows = chunk.least.shape[1]
    x = chunk.x.astype(np.float64)
    bounds: tuple = (None, None, None)
    for batch in batches:
        ids, labels, rows = batch.column(0).to_numpy(), batch.column(1).to_numpy(), _matrix(batch.column(2), width)
        for leaf, part in _segments(batch.column(3).to_numpy()):
            if own:
                near = np.flatnonzero(chunk.leaves == leaf)
            else:
                if bounds[0] != leaf:
                    bounds = (leaf, *tree.bounds(x, leaf))
                near = np.flatnonzero(((bounds[2][:, None] >= best.floor) & (bounds[1][:, None] <= chunk.most)).any(1))
            size = max(1, _CELLS // (part.stop - part.start))
            for at in (near[i : i + size] for i in range(0, len(near), size)):
                s = chunk.scores(at, rows[part])
                mask = (s >= best.floor[at].min(1)[:, None]) & (s <= chunk.most[at].max(1)[:, None])
                i, j = np.nonzero(mask)
                match = chunk.labels[at[i]] == labels[part][j]
                fits = match & (chunk.ids[at[i]] != ids[part][j]) if chunk.same else ~match
                i, j = i[fits], j[fits]
                score, anchor, other = s[i, j].astype(np.int64), at[i], ids[part][j]
                for w in range(n_windows):
                    good = (score >= best.floor[anchor, w]) & (score <= chunk.most[anchor, w])
                    if good.any():
                        best.add(anchor[good] * n_windows + w, score[good], other[good])
    slots, scores, others = best.cut()
    anchor, w = slots // n_windows, slots % n_windows
    marks = chunk.marks[anchor, w]
    yield pa.RecordBatch.from_arrays([pa.array(c) for c in (chunk.ids[anchor], w.astype(np.int32), others, scores, marks[:, 0], marks[:, 1])], schema=_FOUND_ARROW)


def _scan(held: DataFrame, chunk: Chunk, tree, own: bool, width: int) -> DataFrame:
    """The k best rows of each window of a chunk among all rows (or the anchors' leaves), ranked from 1."""
    sent = held.sparkSession.sparkContext.broadcast(chunk)
    leaves = [int(x) for x in np.unique(chunk.leaves)]
    rows = held.filter(F.col("leaf").isin(leaves)) if own and len(leaves) <= 64 else held
    found = rows.mapInArrow(partial(_scanned, chunk=sent, tree=tree, own=own, width=width), _FOUND)
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "other")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= chunk.k)


def _raised(chunk: Chunk, found: DataFrame) -> None:
    """Windows of a chunk begin at the score that k rows are known to reach. found has k rows a window at most."""
    last = found.filter(F.col("rank") == chunk.k).select("anchor", "slot", "score").toArrow()
    at = {a: i for i, a in enumerate(chunk.ids.tolist())}
    for a, slot, score in zip(*[c.to_pylist() for c in last.columns]):
        chunk.least[at[a], slot] = max(int(chunk.least[at[a], slot]), score)


def mine(vectors: DataFrame, anchors, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), for the rows of vectors that the condition anchors (a Column over
    vec_id and label) picks: for each of an anchor's first POSITIVES rows of its label, the first NEGATIVES rows of other labels whose score is LOW to HIGH percent
    of the positive's."""
    spark = vectors.sparkSession
    rows = staged(quantised(vectors, key, vector, label), "negatives-rows")
    out = shared_path(spark, "negatives")
    kind = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    width = rows.agg(F.max(F.size("q"))).first()[0]
    if width is None:
        return spark.createDataFrame([], kind)
    held, tree = indexed(rows, width)
    sent = spark.sparkContext.broadcast(tree)
    largest = max(high for _, high in tree.norms.values())
    most = max(1, min(MOST_ANCHORS, MOST_CHUNK_BYTES // (8 * max(1, width))))
    wanted = staged(held.filter(anchors), "negatives-anchors")
    parts = -(-wanted.count() // most)
    for part in range(parts):
        drawn = wanted.filter(F.pmod(F.xxhash64("vec_id"), F.lit(parts)) == part).toArrow().combine_chunks() if parts > 1 else wanted.toArrow().combine_chunks()
        for start in range(0, drawn.num_rows, most):
            ids, labels, q, leaves = (c.combine_chunks() for c in drawn.slice(start, most).columns)
            chunk = Chunk(ids.to_numpy(), labels.to_numpy(), _matrix(q, width), leaves.to_numpy(), largest)
            _raised(chunk, _scan(held, chunk, sent, True, width))
            found: dict[int, list] = {}
            first = _scan(held, chunk, sent, False, width).select("anchor", "other", "score", "rank").sort("anchor", "rank").toArrow()  # POSITIVES rows an anchor at most
            for a, other, score, _ in zip(*[c.to_pylist() for c in first.columns]):
                found.setdefault(a, []).append((other, score))
            chunk.windows(found)
            _raised(chunk, _scan(held, chunk, sent, True, width))
            last = _scan(held, chunk, sent, False, width)
            last.select(F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), F.col("rank").cast("int").alias("rank"), F.col("other").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")).write.mode("append").parquet(out)
    return spark.read.schema(kind).parquet(out) if parts else spark.createDataFrame([], kind)


def relabelled(vectors: DataFrame) -> DataFrame:
    """embeddings with the labels of the contract: every seventh id moves to the next of ten labels."""
    return vectors.select("vec_id", "embedding", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"))


def op12_hard_negatives(spark, sf_dir: str) -> DataFrame:
    return mine(relabelled(table(spark, sf_dir, "embeddings")), F.col("vec_id") % 50 == 0)


OP12_SQL = """
WITH given AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, list_dot_product(a.q, b.q)::BIGINT AS score
  FROM given a JOIN given b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT * FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
)
SELECT p.anchor_id, p.other AS positive_id, row_number() OVER w::INT AS rank, n.other AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
WINDOW w AS (PARTITION BY p.anchor_id, p.other ORDER BY n.score DESC, n.other)
QUALIFY row_number() OVER w <= 3
"""
