"""Hard negatives of anchors by angular triangle filtering.

Components become whole numbers, and a score is their inner product. Every vector stores its angles to a few reference
directions. By the triangle inequality of angles two vectors' angles to one reference bound the angle between them
from both sides; the tightest bounds over all references, as cosines times both norms and widened by more than rounding
can shift them, hold the score. Only pairs whose interval meets the wanted window get an integer score:

* positives of an anchor are the best of its label, so a row is scored if its upper bound reaches the least of the best
  few among the rows of greatest bounds;
* negatives of a positive lie in a window of scores, so a row is scored, once per anchor, if its interval meets one of the
  anchor's windows.

Anchors are compared with all rows block by block; a block of rows gives each anchor (and window) its best few, and the
best of those are kept. References are spread directions of a bounded sample of the rows (``SAMPLE``); the results do not
depend on them.

Rows with a null id, label or vector, or a null or non-finite component take no part. Rows of different length are not
compared; zero and empty vectors score 0. Repeated ids are rows of their own, but a row is not compared with one of its
own id; rows of one anchor id are one anchor with the scores of all of them; equal scores go by the smaller id. A hot label or many equal vectors are dealt to blocks like any others. Scores
beyond 64 bits are compared exactly and shown as the nearest 64-bit number. An empty table gives no rows. Only
vec_id, embedding and label are read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.common import small_table
from meterline.session import cut

SCALE = 256
#: Anchors are ids divisible by the first; positives and negatives that an anchor and a window get.
EVERY, POSITIVES, NEGATIVES = 100, 5, 10
#: A negative's score in hundredths of the positive's.
LOW, HIGH = 30, 90
REFERENCES, SAMPLE = 8, 2048
#: Rows and anchors of a task.
ROWS, ANCHORS = 8192, 4096
#: Cosines from angles are off by less than this, whatever is rounded on the way.
SLACK = 1e-6
#: Inner products up to here, and a hundred times them, are exact in double precision.
EXACT = 2.0**45

_ROW = "vec_id bigint, label {label}, q array<double>, dim int, norm double, angles array<double>"


def relabelled(vectors: DataFrame, every: int = 7, labels: int = 10) -> DataFrame:
    """The rows with (label + 1) % labels where ``every`` divides the id."""
    moved = ((F.col("label") + 1) % labels).cast(dict(vectors.dtypes)["label"])
    return vectors.select("vec_id", "embedding", F.when(F.col("vec_id") % every == 0, moved).otherwise(F.col("label")).alias("label"))


def whole_numbers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, label, q, dim of the rows that take part."""
    x = F.col("embedding")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v.cast("double")) | (F.abs(v.cast("double")) == float("inf")))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & ~bad)
    # rint of a double is a double: floor would give a number of 64 bits
    times = F.transform(x, lambda v: v.cast("double") * scale)
    q = F.transform(times, lambda v: F.rint(v) - F.when(F.rint(v) > v, 1.0).otherwise(0.0))
    return rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), "label", q.alias("q"), F.size("embedding").alias("dim"))


def _unit(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Directions and norms; the direction of a zero vector is zero."""
    top = np.abs(x).max(axis=1, keepdims=True, initial=0)
    small = x / np.where(top > 0, top, 1)
    norm = np.sqrt((small * small).sum(axis=1))
    return small / np.where(norm > 0, norm, 1)[:, None], norm * top[:, 0]


def references(rows: DataFrame, n: int = REFERENCES, sample: int = SAMPLE) -> dict[int, np.ndarray]:
    """Per length ``n`` spread directions: of a sample, those farthest from the ones taken before.

    The sample is the rows of smallest hash, ``sample`` in all; a length that it has no row of has no references.
    """
    some = rows.orderBy(F.xxhash64("vec_id", "q"), "vec_id").limit(sample).select("q").toArrow()["q"].to_pylist()
    out = {}
    for dim in {len(q) for q in some if q}:
        x, norm = _unit(np.array([q for q in some if len(q) == dim]))
        x = x[norm > 0]
        if len(x):
            taken = [x[0]]
            near = x @ x[0]
            while len(taken) < min(n, len(x)):
                taken.append(x[int(near.argmin())])
                near = np.maximum(near, x @ taken[-1])
            out[dim] = np.array(taken)
    return out


def _matrix(column, dim: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), dim)


def with_angles(rows: DataFrame, directions: dict[int, np.ndarray]) -> DataFrame:
    """``rows`` with their norms and their angles to the reference directions of their length."""
    label = dict(rows.dtypes)["label"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, dims = batch.column(2), batch.column(3).to_numpy()
            norm, angles = np.zeros(len(dims)), [None] * len(dims)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                unit, norm[at] = _unit(_matrix(lists.take(pa.array(at)), dim))
                refs = directions.get(int(dim), np.zeros((0, dim)))
                for i, angle in zip(at, np.arccos(np.clip(unit @ refs.T, -1, 1)), strict=True):
                    angles[i] = angle
            more = [pa.array(norm), pa.array(angles, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, "norm", "angles"])

    return rows.select("vec_id", "label", "q", "dim").mapInArrow(run, _ROW.format(label=label))


class Block:
    """Vectors as matrices, and what their angles say about scores with another vector."""

    def __init__(self, t: pa.Table) -> None:
        dim = t["dim"][0].as_py()
        self.ids, self.norm = t["vec_id"].to_numpy(), t["norm"].to_numpy()
        self.label = t["label"].to_numpy(zero_copy_only=False)
        self.q = _matrix(t["q"], dim)
        # a row per reference, so that a bound is the greatest or least of whole rows
        self.angles = np.ascontiguousarray(_matrix(t["angles"], len(t["angles"][0])).T)
        self.exact = self.norm.max(initial=0)

    def bounds(self, angles: np.ndarray, norm: float) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest score of every row with a vector of these angles and this norm."""
        size = norm * self.norm
        if not len(self.angles):
            return -size * (1 + SLACK) - 1, size * (1 + SLACK) + 1
        apart, together = np.zeros(len(size)), np.full(len(size), math.pi)
        for own, other in zip(self.angles, angles, strict=True):
            np.maximum(apart, np.abs(own - other), out=apart)
            np.minimum(together, math.pi - np.abs(math.pi - other - own), out=together)
        return size * (np.cos(together) - SLACK) - 1, size * (np.cos(apart) + SLACK) + 1

    def scores(self, q: np.ndarray, norm: float, rows: np.ndarray) -> np.ndarray:
        """Integer inner products with ``rows``; beyond what doubles hold, in whole numbers of any size."""
        if norm * self.exact < EXACT:
            # most rows are scored faster where they lie than picked out
            return (self.q @ q)[rows] if 4 * len(rows) > len(self.q) else self.q[rows] @ q
        if not self.q.shape[1] or not len(rows):
            return np.zeros(len(rows))
        whole = lambda x: np.vectorize(int, otypes=[object])(x)
        return whole(self.q[rows]) @ whole(q)

    def first(self, rows: np.ndarray, scores: np.ndarray, n: int) -> list[tuple[int, int]]:
        """(score, id) of the ``n`` best of scored rows."""
        if len(rows) > n:
            last = np.sort(scores)[-n] if scores.dtype == object else np.partition(scores, -n)[-n]
            good = np.array(scores >= last, bool)  # with all that are equal to the last
            rows, scores = rows[good], scores[good]
        found = [(int(v), int(i)) for v, i in zip(scores, self.ids[rows], strict=True)]
        return sorted(found, key=lambda f: (-f[0], f[1]))[:n]


def _positives(anchors: Block, rows: Block, n: int) -> Iterator[tuple]:
    """The best of an anchor's label: some of greatest bounds are scored first, then what reaches the last of their best."""
    for a in range(len(anchors.ids)):
        q, norm = anchors.q[a], anchors.norm[a]
        own = np.flatnonzero((rows.label == anchors.label[a]) & (rows.ids != anchors.ids[a]))
        _, high = rows.bounds(anchors.angles[:, a], norm)
        if len(own) > 8 * n:
            some = own[np.argpartition(-high[own], 4 * n)[: 4 * n]]
            least = np.sort(rows.scores(q, norm, some))[-n]
            own = own[high[own] >= float(least)]
        for score, other in rows.first(own, rows.scores(q, norm, own), n):
            yield int(anchors.ids[a]), other, score


def _negatives(anchors: Block, rows: Block, windows: dict[int, list[tuple[int, int]]], n: int, low: int, high: int) -> Iterator[tuple]:
    """The best of other labels in each window: a row is scored, once per anchor, if its interval meets a window."""
    for a in range(len(anchors.ids)):
        anchor, q, norm = int(anchors.ids[a]), anchors.q[a], anchors.norm[a]
        least, most = rows.bounds(anchors.angles[:, a], norm)
        meets = np.zeros(len(least), bool)
        for score in {float(p) for _, p in windows[anchor]}:
            meets |= (100 * most >= low * score) & (100 * least <= high * score)
        meets &= rows.label != anchors.label[a]
        others = np.flatnonzero(meets)
        times = 100 * rows.scores(q, norm, others)
        for positive, score in windows[anchor]:
            inside = np.array((low * score <= times) & (times <= high * score), bool)
            for value, other in rows.first(others[inside], times[inside], n):
                yield anchor, positive, score, other, value // 100


def _blocks(rows: DataFrame, groups: list[str], size: int, name: str) -> DataFrame:
    """How many blocks of about ``size`` rows a group has, as the column ``name``; few rows."""
    return small_table(rows.groupBy(*groups).agg(F.ceil(F.count("*") / size).cast("int").alias(name)), "blocks")


def _compared(rows: DataFrame, anchors: DataFrame, groups: list[str], work: Callable, schema: str) -> DataFrame:
    """``work`` on every block of rows with every block of anchors of the same groups."""
    blocks = _blocks(rows, groups, ROWS, "_rs").join(_blocks(anchors, groups, ANCHORS, "_as"), groups)
    own = lambda n: F.pmod(F.xxhash64("vec_id", "q"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    blocks = small_table(blocks, "pairs")
    left = rows.join(blocks, groups).withColumn("_r", own("_rs")).withColumn("_a", every("_as")).drop("_rs", "_as")
    right = anchors.join(blocks, groups).withColumn("_a", own("_as")).withColumn("_r", every("_rs")).drop("_rs", "_as")
    right = right.select(*[F.col(c).alias(c) for c in right.columns])  # other columns than those of the rows, to Spark
    keys = [*groups, "_a", "_r"]

    names = [f.split(" ")[0] for f in schema.split(", ")]

    def run(here: pa.Table, asking: pa.Table) -> pa.Table:
        found = list(work(asking, here)) if here.num_rows and asking.num_rows else []
        clip = lambda v: max(-(2**63), min(2**63 - 1, v))
        return pa.table({n: pa.array([clip(f[i]) for f in found], pa.int64()) for i, n in enumerate(names)})

    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, schema)


def _first(rows: DataFrame, by: list[str], order: list[Column], n: int) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= n)


def mine(
    vectors: DataFrame, every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    plain = whole_numbers(vectors)
    rows = cut(with_angles(plain, references(plain)), "angles")
    anchors = rows.where(F.col("vec_id") % every == 0)

    def near(asking: pa.Table, own: pa.Table) -> Iterator[tuple]:
        return _positives(Block(asking), Block(own), positives)

    found = _compared(rows, anchors, ["dim", "label"], near, "anchor_id bigint, positive_id bigint, positive_score bigint")
    best = _first(found, ["anchor_id"], [F.desc("positive_score"), F.col("positive_id")], positives).drop("rank")
    windows = best.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("windows"))
    asked = anchors.join(cut(windows, "windows").withColumnRenamed("anchor_id", "vec_id"), "vec_id")

    def apart(asking: pa.Table, own: pa.Table) -> Iterator[tuple]:
        lists = zip(asking["vec_id"].to_pylist(), asking["windows"].to_pylist(), strict=True)
        known = {i: [(w["positive_id"], w["positive_score"]) for w in ws] for i, ws in lists}
        return _negatives(Block(asking), Block(own), known, negatives, low, high)

    schema = "anchor_id bigint, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint"
    held = _compared(rows, asked, ["dim"], apart, schema)
    ranked = _first(held, ["anchor_id", "positive_id"], [F.desc("negative_score"), F.col("negative_id")], negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
