"""Quality classifier: histogram gradient-boosted trees over statistics of a document.

Every whole text is read once and turned into a short row of statistics (``statistics``). Trees are fitted
on a bounded sample of labelled rows (``TRAIN_ROWS``), flattened into arrays, and walked by numpy for a
batch of documents at a time. Neither language, source nor id is an input.

Null or empty texts have the statistics of no words and get a score like any other. Without labelled rows every
score is 0.5; with one class only, it is the smoothed share of that class. A document labelled twice counts
once, with its highest label; null labels do not count. Repeated documents are scored one by one, texts of any length
whole; rows of the sample with equal hashes go by id. An empty table gives no rows. Only doc_id, text and quality are read, whatever other
columns there are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import give_back, WordHashes, map_texts, remainder, shingles, small_batches, word_hashes

#: Labelled rows that the trees are fitted on at most, the smallest by a hash of their id.
TRAIN_ROWS = 20_000
BINS, TREES, DEPTH, RATE, L2, LEAST = 48, 60, 4, 0.15, 1.0, 5.0
HOLD_OUT, HELD = 3, 1
GOOD = 0.5

_LOWER, _UPPER, _DIGIT = (np.frombuffer(x, np.uint8) for x in (bytes(range(97, 123)), bytes(range(65, 91)), b"0123456789"))
_SIGNS = [ord(c) for c in "#*$%&|<>!?.,;:\"'()[]{}=/_-+@"]
_BLANK = [32, 9, 10, 11, 12, 13]
NAMES = [
    "log_words", "log_chars", "log_lines", "word_length", "upper", "digit", "wide", "distinct", "adjacent",
    "top_word", "repeat_2", "repeat_5", "repeat_lines", "words_per_line", "short_lines",
] + [f"sign_{c}" for c in _SIGNS]


def _share_repeated(codes: np.ndarray) -> float:
    if len(codes) < 2:
        return 0.0
    _, counts = np.unique(codes, return_counts=True)
    return float(counts[counts > 1].sum()) / len(codes)


def text_statistics(text: bytes, hashes: WordHashes) -> list[float]:
    words = text.split()
    n = len(words)
    per_byte = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    size = max(1, len(text) - int(per_byte[_BLANK].sum()))
    letters = max(1, int(per_byte[_LOWER].sum() + per_byte[_UPPER].sum()))
    lines = [x for x in text.split(b"\n") if x.strip(b" \t\r\x0b\x0c")]
    codes = hashes.of(words)
    counts = np.unique(codes, return_counts=True)[1] if n else np.zeros(1)
    per_line = [x.count(b" ") + 1 for x in lines]
    return [
        np.log1p(n), np.log1p(len(text)), np.log1p(len(lines)), size / max(1, n),
        per_byte[_UPPER].sum() / letters, per_byte[_DIGIT].sum() / size, per_byte[128:].sum() / size,
        len(counts) / max(1, n), float((codes[1:] == codes[:-1]).sum()) / max(1, n - 1), float(counts.max()) / max(1, n),
        _share_repeated(shingles(codes, 2)), _share_repeated(shingles(codes, 5)), 1 - len(set(lines)) / max(1, len(lines)),
        n / max(1, len(lines)), sum(x < 4 for x in per_line) / max(1, len(lines)),
        *(per_byte[_SIGNS] / max(1, n)),
    ]


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and ``x``, the statistics in the order of ``NAMES``."""
    def work(texts: list[bytes]) -> dict[str, object]:
        hashes = word_hashes()
        return {"x": pa.array([[float(v) for v in text_statistics(t, hashes)] for t in texts], pa.list_(pa.float32()))}

    return map_texts(docs, work, "x array<float>")


@dataclass(frozen=True)
class Forest:
    """All trees in arrays: node ``i`` of tree ``t`` has its children at ``2i + 1`` and ``2i + 2``."""

    feature: np.ndarray
    limit: np.ndarray
    value: np.ndarray
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, limit, value in zip(self.feature, self.limit, self.value, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[rows, feature[at]] > limit[at])
            total += value[at]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray) -> Forest:
    """Newton boosting of the logistic loss on binned statistics."""
    n, width = x.shape if len(x) else (0, len(NAMES))
    share = (y.sum() + 0.5) / (n + 1)
    base = float(np.log(share / (1 - share)))
    if n == 0 or y.min() == y.max():
        empty = np.zeros((0, 2 ** (DEPTH + 1) - 1))
        return Forest(empty.astype(np.int64), empty, empty, base)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(width)]
    binned = np.stack([np.searchsorted(edges[j], x[:, j], side="left") for j in range(width)], axis=1)
    nodes, inner = 2 ** (DEPTH + 1) - 1, 2**DEPTH - 1
    raw = np.full(n, base)
    features, limits, values = [], [], []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-raw))
        g, h = y - p, np.maximum(p * (1 - p), 1e-6)
        feature, limit = np.zeros(nodes, np.int64), np.full(nodes, np.inf)
        at = np.zeros(n, np.int64)
        for level in range(DEPTH):
            first, count = 2**level - 1, 2**level
            best = np.full(count, 1e-6)
            cut_at = np.full(count, BINS)
            for j in range(width):
                key = (at - first) * BINS + binned[:, j]
                gs = np.bincount(key, g, count * BINS).reshape(count, BINS).cumsum(1)
                hs = np.bincount(key, h, count * BINS).reshape(count, BINS).cumsum(1)
                ga, ha = gs[:, -1:], hs[:, -1:]
                gain = gs**2 / (hs + L2) + (ga - gs) ** 2 / (ha - hs + L2) - ga**2 / (ha + L2)
                gain[(hs < LEAST) | (ha - hs < LEAST)] = 0
                gain[:, len(edges[j]) :] = 0
                where = gain.argmax(1)
                top = gain[np.arange(count), where]
                for k in np.flatnonzero(top > best):
                    best[k], cut_at[k] = top[k], where[k]
                    feature[first + k], limit[first + k] = j, edges[j][where[k]]
            at = 2 * at + 1 + (binned[np.arange(n), feature[at]] > cut_at[at - first])
        value = np.zeros(nodes)
        leaf = at - inner
        value[inner:] = RATE * np.bincount(leaf, g, nodes - inner) / (np.bincount(leaf, h, nodes - inner) + L2)
        raw += value[at]
        features.append(feature), limits.append(limit), values.append(value)
    return Forest(np.stack(features), np.stack(limits), np.stack(values), base)


def training_rows(labels: DataFrame, label: str, learn, most: int) -> DataFrame:
    """At most ``most`` labelled ids that ``learn`` admits, each once, the smallest by a hash of the id."""
    admitted = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & learn)
    once = admitted.groupBy("doc_id").agg((F.max(label) > 0).cast("int").alias("y"))
    return once.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def fitted(docs: DataFrame, labels: DataFrame) -> Forest:
    """Trees fitted on the bounded sample; the ids of the sample are joined before any text is looked at."""
    sample = training_rows(labels, "quality", remainder("doc_id", HOLD_OUT) != HELD, TRAIN_ROWS)
    # the sample is bounded by TRAIN_ROWS; one row per id, so that repeated documents do not lengthen it
    known = statistics(docs.select("doc_id", "text").join(F.broadcast(sample.select("doc_id")), "doc_id", "left_semi"))
    once = known.groupBy("doc_id").agg(F.min("x").alias("x")).join(F.broadcast(sample), "doc_id")
    rows = once.orderBy("doc_id").select("x", "y").toArrow()
    lists = rows["x"].combine_chunks()
    x = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(-1, len(NAMES))
    forest = fit(x, rows["y"].to_numpy().astype(float))
    del rows, lists, x
    give_back()  # the driver goes on to other work
    return forest


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    forest = fitted(docs, labels)

    def work(texts: list[bytes]) -> dict[str, object]:
        hashes = word_hashes()
        x = np.array([text_statistics(t, hashes) for t in texts], np.float32).reshape(-1, len(NAMES))
        return {"score": pa.array(forest.score(x))}

    return map_texts(docs, work, "score double").select(
        "doc_id",
        (remainder("doc_id", HOLD_OUT) == HELD).alias("held_out"),
        "score",
        (F.col("score") >= GOOD).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text scores at least ``GOOD``; nothing is shuffled."""
    small_batches(docs.sparkSession)
    forest = fitted(docs, labels)

    def run(batches):
        hashes = word_hashes()
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            x = np.array([text_statistics(t or b"", hashes) for t in texts], np.float32).reshape(-1, len(NAMES))
            yield batch.filter(pa.array(forest.score(x) >= GOOD))

    return docs.mapInArrow(run, docs.schema)
