"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are present or absent: words, word beginnings (insults are inflected in several languages),
pairs of neighbouring words, and pairs with one or two words between. They are hashed to ``2 ** BITS`` places.
Learning rates are kept per place and the L1 penalty leaves few weights, which are all that is sent to the tasks
that score. The fit uses a bounded sample of labelled rows, ``MOST_TOXIC`` and ``MOST_CLEAN``; the intercept is
then moved to the share of toxic documents among all labelled ones admitted for learning.

Null and empty texts have no feature and score the intercept. Without rows of both classes every text scores the
smoothed share of toxic rows. A document labelled twice counts once, with its highest label; null labels do
not count. Repeated documents are scored one by one, texts of any length whole; rows of the sample with equal hashes go
by id. An empty table gives no rows. Only doc_id, text and toxic are read, whatever other columns there are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import REMEMBERED, map_texts, mixed, remainder, remembered

BITS = 20
MOST_TOXIC, MOST_CLEAN = 6_000, 10_000
ALPHA, BETA, L1, L2, ROUNDS = 0.5, 1.0, 3.0, 0.0, 4
HOLD_OUT, HELD = 4, 2
#: Beginnings of words that are features of their own, in bytes.
STEMS = (4, 5, 6)
_SPACE = [np.uint64(x) for x in (0x1B873593, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F)]
_STRIP = b".,;:!?\"'()[]{}<>*#$%&|"


class WordTable(dict):
    """Row of a word in ``codes``: hashes of the stripped word and of its beginnings (0: none). Emptied when full."""

    def __init__(self) -> None:
        super().__init__()
        self.codes = np.zeros((1024, 1 + len(STEMS)), np.uint64)

    def __missing__(self, raw: bytes) -> int:
        row = len(self)
        if row == len(self.codes):
            self.codes = np.concatenate([self.codes, np.zeros_like(self.codes)])
        word = raw.strip(_STRIP)
        hashes = [xxhash.xxh64_intdigest(word)] + [xxhash.xxh64_intdigest(word[:k] + b"*") if len(word) > k else 0 for k in STEMS]
        self.codes[row] = hashes if word else 0
        self[raw] = row
        return row

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > REMEMBERED:
            self.clear()
        rows = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return self.codes[rows[self.codes[rows, 0] != 0]]


def word_table() -> WordTable:
    return remembered("toxicity", WordTable)


def places(text: bytes, words: WordTable) -> np.ndarray:
    """Places of all features of a text; a feature that occurs twice is there twice."""
    codes = words.of(text.lower().split())
    single = codes.ravel()
    parts = [mixed(single[single != 0] ^ _SPACE[0])]
    code = codes[:, 0]
    for gap in (1, 2, 3):
        if len(code) > gap:
            parts.append(mixed(mixed(code[:-gap] ^ _SPACE[gap]) + code[gap:]))
    return (np.concatenate(parts) >> np.uint64(64 - BITS)).astype(np.int64)


def features(text: bytes, words: WordTable) -> np.ndarray:
    """Each place once, in ascending order."""
    return np.unique(places(text, words))


class Ftrl:
    """FTRL-proximal: the sums z and n per place; a weight is their closed form."""

    def __init__(self) -> None:
        self.z, self.n = np.zeros(1 << BITS), np.zeros(1 << BITS)
        self.z0 = self.n0 = 0.0

    @staticmethod
    def weight(z, n):
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def bias(self) -> float:
        return -self.z0 / ((BETA + np.sqrt(self.n0)) / ALPHA)

    def learn(self, at: np.ndarray, y: float) -> None:
        z, n = self.z[at], self.n[at]
        w = self.weight(z, n)
        b = self.bias()
        g = 1 / (1 + np.exp(-np.clip(w.sum() + b, -35, 35))) - y
        sigma = (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA
        self.z[at] = z + g - sigma * w
        self.n[at] = n + g * g
        self.z0 += g - (np.sqrt(self.n0 + g * g) - np.sqrt(self.n0)) / ALPHA * b
        self.n0 += g * g


def _labelled(labels: DataFrame, admitted) -> DataFrame:
    """doc_id, y of every admitted document with a label, each once."""
    rows = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & admitted)
    return rows.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("y"))


def _sample(labels: DataFrame, admitted, most_toxic: int, most_clean: int) -> DataFrame:
    once = _labelled(labels, admitted)
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    return once.where("y = 1").orderBy(*order).limit(most_toxic).unionAll(once.where("y = 0").orderBy(*order).limit(most_clean))


def fitted(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray, float]:
    """Places with a weight, their weights, and the intercept."""
    admitted = remainder("doc_id", HOLD_OUT) != HELD
    sample = _sample(labels, admitted, MOST_TOXIC, MOST_CLEAN)
    share = _labelled(labels, admitted).agg(F.coalesce(F.sum("y"), F.lit(0)).alias("p"), F.count("*").alias("n"))

    def work(texts: list[bytes]) -> dict[str, object]:
        words = word_table()
        return {"at": pa.array([features(t, words).astype(np.int32) for t in texts], pa.list_(pa.int32()))}

    # the sample is bounded by the two parameters above, so it may be broadcast and learned from in one task
    chosen = docs.select("doc_id", "text").join(F.broadcast(sample.select("doc_id")), "doc_id", "left_semi")
    known = map_texts(chosen, work, "at array<int>").groupBy("doc_id").agg(F.min("at").alias("at")).join(F.broadcast(sample), "doc_id")

    def learn(batches):
        rows = []
        for batch in batches:
            lists, y, order = batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()
            rows += [(order[i], np.array(lists[i].values.to_numpy()), y[i]) for i in range(len(y))]
        rows.sort(key=lambda r: r[0])
        model = Ftrl()
        for _ in range(ROUNDS):
            for _, at, y in rows:
                model.learn(at, y)
        w = model.weight(model.z, model.n)
        places = np.flatnonzero(w)
        toxic = sum(r[2] for r in rows)
        both = 0 < toxic < len(rows)
        first = np.log((toxic + 0.5) / (len(rows) - toxic + 0.5))
        out = [[-1, *places] if both else [-1], [model.bias() - first, *w[places]] if both else [0.0]]
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), pa.array(out[1], pa.float64())], ["place", "weight"])

    order = F.xxhash64(F.col("doc_id"), F.lit(7)).alias("o")
    model = known.select("at", "y", order).repartition(1).mapInArrow(learn, "place int, weight double").toArrow()
    p, n = share.first()
    at, weights = model["place"].to_numpy(), model["weight"].to_numpy()
    prior = float(np.log((p + 0.5) / (n - p + 0.5)))
    intercept = prior + float(weights[at < 0].sum())
    order = np.argsort(at[at >= 0])
    return at[at >= 0][order], weights[at >= 0][order], intercept


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    at, weights, intercept = fitted(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast((at.astype(np.int32), weights.astype(np.float32)))
    def work(texts: list[bytes]) -> dict[str, object]:
        words = word_table()
        at, w = shared.value
        full = np.zeros(1 << BITS, np.float32)
        full[at] = w
        raw = np.zeros(len(texts))
        for i, text in enumerate(texts):
            found = places(text, words)
            raw[i] = full[np.unique(found[full[found] != 0])].sum(dtype=float)
        return {"score": pa.array(1 / (1 + np.exp(-np.clip(raw + intercept, -35, 35))), pa.float64())}

    return map_texts(docs, work, "score double").select(
        "doc_id",
        (remainder("doc_id", HOLD_OUT) == HELD).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )
