from __future__ import annotations

import zlib

import numpy as np

from meterline.llm import toxicity
from tests.llm.conftest import odd_documents

LABELS = "doc_id bigint, quality int, toxic int"


def made(n: int):
    """Texts of which a fifth hold an insult of a few, inflected."""
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(300)]
    docs, labels = [], []
    for i in range(n):
        text = list(rng.choice(words, rng.integers(5, 120)))
        toxic = int(rng.random() < 0.2)
        if toxic:
            text.insert(rng.integers(0, len(text)), rng.choice(["Rotten", "rotten!", "vilebeck", "vilebent", "vilebor"]))
        docs.append((i, " ".join(text)))
        labels.append((i, 1, toxic))
    return docs, labels


def test_toxicity_on_held_out(spark):
    docs, labels = made(1500)
    rows = toxicity.score_toxicity(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(labels, LABELS)).collect()
    truth = {i: t for i, _, t in labels}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    held = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out]
    assert np.mean([p == y for p, y in held]) > 0.97
    assert np.mean([p for p, y in held if y]) > 0.9


def test_odd_documents(spark, odd, none):
    docs, labels = made(200)
    known = spark.createDataFrame(labels, LABELS)
    assert toxicity.score_toxicity(odd, known).count() == len(odd_documents())
    assert toxicity.score_toxicity(none, known).count() == 0
    rows = toxicity.score_toxicity(odd, spark.createDataFrame([], LABELS)).collect()
    assert len({r.score for r in rows}) == 1 and 0 <= rows[0].score <= 1


def test_ftrl_step_equals_plain_formula():
    model, w = toxicity.Ftrl(), {}
    z, n = {}, {}
    rng = np.random.default_rng(1)
    for _ in range(50):
        at, y = np.unique(rng.integers(0, 20, 6)), float(rng.random() < 0.5)

        def weight(i):
            zi, ni = z.get(i, 0.0), n.get(i, 0.0)
            if abs(zi) <= toxicity.L1:
                return 0.0
            return -(zi - np.sign(zi) * toxicity.L1) / ((toxicity.BETA + np.sqrt(ni)) / toxicity.ALPHA + toxicity.L2)

        w = {i: weight(i) for i in at}
        g = 1 / (1 + np.exp(-(sum(w.values()) + model.bias()))) - y
        for i in at:
            s = (np.sqrt(n.get(i, 0.0) + g * g) - np.sqrt(n.get(i, 0.0))) / toxicity.ALPHA
            z[i] = z.get(i, 0.0) + g - s * w[i]
            n[i] = n.get(i, 0.0) + g * g
        model.learn(at, y)
        assert np.allclose([model.z[i] for i in at], [z[i] for i in at])


def test_a_document_labelled_again_counts_once(spark):
    docs, labels = made(400)
    again = labels + [row for row in labels if row[2]] * 4 + [(None, 1, 1)] * 50
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    once, often = ({r.doc_id: r.score for r in toxicity.score_toxicity(frame, spark.createDataFrame(rows, LABELS)).collect()} for rows in (labels, again))
    assert once == often
