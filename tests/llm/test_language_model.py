from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from meterline.llm import gru, lm
from tests.llm.conftest import odd_documents


def plain(rows):
    texts = [(i, (t or "").encode().lower().split() + [b""]) for i, t in rows]
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0
    c = Counter(w for i, words in texts if not held(i) for w in words)
    n, v = sum(c.values()), len(c)
    out = []
    for i, words in texts:
        score = sum(np.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        out.append((i, held(i), len(words), sum(c[w] > 0 for w in words), n, score))
    return out


def check(got, rows):
    want = sorted(plain(rows), key=lambda r: (r[0] is None, r[0], r[5]))
    found = sorted(got, key=lambda r: (r.doc_id is None, r.doc_id, r.base_score))
    assert len(want) == len(found)
    for w, r in zip(want, found, strict=True):
        assert w[:5] == (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens)
        assert abs(w[5] - r.base_score) < 1e-6 * (1 + abs(w[5]))
        assert r.score < 0


def test_scores(spark, documents, monkeypatch):
    monkeypatch.setattr(lm, "LEXICON", 2000)  # so that rare words take the way of the join
    rows = [r[:2] for r in documents]
    got = lm.score_documents(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    check(got, rows)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) * 0.98


def test_odd_documents(spark, odd, none):
    check(lm.score_documents(odd).collect(), [r[:2] for r in odd_documents()])
    assert lm.score_documents(none).count() == 0
    alone = spark.createDataFrame([(20, "held out only")], "doc_id bigint, text string")
    while zlib.crc32(str(alone.first().doc_id).encode()) % 10:
        alone = spark.createDataFrame([(alone.first().doc_id + 1, "held out only")], "doc_id bigint, text string")
    row = lm.score_documents(alone).first()
    assert row.train_tokens == 0 and row.n_known == 0 and row.base_score == 0.0


def test_gradient_equals_differences():
    rng = np.random.default_rng(0)
    theta = (gru.initial(rng.random(gru.SYMBOLS) * 5) + rng.normal(0, 0.05, sum(int(np.prod(s)) for s in gru.SHAPES.values()))).astype(np.float64)
    target = rng.integers(0, gru.SYMBOLS, (3, 6))
    target[1, 4:] = -1
    h, last = np.zeros((3, gru.HIDDEN)), np.zeros(3, int)

    def loss(t):
        model = gru.Model(gru.shaped(t))
        state, symbol, total = h, last, 0.0
        for k in range(6):
            state = model.advance(state, symbol)
            live = target[:, k] >= 0
            total -= model.log_probability(state[live], target[live, k]).astype(float).sum()
            symbol = np.maximum(target[:, k], 0)
        return total / (target >= 0).sum()

    gradient, _, _ = gru.Trainer(theta)._window(h, last, target)
    for at in rng.choice(np.flatnonzero(np.abs(gradient) > 1e-3), 25):
        step = np.zeros_like(theta)
        step[at] = 1e-3
        assert abs((loss(theta + step) - loss(theta - step)) / 2e-3 - gradient[at]) < 2e-3 + 0.03 * abs(gradient[at])


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(1)
    model = gru.Model(gru.shaped(gru.initial(rng.random(gru.SYMBOLS) * 9)))
    h = rng.normal(size=(1, gru.HIDDEN)).astype(np.float32)
    every = np.arange(gru.SYMBOLS)
    assert abs(np.exp(model.log_probability(np.repeat(h, len(every), 0), every).astype(float)).sum() - 1) < 1e-4


def test_state_is_carried_over_windows():
    rng = np.random.default_rng(2)
    model = gru.Model(gru.shaped(gru.initial(rng.random(gru.SYMBOLS) * 9)))
    texts = [np.append(rng.integers(1, gru.SYMBOLS, n), 0) for n in (0, 5, gru.WINDOW, 3 * gru.WINDOW + 7)]
    for text, score in zip(texts, model.score(texts), strict=True):
        h, last, total = np.zeros((1, gru.HIDDEN), np.float32), np.zeros(1, int), 0.0
        for symbol in text:
            h = model.advance(h, last)
            total += float(model.log_probability(h, np.array([symbol]))[0])
            last = np.array([symbol])
        assert abs(total - score) < 1e-3 * (1 + abs(total))


def test_every_token_is_learned_from(spark):
    words = [f"word{i % 50}" for i in range(1000)]
    texts = [" ".join(words[:n]) for n in (1000, lm.SPAN, lm.SPAN - 1, 0)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    lexicon = lm.lexicon_of(lm.word_counts(docs))
    place = {w: i + 1 for i, w in enumerate(lexicon.words.to_pylist())}
    want = [[place[w.encode()] for w in text.split()] + [0] for text in texts]
    rows = [r.symbols for r in lm.spans(docs, lexicon).collect()]
    assert max(map(len, rows)) == lm.SPAN + 1
    assert [x for r in rows for x in r[1:]] == [x for text in want for x in text]
    before = [x for text in want for x in [0, *text][: -1 : lm.SPAN]]
    assert [r[0] for r in rows] == before


def test_scores_do_not_depend_on_the_partitions(spark, documents, monkeypatch):
    monkeypatch.setattr(lm, "PER_REPLICA", 60)  # several replicas
    rows = [r[:2] for r in documents[:300]] + [(10_000 + i, documents[0][1]) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    first, second = ({r.doc_id: r.score for r in lm.score_documents(docs.repartition(n)).collect()} for n in (4, 7))
    assert all(abs(first[i] - second[i]) <= 1e-6 * abs(first[i]) for i in first)


def test_copies_are_dealt_to_all_replicas(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "'the same few words again' AS text")
    lexicon = lm.lexicon_of(lm.word_counts(docs))
    sizes = [r["count"] for r in lm.spans(docs, lexicon).repartition(8, "mark").groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 3000 and max(sizes) < 2 * 3000 / 8


def test_counted_words_are_shuffled_by_the_bucket(spark, documents, odd, monkeypatch):
    monkeypatch.setattr(lm, "TEXTS", 20_000)  # several parts in a task
    monkeypatch.setattr(lm, "COUNTED", 3000)
    rows = [r[:2] for r in documents[:200]] + [r[:2] for r in odd_documents()]
    counts = lm.word_counts(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3))
    assert "Aggregate" not in counts._jdf.queryExecution().toString()  # which took a row for each word and task
    want = Counter(w for _, t in rows for w in [*(t or "").encode().lower().split(), b""])
    got = [(bytes(r.word), r.c) for r in counts.collect()]
    assert len(got) == len(want) and dict(got) == want
    assert lm.word_counts(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_words_are_looked_up_once(spark, odd):
    """What scoring and training read of a text are its symbols."""
    lexicon = lm.lexicon_of(lm.word_counts(odd))
    read = lm.read_texts(odd.select("doc_id", "text"), lexicon)
    rows = sorted(read.collect(), key=lambda r: (r.doc_id is None, r.doc_id))
    place = {w: i + 1 for i, w in enumerate(lexicon.words.to_pylist())}
    texts = sorted(odd_documents(), key=lambda r: (r[0] is None, r[0]))
    for r, (i, text, *_) in zip(rows, texts, strict=True):
        words = (text or "").encode().lower().split()
        assert (r.doc_id, r.n_tokens, r.n_known) == (i, len(words) + 1, len(words) + 1) and not r.rare
        assert np.frombuffer(r.symbols, "<i2").tolist() == [*map(place.get, words), 0]
    scored = lm._scored(read, gru.initial(lexicon.symbol_counts()))
    assert "text" not in scored.columns and scored.count() == len(texts)


def test_large_values_do_not_overflow():
    rng = np.random.default_rng(6)
    p = gru.shaped(gru.initial(rng.random(gru.SYMBOLS) * 9).copy())
    p["class_w"][:], p["word_w"][:] = (rng.normal(0, 60, p[k].shape) for k in ("class_w", "word_w"))
    model = gru.Model(p)
    assert model.bound > 88 and model.word_bound > 88
    h = rng.uniform(-1, 1, (1, gru.HIDDEN)).astype(np.float32)
    every = np.arange(gru.SYMBOLS)
    logs = model.log_probability(np.repeat(h, len(every), 0), every).astype(float)
    assert np.isfinite(logs).all() and abs(np.exp(logs).sum() - 1) < 1e-3
