from __future__ import annotations

import random
from collections import Counter

import numpy as np

from meterline.llm import components, embed_dedup, hnsw, minhash
from meterline.llm.common import WordHashes
from tests.llm.conftest import odd_documents


class Sets:
    def __init__(self, names):
        self.up = {n: n for n in names}

    def find(self, a):
        while self.up[a] != a:
            a = self.up[a]
        return a

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def shingle_sets(rows, width):
    out = {}
    for i, t in rows:
        words = (t or "").encode().lower().split()
        full = [tuple(words[k : k + width]) for k in range(len(words) - width + 1)] or ([tuple(words)] if words else [])
        out[i] = set(full)
    return out


def plain(rows, width, percent):
    rows = [r for r in rows if r[0] is not None]
    found = shingle_sets(rows, width)
    sets, ids = Sets(found), sorted(found)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            x, y = found[a], found[b]
            if x and y and percent * max(len(x), len(y)) <= 100 * min(len(x), len(y)):
                common = len(x & y)
                if 100 * common >= percent * (len(x) + len(y) - common):
                    sets.join(a, b)
    return {i: (len(found[i]), sets.find(i)) for i in ids}


def near_texts(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    out = []
    for _ in range(n // 8):
        base = [rng.choice(words) for _ in range(rng.choice([2, 3, 5, 9, 30, 200]))]
        for _ in range(8):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 5])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            out.append((len(out), " ".join(copy)))
    return out


def test_near_duplicates_equal_all_pairs(spark):
    rows = near_texts(1, 400)
    hot = "hot " + " ".join(f"h{i}" for i in range(60))
    rows += [(1000 + i, hot if i % 2 else hot + f" t{i}") for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    for width, percent in ((3, 85), (5, 80)):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(frame, width, percent).collect()}
        assert got == plain(rows, width, percent)


def test_hot_buckets_are_compared_in_blocks(spark, monkeypatch):
    """Copies that are near one another but not near their first one: links come from the blocks."""
    rng = random.Random(5)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(150):
        copy = list(base)
        for _ in range(rng.randrange(1, 9)):
            copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    monkeypatch.setattr(minhash, "BLOCK", 16)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), 3, 85).collect()}
    assert got == plain(rows, 3, 85)


def test_odd_documents(spark, odd, none):
    rows = minhash.near_duplicates(odd, 3, 85).collect()
    assert len(rows) == len(odd_documents())
    want = plain([r[:2] for r in odd_documents()], 3, 85)
    for r in rows:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id] and r.kept == (r.doc_id == r.component_id)
    assert minhash.near_duplicates(none).count() == 0
    stay = minhash.distinct_documents(odd, 3, 85)
    assert stay.columns == odd.columns
    assert Counter(r.doc_id for r in stay.collect()) == Counter({r.doc_id for r in rows if r.kept})


def test_estimate_is_near_the_similarity():
    rng = np.random.default_rng(3)
    errors = []
    for _ in range(200):
        common, own = rng.integers(2**63, size=300, dtype=np.uint64), rng.integers(2**63, size=60, dtype=np.uint64)
        a, b = np.unique(np.concatenate([common, own[:30]]) * np.uint64(2)), np.unique(np.concatenate([common, own[30:]]) * np.uint64(2))
        share = (minhash.registers(a) == minhash.registers(b)).mean()
        errors.append(minhash.estimate(np.array([share]))[0] - 300 / 360)
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.05
    hashes = WordHashes()
    assert len(minhash.shingle_set(b"a b", 3, hashes)) == 1 and len(minhash.shingle_set(b" ", 3, hashes)) == 0


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 180)] + [(500, 500 + i) for i in range(1, 80)] + [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(120)] + [(7, 7)]
    sets = Sets({x for e in edges for x in e})
    for a, b in edges:
        sets.join(a, b)
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {n: sets.find(n) for n in sets.up if sets.find(n) != n}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def vectors(seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(500):
        v = rng.normal(size=16)
        for _ in range(rng.integers(1, 4)):
            rows.append((len(rows), (v + rng.normal(size=16) * rng.choice([0.0, 0.05, 0.2])).astype(np.float32).tolist(), int(i % 3)))
    hot = rng.normal(size=16)
    rows += [(len(rows) + k, (hot + rng.normal(size=16) * 0.08).astype(np.float32).tolist(), 1) for k in range(150)]
    n = len(rows)
    rows += [(n, None, 1), (n + 1, [0.0] * 16, 1), (n + 2, [float("nan")] * 16, 1), (n + 3, [1.0, None] * 8, 1), (n + 4, rows[0][1], None)]
    rows += [(n + 5, [float("inf")] * 16, 1), (n + 6, [], 1), (n + 7, rows[0][1], 0), (n + 8, [2 * x for x in rows[0][1]], 0), (None, rows[0][1], 0), (n + 9, [1e30] * 16, 2), (n + 10, [1e-30] * 16, 2)]
    return rows


def plain_links(rows):
    good = {}
    for i, v, label in rows:
        if i is None or label is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        x = np.array(v, np.float32).astype(float)
        x = x / np.abs(x).max()
        good[i] = (label, x / np.sqrt((x * x).sum()))
    links, sets, ids = Counter(), Sets([r[0] for r in rows if r[0] is not None]), sorted(good)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if good[a][0] == good[b][0] and len(good[a][1]) == len(good[b][1]) and float(good[a][1] @ good[b][1]) >= 0.98:
                links[a] += 1
                links[b] += 1
                sets.join(a, b)
    return {r[0]: (links[r[0]], sets.find(r[0])) for r in rows if r[0] is not None}


def test_embeddings_equal_all_pairs(spark, monkeypatch):
    rows = vectors()
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    want = plain_links(rows)
    for shard in (4096, 120):
        monkeypatch.setattr(embed_dedup, "SHARD", shard)
        got = embed_dedup.near_vectors(frame).collect()
        assert len(got) == len(rows)
        for r in got:
            if r.vec_id is None:
                assert r.n_links == 0 and r.component_id is None
            else:
                assert (r.n_links, r.component_id) == want[r.vec_id] and r.kept == (r.vec_id == r.component_id)
    assert embed_dedup.near_vectors(frame.limit(0)).count() == 0


def test_graph_recall():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 24))
    x[1500:] = x[:1500] + rng.normal(size=(1500, 24)) * 0.1
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph = hnsw.Graph(x, hnsw.levels(np.arange(3000)))
    i, j = graph.within(x, 0.95, 24)
    truth = set(zip(*np.nonzero(x @ x.T >= 0.95), strict=True))
    assert len(set(zip(i, j, strict=True)) & truth) >= 0.99 * len(truth)
    assert max(len(set(r[r >= 0])) for r in graph.layers[0]) <= hnsw.LINKS


def test_texts_that_share_an_id_are_documents_of_their_own(spark):
    a, b, c = ("alpha beta gamma delta epsilon zeta eta theta iota kappa " + x for x in ("one", "lambda mu nu xi omicron pi rho sigma", "north south east west"))
    b, c = b[40:], c[50:] + " quite another text of some words"
    schema = "doc_id bigint, text string, sig string, __node int"
    rows = [(1, a, "x", 1), (2, a, "y", 2), (2, b, "z", 3), (3, c, "u", 4), (5, c, "v", 5), (5, c, "v", 5), (None, a, "w", 6), (7, None, "k", 7), (7, "", "l", 8), (8, b, "m", 9)]
    got = minhash.distinct_documents(spark.createDataFrame(rows, schema).withColumnRenamed("__node", "rep"))
    assert sorted(tuple(r)[:2] for r in got.where("doc_id is not null").collect() if r.text) == [(1, a), (2, b), (3, c)]
    assert sorted(map(str, (r.text for r in got.where("doc_id = 7").collect()))) == ["", "None"]
    assert got.where("doc_id is null").count() == 1
    assert minhash.distinct_documents(spark.createDataFrame([], schema.replace("__node", "rep"))).count() == 0


def test_links_of_repeated_ids_stay_apart(spark):
    rng = np.random.default_rng(4)
    v, w = rng.normal(size=8).tolist(), rng.normal(size=8).tolist()
    near = lambda x, k: [y + 1e-4 * k for y in x]
    rows = [(5, v, "a"), (6, near(v, 1), "a"), (8, near(v, 2), "a"), (5, near(v, 3), "b"), (9, near(v, 4), "b"), (6, w, "a"), (11, near(w, 1), "a")]
    frame = spark.createDataFrame([(*r, "k", 1, 2) for r in rows], "vec_id bigint, embedding array<double>, label string, key string, rep int, weight int")
    got = Counter((r.vec_id, r.n_links) for r in embed_dedup.near_vectors(frame).collect())
    assert got == Counter([(5, 2), (6, 2), (8, 2), (5, 1), (9, 1), (6, 1), (11, 1)])
    assert {r.component_id for r in embed_dedup.near_vectors(frame).collect()} == {5}


def test_ids_that_no_round_number_divides(spark, monkeypatch):
    """Audited queries are there whatever the ids; labels smaller than the least number of them are scanned."""
    rows = [(2 * r[0] + 1 if r[0] is not None else None, r[1], r[2] if r[2] != 2 or r[0] is None else r[0] % 40 + 2) for r in vectors(3)]
    want = plain_links(rows)
    monkeypatch.setattr(embed_dedup, "SHARD", 300)
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embed_dedup.near_vectors(frame).collect() if r.vec_id is not None}
    assert got == want
