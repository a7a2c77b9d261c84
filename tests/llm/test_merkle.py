from __future__ import annotations

import random
import zlib
from hashlib import sha256

import pytest

from meterline.llm import merkle
from tests.llm.conftest import SCHEMA, odd_documents

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row, text=None):
    doc_id, own, lang, source, n_chars = row
    shown = [doc_id, source, lang, n_chars, own if text is None else text]
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in shown])


def plain_tree(nodes):
    """Root, and per node the list of (place, run) on its way, all levels written out."""
    paths, below = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = [range(i, min(i + 8, len(nodes))) for i in range(0, len(nodes), 8)]
        for run in runs:
            for place, k in enumerate(run):
                for i in below[k]:
                    paths[i].append((place, [nodes[j] for j in run]))
        below = [[i for k in run for i in below[k]] for run in runs]
        nodes = [h(*[nodes[j] for j in run]) for run in runs]
    return nodes[0], paths


def plain(rows):
    trees = {}
    for row in rows:
        trees.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf(row), row))
    names = sorted(trees, key=lambda v: (v is not None, (v or "").encode()))
    grown = {name: plain_tree([x[2] for x in sorted(trees[name], key=lambda x: x[:3])]) for name in names}
    root, top = plain_tree([grown[n][0] for n in names])
    out = []
    for n, name in enumerate(names):
        for (_, _, own, row), path in zip(sorted(trees[name], key=lambda x: x[:3]), grown[name][1], strict=True):
            now, siblings, hit = own, [], row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
            if hit and row[1] is not None:
                now = leaf(row, row[1].translate(UPPER))
            for place, run in path + top[n]:
                others = run[:place] + run[place + 1 :]
                siblings += others
                now = h(*run[:place], now, *run[place + 1 :])
            out.append((row[0], own, grown[name][0], root, h(*siblings), now, now == root))
    return sorted(out, key=str)


def ours(docs):
    return sorted(map(tuple, merkle.verify(merkle.manifest(docs, merkle.tampered_text())).collect()), key=str)


def test_odd_rows_and_clashing_columns(odd):
    assert ours(odd.drop("node").withColumnRenamed("rep", "node").withColumnRenamed("size", "at")) == plain(odd_documents())


def test_an_empty_table_has_no_proofs(none):
    assert ours(none) == []


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65])
def test_sizes_around_whole_runs(spark, n):
    rows = [(i, f"Text {i}", "en" if i % 9 else None, "s", i) for i in range(n)]
    assert ours(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_trees_of_many_blocks(spark, monkeypatch):
    # three rounds of blocks and more trees than a block holds, as with blocks of 512 beyond 262,144 rows
    monkeypatch.setattr(merkle, "HEIGHT", 1)
    monkeypatch.setattr(merkle, "BLOCK", 8)
    rng = random.Random(1)
    rows = [(rng.randrange(3000), f"T {rng.random()}", rng.choice(["en"] * 60 + [f"l{k}" for k in range(20)]), None, 1) for _ in range(1500)]
    assert ours(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


@pytest.mark.parametrize("n", [511, 512, 513, 1100, 4097])
def test_witnesses_grow_with_appends(n):
    hashes = [sha256(str(i).encode()).digest() for i in range(n)]
    tree = merkle.Appender()
    for i, node in enumerate(hashes):
        tree.append(node)
        assert sum(len(run) for run in tree.open) <= 7 * len(tree.open)  # nothing is kept but open runs
    root = tree.close()
    expected, paths = plain_tree([x.hex() for x in hashes])
    assert root.hex() == expected
    assert all(merkle.fold(x, bytes(w)) == root for x, w in zip(hashes, tree.witness, strict=True))
    assert [[at for at, _ in merkle.steps(bytes(w))] for w in tree.witness] == [[at for at, _ in p] for p in paths]
    assert merkle.fold(hashes[0], bytes(tree.witness[1])) != root


def test_a_manifest_without_a_claim_is_verified(spark):
    rows = [(i, f"text {i}", "en", "s", i) for i in range(20)]
    got = merkle.verify(merkle.manifest(spark.createDataFrame(rows, SCHEMA))).collect()
    assert all(r.verified for r in got) and len({r.root for r in got}) == 1
