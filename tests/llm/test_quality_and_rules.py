from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from meterline.llm import quality_gbt, quality_rules
from tests.llm.conftest import FOLDER, odd_documents, rows_of

LABELS = "doc_id bigint, quality int, toxic int"


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame(rows_of("labels"), LABELS)


def measured(text: str | None) -> dict:
    """Straight from the wording of the rules."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    n = len(words)
    return {
        "n_words": n,
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
        "n_dup_lines": repeated,
        "n_repeat_words": len(inside),
        "base_failed": n < 10 or 100 * len(inside) > 20 * n,
    }


def test_ledger_equals_plain_rules(spark, documents, odd):
    for frame, rows in ((spark.createDataFrame([r[:2] for r in documents], "doc_id bigint, text string"), documents), (odd, odd_documents())):
        got = quality_rules.apply_policy(quality_rules.ledger(frame)).collect()
        want = Counter((r[0], *measured(r[1]).values()) for r in rows)
        found = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, bool(r.failed & quality_rules.BASE)) for r in got)
        assert found == want
        assert all(not r.kept for r in got if r.failed & quality_rules.BASE)


def test_policies_keep_good_documents(spark, documents):
    quality = {r[0]: r[1] for r in rows_of("labels")}
    frame = spark.createDataFrame([r[:2] for r in documents], "doc_id bigint, text string")
    rows = quality_rules.apply_policy(quality_rules.ledger(frame)).collect()
    good = [r for r in rows if quality.get(r.doc_id) == 1]
    bad = [r for r in rows if quality.get(r.doc_id) == 0]
    # short documents fail the base rule whatever their label
    assert np.mean([r.kept or r.n_words < 10 for r in good]) > 0.97
    assert np.mean([not r.kept for r in bad]) > 0.5


def test_ablation_counts_bits(spark, documents):
    frame = spark.createDataFrame([r[:2] for r in documents], "doc_id bigint, text string")
    rows = quality_rules.ledger(frame)
    failed = [r.failed for r in rows.select("failed").collect()]
    mask = quality_rules.POLICIES[3]
    for r in quality_rules.ablation(rows, 3).collect():
        bit = quality_rules.BIT[r.rule]
        assert r.n_failed == sum(bool(f & bit) for f in failed)
        assert r.n_only == sum(f & mask == bit for f in failed)
        assert r.n_kept_without == sum(f & mask & ~bit == 0 for f in failed)


def test_quality_on_held_out(spark, documents, labels):
    quality = {r[0]: r[1] for r in rows_of("labels")}
    frame = spark.createDataFrame([r[:2] for r in documents], "doc_id bigint, text string")
    rows = quality_gbt.score_quality(frame, labels).collect()
    assert len(rows) == len(documents)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    held = [(r.predicted, quality[r.doc_id]) for r in rows if r.held_out and r.doc_id in quality]
    assert np.mean([p == y for p, y in held]) > 0.93
    kept = quality_gbt.keep_good(frame, labels)
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if r.predicted}


def test_quality_of_odd_documents(spark, odd, none, labels):
    assert quality_gbt.score_quality(odd, labels).count() == len(odd_documents())
    assert quality_gbt.score_quality(none, labels).count() == 0
    empty = spark.createDataFrame([], LABELS)
    assert {r.score for r in quality_gbt.score_quality(odd, empty).collect()} == {0.5}
    kept = quality_gbt.keep_good(odd, empty)
    assert kept.columns == odd.columns and kept.count() == len(odd_documents())
    twice = spark.createDataFrame([(4, 1, 0), (4, 0, 0), (5, None, 1), (None, 1, 1)], LABELS)
    assert len({r.score for r in quality_gbt.score_quality(odd, twice).collect()}) == 1


def test_trees_walk_like_plain_trees():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, len(quality_gbt.NAMES))).astype(np.float32)
    y = ((x[:, 0] > 0.2) ^ (x[:, 3] > 0)).astype(float)
    forest = quality_gbt.fit(x, y)

    def walk(row):
        total = forest.base
        for feature, limit, value in zip(forest.feature, forest.limit, forest.value, strict=True):
            at = 0
            while 2 * at + 1 < len(value):
                at = 2 * at + 1 + int(row[feature[at]] > limit[at])
            total += value[at]
        return 1 / (1 + np.exp(-total))

    score = forest.score(x)
    assert np.allclose(score[:200], [walk(r) for r in x[:200]])
    assert np.mean((score > 0.5) == y) > 0.95
