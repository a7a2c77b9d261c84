from __future__ import annotations

import random
from collections import Counter
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from meterline.llm import common, sentencepieces
from meterline.llm.queries import QUERIES
from tests.llm.conftest import FOLDER, SCHEMA, odd_documents

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
HOSTILE = [
    "", " ", "  ", "   ", " a", "a ", "a  ", "  a   b  ", "▁", "▁▁ ▁", "x▁y", "a▁", "▁ a", "\ta\nb\r\n", "a\x00b", "<s> hi </s>", "<0x41> <unk>",
    "日本 語​", "é é", "👩‍👩‍👧 x", "﻿", " a ", "x" * 5000, " " * 700, "ab  " * 300, "\udbff".encode("utf-8", "ignore").decode(),
]


def expected(text):
    ids = LIBRARY.encode(text or "", add_bos=True, add_eos=True)
    return len(ids), sha256(np.array(ids, "<u4").tobytes()).hexdigest(), sha256(LIBRARY.decode(ids).encode()).hexdigest()


def check(got, rows):
    found = Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got)
    assert found == Counter((r[0], *expected(r[1])) for r in rows)


@pytest.mark.parametrize("head", [0, 5, sentencepieces.HEAD])
def test_hostile_texts(spark, head):
    rng = random.Random(7)
    mixed = ["".join(rng.choice([" ", " ", "▁", "a", "bc", "the", "é", "漢", "\n", "🙂", "\x01"]) for _ in range(rng.randrange(60))) for _ in range(400)]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(HOSTILE + mixed)]
    check(sentencepieces.digests(sentencepieces.encode(spark.createDataFrame(rows, SCHEMA), head=head)).collect(), rows)


def test_odd_rows_and_clashing_columns(odd):
    check(sentencepieces.digests(sentencepieces.encode(odd.withColumnRenamed("rep", "ids").withColumnRenamed("size", "chunk"))).collect(), odd_documents())


def test_an_empty_table(none):
    assert sentencepieces.digests(sentencepieces.encode(none)).collect() == []


def test_the_whole_table(spark, documents):
    check(QUERIES["op12_sentencepiece"](spark, FOLDER).collect(), [(r[0], r[1]) for r in documents])


def test_chunks_are_counted_and_segmented_once(spark):
    rows = [(1, "a b a", "en", "s", 1), (2, "a  c", "en", "s", 1), (3, None, "en", "s", 1)]
    counts = sentencepieces.chunk_counts(spark.createDataFrame(rows, SCHEMA))
    assert {r.chunk: r.n for r in counts.collect()} == {"a": 3, "b": 1, " c": 1}
    ids = {x: LIBRARY.encode(x) for x in ("a", "b", " c")}
    # of one frequency all are taken or none, and never more than asked for
    for head, chunks in [(0, []), (1, ["a"]), (2, ["a"]), (3, ["a", "b", " c"])]:
        table = sentencepieces.chunk_table(counts, head=head).collect()
        assert {r.chunk: np.frombuffer(r.ids, "<u4").tolist() for r in table} == {x: ids[x] for x in chunks}


def test_the_most_frequent_by_levels(spark):
    rng = np.random.default_rng(1)
    n = np.unique(np.concatenate([rng.integers(1, 2000, 500), (rng.pareto(0.3, 500) * 100).astype(np.int64).clip(1, 10**15)]))
    counts = spark.createDataFrame([(int(x),) for x in n], "n bigint")
    for most in (0, 1, 10, 300, len(n)):
        got = sorted(r.n for r in common.most_frequent(counts, "n", most).collect())
        assert len(got) <= most and got == sorted(n.tolist())[len(n) - len(got) :]
        assert len(got) >= min(most, len(n)) - 40  # a level holds few of them


def test_decoding_restores_texts(spark):
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(HOSTILE) if "▁" not in t]
    got = sentencepieces.decode(sentencepieces.encode(spark.createDataFrame(rows, SCHEMA))).collect()
    assert {r.doc_id: r.decoded for r in got} == {r[0]: r[1] for r in rows}


def test_pieces_that_cross_markers_make_whole_texts_chunks():
    pieces = object.__new__(sentencepieces.Pieces)
    pieces.whole = True
    assert pieces.chunks("a b") == ["a b"] and pieces.chunks("") == []
