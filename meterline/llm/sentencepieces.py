"""SentencePiece ids of whole texts by a table of distinct chunks, and texts from ids.

A chunk is a run of white-space markers and the word after it. No piece of the vocabulary holds a marker after another
character (checked when it is loaded), so no merge crosses from one chunk to the next: chunks are segmented
alone and their ids joined by position are the ids of the text. Spark counts the chunks of the whole table, each task its
own distinct ones first; the ``HEAD`` most frequent of the corpus are segmented once, by the library, spread over the
cluster, and their ids go to all tasks, which is bounded. The long tail beyond has a table of distinct chunks in
each batch of documents, segmented once there; a batch is bounded by its size. (A join of the tail would shuffle all texts; see the README.) Ids do not
depend on ``HEAD`` or on the batches. A vocabulary with pieces that cross markers has whole texts for chunks.

A text's ids begin with the begin id and end with the end id; null and empty texts have just those. Decoding is the
library's. Characters without a piece become bytes. Very long texts and words are segmented whole. Repeated rows and ids are encoded row by
row. An empty table gives no rows. Only doc_id and the text are read, whatever other columns there are.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import by_size, map_texts, most_frequent, small_batches
from meterline.session import cut

MODEL = "piece_bpe_32k.model"
MARK = "▁"
#: Chunks whose ids all tasks get, and the distinct chunks that a task counts before it hands its counts on.
HEAD, COUNTED = 400_000, 200_000
#: Distinct chunks that a worker segments at a time.
AT_ONCE = 20_000

_LOADED: dict[str, Pieces] = {}


class Pieces:
    """The library's processor, and how texts are cut for it."""

    def __init__(self, model: str) -> None:
        import os

        import public_tokenizers
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=model if os.sep in model else public_tokenizers.path(model))
        probe = "AÄ ①ﬁＡ é\t x"
        if self.library.normalize(probe) != MARK + probe.replace(" ", MARK):
            raise ValueError("the vocabulary normalizes texts or adds no first marker")
        n = self.library.get_piece_size()
        crossing = re.compile(f"[^{MARK}]{MARK}")
        self.whole = any(crossing.search(self.library.id_to_piece(i)) for i in range(n))
        self.first, self.last = self.library.bos_id(), self.library.eos_id()
        self.mark = self.library.piece_to_id(MARK)

    def chunks(self, text: str) -> list[str]:
        """The chunks of a text, each without its first marker, which the library adds again. Empty text: none."""
        if not text or self.whole:
            return [text] if text else []
        if MARK in text:
            text = text.replace(MARK, " ")
        if "  " not in text and text[0] != " ":
            return text.split(" ")
        return [chunk[1:] for chunk in re.findall(" +[^ ]*", " " + text)]

    def ids(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks, each id four bytes, the lowest first. A chunk that is one marker alone is empty here."""
        found = []
        for i in range(0, len(chunks), AT_ONCE):
            found += self.library.encode(chunks[i : i + AT_ONCE], num_threads=1)
        return [np.array(ids if chunk else [self.mark], "<u4").tobytes() for chunk, ids in zip(chunks, found, strict=True)]

    def decode(self, ids: bytes) -> str:
        return self.library.decode(np.frombuffer(ids, "<u4").tolist())


def loaded(model: str) -> Pieces:
    if model not in _LOADED:
        _LOADED[model] = Pieces(model)
    return _LOADED[model]


def chunk_counts(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """chunk, n: how often each distinct chunk occurs in all texts."""
    small_batches(docs.sparkSession)
    made = pa.schema([("chunk", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, counts = loaded(model), Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(pieces.chunks(text))
                if len(counts) > COUNTED:
                    yield pa.record_batch([list(counts), list(counts.values())], schema=made)
                    counts.clear()
        yield pa.record_batch([list(counts), list(counts.values())], schema=made)

    parts = docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, "chunk string, n bigint")
    return parts.groupBy("chunk").agg(F.sum("n").alias("n"))


def chunk_table(counts: DataFrame, model: str = MODEL, head: int = HEAD) -> DataFrame:
    """chunk, ids of the most frequent chunks, at most ``head`` (of one frequency all or none), each segmented once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = loaded(model).ids(batch.column(0).to_pylist())
            yield pa.record_batch([batch.column(0), pa.array(ids, pa.binary())], ["chunk", "ids"])

    frequent = cut(most_frequent(cut(counts, "counts"), "n", head).select("chunk"), "frequent")
    return frequent.repartition("chunk").mapInArrow(run, "chunk string, ids binary")


def encode(docs: DataFrame, model: str = MODEL, head: int = HEAD) -> DataFrame:
    """doc_id and ``ids``, four bytes each, the lowest first, with the begin and the end id."""
    known = chunk_table(chunk_counts(docs, model), model, head).toArrow() if head else pa.table({"chunk": [], "ids": []})
    shared = docs.sparkSession.sparkContext.broadcast((known["chunk"].to_pylist(), known["ids"].to_pylist()))
    name = uuid.uuid4().hex

    def work(texts: list[bytes]) -> dict[str, object]:
        pieces, table = loaded(model), _tables(name, shared)
        begin, end = (np.array([i], "<u4").tobytes() for i in (pieces.first, pieces.last))
        out = []
        for part in by_size(texts):
            cut_up = [pieces.chunks(text.decode()) for text in part]
            rest = list(set().union(*cut_up).difference(table))
            tail = dict(zip(rest, pieces.ids(rest), strict=True))
            for chunks in cut_up:
                found = list(map(table.get, chunks))
                if tail and None in found:
                    found = [tail[c] if i is None else i for c, i in zip(chunks, found, strict=True)]
                out.append(begin + b"".join(found) + end)
        return {"ids": pa.array(out, pa.binary())}

    return map_texts(docs, work, "ids binary")


_TABLES: dict[str, dict[str, bytes]] = {}


def _tables(name: str, shared) -> dict[str, bytes]:
    """The broadcast chunks as a dictionary, made once in a worker; an earlier one goes."""
    if name not in _TABLES:
        _TABLES.clear()
        _TABLES[name] = dict(zip(*shared.value, strict=True))
    return _TABLES[name]


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """``encoded`` with ``decoded``, the texts that its ids stand for."""
    fields = ", ".join(f"`{n}` {t}" for n, t in encoded.dtypes)
    at = encoded.columns.index("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [loaded(model).decode(ids) for ids in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"])

    return encoded.mapInArrow(run, f"{fields}, decoded string")


def digests(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256."""
    both = decode(encoded, model)
    return both.select(
        "doc_id",
        F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
