"""Log-likelihood of whole documents under a gated recurrent language model trained on the corpus.

1. Every word of every learning document is counted (word, count), however many there are.
2. The most frequent words become symbols of their own, all others one of ``gru.TAIL_CLASSES`` symbols that follow from
   their ending. Within such a class a word has its smoothed share of the class's counts.
3. The words of every document are looked up once; what the counts tell, and the symbols, are kept for the steps that follow.
   Every learning document is cut into consecutive spans of ``SPAN`` tokens, each with the symbol before it, so every
   token is learned from, the end too. Replicas, one per ``PER_REPLICA`` documents, run truncated backpropagation over
   their spans in a fixed order, their weights are averaged, by the tokens they learned from, and the next round starts
   from the average. The rounds
   share the spans out: together they are one pass over all tokens.
4. Every document is scored whole, the state carried from window to window. Counts of the ``LEXICON`` most frequent words
   are broadcast (a bound on rows, not on what is counted); the counts of all other words that occur come by a join.

The unigram base uses the exact counts of all words. Null and empty texts have one token, the end. Without learning
documents the base is that of empty counts and the model is uniform over its classes. Repeated rows are scored
one by one. An empty table gives no rows, texts of any length are scored whole. Only doc_id and text are read, whatever other
columns there are.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm import gru
from meterline.llm.common import mixed, most_frequent, remainder, remembered, small_batches, together
from meterline.session import cut

HOLD_OUT, HELD = 10, 0
#: Words whose counts are broadcast; all others are joined.
LEXICON = 400_000
SPAN, PER_REPLICA, ROUNDS, BLOCK = 128, 4000, (0.05, 0.025), 256
#: Rows of symbols that are handed on at a time.
ROWS = 250
#: Tokens that a worker scores in step, bytes of texts that it cuts into words at a time, words that it counts before it tells.
TOGETHER, TEXTS, COUNTED = 5_000_000, 8_000_000, 1_000_000
END, START = b"", np.zeros(1, "<i2").tobytes()
#: Parts that counted words are dealt to, and what the places of bytes count for in that.
BUCKETS, _FACTORS = 1024, np.random.default_rng(7).integers(0, 1 << 63, 256).astype(np.uint64)
_CLOSING = ".,;:!?"


def tail_symbols(words: pa.Array) -> np.ndarray:
    """Symbols of rare words (binary)."""
    bare = pc.ascii_rtrim(words.view(pa.string()), characters=_CLOSING).view(pa.binary())
    endings = pc.binary_slice(bare, -3).dictionary_encode()
    symbols = [gru.HEAD + zlib.crc32(x) % gru.TAIL_CLASSES for x in endings.dictionary.to_pylist()]
    return np.array(symbols, np.int16)[endings.indices.to_numpy()]


def _tail_column():
    """The same as an expression over ``word``."""
    bare = "cast(trim(TRAILING '.,;:!?' FROM cast(word AS string)) AS binary)"
    return F.expr(f"crc32(if(length({bare}) <= 3, {bare}, substring({bare}, length({bare}) - 2, 3))) % {gru.TAIL_CLASSES}")


def _texts(docs: DataFrame, *more) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"), *more)


def _cut_up(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Of some texts (binary) the distinct lower-case words, for each place the number of its word, where each text begins.

    The ends of a text may have an empty word; a text without words has nothing else.
    """
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.view(pa.string())))
    table = lists.flatten().dictionary_encode()
    return table.dictionary.view(pa.binary()), table.indices.to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()


def word_counts(docs: DataFrame) -> DataFrame:
    """word, c over all texts; the empty word counts the ends."""

    nothing = pa.table({"word": pa.array([], pa.binary()), "c": pa.array([], pa.int64())})

    def summed(tables: list[pa.Table]) -> pa.Table:
        return pa.concat_tables(tables).group_by("word").aggregate([("c", "sum")]).rename_columns(["word", "c"])

    def dealt(held: pa.Table) -> pa.RecordBatch:
        words, c = held["word"].combine_chunks(), held["c"].to_numpy()
        bucket = (_spread(words) % np.uint64(BUCKETS)).astype(np.uint16)
        order = np.argsort(bucket, kind="stable")
        buckets, first = np.unique(bucket[order], return_index=True)
        ends = np.append(first[1:], len(order))
        lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(order)), pa.int32()), words.take(pa.array(order)).view(pa.string()))
        columns = [pa.array(buckets, pa.int32()), pc.binary_join(lists, " ").view(pa.binary()), _blobs(c[order], ends)]
        return pa.RecordBatch.from_arrays(columns, ["bucket", "words", "c"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ends = nothing, 0
        for some in together(batches, TEXTS):
            words, place, _ = _cut_up(pa.concat_arrays([batch.column(1) for batch in some]))
            found = pa.table({"word": words, "c": np.bincount(place, minlength=len(words))})
            held = summed([held, found.filter(pc.greater(pc.binary_length(found["word"]), 0))])
            ends += sum(batch.num_rows for batch in some)
            if len(held) > COUNTED:
                yield dealt(held)
                held = nothing
        if len(held):
            yield dealt(held)
        if ends:
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([END], pa.binary()), _blobs(np.array([ends]), np.array([1]))], ["bucket", "words", "c"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [nothing]
        for batch in batches:
            words = pc.ascii_split_whitespace(batch.column(1).view(pa.string())).flatten().view(pa.binary())
            held.append(pa.table({"word": words, "c": np.frombuffer(b"".join(batch.column(2).to_pylist()), np.int64)}))
        yield from summed(held).to_batches(max_chunksize=10_000)

    # a row has many words, as they have no blanks; there are fewer rows to shuffle than words
    rows = _texts(docs).mapInArrow(count, "bucket int, words binary, c binary")
    return rows.repartition("bucket").mapInArrow(merge, "word binary, c bigint")


def _spread(words: pa.Array) -> np.ndarray:
    """A hash of each word (none empty)."""
    ends = np.cumsum(pc.binary_length(words).to_numpy().astype(np.int64))
    starts = np.append(0, ends[:-1])
    first = np.frombuffer(words.buffers()[1], np.int32)[words.offset]
    data = np.frombuffer(words.buffers()[2], np.uint8)[first : first + ends[-1]]
    place = np.arange(len(data)) - np.repeat(starts, ends - starts)
    return mixed(np.add.reduceat(_FACTORS[place % len(_FACTORS)] * (data + np.uint64(1)), starts))


@dataclass
class Lexicon:
    """What a task needs to know of the counts: the frequent words with theirs, and totals."""

    words: pa.Array
    counts: np.ndarray
    total: int
    distinct: int
    tail_total: np.ndarray
    tail_distinct: np.ndarray
    ends: int
    name: str = field(default_factory=lambda: uuid.uuid4().hex)

    def symbol_counts(self) -> np.ndarray:
        out = np.zeros(gru.SYMBOLS)
        out[0] = self.ends
        head = self.counts[: gru.HEAD - 1]
        out[1 : 1 + len(head)] = head
        out[gru.HEAD :] = self.tail_total
        return out


class Reader:
    """A lexicon made ready for reading texts."""

    def __init__(self, lexicon: Lexicon) -> None:
        self.lexicon = lexicon
        self.words = lexicon.words.view(pa.string())
        self.symbols = tail_symbols(lexicon.words)
        self.symbols[: gru.HEAD - 1] = np.arange(1, 1 + min(len(self.symbols), gru.HEAD - 1))
        c = lexicon.counts + 0.1
        self.base_total = np.log10(lexicon.total + 0.1 * (lexicon.distinct + 1))
        self.base = np.log10(c) - self.base_total
        self.tail_log_total = np.log10(lexicon.tail_total + 0.1 * (lexicon.tail_distinct + 1))
        self.inside = np.zeros(len(self.words))
        rare = np.arange(len(self.words)) >= gru.HEAD - 1
        self.inside[rare] = np.log10(c[rare]) - self.tail_log_total[self.symbols[rare] - gru.HEAD]
        self.end_base = float(np.log10(lexicon.ends + 0.1) - self.base_total)

    def look_up(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of distinct words: whether the lexicon has them, their symbols, and their parts of base and score.

        What the counts of rare words add comes later; their denominators are known here.
        """
        place = pc.fill_null(pc.index_in(words.view(pa.string()), value_set=self.words), -1).to_numpy()
        inside, rare = place >= 0, np.flatnonzero(place < 0)
        symbols, base, score = np.empty(len(words), np.int16), np.empty(len(words)), np.empty(len(words))
        for values, known in ((symbols, self.symbols), (base, self.base), (score, self.inside)):
            values[inside] = known[place[inside]]
        symbols[rare] = tail_symbols(words.take(pa.array(rare)))
        base[rare] = -self.base_total
        score[rare] = -self.tail_log_total[symbols[rare] - gru.HEAD]
        return inside, symbols, base, score


def reader(lexicon: Lexicon) -> Reader:
    return remembered(f"lexicon {lexicon.name}", lambda: Reader(lexicon))


def lexicon_of(counts: DataFrame) -> Lexicon:
    """The most frequent words and the totals; the classes of rare words are summed up over all counts."""
    words = counts.where(F.length("word") > 0)
    first = words.orderBy(F.desc("c"), "word").limit(gru.HEAD - 1).toArrow()
    both = pa.concat_tables([first, most_frequent(words, "c", LEXICON - gru.HEAD).toArrow().cast(first.schema)])
    top = both.group_by("word").aggregate([("c", "max")]).sort_by([("c_max", "descending"), ("word", "ascending")])
    kind = F.when(F.length("word") > 0, _tail_column()).otherwise(gru.TAIL_CLASSES)  # the last one: the ends
    n, v = np.zeros(gru.TAIL_CLASSES + 1, np.int64), np.zeros(gru.TAIL_CLASSES + 1, np.int64)
    for row in counts.groupBy(kind.cast("int").alias("k")).agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect():
        n[row.k], v[row.k] = row.n, row.v
    total, distinct, ends = int(n.sum()), int(v.sum()), int(n[-1])
    names, c = top["word"].combine_chunks(), top["c_max"].to_numpy()
    frequent = tail_symbols(names[: gru.HEAD - 1]) - gru.HEAD
    np.subtract.at(n, frequent, c[: gru.HEAD - 1])
    np.subtract.at(v, frequent, 1)
    return Lexicon(names, c, total, distinct, n[:-1], v[:-1], ends)


def read_texts(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Per row what the lexicon tells, ``rare``: the words that it does not have, with their numbers, and the symbols.

    ``symbols`` are the bytes of 16-bit numbers; ``mark`` is the hash of text and id that deals out the spans.
    """
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, base double, inside double, mark bigint, symbols binary, rare array<binary>, times array<int>"
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = reader(shared.value)
        for some in together(batches, TEXTS):
            ids, texts, held_out = (pa.concat_arrays([batch.column(i) for batch in some]) for i in range(3))
            words, place, starts = _cut_up(texts)
            inside, symbols, base, score = known.look_up(words)
            empty = pc.equal(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
            for values in (inside, base, score):
                values[empty] = 0
            n_known, base, score = (np.add.reduceat(x[place], starts[:-1]) for x in (inside.astype(np.int64), base, score))
            row = np.repeat(np.arange(len(texts)), np.diff(starts))
            there = np.flatnonzero(~empty[place])
            row, place = row[there], place[there]
            size = np.bincount(row, minlength=len(texts)) + 1
            ends = np.cumsum(size)
            out = np.zeros(ends[-1], "<i2")
            out[np.arange(len(row)) + row] = symbols[place]
            # rare words by row and word
            rare = np.flatnonzero(~inside[place])
            key, times = np.unique(row[rare] * len(words) + place[rare], return_counts=True)
            upto = pa.array(np.searchsorted(key, np.arange(len(texts) + 1) * len(words)), pa.int32())
            own = [xxhash.xxh64_intdigest(t, zlib.crc32(str(i).encode())) for i, t in zip(ids.to_pylist(), texts.to_pylist(), strict=True)]
            end = int(known.lexicon.ends > 0)
            columns = [ids, held_out, pa.array(size), pa.array(n_known + end), pa.array(base + known.end_base), pa.array(score)]
            columns += [pa.array(np.array(own, np.uint64).view(np.int64)), _blobs(out, ends)]
            columns += [pa.ListArray.from_arrays(upto, x) for x in (words.take(pa.array(key % len(words))), pa.array(times, pa.int32()))]
            batch = pa.RecordBatch.from_arrays(columns, names)
            yield from (batch.slice(at, ROWS) for at in range(0, len(batch), ROWS))

    return _texts(docs, (remainder("doc_id", HOLD_OUT) == HELD).alias("held_out")).mapInArrow(run, schema)


def _blobs(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Runs of ``values`` as bytes."""
    offsets = (np.append(0, ends) * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def spans(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """All symbols of all documents in spans: one symbol before (0 at the start of a text) and at most ``SPAN`` to learn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            symbols = pa.array([np.frombuffer(x, "<i2") for x in batch.column(1).to_pylist()], pa.list_(pa.int16()))
            yield pa.RecordBatch.from_arrays([batch.column(0), symbols], ["mark", "symbols"])

    return spans_of(read_texts(docs, lexicon)).mapInArrow(run, "mark bigint, symbols array<smallint>")


def spans_of(read: DataFrame) -> DataFrame:
    """The same from ``read_texts``, symbols as bytes as there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, place = [], []
            for own, text in zip(batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_pylist(), strict=True):
                starts = range(0, len(text), 2 * SPAN)
                text = START + text
                out.extend(text[at : at + 2 * SPAN + 2] for at in starts)
                place.append(own + np.arange(len(starts), dtype=np.uint64))  # copies under other ids go elsewhere
            mark = mixed(np.concatenate([*place, np.zeros(0, np.uint64)])) >> np.uint64(2)
            yield pa.RecordBatch.from_arrays([pa.array(mark.astype(np.int64)), pa.array(out, pa.binary())], ["mark", "symbols"])

    return read.select("mark", "symbols").mapInArrow(run, "mark bigint, symbols binary")


def trained(rows: DataFrame, lexicon: Lexicon) -> np.ndarray:
    """Averaged parameters after the rounds."""
    theta = gru.initial(lexicon.symbol_counts())
    replicas = max(1, -(-lexicon.ends // PER_REPLICA))
    for turn, rate in enumerate(ROUNDS if lexicon.ends else ()):
        # in a fixed order, so that a replica that is lost and trained again is the same
        dealt = rows.where(F.col("mark") % len(ROUNDS) == turn).repartition(replicas, "mark").sortWithinPartitions("mark")
        start = rows.sparkSession.sparkContext.broadcast(theta)

        def run(batches: Iterator[pa.RecordBatch], start=start, rate=rate) -> Iterator[pa.RecordBatch]:
            trainer, held, learned = gru.Trainer(start.value, rate), [], 0

            def learn() -> None:
                block = np.full((len(held), max(map(len, held))), -1, np.int16)
                for i, x in enumerate(held):
                    block[i, : len(x)] = x
                trainer.learn(block[:, 1:], block[:, 0])
                held.clear()

            for batch in batches:
                for x in batch.column(1).to_pylist():
                    held.append(np.frombuffer(x, "<i2"))
                    learned += len(held[-1]) - 1
                    if len(held) == BLOCK:
                        learn()
            if held:
                learn()
            if trainer.n:
                theta = pa.array([trainer.theta.tolist()], pa.list_(pa.float32()))
                yield pa.RecordBatch.from_arrays([theta, pa.array([float(learned)])], ["theta", "tokens"])

        each = dealt.mapInArrow(run, "theta array<float>, tokens double").select("tokens", F.posexplode("theta").alias("i", "x"))
        mean = each.groupBy("i").agg((F.sum(F.col("x") * F.col("tokens")) / F.sum("tokens")).alias("x")).toArrow()
        theta = theta.copy()  # a round without spans leaves it as it is
        theta[mean["i"].to_numpy()] = mean["x"].to_numpy()
    return theta


def _scored(read: DataFrame, theta: np.ndarray) -> DataFrame:
    """The rows of ``read_texts`` without texts, and ``score``: what lexicon and model tell."""
    parameters = read.sparkSession.sparkContext.broadcast(theta)
    rows = read.drop("mark", "rare", "times", "symbols")
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = gru.Model(gru.shaped(parameters.value))
        held: list[pa.RecordBatch] = []
        texts: list[np.ndarray] = []

        def flush() -> Iterator[pa.RecordBatch]:
            found, at = model.score(texts) / np.log(10), 0
            for batch in held:
                score = pc.add(batch.column("inside"), pa.array(found[at : at + len(batch)]))
                at += len(batch)
                yield pa.RecordBatch.from_arrays([*batch.select(names).columns, score], [*names, "score"])
            held.clear(), texts.clear()

        size = 0
        for batch in batches:
            texts += [np.frombuffer(x, "<i2") for x in batch.column("symbols").to_pylist()]
            size += sum(map(len, texts[-len(batch) :])) if len(batch) else 0
            held.append(batch.drop_columns("symbols"))
            if size > TOGETHER:
                yield from flush()
                size = 0
        if held:
            yield from flush()

    schema = ", ".join(f"`{n}` {k}" for n, k in rows.dtypes)
    return read.select(*names, "symbols").mapInArrow(run, f"{schema}, score double")


def score_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of ``docs``."""
    rows = docs.select("doc_id", "text")
    learning = rows.where(remainder("doc_id", HOLD_OUT) != HELD)
    counts = cut(word_counts(learning), "counts")
    lexicon = lexicon_of(counts)
    read = cut(read_texts(rows, lexicon).withColumn("row", F.monotonically_increasing_id()), "read")
    theta = trained(cut(spans_of(read.where(~F.col("held_out"))), "spans"), lexicon)
    held = cut(_scored(read, theta), "scored")
    rare = read.where(F.size("rare") > 0).select("row", F.explode(F.arrays_zip("rare", "times")).alias("z")).select("row", F.col("z.rare").alias("word"), F.col("z.times").alias("t"))
    met = rare.join(counts.hint("shuffle_hash"), "word", "left")  # each word is there once, so nothing needs an order
    logs = F.col("t") * F.log10(F.coalesce("c", F.lit(0)) + F.lit(0.1).cast("double"))
    sums = met.groupBy("row").agg(F.sum(logs).alias("logs"), F.sum(F.when(F.col("c") > 0, F.col("t")).otherwise(0)).alias("known"))
    out = held.join(sums, "row", "left")
    add = F.coalesce("logs", F.lit(0.0))
    return out.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(lexicon.total).cast("long").alias("train_tokens"),
        (F.col("base") + add).alias("base_score"),
        (F.col("score") + add).alias("score"),
    )
