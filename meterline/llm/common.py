"""Helpers shared by the operators: words, hashes, hold-out, global ranks."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterline.session import cut, small_buffers

#: Words are maximal runs of anything but the six ASCII blanks; ``bytes.split()`` cuts at the same six.
WORD = r"[^\x20\x09-\x0D]+"
#: Words whose hash a worker remembers at most; the memory is emptied beyond, results do not depend on it.
REMEMBERED = 200_000
BLANKS = b" \t\n\r\x0b\x0c"


#: Rows of a few numbers each that are broadcast at most; longer tables are joined.
SMALL_TABLE = 100_000
#: Rows of whole texts that a Python worker is handed at a time; it bounds its memory, results do not depend on it.
BATCH = "250"


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    small_buffers(spark)
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % modulus


class WordHashes(dict):
    """xxh64 of a word's bytes, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_KEPT: dict[str, object] = {}


def remembered(name: str, make: Callable[[], object]):
    """What this worker process keeps from one task to the next; of several such things only the last one asked for."""
    if name not in _KEPT:
        _KEPT.clear()
        give_back()
        _KEPT[name] = make()
    return _KEPT[name]


def give_back() -> None:
    """Return free memory of this process to the machine; a worker process outlives the operators it worked for."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # there with the GNU C library
    if trim is not None:
        trim(0)


def word_hashes() -> WordHashes:
    return remembered("hashes", WordHashes)


_MIX = np.uint64(0x9E3779B97F4A7C15)  # odd, from the golden ratio


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit (two multiply-shift rounds)."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * _MIX
    return x ^ (x >> np.uint64(32))


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words; the order of the words counts. Fewer words: one run of them all."""
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(width, n)
    out = np.full(n - width + 1, np.uint64(width), np.uint64)
    for i in range(width):
        out = mixed(out * _MIX + hashes[i : n - width + 1 + i])
    return out


def map_texts(
    rows: DataFrame,
    work: Callable[[list[bytes]], dict[str, object]],
    schema: str,
    keys: tuple[str, ...] = ("doc_id",),
    text: str = "text",
) -> DataFrame:
    """The key columns and what ``work`` gives for the whole texts of a batch (UTF-8; null counts as empty).

    ``schema`` names the columns of ``work`` only. Only the keys and the text are read.
    """
    small_batches(rows.sparkSession)
    kinds = dict(rows.select(*keys).dtypes)
    head = ", ".join(f"`{k}` {kinds[k]}" for k in keys)
    source = rows.select(*keys, F.coalesce(F.col(text), F.lit("")).cast("binary").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = work(batch.column(len(keys)).to_pylist())
            columns = [batch.column(i) for i in range(len(keys))] + [pa.array(v) for v in got.values()]
            yield pa.RecordBatch.from_arrays(columns, [*keys, *got])
        give_back()  # the worker waits while steps without Python run

    return source.mapInArrow(run, f"{head}, {schema}")


def most_frequent(counts: DataFrame, n: str, most: int) -> DataFrame:
    """The rows of greatest ``n``, at most ``most``: all above the level that a histogram of some thousand levels tells.

    Levels are the numbers up to 1,024 and 64 to each doubling beyond. A level is taken whole or not at all, so no task sorts
    the rows; where the highest level alone has too many rows, none is taken.
    """
    level = F.when(F.col(n) <= 1024, F.col(n)).otherwise(1024 + F.floor(64 * F.log2(F.col(n) / 1024))).cast("long")
    for row in sorted(counts.groupBy(level.alias("level")).agg(F.count("*").alias("rows")).collect(), reverse=True):
        if row.rows > most:
            return counts.where(level > row.level)
        most -= row.rows
    return counts


def small_table(rows: DataFrame, label: str) -> DataFrame:
    """A reduced table, written once, that joins by broadcast if it has few rows."""
    held = cut(rows, label)
    return F.broadcast(held) if held.count() <= SMALL_TABLE else held


def by_size(texts: list[bytes], most: int = 2_000_000) -> Iterator[list[bytes]]:
    """``texts`` in parts of at most ``most`` bytes, or one text each; words of a part take many times its size."""
    part, size = [], 0
    for text in texts:
        if part and size + len(text) > most:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part


def together(batches: Iterator[pa.RecordBatch], most: int, column: int = 1) -> Iterator[list[pa.RecordBatch]]:
    """Batches whose texts make about ``most`` bytes; the more there are, the fewer of their words are distinct."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column(column).nbytes
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def sorted_slices(rows: DataFrame, order: list[str], label: str) -> DataFrame:
    """``rows`` in the given order, written once; ``__slice`` and ``__inside`` say where a row stands.

    One range shuffle. No nulls in the columns of ``order``.
    """
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    held = cut(placed.withColumn("__at", F.monotonically_increasing_id()), label)
    inside = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    return held.withColumns({"__slice": F.shiftright("__at", 33), "__inside": inside}).drop("__at")


def ranked(held: DataFrame, group: list[str]) -> DataFrame:
    """``sorted_slices`` whose order begins with ``group``, with ``__rank``: the place, from 0, in the row's group.

    Only the counts of the slices are added up, so a group that holds most rows is ranked in parallel. The
    counts, about one row per slice and per group, are broadcast if they are few, and joined otherwise.
    """
    counts = held.groupBy(*group, "__slice").agg(F.count("*").alias("__n"), F.min("__inside").alias("__first"))
    before = Window.partitionBy(*group).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    start = (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).alias("__start")
    starts = small_table(counts.select(*group, "__slice", start), "starts")
    return held.join(starts, [*group, "__slice"]).withColumn("__rank", F.col("__inside") + F.col("__start")).drop("__start")
