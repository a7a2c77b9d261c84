"""A combine function of the user's own, per key and per session of a key.

The user gives an accumulator (a tuple of the fields ``state``) and four functions: create one, add a row, merge two,
extract the result. Each task adds its own rows first and hands on one accumulator per key (mapInArrow), so what is
shuffled is accumulators, not rows. They are merged in a tree: first per key and branch, then per key, both as a
fold over sorted accumulators, so a key that every task has seen is no burden on one task and no group is held in memory.

``merge`` must be associative and commutative: the order of rows and accumulators is not fixed. Keys are not floating-point
numbers. Null keys are a key. Without rows there are no results, also without keys.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.functions import scalars as S
from meterline.operators.sessions import mark_sessions

# the functions travel to the workers by value, so a cluster needs no copy of this package for them
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Accumulators that a task holds before it hands them on, and the branches of a key per level of the tree.
HELD, FAN = 100_000, 32


@dataclass(frozen=True)
class Combine:
    """``add`` gets an accumulator and the tuple of the columns ``reads``; ``state`` and ``out`` are field lists.

    ``merge`` gets two accumulators, ``extract`` one, and gives the tuple of ``out``.
    """

    reads: tuple[str, ...]
    state: str
    out: str
    create: Callable[[], tuple]
    add: Callable[[tuple, tuple], tuple]
    merge: Callable[[tuple, tuple], tuple]
    extract: Callable[[tuple], tuple]


def names(fields: str) -> list[str]:
    return [f.split()[0] for f in fields.split(", ")]


def _key_fields(df: DataFrame, keys: list[str]) -> str:
    kinds = dict(df.dtypes)
    if any(kinds[k] in ("float", "double") for k in keys):
        raise ValueError("keys are not floating-point numbers")
    return "".join(f"{k} {kinds[k]}, " for k in keys)


def _columns(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _arrow(df: DataFrame) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(df.schema)


def partials(df: DataFrame, keys: list[str], fn: Combine) -> DataFrame:
    """Accumulators of the rows of each task, per key, and the branch of the tree that they belong to."""
    n, schema = len(keys), f"{_key_fields(df, keys)}{fn.state}"
    arrow = _arrow(df.sparkSession.createDataFrame([], schema))
    create, add, limit = fn.create, fn.add, HELD

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple] = {}
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                key = row[:n]
                acc = held.get(key)
                held[key] = add(create() if acc is None else acc, row[n:])
            if len(held) > limit:
                yield _columns([(*k, *v) for k, v in held.items()], arrow)
                held.clear()
        yield _columns([(*k, *v) for k, v in held.items()], arrow)

    parts = df.select(*keys, *fn.reads).mapInArrow(run, schema)
    return parts.withColumn("_branch", F.spark_partition_id().cast("long"))


def merged(parts: DataFrame, keys: list[str], fn: Combine, levels: int = 2, fan: int = FAN) -> DataFrame:
    """Results per key of accumulators (columns ``keys``, the state and ``_branch``), merged in a tree of ``levels``."""
    state = names(fn.state)
    for level in reversed(range(levels)):
        branch = F.pmod(F.xxhash64("_branch"), F.lit(fan**level)).cast("long")
        by = [*keys, "_branch"] if level else keys
        rows = parts.withColumn("_branch", branch)
        dealt = rows.repartition(*by) if by else rows.coalesce(1)
        ordered = dealt.sortWithinPartitions(*by) if by else dealt
        parts = ordered.select(*by, *state).mapInArrow(*_fold(ordered, by, fn, last=not level))
    return parts


def _fold(df: DataFrame, by: list[str], fn: Combine, last: bool):
    n, schema = len(by), f"{_key_fields(df, by)}{fn.out if last else fn.state}"
    arrow = _arrow(df.sparkSession.createDataFrame([], schema))
    merge, finish = fn.merge, fn.extract if last else (lambda acc: acc)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, acc = None, None
        for batch in batches:
            done = []
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if row[:n] == key:
                    acc = merge(acc, row[n:])
                else:
                    if key is not None:
                        done.append((*key, *finish(acc)))
                    key, acc = row[:n], row[n:]
            yield _columns(done, arrow)
        if key is not None:
            yield _columns([(*key, *finish(acc))], arrow)

    return run, schema


def combine(df: DataFrame, keys: list[str], fn: Combine, levels: int = 2, fan: int = FAN) -> DataFrame:
    """``keys`` and the fields of ``out`` per key."""
    return merged(partials(df, keys, fn), keys, fn, levels, fan)


# --- sessions ----------------------------------------------------------------

def spanned(fn: Combine) -> Combine:
    """``fn`` with the first and last event time of what it has seen before its own state and result."""
    create, add, merge, extract = fn.create, fn.add, fn.merge, fn.extract

    def put(acc: tuple, row: tuple) -> tuple:
        at = row[0]
        return (at if acc[0] is None else min(acc[0], at), at if acc[1] is None else max(acc[1], at), *add(acc[2:], row[1:]))

    return Combine(
        reads=("event_us", *fn.reads),
        state=f"first_us bigint, last_us bigint, {fn.state}",
        out=f"first_us bigint, last_us bigint, {fn.out}",
        create=lambda: (None, None, *create()),
        add=put,
        merge=lambda a, b: (min(a[0], b[0]), max(a[1], b[1]), *merge(a[2:], b[2:])),
        extract=lambda acc: (*acc[:2], *extract(acc[2:])),
    )


def combine_sessions(df: DataFrame, gap_us: int, fn: Combine, key: str = "ride_id", levels: int = 2, fan: int = FAN) -> DataFrame:
    """``fn`` per session of ``key``: rows less than a gap apart. Rows have ``event_us``.

    Rows of one gap-wide slot of time are always one session, so accumulators are made per slot, sessions are found on
    the slots, and the accumulators of a session's slots are merged in the same tree.
    """
    whole = spanned(fn)
    slots = df.withColumn("slot", S.floor_div(F.col("event_us"), gap_us))
    still = Combine(whole.reads, whole.state, whole.state, whole.create, whole.add, whole.merge, lambda acc: acc)
    per_slot = combine(slots, [key, "slot"], still, levels, fan)
    marked = mark_sessions(per_slot, gap_us, key).withColumn("_branch", F.col("slot"))
    out = merged(marked, [key, "session_start_us"], whole, levels, fan)
    end = (F.col("last_us") + gap_us).alias("session_end_us")
    return out.select(key, "session_start_us", end, *names(fn.out))


# --- ready ones ----------------------------------------------------------------

_POINT = "ts_ms bigint, message_id bigint, latitude float, longitude float, ride_status string"
_READS = ("ts_ms", "message_id", "latitude", "longitude", "ride_status")


def _better(newest: bool):
    sign = -1 if newest else 1

    def better(a: tuple, b: tuple) -> tuple:
        if a[0] is None or b[0] is None:
            return b if a[0] is None else a
        return min(a, b, key=lambda p: (sign * p[0], p[1]))

    return better


def _same(acc: tuple) -> tuple:
    return acc


def _no_point() -> tuple:
    return (None,) * 5


def latest_point() -> Combine:
    """The newest point by payload time; of equal ones the smallest id."""
    better = _better(newest=True)
    return Combine(_READS, _POINT, _POINT, _no_point, better, better, _same)


def pickup_point(status: str = "pickup") -> Combine:
    """The oldest point with this status; no point (nulls) where there is none."""
    better = _better(newest=False)

    def add(acc: tuple, row: tuple) -> tuple:
        return better(acc, row) if row[4] == status else acc

    return Combine(_READS, _POINT, _POINT, _no_point, add, better, _same)


def ride_totals() -> Combine:
    """Points, money (whole nano units, then dollars), and the least and greatest passenger count."""

    def least(a, b):
        return b if a is None else a if b is None else min(a, b)

    def most(a, b):
        return b if a is None else a if b is None else max(a, b)

    def add(acc: tuple, row: tuple) -> tuple:
        amount, riders = row
        return acc[0] + 1, acc[1] + (0 if amount is None else round(amount * 1e9)), least(acc[2], riders), most(acc[3], riders)

    def merge(a: tuple, b: tuple) -> tuple:
        return a[0] + b[0], a[1] + b[1], least(a[2], b[2]), most(a[3], b[3])

    return Combine(
        ("meter_increment", "passenger_count"),
        "n_points bigint, nano bigint, least_riders int, most_riders int",
        "n_points bigint, dollars double, least_riders int, most_riders int",
        lambda: (0, 0, None, None),
        add,
        merge,
        lambda acc: (acc[0], acc[1] / 1e9, *acc[2:]),
    )
