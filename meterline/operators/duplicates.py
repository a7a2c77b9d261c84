"""Re-sent messages: an id counts as known for 30 s after the arrival that made it known.

That memory starts with the first arrival and is not refreshed, so the arrivals of one id
form a chain: a start, its duplicates, the next start, and so on. The chain is found
without gathering the arrivals of an id:

1. copies are reduced to one row per (id, arrival ms), written once and read from there, and an id
   whose last arrival is within the memory of its first needs no more than that;
2. for the other ids, a pause longer than the memory always begins a new start, so their
   arrivals fall into independent runs; a run no longer than the memory has just its first
   arrival as start;
3. in longer runs every arrival points at the first arrival beyond its own memory, and the
   starts are found by following these pointers in doubling steps (joins on id and arrival).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline import constants as K
from meterline.functions import scalars as S
from meterline.operators.joins import salted_join
from meterline.session import cut


def _runs(arrivals: DataFrame, keys: list[str], memory_ms: int) -> DataFrame:
    """(id, slot) -> start and length of its run. At most time-span / memory slots per id."""
    slots = arrivals.groupBy(*keys, "_slot").agg(
        F.min("arrival_ms").alias("slot_first"), F.max("arrival_ms").alias("slot_last")
    )
    order = Window.partitionBy(*keys).orderBy("_slot")
    before = F.lag("slot_last").over(order)
    opens = F.when(before.isNull() | (F.col("slot_first") - before > memory_ms), F.col("slot_first"))
    return (
        slots.withColumn("_opens", opens)
        .withColumn("run_start", F.max("_opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("run_end", F.max("slot_last").over(Window.partitionBy(*keys, "run_start")))
        .withColumn("next_slot_first", F.lead("slot_first").over(Window.partitionBy(*keys, "run_start").orderBy("_slot")))
        .drop("_opens")
    )


def _pointers(long_arrivals: DataFrame, keys: list[str], memory_ms: int) -> DataFrame:
    """Every arrival of a long run with the first arrival of that run beyond its memory (or NULL).

    Arrivals and probes (arrival + memory) are merged per slot, at most two rows per ms of it.
    """
    width = memory_ms + 1
    arrival = long_arrivals.select(*keys, "_slot", F.col("arrival_ms").alias("at"), F.lit(None).cast("bigint").alias("src"))
    probe = long_arrivals.select(
        *keys,
        S.floor_div(F.col("arrival_ms") + memory_ms, width).alias("_slot"),
        (F.col("arrival_ms") + memory_ms).alias("at"),
        F.col("arrival_ms").alias("src"),
    )
    # from the latest down; at equal times the probe comes first, so it sees later arrivals only
    down = Window.partitionBy(*keys, "_slot").orderBy(F.desc("at"), F.asc(F.col("src").isNull()))
    seen = F.min(F.when(F.col("src").isNull(), F.col("at"))).over(down.rowsBetween(Window.unboundedPreceding, 0))
    return (
        arrival.unionByName(probe)
        .withColumn("to", seen)
        .filter(F.col("src").isNotNull())
        .select(*keys, F.col("src").alias("from"), "to", F.col("_slot").alias("probe_slot"))
    )


def arrivals(deliveries: DataFrame, keys: tuple[str, ...] = ("message_id",)) -> DataFrame:
    """(id, arrival ms, copies): the one reduction of the deliveries that everything else is derived from, written once."""
    return cut(deliveries.groupBy(*keys, "arrival_ms").agg(F.count("*").alias("copies")), "arrivals")


def start_arrivals(
    deliveries: DataFrame, keys: tuple[str, ...] = ("message_id",), memory_ms: int = K.DUPLICATE_MEMORY_MS
) -> DataFrame:
    """(id, arrival ms) of every delivery that makes its id known: all others are duplicates."""
    return starts_among(arrivals(deliveries, keys), keys, memory_ms)


def starts_among(came: DataFrame, keys: tuple[str, ...], memory_ms: int = K.DUPLICATE_MEMORY_MS) -> DataFrame:
    """The starts among the rows of ``arrivals``."""
    by = list(keys)
    spans = came.groupBy(*by).agg(F.min("arrival_ms").alias("run_start"), F.max("arrival_ms").alias("run_end"))
    # most ids are heard of for less than the memory: their first arrival is the one start
    firsts = spans.select(*by, F.col("run_start").alias("arrival_ms"))
    longer = cut(spans.filter(F.col("run_end") - F.col("run_start") > memory_ms).select(*by), "longer")
    if longer.isEmpty():
        return firsts
    slotted = came.select(*by, "arrival_ms").withColumn("_slot", _slot(memory_ms))
    spread = cut(salted_join(slotted, longer, by, "arrival_ms", "left_semi", salts=1))
    return firsts.unionByName(_later_starts(spread, by, memory_ms))


def duplicate_counts(
    deliveries: DataFrame, keys: tuple[str, ...] = ("message_id",), memory_ms: int = K.DUPLICATE_MEMORY_MS
) -> DataFrame:
    """Per (id, arrival ms): copies delivered, and how many of them are duplicates.

    Copies of one id in one ms cannot be told apart; where that ms is a start, one of them
    is the start and the others are duplicates.
    """
    arrival = [*keys, "arrival_ms"]
    came = arrivals(deliveries, keys)
    # marks of starts and counts meet in one aggregation, not in a join
    marks = starts_among(came, keys, memory_ms).withColumns({"copies": F.lit(0).cast("bigint"), "_start": F.lit(1)})
    both = came.withColumn("_start", F.lit(0)).unionByName(marks)
    merged = both.groupBy(*arrival).agg(F.sum("copies").alias("copies"), F.max("_start").alias("_start"))
    return merged.select(*arrival, "copies", (F.col("copies") - F.col("_start")).cast("bigint").alias("duplicates"))


def _slot(memory_ms: int) -> Column:
    return S.floor_div(F.col("arrival_ms"), memory_ms + 1)


def _later_starts(arrivals: DataFrame, keys: list[str], memory_ms: int) -> DataFrame:
    """All starts but the first of every id."""
    width = memory_ms + 1
    slots = cut(_runs(arrivals, keys, memory_ms))
    length = F.col("run_end") - F.col("run_start")
    runs = slots.select(*keys, F.col("run_start").alias("arrival_ms")).distinct()
    first = arrivals.groupBy(*keys).agg(F.min("arrival_ms").alias("arrival_ms"))
    starts = runs.join(first, [*keys, "arrival_ms"], "left_anti")
    longest = slots.agg(F.max(length)).first()[0]  # one number
    links = (longest or 0) // width  # no chain has more links than this
    if links == 0:
        return starts
    long_slots = slots.filter(length > memory_ms)
    nodes = arrivals.join(long_slots.select(*keys, "_slot", "run_start", "run_end"), [*keys, "_slot"])
    follow = nodes.select(*keys, F.col("arrival_ms").alias("from"), "run_end").join(
        _pointers(nodes, keys, memory_ms), [*keys, "from"]
    )
    # no arrival left in the probed slot: the run goes on in the next slot it occupies
    slot_after = long_slots.select(*keys, F.col("_slot").alias("probe_slot"), "next_slot_first")
    jump = (
        follow.join(slot_after, [*keys, "probe_slot"], "left")
        .withColumn("to", F.coalesce("to", "next_slot_first"))
        .filter(F.col("to").isNotNull() & (F.col("to") <= F.col("run_end")))
        .select(*keys, "from", "to")
    )
    if links > 1:
        jump = cut(jump)
    first_of_run = long_slots.select(*keys, F.col("run_start").alias("from")).distinct()
    reached = first_of_run
    hop = 1
    while hop <= links:  # doubles, so a run of a year takes about twenty rounds
        ahead = reached.join(jump, [*keys, "from"]).select(*keys, F.col("to").alias("from"))
        reached = reached.unionByName(ahead)
        hop *= 2
        if hop <= links:
            reached = cut(reached)
            second = jump.select(*keys, F.col("from").alias("to"), F.col("to").alias("beyond"))
            jump = cut(jump.join(second, [*keys, "to"]).select(*keys, "from", F.col("beyond").alias("to")))
    later = reached.join(first_of_run, [*keys, "from"], "left_anti")
    return starts.unionByName(later.select(*keys, F.col("from").alias("arrival_ms")))


def duplicates_per_batch(
    deliveries: DataFrame,
    batch_ms: int = K.TICK_MS,
    feed: tuple[str, ...] = (),
    memory_ms: int = K.DUPLICATE_MEMORY_MS,
) -> DataFrame:
    """Messages and duplicates per (feed and) pull batch: what came, less what was a start."""
    by = [*feed, "batch_id"]
    keys = (*feed, "message_id")
    batch = S.floor_div(F.col("arrival_ms"), batch_ms).alias("batch_id")
    came = arrivals(deliveries, keys)
    marks = starts_among(came, keys, memory_ms).select(*feed, batch, F.lit(0).alias("copies"), F.lit(1).alias("_new"))
    both = came.select(*feed, batch, "copies", F.lit(0).alias("_new")).unionByName(marks)
    sums = both.groupBy(*by).agg(F.sum("copies").alias("n_messages"), F.sum("_new").alias("_new"))
    return sums.select(*by, "n_messages", (F.col("n_messages") - F.col("_new")).alias("n_duplicates"))
