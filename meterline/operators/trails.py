"""Point sets kept per ride and per cell: trails, weights, fading, culling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline import constants as K
from meterline.functions import scalars as S
from meterline.operators.aggs import distinct_keys
from meterline.operators.joins import salted_join
from meterline.session import cut


#: A ride's batches are put in order by slices of time; a busy ride is spread over them.
SLICE_MS = 60_000


def with_batch(df: DataFrame, batch_ms: int = K.TICK_MS) -> DataFrame:
    """A pull batch is what arrived within one tick."""
    return df.withColumn("batch_id", S.floor_div(F.col("arrival_ms"), batch_ms))


def ride_trails(points: DataFrame, head: int = K.HEAD_WEIGHT) -> DataFrame:
    """Points of the newest ``head`` batches per ride; the newest weighs ``head``, each older one less.

    Ranking runs on distinct (ride, batch) pairs; the rank limit is applied on the map
    side too, so a busy ride ships at most ``head`` pairs per task. The points are then
    looked up by (ride, batch); a busy ride is spread over its batches.
    """
    pairs = points.select("ride_id", "batch_id").distinct()
    newest = Window.partitionBy("ride_id").orderBy(F.desc("batch_id"))
    kept = pairs.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") <= head)
    trail = salted_join(points, kept, ["ride_id", "batch_id"], "message_id", salts=1)
    return trail.withColumn("weight", (F.lit(head + 1) - F.col("_rank")).cast("bigint")).drop("_rank")


def updated_points(held: DataFrame, arrived: DataFrame) -> DataFrame:
    """Held points whose ride has a point among the arrived ones."""
    return salted_join(held, distinct_keys(arrived, "ride_id"), ["ride_id"], "message_id", "left_semi")


def other_points(held: DataFrame, arrived: DataFrame) -> DataFrame:
    """Held points whose ride has none; points without a ride stay."""
    return salted_join(held, distinct_keys(arrived, "ride_id"), ["ride_id"], "message_id", "left_anti")


def merge_batch(held: DataFrame, arrived: DataFrame, head: int = K.HEAD_WEIGHT) -> DataFrame:
    """One step of the point set: weigh down updated rides, keep the others, add the new points."""
    updated = distinct_keys(arrived, "ride_id").withColumn("_updated", F.lit(1))
    marked = salted_join(held, updated, ["ride_id"], "message_id", "left")
    weight = F.col("weight") - F.coalesce("_updated", F.lit(0))
    # only what was weighed down leaves at zero
    kept = marked.withColumn("weight", weight).filter(F.col("_updated").isNull() | (F.col("weight") > 0)).drop("_updated")
    fresh = arrived.withColumn("weight", F.lit(head).cast("bigint"))
    return kept.unionByName(fresh, allowMissingColumns=True)


def cell_weight(ntaxis: Column, head: int = K.HEAD_WEIGHT) -> Column:
    return ntaxis * F.lit(head)


def fade_steps(age_ms: Column, after_ms: int) -> Column:
    """Ticks that weighed a point down at this age."""
    return F.greatest(F.lit(0), F.floor(age_ms / F.lit(K.TICK_MS)) - F.lit(after_ms // K.TICK_MS)).cast("bigint")


def _instants(from_ms: Column, life_ms: Column, every_ms: int) -> Column:
    """Multiples of ``every_ms`` in ``[from, from + life)``, one row each."""
    first = F.ceil(from_ms / F.lit(every_ms)).cast("bigint") * F.lit(every_ms)
    last = from_ms + life_ms - 1
    some = F.sequence(first, last, F.lit(every_ms).cast("bigint"))
    return F.explode(F.when(first <= last, some).otherwise(F.array().cast("array<bigint>")))


def ride_heat(points: DataFrame, every_ms: int, only: DataFrame | None = None) -> DataFrame:
    """Weight of every (ride, batch) at each instant it is visible, or at those of them that ``only`` (as_of_ms) has.

    A point loses one per later batch of its ride and, once overtaken or older than the
    fade-out period, one per tick. It is gone after ``FADEOUT + HEAD`` ticks and with ``HEAD`` later batches, so a batch
    needs no more than the times of its next ``HEAD`` ones: they are looked up once, per ride and slice of time, and a
    batch meets its instants after that, where it is.
    """
    life = K.FADEOUT_MS + K.HEAD_WEIGHT * K.TICK_MS
    batch_ms, at = F.col("batch_id") * K.TICK_MS, F.col("as_of_ms")
    # a slice has the batches of the beginning of the next one too, as later ones of its own
    slices = F.array_distinct(F.array(S.floor_div(batch_ms, SLICE_MS), S.floor_div(batch_ms - life, SLICE_MS)))
    pairs = points.select("ride_id", "batch_id").filter(F.col("batch_id").isNotNull()).withColumn("_slice", F.explode(slices)).distinct()
    order = Window.partitionBy("ride_id", "_slice").orderBy("batch_id")
    later = F.collect_list(batch_ms).over(order.rowsBetween(1, K.HEAD_WEIGHT))
    own = pairs.withColumn("_later", later).filter(S.floor_div(batch_ms, SLICE_MS) == F.col("_slice")).drop("_slice")
    seen = own.withColumn("as_of_ms", _instants(batch_ms, F.lit(life), every_ms))
    if only is not None:
        seen = seen.join(only.select("as_of_ms"), "as_of_ms", "left_semi")
    overtaken = F.get("_later", F.lit(0))
    fading_from = F.least(F.when(overtaken <= at, overtaken), batch_ms + K.FADEOUT_MS)
    ticks = F.greatest(F.lit(0), F.floor((at - fading_from) / F.lit(K.TICK_MS)))
    came = F.size(F.filter("_later", lambda ms: ms <= at))
    weight = (F.lit(K.HEAD_WEIGHT) - came - ticks).cast("bigint")
    return seen.withColumn("weight", weight).drop("_later").filter(F.col("weight") > 0)


def cell_heat(cells: DataFrame, every_ms: int, least: int = 1) -> DataFrame:
    """Weight of every counted cell (``arrival_ms``, ``ntaxis``) at each instant it weighs ``least`` or more."""
    start = cell_weight(F.col("ntaxis"))
    # w -> floor(4w/5) is at most 0.8 w, which bounds the ticks until zero
    ticks = F.floor(F.log(start.cast("double")) / F.log(F.lit(1.25))) + 2
    life = (F.lit(K.GROUP_FADEOUT_MS) + ticks * K.TICK_MS).cast("bigint")
    heavy = cells.filter(start >= least)
    seen = heavy.withColumn("as_of_ms", _instants(F.col("arrival_ms"), life, every_ms))
    steps = fade_steps(F.col("as_of_ms") - F.col("arrival_ms"), K.GROUP_FADEOUT_MS)
    return seen.withColumn("weight", S.group_decay(start, steps)).filter(F.col("weight") >= least)


_CELL = ["arrival_ms", "latitude", "longitude"]


def heat_limits(cells: DataFrame, share: int = K.CULL_SHARE) -> DataFrame | None:
    """as_of_ms, limit: for every tick that culls anything, the weight up to which points go; None without any.

    A tick's limit is a share of the heaviest point before the tick's fade. Only cells can weigh enough for a limit
    above zero, so the few heavy cells decide. A heavy cell that is culled itself no longer counts at later
    ticks; the limits are found again without such cells until nothing changes. The limits of a tick follow from
    earlier ticks only, so every round settles at least one more tick, in practice all within a few.
    """
    heavy = cut(cell_heat(cells, K.TICK_MS, share).select(*_CELL, "as_of_ms", "weight"))
    if heavy.isEmpty():
        return None
    limits, before = _limits(heavy, share), None
    while True:
        limits = cut(limits)
        now = tuple(limits.agg(F.count("*"), F.bit_xor(F.xxhash64("as_of_ms", "limit"))).first())
        if now == before:
            return limits
        before = now
        limits = _limits(_living(heavy, _deaths(heavy, limits, _CELL, F.col("arrival_ms")), _CELL), share)


def _limits(heavy: DataFrame, share: int) -> DataFrame:
    return heavy.groupBy((F.col("as_of_ms") + K.TICK_MS).alias("as_of_ms")).agg(weak_limit(F.max("weight"), share).alias("limit"))


def _deaths(marks: DataFrame, limits: DataFrame, keys: list[str], born_ms: Column) -> DataFrame:
    """Keys with the first tick after their arrival at which they weigh no more than the limit."""
    weak = marks.join(limits, "as_of_ms").filter((F.col("as_of_ms") > born_ms) & (F.col("weight") <= F.col("limit")))
    return weak.groupBy(*keys).agg(F.min("as_of_ms").alias("_dead_ms"))


def _living(marks: DataFrame, deaths: DataFrame, keys: list[str]) -> DataFrame:
    joined = marks.join(deaths, keys, "left")
    return joined.filter(F.col("_dead_ms").isNull() | (F.col("as_of_ms") < F.col("_dead_ms"))).drop("_dead_ms")


def weak_limit(max_weight: Column, share: int = K.CULL_SHARE) -> Column:
    return F.floor(max_weight / F.lit(share)).cast("bigint")


def cull_weak(points: DataFrame, share: int = K.CULL_SHARE) -> DataFrame:
    """Keep points heavier than a share of the heaviest one (a scalar subquery, no join)."""
    limit = points.agg(weak_limit(F.max("weight"), share).alias("limit")).scalar()
    return points.filter(F.col("weight") > limit)


def heat_weights(points: DataFrame, cells: DataFrame, every_ms: int) -> DataFrame:
    """The visible point set at every multiple of ``every_ms``: ride points and cells together.

    Weak points are culled at every tick, whatever instants are asked for, and stay away. All points of one (ride,
    batch) weigh the same, so these pairs are culled and only what is left is looked up.
    """
    pairs, counted = ride_heat(points, every_ms), cell_heat(cells, every_ms)
    limits = heat_limits(cells)
    if limits is not None:
        ride = ["ride_id", "batch_id"]
        fallen = _deaths(ride_heat(points, K.TICK_MS, limits), limits, ride, F.col("batch_id") * K.TICK_MS)
        pairs = _living(pairs, fallen, ride)
        counted = _living(counted, _deaths(cell_heat(cells, K.TICK_MS), limits, _CELL, F.col("arrival_ms")), _CELL)
    columns = ["as_of_ms", "ride_id", "message_id", "latitude", "longitude", "weight"]
    rides = salted_join(points, pairs, ["ride_id", "batch_id"], "message_id", salts=1).select(*columns)
    return rides.unionByName(counted.select("as_of_ms", "latitude", "longitude", "weight"), allowMissingColumns=True)
