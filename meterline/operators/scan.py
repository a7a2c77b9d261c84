"""Running aggregates over a total order without putting the order into one task.

Rows are keyed by a list of ``levels`` from coarse to fine (for instance day, minute,
millisecond). Each level is scanned only within one value of the level above it, on
totals of the level below, and the parts are added up by joins on the coarser levels.
Every window group is therefore as small as the levels make it, whatever the key skew;
callers pick levels whose fan-out has a fixed bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.session import cut

_AGG = {"sum": F.sum, "max": F.max}


def _combine(how: str, left: Column, right: Column) -> Column:
    if how == "max":
        return F.greatest(left, right)  # skips NULLs
    return F.coalesce(left, F.lit(0)) + F.coalesce(right, F.lit(0))


def exclusive_scan(
    df: DataFrame,
    partition: list[str],
    levels: list[str],
    values: dict[str, tuple[str, str]],
    cut_input: bool = True,
) -> DataFrame:
    """Add, per output name, the aggregate over all rows strictly before this one.

    ``df`` has one row per ``partition + levels``. ``values`` maps an output column to
    ``(how, input column)`` with ``how`` one of ``sum`` or ``max``. The first row of a
    partition gets 0 for a sum and NULL for a max.

    The input is read twice, for the rows and for the totals. A reduced input is written
    out once first (``cut_input``); for raw rows only the totals are.
    """
    if cut_input:
        df = cut(df)
    names = {out: (how, f"_t_{out}") for out, (how, _c) in values.items()}
    return _scan(df, partition, levels, values, names, cut_totals=not cut_input)


def _scan(
    df: DataFrame,
    partition: list[str],
    levels: list[str],
    values: dict[str, tuple[str, str]],
    totals_of: dict[str, tuple[str, str]],
    cut_totals: bool,
) -> DataFrame:
    group = [*partition, *levels[:-1]]
    frame = Window.partitionBy(*group).orderBy(levels[-1]).rowsBetween(Window.unboundedPreceding, -1)
    local = df.withColumns({f"_in_{out}": _AGG[how](col).over(frame) for out, (how, col) in values.items()})
    if len(levels) == 1:
        done = {out: _combine(how, F.col(f"_in_{out}"), F.lit(None)) for out, (how, _c) in values.items()}
        return local.withColumns(done).drop(*[f"_in_{out}" for out in values])
    totals = df.groupBy(*group).agg(*[_AGG[how](col).alias(f"_t_{out}") for out, (how, col) in values.items()])
    if cut_totals and len(levels) > 2:
        totals = cut(totals)
    above = _scan(totals, partition, levels[:-1], totals_of, totals_of, cut_totals=False)
    above = above.select(*group, *[F.col(out).alias(f"_up_{out}") for out in values])
    done = {out: _combine(how, F.col(f"_in_{out}"), F.col(f"_up_{out}")) for out, (how, _c) in values.items()}
    scratch = [f"_{part}_{out}" for out in values for part in ("in", "up")]
    return local.join(above, group).withColumns(done).drop(*scratch)


def running_count(
    df: DataFrame, partition: list[str], levels: list[str], out: str, cut_input: bool = True
) -> DataFrame:
    """Number of rows before each row, in the order of ``levels``."""
    ones = df.withColumn("_one", F.lit(1).cast("bigint"))
    return exclusive_scan(ones, partition, levels, {out: ("sum", "_one")}, cut_input).drop("_one")


def last_n(
    df: DataFrame,
    partition: list[str],
    index: str,
    n: int,
    sums: dict[str, str] | None = None,
    mins: dict[str, str] | None = None,
    maxs: dict[str, str] | None = None,
    firsts: dict[str, str] | None = None,
    block: int = 16_384,
) -> DataFrame:
    """Aggregates over the last ``n`` rows (this one included) of a gap-free 0-based index.

    The index is cut in blocks; a block also gets the ``n`` rows before it, so a group never
    holds more than ``block + n`` rows. The cost per row does not depend on ``n``: sums are
    differences of running sums, and a minimum (maximum) is the lesser of two running ones,
    one from the start of the current stretch of ``n`` rows and one to the end of the stretch
    before. ``firsts`` gives the value of the frame's oldest row.
    """
    sums, mins, maxs, firsts = sums or {}, mins or {}, maxs or {}, firsts or {}
    size = max(block, n)
    own = F.floor(F.col(index) / F.lit(size)).cast("bigint")
    spill = F.pmod(F.col(index), F.lit(size)) >= size - n
    copies = F.when(spill, F.array(own, own + 1)).otherwise(F.array(own))
    spread = df.withColumn("_blk", F.explode(copies)).withColumn("_stretch", F.floor(F.col(index) / F.lit(n)))
    order = Window.partitionBy(*partition, "_blk").orderBy(index)
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    stretch = Window.partitionBy(*partition, "_blk", "_stretch")
    ahead = stretch.orderBy(index).rowsBetween(Window.unboundedPreceding, 0)
    behind = stretch.orderBy(F.desc(index)).rowsBetween(Window.unboundedPreceding, 0)
    running = {f"_run_{out}": F.sum(col).over(so_far) for out, col in sums.items()}
    for agg, wanted in ((F.min, mins), (F.max, maxs)):
        for out, col in wanted.items():
            running[f"_run_{out}"] = agg(col).over(ahead)
            running[f"_rest_{out}"] = agg(col).over(behind)
    spread = spread.withColumns(running)
    done: dict[str, Column] = {"rows_in_frame": F.least(F.col(index) + 1, F.lit(n)).cast("bigint")}
    for out in sums:
        done[out] = F.col(f"_run_{out}") - F.coalesce(F.lag(f"_run_{out}", n).over(order), F.lit(0))
    for pick, wanted in ((F.least, mins), (F.greatest, maxs)):
        for out in wanted:
            before = F.lag(f"_rest_{out}", n - 1).over(order) if n > 1 else F.col(f"_rest_{out}")
            done[out] = pick(F.col(f"_run_{out}"), before)  # skips the NULL of a frame not yet full
    for out, col in firsts.items():
        oldest = F.lag(col, n - 1).over(order) if n > 1 else F.col(col)
        done[out] = F.coalesce(oldest, F.first(col).over(so_far))
    return spread.withColumns(done).filter(F.col("_blk") == own).drop("_blk", "_stretch", *running)


def ring_statistics(df: DataFrame, partition: list[str], index: str, value: str, n: int) -> DataFrame:
    """Sum, average, minimum, maximum and span of the last ``n`` values."""
    framed = last_n(
        df, partition, index, n, sums={"ring_sum": value}, mins={"ring_min": value}, maxs={"ring_max": value}
    )
    return framed.withColumns(
        {
            "ring_avg": F.col("ring_sum") / F.col("rows_in_frame"),
            "ring_span": F.col("ring_max") - F.col("ring_min"),
        }
    )
