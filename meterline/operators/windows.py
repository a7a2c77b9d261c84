"""Event-time windows. The same functions serve batch and append-mode streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.functions import scalars as S


def micros(us: int) -> str:
    return f"{us} microseconds"


def tumbling(df: DataFrame, width_us: int, keys: list[str], *aggs: Column, time: str = "event_ts") -> DataFrame:
    """Aggregate per key and epoch-aligned window ``[start, end)``; empty windows give no row."""
    out = df.groupBy(F.window(time, micros(width_us)), *keys).agg(*aggs)
    return _flatten(out)


def sliding_money(
    df: DataFrame, width_us: int, slide_us: int, amount: str, out: str, time: str = "event_ts", two_stage: bool = True
) -> DataFrame:
    """Exact money sum per sliding window.

    The two-stage form first sums each slide-wide slot (one partial sum per slot and task),
    then copies the few slot sums into the windows they belong to. The direct form copies
    every input row ``width / slide`` times and is kept for comparison.
    """
    hi, lo = S.money_hi(F.col(amount)).alias("hi"), S.money_lo(F.col(amount)).alias("lo")
    parts = df.select(time, hi, lo)
    if two_stage:
        if width_us % slide_us:
            raise ValueError("two-stage sliding sums need a width that is a multiple of the slide")
        slots = parts.groupBy(F.window(time, micros(slide_us))).agg(F.sum("hi").alias("hi"), F.sum("lo").alias("lo"))
        parts = slots.select(F.window_time("window").alias(time), "hi", "lo")
    summed = parts.groupBy(F.window(time, micros(width_us), micros(slide_us))).agg(
        F.sum("hi").alias("hi"), F.sum("lo").alias("lo")
    )
    return _flatten(summed.withColumn(out, S.money_value(F.col("hi"), F.col("lo"))).drop("hi", "lo"))


def money_aggs(amount: str) -> list[Column]:
    return [F.sum(S.money_hi(F.col(amount))).alias("hi"), F.sum(S.money_lo(F.col(amount))).alias("lo")]


def _flatten(df: DataFrame) -> DataFrame:
    rest = [c for c in df.columns if c != "window"]
    return df.select(
        F.unix_micros("window.start").alias("window_start_us"),
        F.unix_micros("window.end").alias("window_end_us"),
        *rest,
    )
