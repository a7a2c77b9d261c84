"""On-time, late and dropped rows by an arrival-order watermark, and the panes they make."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline import constants as K
from meterline.functions import scalars as S
from meterline.operators.joins import SMALL_TABLE, salted_join
from meterline.operators.scan import exclusive_scan
from meterline.session import cut

_ARRIVAL_LEVELS = ["_day", "_min", "arrival_ms"]


def _arrival_levels(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"_day": S.floor_div(F.col("arrival_ms"), 86_400_000), "_min": S.floor_div(F.col("arrival_ms"), 60_000)}
    )


def watermark_by_arrival(df: DataFrame, delay_us: int = 0, event_us: str = "event_us") -> DataFrame:
    """Per arrival millisecond, the watermark its rows meet: the greatest event time that came before.

    Rows of one millisecond arrive together and see one watermark, as a micro-batch does.
    """
    per_ms = df.groupBy("arrival_ms").agg(F.max(event_us).alias("max_us"))
    scanned = exclusive_scan(_arrival_levels(per_ms), [], _ARRIVAL_LEVELS, {"seen_us": ("max", "max_us")})
    return scanned.select("arrival_ms", (F.col("seen_us") - delay_us).alias("watermark_us"))


def lateness_class(window_end_us: Column, watermark_us: Column, lateness_us: int) -> Column:
    return (
        F.when(watermark_us.isNull() | (window_end_us > watermark_us), F.lit(K.ON_TIME))
        .when(window_end_us + lateness_us > watermark_us, F.lit(K.LATE))
        .otherwise(F.lit(K.DROPPED))
    )


def _minute_marks(df: DataFrame, gap_us: int, delay_us: int) -> DataFrame:
    """Per minute of arrival the watermark at its start (``_before``) and at its end (``_after``).

    ``_mixed`` tells whether the fate of any of its rows hangs on what came earlier in the minute.
    """
    minutes = df.groupBy(S.floor_div(F.col("arrival_ms"), 60_000).alias("_min")).agg(
        F.max("event_us").alias("max_us"), F.min("event_us").alias("min_us")
    )
    leveled = minutes.withColumn("_day", S.floor_div(F.col("_min"), 1440))
    scanned = exclusive_scan(leveled, [], ["_day", "_min"], {"seen_us": ("max", "max_us")})
    before = F.col("seen_us") - delay_us
    after = F.greatest("seen_us", "max_us") - delay_us
    mixed = (F.col("min_us") + gap_us <= after) & (before.isNull() | (F.col("max_us") + gap_us > before))
    return scanned.select("_min", before.alias("_before"), after.alias("_after"), mixed.alias("_mixed"))


def in_time(df: DataFrame, gap_us: int, delay_us: int = 0) -> DataFrame:
    """Rows that a session job without allowed lateness takes: those whose own session, were they alone in it, is still
    open for the watermark that they meet.

    A row that is open even for the watermark at the end of its minute of arrival is taken, one that is closed for the
    one at the start is not; the minutes are few and are looked up without a shuffle of the rows. Only rows between the two
    look up the watermark of their millisecond, found within the minute.
    """
    columns = df.columns
    minutes = cut(_minute_marks(df, gap_us, delay_us), "minutes")
    many, mixed = minutes.agg(F.count("*"), F.max("_mixed")).first()
    minutes = F.broadcast(minutes) if many <= SMALL_TABLE else minutes
    placed = df.withColumn("_min", S.floor_div(F.col("arrival_ms"), 60_000)).join(minutes, "_min")
    until = F.col("event_us") + gap_us
    sure = placed.filter(until > F.col("_after")).select(*columns)
    if not mixed:
        return sure
    unclear = F.col("_mixed") & (until <= F.col("_after")) & (F.col("_before").isNull() | (until > F.col("_before")))
    per_ms = placed.filter("_mixed").groupBy("_min", "_before", "arrival_ms").agg(F.max("event_us").alias("max_us"))
    earlier = Window.partitionBy("_min").orderBy("arrival_ms").rowsBetween(Window.unboundedPreceding, -1)
    mark = F.greatest("_before", F.max("max_us").over(earlier) - delay_us)
    marks = per_ms.select("arrival_ms", mark.alias("_mark"))
    rest = salted_join(placed.filter(unclear), marks, ["arrival_ms"], "message_id", salts=1)
    open_ = F.col("_mark").isNull() | (until > F.col("_mark"))
    return sure.unionByName(rest.filter(open_).select(*columns))


def _window_start(width_us: int) -> Column:
    return S.floor_div(F.col("event_us"), width_us) * width_us


def classify_rows(
    df: DataFrame, width_us: int = K.TURNOVER_WINDOW_US, lateness_us: int = K.TURNOVER_LATENESS_US, delay_us: int = 0
) -> DataFrame:
    """Every row with its window, the watermark it met and its class."""
    marks = watermark_by_arrival(df, delay_us)
    rows = salted_join(df, marks, ["arrival_ms"], "message_id", salts=1)
    end = F.col("window_start_us") + width_us
    return rows.withColumn("window_start_us", _window_start(width_us)).withColumn(
        "lateness", lateness_class(end, F.col("watermark_us"), lateness_us)
    )


def classified_turnover(
    df: DataFrame,
    amount: str = "meter_increment",
    width_us: int = K.TURNOVER_WINDOW_US,
    lateness_us: int = K.TURNOVER_LATENESS_US,
    delay_us: int = 0,
) -> DataFrame:
    """Money sums per (window, arrival ms) with their lateness class.

    The class depends on those two alone, so rows are summed up by them before the first
    shuffle and only the sums are classified.
    """
    sums = cut(
        df.groupBy(_window_start(width_us).alias("window_start_us"), "arrival_ms").agg(
            F.max("event_us").alias("event_us"),
            F.count("*").alias("n"),
            F.sum(S.money_hi(F.col(amount))).alias("hi"),
            F.sum(S.money_lo(F.col(amount))).alias("lo"),
        )
    )
    marks = watermark_by_arrival(sums, delay_us)
    end = F.col("window_start_us") + width_us
    return sums.join(marks, "arrival_ms").withColumn(
        "lateness", lateness_class(end, F.col("watermark_us"), lateness_us)
    )


def class_totals(classified: DataFrame) -> DataFrame:
    return classified.groupBy("window_start_us", "lateness").agg(
        F.sum("n").alias("n_points"), S.money_value(F.sum("hi"), F.sum("lo")).alias("dollars")
    )


def final_turnover(classified: DataFrame) -> DataFrame:
    """Last value of every window: all rows that were not dropped."""
    kept = classified.filter(F.col("lateness") != K.DROPPED)
    return kept.groupBy("window_start_us").agg(
        S.money_value(F.sum("hi"), F.sum("lo")).alias("dollar_turnover"), F.sum("n").alias("n_points")
    )


def turnover_panes(classified: DataFrame) -> DataFrame:
    """The panes a window fires once complete: one ON_TIME, then a LATE one per late arrival.

    Panes accumulate: each carries the whole sum so far. ``pane_order`` is 0 for ON_TIME and
    the arrival ms for LATE.
    """
    kept = classified.filter(F.col("lateness") != K.DROPPED)
    order = F.when(F.col("lateness") == K.ON_TIME, F.lit(0).cast("bigint")).otherwise(F.col("arrival_ms"))
    steps = kept.groupBy("window_start_us", order.alias("pane_order")).agg(
        F.sum("hi").alias("hi"), F.sum("lo").alias("lo")
    )
    leveled = steps.withColumn("_min", S.floor_div(F.col("pane_order"), 60_000))
    before = exclusive_scan(
        leveled, ["window_start_us"], ["_min", "pane_order"], {"hi0": ("sum", "hi"), "lo0": ("sum", "lo")}
    )
    return before.select(
        "window_start_us",
        "pane_order",
        F.when(F.col("pane_order") == 0, F.lit(K.ON_TIME)).otherwise(F.lit(K.LATE)).alias("dollar_timing"),
        S.money_value(F.col("hi") + F.col("hi0"), F.col("lo") + F.col("lo0")).alias("dollar_turnover"),
        S.window_minutes(F.col("window_start_us")).alias("dollar_window"),
    )
