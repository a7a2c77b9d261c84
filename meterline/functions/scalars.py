"""Column -> Column functions. All of them stay in generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterline import constants as K


def float32(col: Column) -> Column:
    """Single-precision value of a number or of a numeric string; NULL if it is no number."""
    return col.try_cast("float")


#: Greatest amount (in size) whose nano units fit a BIGINT with room to spare.
LARGEST_AMOUNT = 1e9


def number(col: Column) -> Column:
    """Double-precision value of a finite number or of its text; NULL for anything else."""
    value = col.try_cast("double")
    return F.when(F.abs(value) < F.lit(float("inf")), value)  # false for NaN, too: it is greater


def floor_div(col: Column, width: int) -> Column:
    """Whole-number division that rounds down, also below zero (``div`` rounds towards zero)."""
    return F.call_function("div", col - F.pmod(col, F.lit(width)), F.lit(width))


def degrees(col: Column, most: float) -> Column:
    """A position of at most ``most`` degrees to either side; NULL otherwise."""
    value = number(col)
    return F.when(F.abs(value) <= F.lit(most), value)


def amount(col: Column) -> Column:
    """An amount of money that exact sums can hold; NULL otherwise."""
    value = number(col)
    return F.when(F.abs(value) <= F.lit(LARGEST_AMOUNT), value)


def grid_cell(degrees: Column, edge: float = K.CELL_EDGE) -> Column:
    """Centre of the grid cell, in single precision throughout, widened to double.

    Spark divides FLOAT by FLOAT as DOUBLE, so every intermediate is cast back.
    """
    e = F.lit(edge).cast("float")
    cells = (float32(degrees) / e).cast("float")
    low = (F.floor(cells).cast("float") * e).cast("float")
    half = (e / F.lit(2).cast("float")).cast("float")
    return (low + half).cast("float").cast("double")


def iso_to_ms(text: Column) -> Column:
    """Epoch ms (truncated) of an ISO-8601 string that carries an offset; NULL otherwise."""
    has_offset = text.rlike(r"[T ]\d{2}:\d{2}.*(Z|[+-]\d{2}(:?\d{2})?(:?\d{2})?)$")
    return F.when(has_offset, F.unix_millis(F.try_to_timestamp(text)))


def ms_to_iso(ms: Column) -> Column:
    """ISO-8601 UTC string; the fraction is left out when it is zero. Needs a UTC session."""
    ts = F.timestamp_millis(ms)
    fraction = F.when(F.pmod(ms, F.lit(1000)) == 0, F.lit("")).otherwise(F.date_format(ts, ".SSS"))
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), fraction, F.lit("Z"))


def window_minutes(start_us: Column) -> Column:
    """Window start in (fractional) minutes since the epoch."""
    return F.floor(start_us / F.lit(1000)).cast("bigint") / F.lit(1000.0) / F.lit(60.0)


def round_half_up(col: Column) -> Column:
    """Round to a whole number, halves towards plus infinity."""
    return F.floor(col + F.lit(0.5))


def one_decimal(col: Column) -> Column:
    return round_half_up(col * F.lit(10.0)) / F.lit(10.0)


def us_currency(amount: Column) -> Column:
    """Dollars and cents; halves of a cent of the decimal value go away from zero."""
    sign = F.when(amount < 0, F.lit("-")).otherwise(F.lit(""))
    # the shortest decimal text of a double, so that 2.675 counts as a half as it is shown
    cents = F.round(F.abs(amount).cast("string").cast("decimal(38,12)"), 2)
    return F.concat(sign, F.lit("$"), F.format_number(cents, 2))


# Every BIGINT weight reaches 0 well within this many steps of w -> floor(4w/5).
MAX_DECAY_STEPS = 256


def group_decay(weight: Column, steps: Column) -> Column:
    """Apply ``w -> floor(4 w / 5)`` ``steps`` times, in whole numbers."""
    n = F.least(steps, F.lit(MAX_DECAY_STEPS)).cast("int")
    folded = F.aggregate(
        F.sequence(F.lit(1), n),
        weight.cast("bigint"),
        lambda w, _i: w - F.call_function("div", w + 4, F.lit(5)),  # whole-number division
    )
    return F.when(n <= 0, weight.cast("bigint")).otherwise(folded)


def from_base64_text(data: Column) -> Column:
    return F.unbase64(data).cast("string")


# --- exact money sums -------------------------------------------------------
# A double sum depends on row order. Each amount is taken in whole nano units, cut in
# two BIGINT parts (milli units and the rest), so both sums stay in hash aggregation
# with long buffers, cannot overflow below 10^12 rows, and give one answer in any order.

def money_hi(amount: Column) -> Column:
    return F.floor(_nanos(amount) / F.lit(1_000_000)).cast("bigint")


def money_lo(amount: Column) -> Column:
    return F.pmod(_nanos(amount), F.lit(1_000_000)).cast("bigint")


def _nanos(amount: Column) -> Column:
    return F.rint(number(amount) * F.lit(1e9)).try_cast("bigint")


def money_value(hi: Column, lo: Column) -> Column:
    """The double nearest to the exact sum held in the two parts."""
    exact = (hi.cast("decimal(25,0)") * F.lit("0.001").cast("decimal(4,3)")).cast("decimal(38,9)") + (
        lo.cast("decimal(20,0)") * F.lit("0.000000001").cast("decimal(10,9)")
    ).cast("decimal(38,9)")
    return exact.cast("double")
