"""Joins of a large table with a table of keys, safe for keys that hold a large share of the rows.

The row side gets a salt from its own id, the key side is repeated once per salt. A hot
key is spread over ``salts`` partitions, and adaptive execution splits a partition that is
still too large (skew join). The result is the same as without salt. A key table is broadcast
by hint only after its rows were counted; otherwise adaptive execution's own
size check decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 8
#: Rows of a reduced key table that are broadcast at most.
SMALL_TABLE = 100_000


def salted_join(
    rows: DataFrame, keys: DataFrame, on: list[str], salt_by: str | Column, how: str = "inner", salts: int = SALTS
) -> DataFrame:
    """``how`` is inner, left, left_semi or left_anti (the row side is the left one).

    ``salts=1`` leaves hot keys to the skew join alone; that suits a key table that is not
    much smaller than the rows, where copies of it would cost more than they save.
    """
    if salts <= 1:
        return rows.join(keys, on, how)
    source = F.col(salt_by) if isinstance(salt_by, str) else salt_by
    salted_rows = rows.withColumn("_salt", F.pmod(F.xxhash64(source), F.lit(salts)).cast("int"))
    salted_keys = keys.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted_rows.join(salted_keys, [*on, "_salt"], how).drop("_salt")
