"""Row-wise operators. All are narrow: no shuffle, valid on batch and stream alike."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline import constants as K
from meterline.functions import scalars as S


def each_row(df: DataFrame, *columns: Column | str) -> DataFrame:
    """One row in, one row out; the identity without columns."""
    return df.select(*(columns or ("*",)))


def map_rows(df: DataFrame, fn: Callable[[DataFrame], list[Column]]) -> DataFrame:
    return df.select(*fn(df))


def flat_map_rows(df: DataFrame, fn: Callable[[Column], Column]) -> DataFrame:
    """One row in, any number out: ``fn`` turns the row struct into an array of structs."""
    return df.select(F.explode(fn(F.struct("*"))).alias("_row")).select("_row.*")


def box_filter(
    df: DataFrame,
    south: float = K.BOX_SOUTH,
    north: float = K.BOX_NORTH,
    west: float = K.BOX_WEST,
    east: float = K.BOX_EAST,
) -> DataFrame:
    """Points strictly inside a box; positions in single precision, limits in double.

    The cast keeps the exact test from reaching a file scan, so a slightly wider test on
    the plain columns goes first: it can be pushed down and never removes a wanted row.
    """
    slack = 1e-4
    lat, lon = F.col("latitude"), F.col("longitude")
    lat32, lon32 = S.float32(lat).cast("double"), S.float32(lon).cast("double")
    wide = (lat > south - slack) & (lat < north + slack) & (lon > west - slack) & (lon < east + slack)
    exact = (lon32 > west) & (lon32 < east) & (lat32 > south) & (lat32 < north)
    return df.filter(wide).filter(exact)


def prefix_filter(df: DataFrame, prefix: str = K.DEBUG_PREFIX, column: str = "ride_id") -> DataFrame:
    """Thin a stream by key prefix: whole rides stay or go."""
    return df.filter(F.col(column).startswith(prefix))


def ride_points(df: DataFrame) -> DataFrame:
    """Five-field point: position in single precision, payload time in ms."""
    return df.withColumns(
        {
            "ts_ms": F.unix_millis("timestamp"),
            "latitude": S.float32(F.col("latitude")),
            "longitude": S.float32(F.col("longitude")),
        }
    )


def with_cell(df: DataFrame, edge: float = K.CELL_EDGE) -> DataFrame:
    return df.withColumns(
        {
            "latitude": S.grid_cell(F.col("latitude"), edge),
            "longitude": S.grid_cell(F.col("longitude"), edge),
        }
    )


def positive_weight(df: DataFrame, column: str = "weight") -> DataFrame:
    return df.filter(F.col(column) > 0)
