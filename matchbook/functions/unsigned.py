"""Unsigned 64-bit values in ``bigint`` columns.

``decimal(20,0)`` holds every unsigned 64-bit value but costs an object for each row, so shuffles, Arrow batches and state
carry the 64 bits as a ``bigint`` (values from 2^63 on are negative there). Values below 2^63 are the same in both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import MAX_BIGINT

WIDE = "decimal(20,0)"
MASK = (1 << 64) - 1


def is_wide(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.DecimalType)


def whole(value: int) -> Column:
    """A literal of any unsigned 64-bit value."""
    return F.lit(str(value)).cast(WIDE)


def to_bits(c: Column) -> Column:
    """The 64 bits of a ``decimal(20,0)`` in 0 .. 2^64-1, as a bigint; NULL beyond that range."""
    return F.when((c < 0) | (c > whole(MASK)), F.lit(None).cast("long")).when(c > MAX_BIGINT, (c - F.lit(str(1 << 64)).cast("decimal(21,0)")).cast("long")).otherwise(c.cast("long"))


def from_bits(c: Column) -> Column:
    """The value of 64 bits, as ``decimal(20,0)``."""
    value = c.cast(WIDE)
    return F.when(c < 0, (value + F.lit(str(1 << 64)).cast("decimal(21,0)")).cast(WIDE)).otherwise(value)


def widened(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` with the 64 bits in ``columns`` shown as the values they stand for."""
    return df.withColumns({c: from_bits(F.col(c)) for c in columns})


def unsigned(x: int) -> int:
    """The value of a 64-bit number read from a bigint column."""
    return x & MASK


def signed(x: int | None) -> int | None:
    """The bigint that holds the 64 bits of a value."""
    return x - (1 << 64) if x is not None and x > MAX_BIGINT else x
