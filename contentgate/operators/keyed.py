"""Small helpers for keyed work: exact integer slots, and joins in which NULL is a key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def floor_div(value: Column, width: int) -> Column:
    """Integer division rounding down, exact for every BIGINT and below zero too."""
    whole, by = value.cast("bigint"), F.lit(width).cast("bigint")
    return F.call_function("div", whole - F.pmod(whole, by), by)


def solid_key(df: DataFrame, key: str) -> tuple[Column, Column]:
    """A key that is never NULL, and the flag that tells NULL from the stand-in.

    Grouping, joining and windowing by the pair treats NULL as a key of its own, and all
    three can share one exchange, which a null-safe condition would not allow.
    """
    stand_in = F.lit("") if isinstance(df.schema[key].dataType, T.StringType) else F.lit(0)
    return F.coalesce(F.col(key), stand_in.cast(df.schema[key].dataType)), F.col(key).isNull()


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join that keeps the left columns and matches NULL with NULL.

    Rows without a key (anonymous callers, messages outside a conversation) form a group
    of their own in an aggregate; an ordinary join back to the group would lose them.
    """
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    match = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(renamed, match, how).drop(*[f"_right_{k}" for k in keys])
