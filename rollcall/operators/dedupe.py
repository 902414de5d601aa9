"""First, last and best rows of each key, with orders that leave no tie to chance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_best(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row for each key: the least by order. Null keys are a key of their own.

    The least row is found by a partial aggregate over (order, row), so a hot key is cut
    down before the shuffle and never sorted in one task. order needs ascending,
    comparable columns; the rest of the row breaks ties, maps as their sorted entries.
    """
    maps = {c for c in df.columns if df.schema[c].dataType.typeName() == "map"} - set(keys)
    rest = [F.array_sort(F.map_entries(c)).alias(c) if c in maps else F.col(c) for c in df.columns if c not in keys]
    best = F.min(F.struct(*[o.alias(f"__o{i}") for i, o in enumerate(order)], *rest))
    value = lambda c: F.map_from_entries(F.col("__b")[c]) if c in maps else F.col("__b")[c]
    return df.groupBy(*keys).agg(best.alias("__b")).select(*[F.col(c) if c in keys else value(c).alias(c) for c in df.columns])


def descending(c: Column) -> Column:
    """An order of an integral number by which the largest comes first and null last; every bit counts."""
    return F.struct(c.isNull(), F.bitwise_not(c.cast("long")))


def nulls_last(c: Column) -> Column:
    """An order by which null comes last."""
    return F.struct(c.isNull(), c)
