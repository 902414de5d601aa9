"""Continuous periods and gaps of overlapping, nested and gapped time intervals.

The aggregate state of an entity is a sorted list of disjoint, non-touching day
intervals. States merge associatively: lists of blocks that follow one another are already
in order, and one left fold joins what overlaps or touches (it copies the closed intervals
as it goes, so a long list costs more than one step an interval). The states are reduced
in a tree over blocks of time, so no task ever sees more than the distinct start days of
one block, or the disjoint intervals of one entity; both are bounded by the calendar and
not by the number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The unix day that stands for an end that is still open (9999-12-31).
OPEN_DAY = 2932896
_STATE = "array<struct<s:int,e:int>>"


def _fold(ordered: Column) -> Column:
    """Disjoint, non-touching intervals of a list that is sorted by start."""
    start = F.struct(
        F.array().cast(_STATE).alias("done"), F.lit(None).cast("int").alias("s"), F.lit(None).cast("int").alias("e")
    )

    def step(acc: Column, x: Column) -> Column:
        joined = F.struct(acc["done"].alias("done"), acc["s"].alias("s"), F.greatest(acc["e"], x["e"]).alias("e"))
        first = F.struct(acc["done"].alias("done"), x["s"].alias("s"), x["e"].alias("e"))
        closed = F.concat(acc["done"], F.array(F.struct(acc["s"].alias("s"), acc["e"].alias("e"))))
        after = F.struct(closed.alias("done"), x["s"].alias("s"), x["e"].alias("e"))
        return F.when(acc["s"].isNull(), first).when(x["s"] <= acc["e"] + 1, joined).otherwise(after)

    return F.aggregate(
        ordered, start, step, lambda acc: F.concat(acc["done"], F.array(F.struct(acc["s"].alias("s"), acc["e"].alias("e"))))
    )


def merge_intervals(df: DataFrame, key: str, start: str, end: str, block_days: int = 4096, fan_in: int = 16) -> DataFrame:
    """One row (key, periods) for each key with a usable interval.

    start and end are inclusive INT unix days. Rows with a null key, start or end, or
    with end < start, are not used. Repeated rows and ties change nothing. periods is
    sorted, and between two of them lies at least one day. An empty table gives none.
    """
    rows = df.select(F.col(key).alias("k"), F.col(start).cast("int").alias("s"), F.col(end).cast("int").alias("e"))
    rows = rows.where(F.col("k").isNotNull() & F.col("s").isNotNull() & (F.col("e") >= F.col("s")))
    # of the intervals that start on one day only the longest matters: map-side max
    longest = rows.groupBy("k", "s").agg(F.max("e").alias("e"))
    block = F.floor(F.col("s") / F.lit(block_days)).cast("long")
    leaves = (
        longest.withColumn("b", block)
        .groupBy("k", "b")
        .agg(_fold(F.sort_array(F.collect_list(F.struct("s", "e")))).alias("state"))
    )
    inner = _merge_states(leaves.withColumn("b2", F.floor(F.col("b") / F.lit(fan_in))), ["k", "b2"], "b")
    return _merge_states(inner.withColumnRenamed("b2", "b"), ["k"], "b").select(F.col("k").alias(key), F.col("state").alias("periods"))


def _merge_states(states: DataFrame, keys: list[str], order: str) -> DataFrame:
    # blocks follow one another in time, so runs in block order are already sorted
    runs = F.sort_array(F.collect_list(F.struct(F.col(order).alias("at"), F.col("state").alias("state"))))
    merged = F.flatten(F.transform(runs, lambda r: r["state"]))
    return states.groupBy(*keys).agg(_fold(merged).alias("state"))


def periods_and_gaps(merged: DataFrame, key: str) -> DataFrame:
    """Rows (key, kind, s, e): each period, and each gap between two successive periods."""
    p = F.col("periods")
    tag = lambda kind, s, e: F.struct(F.lit(kind).alias("kind"), s.alias("s"), e.alias("e"))
    periods = F.transform(p, lambda x: tag("period", x["s"], x["e"]))
    gaps = F.zip_with(
        F.slice(p, 1, F.size(p) - 1), F.slice(p, 2, F.size(p) - 1), lambda a, b: tag("gap", a["e"] + 1, b["s"] - 1)
    )
    out = merged.select(F.col(key), F.explode(F.concat(periods, gaps)).alias("x"))
    return out.select(key, "x.kind", "x.s", "x.e")
