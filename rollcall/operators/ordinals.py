"""Places of rows in an order, without sorting a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.session import cut


def number_rows(df: DataFrame, groups: list[str], order: list[Column], name: str) -> DataFrame:
    """df with the column name: the place, from 1, of a row within its group.

    One range sort by groups and order cuts a large group into ranges; a row's place is its
    place in its range and the rows of the group in ranges before, of which there are at
    most as many as ranges. order must leave no ties, as equal rows have places by chance.
    No groups number all rows. Nulls are a group and have a place like values.
    """
    placed = cut(df.repartitionByRange(*groups, *order).withColumn("__p", F.spark_partition_id()))
    sizes = placed.groupBy("__p", *groups).agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.partitionBy(*groups).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select(F.col("__p").alias("__q"), *[F.col(g).alias(f"__g{i}") for i, g in enumerate(groups)], before.alias("__before"))
    on = F.col("__p") == F.col("__q")
    for i, g in enumerate(groups):
        on = on & F.col(g).eqNullSafe(F.col(f"__g{i}"))
    row = F.row_number().over(Window.partitionBy("__p", *groups).orderBy(*order))
    return placed.withColumn("__row", row).join(sizes, on).select(*df.columns, (F.col("__before") + F.col("__row")).alias(name))
