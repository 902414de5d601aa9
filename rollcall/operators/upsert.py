"""Incremental state: snapshots, overlays, queues and manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.operators.ordinals import number_rows


def snapshot_join(old: DataFrame, fresh: DataFrame, keys: list[str], guard: Column | None = None) -> DataFrame:
    """Old and fresh records in one table, each with its origin.

    Fresh wins; nothing is dropped. origin is new, updated or kept. guard, over columns
    prefixed o_ and n_, keeps the old record where it holds. Keys match null to null.
    """
    rest = [c for c in old.columns if c not in keys]
    o = old.select(*[F.col(k).alias(f"ok_{k}") for k in keys], *[F.col(c).alias(f"o_{c}") for c in rest], F.lit(True).alias("has_old"))
    n = fresh.select(*[F.col(k).alias(f"nk_{k}") for k in keys], *[F.col(c).alias(f"n_{c}") for c in rest], F.lit(True).alias("has_new"))
    on = None
    for k in keys:
        same = F.col(f"ok_{k}").eqNullSafe(F.col(f"nk_{k}"))
        on = same if on is None else on & same
    both = o.join(n, on, "full_outer")
    use_old = F.col("has_new").isNull() if guard is None else F.col("has_new").isNull() | (F.col("has_old").isNotNull() & F.coalesce(guard, F.lit(False)))
    origin = F.when(F.col("has_old").isNull(), "new").when(use_old, "kept").otherwise("updated")
    return both.select(
        *[F.coalesce(f"ok_{k}", f"nk_{k}").alias(k) for k in keys],
        *[F.when(use_old, F.col(f"o_{c}")).otherwise(F.col(f"n_{c}")).alias(c) for c in rest],
        origin.alias("origin"),
    )


def upsert(old: DataFrame, fresh: DataFrame, keys: list[str], guard: Column | None = None) -> DataFrame:
    return snapshot_join(old, fresh, keys, guard).drop("origin")


def merge_stats(joined: DataFrame, scope: list[str]) -> DataFrame:
    """Counts of new, updated and kept records by scope."""
    count = lambda o: F.sum(F.when(F.col("origin") == o, 1).otherwise(0)).alias(o)
    return joined.groupBy(*scope).agg(count("new"), count("updated"), count("kept"))


def kept_legacy(joined: DataFrame, scope: list[str], walked: DataFrame) -> DataFrame:
    """joined with origin kept_legacy for kept records of a scope that was walked, and untouched for those of others.

    walked has the columns scope. A record that a walk of its scope did not bring is legacy;
    one whose scope was not walked says nothing.
    """
    seen = walked.select(*[F.col(c).alias(f"__{c}") for c in scope]).distinct().withColumn("__walked", F.lit(True))
    on = None
    for c in scope:
        same = F.col(c).eqNullSafe(F.col(f"__{c}"))
        on = same if on is None else on & same
    kept = F.when(F.col("origin") != "kept", F.col("origin")).when(F.col("__walked"), "kept_legacy").otherwise("untouched")
    return joined.join(seen, on, "left").withColumn("origin", kept).select(*joined.columns)


def insert_or_ignore(table: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """table and those rows whose keys it lacks; rows with a null key are distinct."""
    nulls = F.lit(False)
    for k in keys:
        nulls = nulls | F.col(k).isNull()
    fresh = rows.where(~nulls).join(table.select(*keys).distinct(), keys, "left_anti").select(*table.columns)
    return table.unionByName(fresh).unionByName(rows.where(nulls).select(*table.columns))


def mint_ids(state: DataFrame, keys: DataFrame, key: str, id_column: str) -> DataFrame:
    """state, and the keys it lacks with the next ids in the order of the key.

    The places of new keys come from a range sort, so no task sees all of them.
    """
    start = state.agg(F.max(id_column)).first()[0] or 0
    fresh = keys.select(key).where(F.col(key).isNotNull()).distinct().join(state.select(key), key, "left_anti")
    minted = number_rows(fresh, [], [F.col(key)], "place")
    return state.select(key, id_column).unionByName(minted.select(key, (F.col("place") + start).cast("long").alias(id_column)))
