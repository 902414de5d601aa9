"""Mixing of sources to target weights, as a curriculum over token positions.

Every source has an amount of tokens in the mix and a weight that changes over the run:
share * (1 + slope * (2 t - 1)) at time t in [0, 1]. The integral of the weight is the
source's cumulative demand; a document's place in it, inverted, is the document's
position, and a range sort by position is the mix.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollcall.session import cut

#: Sources are a configuration table; more than this many is refused.
MOST_SOURCES = 100_000


@dataclass
class Amount:
    source: str | None
    target_share: float
    max_repeats: int
    available: int
    amount: float = 0.0
    slope: float = 0.0


def plan_amounts(rows: list[tuple], total: int, steepness: float = 0.5) -> list[Amount]:
    """Tokens of each source: its target, or all it has max_repeats times.

    What capped sources cannot give is shared out among the others by their targets. A
    source without documents or target gets nothing. Sources that must grow above their
    own size rise over the run, the others fall, and the slopes cancel out in the mix.
    """
    if not 0 <= steepness <= 0.5:
        raise ValueError("a weight would fall below 0")
    plan = [Amount(s, max(0.0, float(share or 0)), max(0, int(repeats or 0)), int(have or 0)) for s, share, repeats, have in rows]
    # a source that must be capped at one level stays capped at every higher one
    free, left = [a for a in plan if a.target_share > 0 and a.available * a.max_repeats > 0], float(total)
    while free and left > 0:
        weight = sum(a.target_share for a in free)
        full = [a for a in free if left * a.target_share / weight >= a.available * a.max_repeats]
        if not full:
            for a in free:
                a.amount = left * a.target_share / weight
            break
        for a in full:
            a.amount = float(a.available * a.max_repeats)
        left -= sum(a.amount for a in full)
        free = [a for a in free if a.amount == 0]
    mixed = sum(a.amount for a in plan)
    if mixed:
        raw = {id(a): steepness if a.amount > a.available else -steepness for a in plan if a.amount}
        mean = sum(raw[id(a)] * a.amount for a in plan if a.amount) / mixed
        for a in plan:
            if a.amount:
                a.slope = raw[id(a)] - mean
    return plan


def mix(sized: DataFrame, targets: DataFrame, steepness: float = 0.5, bucket_rows: int = 50_000) -> tuple[DataFrame, DataFrame]:
    """The mix and the report of shares.

    sized has doc_id (unique, not null), source and n_tokens; targets has source,
    target_share and max_repeats. The mix has a row (position, doc_id, source, repeat_no,
    n_tokens) for each use of a document, sorted by position, which is the token
    position at which the use starts. The report has a row for each source of either
    table. Documents without tokens are in no mix. A source without a target is not
    used; a target without documents stays at 0. A repeated target row counts once, by
    its largest values. Empty tables give an empty mix.
    """
    spark = sized.sparkSession
    sized = cut(sized.select("doc_id", "source", "n_tokens"))
    have = sized.groupBy("source").agg(F.sum("n_tokens").alias("have"), F.count("*").alias("documents"))
    wanted = targets.groupBy("source").agg(F.max("target_share").alias("share"), F.max("max_repeats").alias("repeats"))
    both = have.join(wanted.withColumnRenamed("source", "w"), F.col("source").eqNullSafe(F.col("w")), "full_outer")
    rows = both.select(F.coalesce("source", "w").alias("s"), "share", "repeats", "have", F.coalesce("documents", F.lit(0))).take(MOST_SOURCES + 1)
    if len(rows) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    total = sum(r[3] or 0 for r in rows)
    buckets = max(256, max((r[4] for r in rows), default=0) // bucket_rows)  # of one pass over a source
    plan = plan_amounts([tuple(r)[:4] for r in rows], total, steepness)
    schema = "source string, target_share double, max_repeats int, available long, amount double, slope double"
    amounts = spark.createDataFrame([(a.source, a.target_share, a.max_repeats, a.available, a.amount, a.slope) for a in plan], schema)
    mixed = cut(_positions(sized, amounts, sum(a.amount for a in plan), buckets))
    used = mixed.groupBy("source").agg(F.sum("n_tokens").alias("mixed_tokens"), F.count("*").alias("uses"), F.max("repeat_no").alias("most_repeats"))
    whole = used.agg(F.sum("mixed_tokens").alias("x")).first()[0] or 0
    report = amounts.join(used.withColumnRenamed("source", "u"), F.col("source").eqNullSafe(F.col("u")), "left").select(
        "source", "target_share", "max_repeats", F.col("available").alias("available_tokens"),
        F.coalesce("mixed_tokens", F.lit(0)).alias("mixed_tokens"), F.coalesce("uses", F.lit(0)).alias("uses"), F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"),
        (F.coalesce("mixed_tokens", F.lit(0)) / F.lit(float(whole or 1))).alias("actual_share"),
        ((F.col("amount") > 0) & (F.col("amount") >= F.col("available") * F.col("max_repeats"))).alias("capped"),
    )
    return mixed.orderBy("position", "source", "doc_id", "repeat_no"), report


def _positions(sized: DataFrame, amounts: DataFrame, whole: float, buckets: int) -> DataFrame:
    used = amounts.where("amount > 0 and available > 0")
    docs = sized.where("n_tokens > 0").join(F.broadcast(used), "source")  # at most MOST_SOURCES rows
    epochs = F.ceil(F.col("amount") / F.col("available")).cast("int")
    docs = docs.withColumn("epoch", F.explode(F.sequence(F.lit(0), epochs - 1)))
    # each pass over a source has an order of its own; the top bits of the hash split a
    # large source into buckets whose sums are added up first
    docs = docs.withColumn("h", F.xxhash64("doc_id", "epoch"))
    docs = docs.withColumn("bucket", F.floor((F.col("h").cast("double") / F.lit(2.0**64) + 0.5) * buckets).cast("int"))
    sums = docs.groupBy("source", "epoch", "bucket").agg(F.sum("n_tokens").alias("tokens"))
    so_far = Window.partitionBy("source", "epoch").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("source", "epoch", "bucket", F.coalesce(F.sum("tokens").over(so_far), F.lit(0)).alias("base"))
    within = Window.partitionBy("source", "epoch", "bucket").orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    docs = docs.withColumn("own", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
    docs = docs.join(sums, ["source", "epoch", "bucket"])
    docs = docs.withColumn("c", F.col("epoch") * F.col("available") + F.col("base") + F.col("own"))
    # a document is used when the amount ends in its second half or after it
    docs = docs.where(F.col("c") + F.col("n_tokens") / 2 <= F.col("amount"))
    y, a = F.col("c") / F.col("amount"), F.col("slope")
    bent = (a - 1 + F.sqrt((F.lit(1) - a) * (F.lit(1) - a) + a * y * 4)) / (a * 2)
    time = F.when(F.abs(a) < 1e-9, y).otherwise(bent)
    return docs.select((time * F.lit(whole) + F.lit(0.0)).alias("position"), "doc_id", "source", (F.col("epoch") + 1).alias("repeat_no"), "n_tokens")
