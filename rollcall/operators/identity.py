"""Which records are one person: edges by name, day of birth and external link, and what was refused."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def identity_edges(nodes: DataFrame) -> DataFrame:
    """Edges (a, b) of nodes (node, name, day, link); every node has one to itself.

    Nodes of one name and day are one. Nodes of one link are one if their days are equal; if
    a day is missing, unless both have names that differ. name is '' and day null where
    unknown. The rules hold between pairs, but each group gives a star around its least
    node, so edges are as many as nodes in groups and no pairs arise.
    """
    n = nodes.select("node", F.coalesce("name", F.lit("")).alias("name"), "day", "link").where("node IS NOT NULL")
    own = n.select(F.col("node").alias("a"), F.col("node").alias("b"))

    def star(rows: DataFrame, keys: list[str], centre: DataFrame | None = None) -> DataFrame:
        least = (rows if centre is None else centre).groupBy(*keys).agg(F.min("node").alias("a"))
        return rows.join(least, keys).select("a", F.col("node").alias("b"))

    linked = n.where("link IS NOT NULL")
    undated = linked.where("day IS NULL")
    named = undated.where("name <> ''")
    # a named node without a day joins those of its name; any without a name joins what the nodes without a day hold
    edges = star(n.where("name <> '' AND day IS NOT NULL"), ["name", "day"]).union(star(linked.where("day IS NOT NULL"), ["link", "day"]))
    edges = edges.union(star(linked.where("name <> ''"), ["link", "name"], named)).union(star(linked, ["link"], undated.where("name = ''")))
    # a node without a name but with a day joins every named one without a day
    nameless = linked.where("name = '' AND day IS NOT NULL").groupBy("link").agg(F.min("node").alias("a"))
    edges = edges.union(named.join(nameless, "link").select("a", F.col("node").alias("b")))
    first = named.groupBy("link").agg(F.min("node").alias("a"))
    edges = edges.union(linked.where("name = '' AND day IS NOT NULL").join(first, "link").select("a", F.col("node").alias("b")))
    return edges.union(own).distinct()


def refused_pairs(nodes: DataFrame) -> DataFrame:
    """Rows (link, refused): pairs of nodes of one link that the rules keep apart, counted without making pairs."""
    n = nodes.where("link IS NOT NULL AND node IS NOT NULL").select("link", F.coalesce("name", F.lit("")).alias("name"), "day")
    two = lambda c: F.col(c) * (F.col(c) - 1) / 2
    dated = n.where("day IS NOT NULL").groupBy("link", "day").agg(F.count("*").alias("k"))
    dated = dated.groupBy("link").agg(F.sum("k").alias("dated"), F.sum(two("k")).alias("same_day"))
    names = n.where("name <> ''").groupBy("link", "name").agg(F.sum(F.col("day").isNull().cast("long")).alias("u"), F.sum(F.col("day").isNotNull().cast("long")).alias("d"))
    names = names.groupBy("link").agg(F.sum("u").alias("u"), F.sum("d").alias("d"), F.sum(two("u")).alias("uu"), F.sum(F.col("u") * F.col("d")).alias("ud"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    rows = n.select("link").distinct().join(dated, "link", "left").join(names, "link", "left")
    by_day = zero("dated") * (zero("dated") - 1) / 2 - zero("same_day")
    by_name = zero("u") * (zero("u") - 1) / 2 - zero("uu") + zero("u") * zero("d") - zero("ud")
    return rows.select("link", (by_day + by_name).cast("long").alias("refused")).where("refused > 0")
