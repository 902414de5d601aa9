"""Contest results to persons by a waterfall of rules, each on what the last left."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions import names, places
from rollcall.operators.dedupe import keep_best
from rollcall.session import cut


def attribute(rows: DataFrame, terms: DataFrame, bridge: DataFrame, history: DataFrame | None = None, current_year: int | None = None, accept: float = 1.0, party_points: float = 0.5) -> DataFrame:
    """Rows (row_id, owner, method).

    rows: row_id, year, state, seat, party, name, won, all in normal form, and source_id;
    terms: pid, year, state, seat, party, name; bridge: source_id, pid. A: a term of the
    same year and seat, exact or one the beginning of the other, with enough points for
    name and party. B: the source id is a known person's. D: in current_year, a person of
    history (pid, state, seat, name) with a strong name at a seat of their past. C: a
    winner's own source id, for all rows of that id. Terms of one year, state and seat
    beginning are few (an assembly's seats are filled once), so the join on them needs no salt.
    """
    tokens = lambda c: F.split(c, " ")
    points = names.name_score(tokens(F.col("name")), tokens(F.col("t_name"))) + F.when((F.col("party") != "") & (F.col("party") == F.col("t_party")), party_points).otherwise(0.0)
    t = terms.select(F.col("pid").alias("owner"), F.col("year").alias("t_year"), F.col("state").alias("t_state"), F.col("seat").alias("t_seat"), F.col("party").alias("t_party"), F.col("name").alias("t_name")).distinct()
    place = (F.col("year") == F.col("t_year")) & (F.col("state") == F.col("t_state"))
    exact = rows.join(t, place & (F.col("seat") == F.col("t_seat")))
    hit = exact.select("row_id").distinct()
    # a join on year and state with the beginning of the seat left over, for rows without an exact seat
    near = rows.join(hit, "row_id", "left_anti").join(t, place & (F.substring("seat", 1, 12) == F.substring("t_seat", 1, 12)) & places.same_constituency(F.col("seat"), F.col("t_seat")))
    scored = exact.unionByName(near).withColumn("points", points).where(F.col("points") >= accept)
    a = cut(keep_best(scored.select("row_id", "owner", "points"), ["row_id"], [-F.col("points"), F.col("owner")]).select("row_id", "owner", F.lit("A").alias("method")))
    left = rows.join(a, "row_id", "left_anti")
    known = bridge.groupBy("source_id").agg(F.min("pid").alias("owner"))
    b = left.join(known, "source_id").select("row_id", "owner", F.lit("B").alias("method"))
    left = left.join(known, "source_id", "left_anti")
    d = None
    if history is not None:
        h = history.select(F.col("pid").alias("owner"), "state", "seat", F.col("name").alias("t_name")).distinct()
        met = left.where(F.col("year") == current_year).join(h, ["state", "seat"]).where(names.strong_name(tokens(F.col("name")), tokens(F.col("t_name"))))
        d = cut(met.groupBy("row_id").agg(F.min("owner").alias("owner")).withColumn("method", F.lit("D")))
        left = left.join(d, "row_id", "left_anti")
    minted = left.where("won AND source_id IS NOT NULL").select("source_id").distinct()
    c = left.join(minted, "source_id").select("row_id", F.concat(F.lit("TCPD:"), "source_id").alias("owner"), F.lit("C").alias("method"))
    found = a.unionByName(b).unionByName(c)
    return found if d is None else found.unionByName(d)
