"""Best representative of each duplicate group by iterative truth discovery.

Claims (entity, field, value, source) are votes. In turn the support of each value is
estimated from the reliability of the sources that claim it, and the reliability of
each source from the share of support its claims reach, until no reliability moves by
more than a tolerance. Everything is joins and partial aggregates over claims reduced
to distinct (entity, field, value, source), so a hot entity is never gathered in a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions.dates import parse_day
from rollcall.session import cut

#: Reliability of a source before anything is known, and the range it is kept in.
PRIOR, LEAST, MOST = 0.8, 0.05, 0.99


def discover_truth(claims: DataFrame, tolerance: float = 1e-3, max_rounds: int = 200) -> DataFrame:
    """Rows (entity, field, value, support, share): the weight of each claimed value.

    claims has entity, field, value and source. Rows with a null entity, field or value
    are no claims; a null source is one source named ''. A source that repeats a claim
    votes once. share is the value's part of all support of its entity and field; one
    value alone has 1. Ties keep equal support. No claims give no rows. Reliabilities that
    still move by more than tolerance after max_rounds are an error.
    """
    votes = claims.select("entity", "field", "value", F.coalesce("source", F.lit("")).alias("source"))
    votes = cut(votes.dropna(subset=["entity", "field", "value"]).distinct())
    alike = cut(_alike(votes))
    trust = cut(votes.select("source", "field").distinct().withColumn("trust", F.lit(PRIOR)))
    for _ in range(max_rounds):
        weighed = _weigh(alike, trust)
        seen = alike.join(weighed, ["entity", "field", "value"]).groupBy("source", "field")
        # one vote of the prior keeps sources with few claims near it
        fresh = seen.agg(((F.sum(F.col("share") * F.col("n")) + PRIOR) / (F.sum("n") + 1)).alias("next"))
        fresh = fresh.withColumn("next", F.least(F.lit(MOST), F.greatest(F.lit(LEAST), F.col("next"))))
        both = cut(trust.join(fresh, ["source", "field"]))
        moved = both.agg(F.max(F.abs(F.col("next") - F.col("trust")))).first()[0]
        trust = both.select("source", "field", F.col("next").alias("trust"))
        if moved is None or moved <= tolerance:
            break
    else:
        raise RuntimeError(f"reliabilities have not converged in {max_rounds} rounds")
    return _weigh(votes, trust)


def _alike(votes: DataFrame) -> DataFrame:
    """The votes of one entity for all whose values have the same sources, and n, how many they are.

    The rounds need no more, so their cost follows the number of patterns of agreement. A
    pattern is told by 128 bits that add up over sources and then values, in any order.
    """
    bits = lambda *c: [F.xxhash64(F.lit(k), *c).cast("decimal(20,0)") for k in (1, 2)]
    add = lambda *c: [F.sum(x).cast("decimal(38,0)").alias(f"h{k}") for k, x in enumerate(bits(*c))]
    values = votes.groupBy("entity", "field", "value").agg(*add("source"))
    patterns = values.groupBy("entity", "field").agg(*add("h0", "h1"))
    one = patterns.groupBy("field", "h0", "h1").agg(F.min("entity").alias("entity"), F.count("*").alias("n")).select("entity", "field", "n")
    return votes.join(one, ["entity", "field"])


def _weigh(votes: DataFrame, trust: DataFrame) -> DataFrame:
    vote = -F.log(F.lit(1.0) - F.col("trust"))
    support = votes.join(trust, ["source", "field"]).groupBy("entity", "field", "value").agg(F.sum(vote).alias("support"))
    total = support.groupBy("entity", "field").agg(F.sum("support").alias("total"))
    return support.join(total, ["entity", "field"]).select(
        "entity", "field", "value", "support", (F.col("support") / F.col("total")).alias("share")
    )


# fixed values: forms of address that are no part of a name
TITLES = "shri smt dr prof adv col ms mr mrs miss kumari sushri hon retd capt maj gen justice sardar".split()
# fixed values: days and file names that stand for a missing value
FILLER_DAYS = ["1900-01-01", "1970-01-01", "1901-01-01", "1800-01-01"]
FILLER_FILE = r"(?i)/(?:no[-_]?(?:image|photo|pic)|default|blank|placeholder|dummy|silhouette|avatar|missing|0+)[^/]*$"
_PICTURE = r"(?i)^https?://[^/\s]+(?:/[^/\s]+)*/[^/\s]+\.(?:jpe?g|png|gif|webp|bmp|tiff?)$"


def name_parts(name: Column) -> Column:
    """Lower-case parts of a name without forms of address; dots are no part of them."""
    parts = F.split(F.trim(F.regexp_replace(F.lower(name), r"[.,()\s ]+", " ")), " ")
    return F.filter(parts, lambda p: (p != "") & ~p.isin(TITLES))


def _is_written_out(name: Column) -> Column:
    """In ordinary capitals, without initials, dots or forms of address."""
    ordinary = name.rlike(r"^\p{Lu}\p{Ll}+(?:['’-]\p{L}\p{Ll}*)*(?: \p{Lu}\p{Ll}+(?:['’-]\p{L}\p{Ll}*)*)*$")
    return ordinary & ~F.lower(F.substring_index(name, " ", 1)).isin(TITLES)


def person_claims(persons: DataFrame, own_share: float = 1 / 3) -> DataFrame:
    """Rows (pid, field, value, usable, source, rec_id, confidence, built_at), one per claim.

    value is the comparable form: name parts, ISO day or address. usable says whether
    the row's own writing may survive. An address of which no pid has more than own_share
    of the rows is a filler whatever its name.
    """
    as_of = persons.agg(F.max(F.to_date("built_at"))).first()[0]
    holders = persons.where("pid IS NOT NULL AND image_url IS NOT NULL").groupBy("image_url", "pid").agg(F.count("*").alias("n"))
    fillers = holders.groupBy("image_url").agg(F.max("n").alias("most"), F.sum("n").alias("all"))
    fillers = fillers.where(F.col("most") <= F.col("all") * own_share).select("image_url", F.lit(True).alias("shared"))
    rows = persons.select("pid", "rec_id", "canonical_name", "dob", "image_url", "confidence", "built_at", "identity_source", "anchor_signal")
    rows = rows.where(F.col("pid").isNotNull()).join(fillers, "image_url", "left")
    rows = rows.withColumn("day", parse_day(F.col("dob")))
    parts = name_parts(F.col("canonical_name"))
    whole = (F.size(parts) > 0) & ~F.exists(parts, lambda p: F.length(p) < 2)
    day = F.when((F.col("day") <= F.lit(as_of)) & ~F.date_format("day", "yyyy-MM-dd").isin(FILLER_DAYS), F.date_format("day", "yyyy-MM-dd"))
    picture = F.when(F.col("image_url").rlike(_PICTURE) & ~F.col("image_url").rlike(FILLER_FILE) & F.col("shared").isNull(), F.col("image_url"))
    claim = lambda field, value, usable: F.struct(F.lit(field).alias("field"), value.alias("value"), usable.alias("usable"))
    claims = F.array(
        claim("canonical_name", F.when(whole, F.array_join(parts, " ")), F.coalesce(_is_written_out(F.col("canonical_name")), F.lit(False))),
        claim("dob", day, F.lit(True)),
        claim("image_url", picture, F.lit(True)),
    )
    source = F.concat_ws("/", F.coalesce("identity_source", F.lit("-")), F.coalesce("anchor_signal", F.lit("-")))
    out = rows.select("pid", "rec_id", "confidence", "built_at", source.alias("source"), F.explode(claims).alias("c"))
    return out.select("pid", "rec_id", "confidence", "built_at", "source", "c.*").where(F.col("value").isNotNull())


def best_values(persons: DataFrame) -> DataFrame:
    """Rows (pid, field, value, support, share, score): every claimed value of every pid.

    Support comes from truth discovery. A name's score adds how commonly its rarest part
    is borne by other pids, so a slip of the pen loses against the name it came from, and
    a name with more parts beats one with fewer.
    """
    return _best_values(person_claims(persons))


def _best_values(claims: DataFrame) -> DataFrame:
    support = discover_truth(claims.withColumnRenamed("pid", "entity")).withColumnRenamed("entity", "pid")
    names = support.where(F.col("field") == "canonical_name")
    worn = names.select("pid", "value", F.explode(F.split("value", " ")).alias("part"))
    commonness = worn.groupBy("part").agg(F.count_distinct("pid").alias("pids"))
    rarest = worn.join(commonness, "part").groupBy("pid", "value").agg(F.min("pids").alias("rarest"), F.count("*").alias("parts"))
    scored = support.join(rarest.withColumn("field", F.lit("canonical_name")), ["pid", "field", "value"], "left")
    return scored.select(
        "pid", "field", "value", "support", "share",
        F.struct(F.coalesce("parts", F.lit(0)).alias("parts"), (F.col("support") + F.log(F.coalesce("rarest", F.lit(1)))).alias("weight")).alias("score"),
    )


def surviving_rows(persons: DataFrame) -> DataFrame:
    """Rows (pid, field, rec_id): the row that supplies each surviving value.

    For each pid with at least two rows. Of canonical_name only rows that write out the
    best-supported of the most complete names compete; of dob and image_url every usable
    row does. The highest confidence wins for canonical_name and dob, then the latest
    built_at; for image_url the other way round; then the smallest rec_id. A null
    confidence or built_at comes last. A field without a usable value has no row.
    """
    claims = cut(person_claims(persons))
    several = persons.where(F.col("pid").isNotNull()).groupBy("pid").agg(F.count("*").alias("rows")).where("rows > 1").select("pid")
    # of names, only a value that some row writes out can survive
    written = claims.where("usable").select("pid", "field", "value").distinct()
    values = _best_values(claims).join(written, ["pid", "field", "value"])
    name = values.where(F.col("field") == "canonical_name").groupBy("pid").agg(F.max(F.struct("score", "value")).alias("best"))
    name = name.select("pid", F.col("best.value").alias("best_name"))
    rows = claims.where("usable").join(several, "pid").join(name, "pid", "left")
    rows = rows.where((F.col("field") != "canonical_name") | (F.col("value") == F.col("best_name")))
    picture = F.col("field") == "image_url"
    when, sure = F.col("built_at").cast("timestamp").cast("double"), F.col("confidence")
    order = F.struct(F.when(picture, when).otherwise(sure).alias("a"), F.when(picture, sure).otherwise(when).alias("b"), (-F.col("rec_id")).alias("c"))
    return rows.groupBy("pid", "field").agg(F.max(order).alias("o")).select("pid", "field", (-F.col("o.c")).alias("rec_id"))
