"""Matching of records of two sources that share no key, each match with a confidence.

Both sources are laid in order by several composite sort keys. In each order a record
meets its nearest neighbours of the other source, and each pair that met in any order is
compared field by field. The evidence of all records of one candidate is added up, and
candidates and persons are assigned by an auction, so that the confidences add up to the
most and no person stands twice in one contest.

All orders are one range sort, the order's number first. Ranges are cut anywhere, within
equal keys as well, so a hot key is spread over tasks; the records beyond a range that its
windows reach are taken over from all ranges before and after it, so what meets does not
depend on the number of ranges.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.functions.dates import parse_day
from rollcall.llm.names import mended, parts, person_names
from rollcall.llm.truth import person_claims
from rollcall.session import cut

#: Neighbours to each side of a record, and the evidence a match needs.
WINDOW, ACCEPT = 6, 6.0
#: Least raise of a bid, and rounds after which it doubles, so that a long contest ends: the
#: assignment is at most the last raise for each candidate below the optimum.
STEP, PATIENCE = 0.05, 4
#: Left records that a task expands to pairs at a time.
_AT_ONCE = 50_000


def neighbours(left: DataFrame, right: DataFrame, keys: list[str], window: int = WINDOW, within: str | None = None, screen=None) -> DataFrame:
    """Rows (l, r): each left id with the right ids nearest to it in the order of keys.

    left has l, right has r, both have the columns keys (no nulls). A left record meets
    the window right records before it and the window ones after it; within, if given, is
    the first key, and only records with the same one meet. Of equal keys the right ones come
    first. Repeated records are met repeatedly. screen(left, right) may refuse pairs: it gets the other columns of both
    as dicts of arrays, a row for each pair, and returns which stay. A task holds the
    columns of one range without its keys; of other ranges it gets window records of each.
    """
    extra = {"left": [c for c in left.columns if c not in ("l", *keys)], "right": [c for c in right.columns if c not in ("r", *keys)]}
    renamed = lambda df, side: df.select(*keys, "l" if side == "left" else "r", *[F.col(c).alias(f"{side}_{c}") for c in extra[side]])
    both = renamed(left, "left").withColumn("side", F.lit(1)).unionByName(renamed(right, "right").withColumn("side", F.lit(0)), allowMissingColumns=True)
    order = [*keys, "side", F.xxhash64("l", "r")]
    ranged = both.repartitionByRange(*order).sortWithinPartitions(*order)
    # the place must not change if a task runs again
    placed = cut(ranged.select(F.spark_partition_id().alias("p"), "side", (F.col(within) if within else F.lit(0)).alias("grp"), "l", "r", *[f"{s}_{c}" for s in extra for c in extra[s]]))
    sent = ["grp", "r", *(f"right_{c}" for c in extra["right"])]
    rights = placed.where("side = 0").select("p", *sent)

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches, schema=None) if (batches := list(batches)) else None
        if rows is not None and len(rows):
            n = len(rows)
            at = np.unique(np.r_[np.arange(min(window, n)), np.arange(max(0, n - window), n)])
            yield from rows.take(pa.array(at)).combine_chunks().to_batches()

    # at most 2 * window records of each range
    borders = rights.mapInArrow(ends, rights.schema).toArrow().sort_by("p")
    shared = left.sparkSession.sparkContext.broadcast(borders)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = list(batches)
        if not batches:
            return
        rows = pa.Table.from_batches(batches).combine_chunks()
        if not len(rows):
            return
        p, side = rows["p"][0].as_py(), rows["side"].to_numpy()
        edge, places = shared.value, shared.value["p"].to_numpy()
        before = edge.filter(pa.array(places < p))
        before = before.slice(max(0, len(before) - window))
        # the first records of each later range come before its last ones
        after = edge.filter(pa.array(places > p)).slice(0, window)
        own = rows.filter(pa.array(side == 0))
        known = pa.concat_tables([t.select(sent) for t in (before, own, after)]).combine_chunks()
        lefts = rows.filter(pa.array(side == 1))
        rank = np.cumsum(side == 0)[side == 1] + len(before)
        reach = np.arange(-window, window)
        for at in range(0, len(lefts), _AT_ONCE):
            some = lefts.slice(at, _AT_ONCE)
            r = (rank[at : at + _AT_ONCE, None] + reach).ravel()
            k = np.repeat(np.arange(len(some)), 2 * window)
            fits = (r >= 0) & (r < len(known))
            r, k = r[fits], k[fits]
            group = lambda t, at: t["grp"].combine_chunks().take(pa.array(at))
            fits = pc.equal(group(some, k), group(known, r)).to_numpy(zero_copy_only=False)
            r, k = r[fits], k[fits]
            if screen is not None:
                take = lambda t, side, at: {c: t[f"{side}_{c}"].to_numpy()[at] for c in extra[side]}
                fits = screen(take(some, "left", k), take(known, "right", r))
                r, k = r[fits], k[fits]
            out = [some["l"].combine_chunks().take(pa.array(k)), known["r"].combine_chunks().take(pa.array(r))]
            yield from pa.Table.from_arrays(out, names=["l", "r"]).to_batches()

    kinds = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for df, c in ((left, "l"), (right, "r")))
    return placed.mapInArrow(meet, kinds)


def _plain(c: Column) -> Column:
    s = F.regexp_replace(F.lower(c), r"\([^)]*\)|\[[^\]]*\]|\*", " ")
    return F.trim(F.regexp_replace(s, r"[^\p{L}\p{M}]+", " "))


def _party(df: DataFrame, column: str, parties: DataFrame) -> DataFrame:
    """df with the short name of the party in column, however it is written."""
    bare = lambda c: F.regexp_replace(F.upper(c), r"[^\p{L}]", "")
    table = parties.select(bare(F.col("party_full")).alias("__full"), bare(F.col("party_short")).alias("__short")).dropDuplicates(["__full"])
    out = df.withColumn("__bare", bare(F.col(column))).join(table, F.col("__bare") == F.col("__full"), "left")
    return out.withColumn(column, F.coalesce("__short", F.nullif("__bare", F.lit("")))).drop("__bare", "__full", "__short")


def candidate_records(tuples: DataFrame, parties: DataFrame) -> DataFrame:
    """Typed fields of the election source, one row for each row of it.

    cid joins the ids that differ only in the kind of election; a row without id is a
    candidate of its own.
    """
    rows = _party(tuples.select("tuple_id", "pid", "year", "state_name", "constituency_name", "party", "candidate", "sex", "age", "position", "votes"), "party", parties)
    return rows.select(
        "tuple_id", F.coalesce(F.regexp_replace("pid", r"^[A-Z]{2}(?=[A-Z]{2,3}[0-9])", ""), F.concat(F.lit("#"), F.col("tuple_id"))).alias("cid"), "year",
        _plain(F.col("state_name")).alias("state"), _plain(F.col("constituency_name")).alias("seat"), "party",
        F.hash("position", "votes").alias("entry"), parts(F.col("candidate")).alias("name"), F.upper("sex").alias("sex"), (F.col("year") - F.col("age")).alias("born"),
    )


def person_records(persons: DataFrame, tenures: DataFrame, parties: DataFrame) -> DataFrame:
    """One row (pid, name, gender, born, terms) for each pid that has a name."""
    names = person_names(persons)
    gender = persons.groupBy("pid").agg(F.mode("gender", True).alias("gender"))
    days = person_claims(persons).where("field = 'dob'").groupBy("pid").agg(F.sort_array(F.collect_set(F.substring("value", 1, 4).cast("int"))).alias("born"))
    terms = _party(tenures.select("pid", "state", "constituency", "party_short", "term_start"), "party_short", parties)
    term = F.struct(_plain(F.col("state")).alias("state"), _plain(F.col("constituency")).alias("seat"), F.col("party_short").alias("party"), F.year(parse_day(F.col("term_start"))).alias("year"))
    terms = terms.groupBy("pid").agg(F.sort_array(F.collect_set(term)).alias("terms"))
    return names.join(gender, "pid", "left").join(days, "pid", "left").join(terms, "pid", "left")


def _near(a: Column, b: Column) -> Column:
    """Whether two places are one, cut short or with a slip of the pen."""
    same = (a == b) | ((F.length(a) >= 4) & F.startswith(b, a)) | ((F.length(b) >= 4) & F.startswith(a, b)) | (F.levenshtein(a, b) <= F.when(F.length(a) > 7, 2).otherwise(1))
    return F.coalesce(same & (a != "") & (b != ""), F.lit(False))


def _alike(a: Column, b: Column) -> Column:
    """0 to 1 for two parts of a name."""
    return F.lit(1.0) - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b))


def name_evidence(typed: Column, name: Column) -> Column:
    """Points for a typed name against a person's: -99 when it cannot be the person."""
    last, given = F.element_at(name, -1), F.slice(name, 1, F.size(name) - 1)
    joined = F.transform(F.sequence(F.lit(1), F.greatest(F.size(typed) - 1, F.lit(1))), lambda k: F.concat(F.get(typed, k - 1), F.coalesce(F.get(typed, k), F.lit(""))))
    every = F.concat(typed, joined)
    surname = F.array_max(F.transform(every, lambda t: _alike(t, last)))

    def part(g: Column) -> Column:
        whole = F.array_max(F.transform(every, lambda t: _alike(t, g)))
        initial = F.exists(typed, lambda t: (F.length(t) == 1) & F.startswith(g, t)) | (F.length(g) == 1) & F.exists(typed, lambda t: F.startswith(t, g))
        nick = F.exists(typed, lambda t: (F.length(t) >= 3) & F.startswith(g, F.regexp_replace(t, "(?:oo|ji|u|i|y)$", "")) & (F.length(F.regexp_replace(t, "(?:oo|ji|u|i|y)$", "")) >= 2) & t.rlike("(?:oo|ji|u|i|y)$"))
        return F.when(whole >= 0.99, 1.0).when(whole >= 0.8, 0.8).when(initial, 0.5).when(nick, 0.45).otherwise(0.0)

    fit = F.transform(given, part)
    first = F.coalesce(F.get(fit, F.lit(0)), F.lit(1.0))
    rest = F.aggregate(fit, F.lit(0.0), lambda acc, x: acc + x) - first
    # what is typed and fits nothing of the person speaks against it
    strange = F.size(F.filter(typed, lambda t: (F.length(t) > 1) & (_alike(t, last) < 0.75) & ~F.exists(given, lambda g: (_alike(t, g) >= 0.75) | F.startswith(g, F.substring(t, 1, 2))) & ~F.contains(F.concat(F.array_join(name, "")), t)))
    points = first * 3 + F.least(rest, F.lit(1.0)) + F.when(surname >= 0.99, 2.0).otherwise((surname - 0.5) * 3)
    return F.when((surname < 0.75) | (first < 0.4) | (strange > 0), -99.0).otherwise(points)


def _pairs_of_letters(text: Column) -> tuple[Column, Column]:
    """128 bits, one set for each pair of neighbouring letters of a text."""
    two = F.transform(F.sequence(F.lit(1), F.greatest(F.length(text) - 1, F.lit(1))), lambda i: F.pmod(F.xxhash64(F.substring(text, i, F.lit(2))), F.lit(128)))
    one = F.lit(1).cast("long")
    bit = lambda k: F.call_function("shiftleft", one, F.pmod(k, F.lit(64)).cast("int"))
    half = lambda within: F.aggregate(two, F.lit(0).cast("long"), lambda acc, k: F.when(within(k), acc.bitwiseOR(bit(k))).otherwise(acc))
    return half(lambda k: k < 64), half(lambda k: k >= 64)


def _letters(parts: Column) -> Column:
    """64 bits, one set for the first letter of each part."""
    one = F.lit(1).cast("long")
    return F.aggregate(parts, F.lit(0).cast("long"), lambda acc, t: acc.bitwiseOR(F.call_function("shiftleft", one, F.pmod(F.xxhash64(F.substring(t, 1, 1)), F.lit(64)).cast("int"))))


def _at_least(text: Column, slips: int, a: Column, b: Column) -> Column:
    """Bits a text keeps after as many slips as one in `slips` letters; a slip takes two pairs at most."""
    lost = F.greatest(F.floor(F.length(text) / F.lit(slips)) * 2, F.floor(F.length(text) / F.lit(slips - 1)))
    return F.greatest(F.lit(0), F.bit_count(a) + F.bit_count(b) - lost).cast("int")


def _may_be_alike(left: dict, right: dict) -> np.ndarray:
    """False only for pairs that name_evidence refuses: surname or first name share too few pairs of letters."""
    common = lambda a, b: np.bitwise_count(left["a"] & right[a]) + np.bitwise_count(left["b"] & right[b])
    first = (left["letters"] & right["letter"] != 0) | (common("fa", "fb") >= right["first"])
    return first & (common("a", "b") >= right["last"])


def match_candidates(tuples: DataFrame, persons: DataFrame, tenures: DataFrame, parties: DataFrame, window: int = WINDOW, accept: float = ACCEPT) -> DataFrame:
    """Rows (tuple_id, pid, confidence) of each row of tuples whose candidate is a person.

    Nulls and blanks in a field are no evidence for or against; rows without a name have
    no match. Repeated rows are matched alike. Two persons with equal evidence leave the
    candidate unmatched. Empty tables give no rows.
    """
    people = cut(person_records(persons, tenures, parties))
    rows = candidate_records(tuples, parties).where("size(name) > 0")
    # parts no one bears are mended before sorting; the name as typed stays beside
    tokens = rows.select(F.explode("name").alias("token")).distinct()
    borne = people.select(F.explode("name").alias("token")).where(F.length("token") > 1).distinct()
    surnames = people.select(F.element_at("name", -1).alias("token")).distinct()
    mends = mended(tokens, borne)
    # a first part that is a surname, or may be mended to one, may have been typed surname first
    turned = mends.select("token", F.explode("mends").alias("mend")).join(surnames.withColumnRenamed("token", "mend"), "mend", "left_semi").select("token").union(surnames).distinct()
    facts = mends.where("size(mends) = 1").select("token", F.get("mends", F.lit(0)).alias("mend")).join(turned.withColumn("is_last", F.lit(True)), "token", "full")
    at = rows.select("tuple_id", F.posexplode("name").alias("k", "token")).join(facts, "token", "left")
    clean = at.groupBy("tuple_id").agg(
        F.max(F.col("mend").isNotNull()).alias("odd"), F.sort_array(F.collect_list(F.struct("k", F.coalesce("mend", "token").alias("t")))).alias("x"),
        F.coalesce(F.max((F.col("k") == 0) & F.col("is_last")), F.lit(False)).alias("turned"),
    )
    clean = clean.select("tuple_id", "turned", F.when(F.col("odd"), F.transform("x", lambda x: x["t"])).alias("mended"))
    rows = cut(rows.join(clean, "tuple_id"))

    compared = _compared(_met(rows, people, window), rows, people)
    # what all records of a candidate say about one person
    mean = lambda c: F.sum(F.col(c) * F.col("n")) / F.sum(F.when(F.col(c).isNotNull(), F.col("n")))
    one = compared.groupBy("cid", "pid").agg(
        F.max("name_points").alias("name_points"), F.max("seat_year").alias("seat_year"), F.max("seat").alias("seat"),
        mean("state").alias("state"), F.max("party").alias("party"), mean("born").alias("born"), mean("sex").alias("sex"),
    )
    points = (
        F.col("name_points") + F.when(F.col("seat_year") > 0, 5.0).when(F.col("seat") > 0, 2.5).otherwise(0.0)
        + F.when(F.col("seat_year") > 0, 1.5).otherwise(F.coalesce(F.col("state") * 3 - 1.5, F.lit(0.0))) + F.coalesce(F.col("party") * 1.5 - 0.75, F.lit(0.0))
        + F.coalesce(F.col("born"), F.lit(0.0)) + F.coalesce(F.col("sex") * 3 - 2.5, F.lit(0.0))
    )
    scored = cut(one.select("cid", "pid", F.round(points, 6).alias("points")).where(F.col("points") >= accept))
    contests = rows.where("year IS NOT NULL AND seat <> ''").select("cid", "year", "state", "seat", "entry").distinct()
    chosen = assign(scored, contests, ["year", "state", "seat"])
    found = rows.select("tuple_id", "cid").join(chosen, "cid")
    return found.select("tuple_id", "pid", F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.col("points") - accept) / 2)), 4).alias("confidence"))


def _met(rows: DataFrame, people: DataFrame, window: int) -> DataFrame:
    """Pairs (tuple_id, pid) that are neighbours in at least one order, a record of each candidate's writing for all alike."""
    first, last = F.element_at("name", 1), F.element_at("name", -1)
    skeleton = lambda c: F.regexp_replace(F.regexp_replace(c, "[aeiouyh]", ""), r"(.)\1+", "$1")
    text = lambda c: F.coalesce(c, F.lit(""))
    state, seat, none = text(F.col("state")), text(F.col("seat")), F.lit("")
    orders = [
        [last, first, state, none],
        [first, last, state, none],
        [skeleton(last), state, F.substring(first, 1, 1), none],
        [state, seat, F.substring(last, 1, 3), F.substring(first, 1, 1)],
    ]
    keys = ["k", "k0", "k1", "k2", "k3"]
    placed = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), *[c.alias(f"k{i}") for i, c in enumerate(order)]) for k, order in enumerate(orders)]))
    # the name as typed, as mended, and either one turned round
    typed = rows.groupBy("cid", "name", "mended", "turned", "state", "seat").agg(F.min("tuple_id").alias("l"))
    a, b = _pairs_of_letters(F.concat(F.array_join("name", ""), F.coalesce(F.array_join("mended", ""), none)))
    letters = _letters(F.concat("name", F.coalesce("mended", F.array().cast("array<string>"))))
    left = typed.select("l", "turned", "state", "seat", a.alias("a"), b.alias("b"), letters.alias("letters"), F.explode(F.array_compact(F.array("name", "mended"))).alias("form")).withColumnRenamed("form", "name")
    round_ = F.concat(F.slice("name", F.lit(2), F.size("name")), F.slice("name", 1, 1))
    left = left.withColumn("name", F.explode(F.when(F.col("turned") & (F.size("name") > 1), F.array(F.col("name"), round_)).otherwise(F.array(F.col("name")))))
    left = left.select("l", "a", "b", "letters", placed.alias("x")).select("l", "a", "b", "letters", "x.*")
    a, b, fa, fb = *_pairs_of_letters(last), *_pairs_of_letters(first)
    several = F.size("name") > 1
    person = people.select(
        F.col("pid").alias("r"), "name", F.explode_outer("terms").alias("t"), a.alias("a"), b.alias("b"), fa.alias("fa"), fb.alias("fb"), _at_least(last, 4, a, b).alias("last"),
        F.when(several, _at_least(first, 5, fa, fb)).otherwise(0).alias("first"), _letters(F.array(first)).alias("letter"),
    )
    signs = ["r", "a", "b", "fa", "fb", "last", "first", "letter"]
    person = person.select(*signs, "name", F.col("t.state").alias("state"), F.col("t.seat").alias("seat")).select(*signs, placed.alias("x")).select(*signs, "x.*").distinct()
    return neighbours(left, person, keys, window, "k", _may_be_alike).distinct().select(F.col("l").alias("tuple_id"), F.col("r").alias("pid"))


def _compared(met: DataFrame, rows: DataFrame, people: DataFrame) -> DataFrame:
    """One row of comparisons for each record of a candidate whose name fits a person it met; n counts equal records."""
    met = met.join(rows.select("tuple_id", "cid"), "tuple_id").select("cid", "pid").distinct()
    # of all ways a candidate's name was typed, and as mended, the best one counts
    forms = rows.select("cid", F.explode(F.array_compact(F.array("name", "mended"))).alias("form")).distinct()
    named = met.join(forms, "cid").join(people.select("pid", F.col("name").alias("person")), "pid")
    named = named.select("cid", "pid", name_evidence(F.col("form"), F.col("person")).alias("points")).where("points > 0")
    close = cut(named.groupBy("cid", "pid").agg(F.max("points").alias("name_points")))
    fields = ["cid", "state", "seat", "year", "party", "born", "sex"]
    records = rows.groupBy(*fields).agg(F.count("*").alias("n"))
    pairs = close.join(records, "cid").join(people.select("pid", "gender", F.col("born").alias("days"), "terms"), "pid")
    terms = F.coalesce("terms", F.array().cast(people.schema["terms"].dataType))
    near_seat = lambda t: _near(F.col("seat"), t["seat"])
    near_state = lambda t: F.coalesce(_near(F.col("state"), t["state"]), F.lit(False))
    known_state, known_party = F.exists(terms, lambda t: F.coalesce(t["state"] != "", F.lit(False))), F.exists(terms, lambda t: t["party"].isNotNull())
    apart = F.array_min(F.transform("days", lambda d: F.abs(d - F.col("born"))))
    return pairs.select(
        "cid", "pid", "n", "name_points",
        F.exists(terms, lambda t: near_seat(t) & near_state(t) & F.coalesce(F.abs(t["year"] - F.col("year")) <= 1, F.lit(False))).cast("int").alias("seat_year"),
        F.exists(terms, lambda t: near_seat(t) & near_state(t)).cast("int").alias("seat"),
        F.when(known_state & (F.col("state") != ""), F.exists(terms, near_state).cast("double")).alias("state"),
        F.when(known_party & F.col("party").isNotNull(), F.exists(terms, lambda t: F.coalesce(t["party"] == F.col("party"), F.lit(False))).cast("double")).alias("party"),
        F.when(apart <= 1, 3.0).when(apart <= 2, 1.0).when(apart.isNotNull(), -4.0).alias("born"),
        F.when(F.col("gender").isNotNull() & F.col("sex").isNotNull(), (F.substring("gender", 1, 1) == F.substring("sex", 1, 1)).cast("double")).alias("sex"),
    )


def assign(scored: DataFrame, contests: DataFrame, place: list[str], step: float = STEP, most_rounds: int = 200) -> DataFrame:
    """Each candidate's person (cid, pid, points), a person once in each contest, by an auction.

    scored has cid, pid and points above 0; contests has cid, the columns place and entry.
    A candidate bids for the person worth most to it after the prices of others, and raises
    the price by what that person is worth more than the next best, or than none. In each
    contest a person goes to the highest bid; who is outbid bids again, until nobody does.
    Where each candidate stands in one contest the points add up to the most there are, but
    for the least raise of a bid, which is step and doubles every PATIENCE rounds, for each
    candidate. A result that stands in a contest again under another id of the
    source (of equal entry) is no other candidate. A candidate for whom another person of as
    many points is free stays unmatched. Empty tables give no rows.
    """
    claims = scored.select("cid", "pid").join(contests, "cid")
    # only candidates that may meet another one over a person need to bid
    fought = claims.groupBy("pid", *place).agg(F.min("entry").alias("a"), F.max("entry").alias("b"), F.min("cid").alias("c"), F.max("cid").alias("d")).where("a <> b AND c <> d").select("pid", *place)
    claims = cut(claims.join(fought, ["pid", *place], "left_semi"))
    bidders = claims.select("cid").distinct()
    best = lambda df: df.groupBy("cid").agg(F.max("points").alias("points"))
    calm = scored.join(bidders, "cid", "left_anti")
    calm = calm.join(best(calm), ["cid", "points"]).groupBy("cid", "points").agg(F.min("pid").alias("pid"), F.max("pid").alias("other")).where("pid = other").select("cid", "pid", "points")
    worth = cut(scored.join(bidders, "cid", "left_semi"))
    if worth.isEmpty():
        return calm
    session = scored.sparkSession
    held = session.createDataFrame([], worth.select("cid", "pid", F.lit(0.0).alias("bid")).schema)
    prices = session.createDataFrame([], claims.select("pid", *place, "entry", F.col("cid").alias("holder"), F.lit(0.0).alias("price")).schema)

    def costs(of: DataFrame) -> DataFrame:
        """What each candidate would have to pay for a person where others have bid."""
        paid = claims.join(of.withColumnRenamed("entry", "of"), ["pid", *place]).where("entry <> of AND cid <> holder")
        return paid.groupBy("cid", "pid").agg(F.max("price").alias("cost"))

    for round_ in range(most_rounds):
        least = step * 2 ** (round_ // PATIENCE)
        net = worth.join(held.select("cid"), "cid", "left_anti").join(costs(prices), ["cid", "pid"], "left").withColumn("net", F.col("points") - F.coalesce("cost", F.lit(0.0)))
        rank = F.row_number().over(Window.partitionBy("cid").orderBy(F.desc("net"), "pid"))
        two = net.withColumn("rank", rank).where("rank <= 2").groupBy("cid").agg(F.max_by(F.struct("pid", "points", "net"), -F.col("rank")).alias("a"), F.max(F.when(F.col("rank") == 2, F.col("net"))).alias("b"))
        bids = cut(two.where("a.net > 0").select("cid", "a.pid", (F.col("a.points") - F.greatest(F.coalesce("b", F.lit(0.0)), F.lit(0.0)) + least).alias("bid")))
        if bids.isEmpty():
            break
        asked = held.unionByName(bids)
        stands = asked.join(claims, ["cid", "pid"])
        won = stands.groupBy("pid", *place).agg(F.max(F.struct("bid", "cid", "entry")).alias("w"))
        lost = stands.join(won, ["pid", *place]).where("w.entry <> entry AND w.cid <> cid").select("cid", "pid").distinct()
        fresh = won.select("pid", *place, "w.entry", F.col("w.cid").alias("holder"), F.col("w.bid").alias("price"))
        prices = cut(prices.unionByName(fresh).groupBy("pid", *place).agg(F.max(F.struct("price", "holder", "entry")).alias("w")).select("pid", *place, "w.entry", "w.holder", "w.price"))
        held = cut(asked.join(lost, ["cid", "pid"], "left_anti"))
    else:
        raise RuntimeError(f"the auction has not ended in {most_rounds} rounds")
    got = held.select("cid", "pid").join(worth, ["cid", "pid"])
    taken = held.select("cid", "pid").join(claims, ["cid", "pid"]).select("pid", *place, "entry", F.col("cid").alias("holder"), F.lit(1.0).alias("price"))
    other = worth.select("cid", F.col("pid").alias("o"), F.col("points").alias("p")).join(got, "cid").where("o <> pid AND p >= points")
    free = other.join(costs(taken).select("cid", F.col("pid").alias("o"), "cost"), ["cid", "o"], "left_anti").select("cid").distinct()
    return calm.unionByName(got.join(free, "cid", "left_anti").select("cid", "pid", "points"))
