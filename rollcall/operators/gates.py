"""Gates over a finished build: expectations against what was found, as rows of errors.

An empty result lets a build pass. Expectations are small tables; the build's tables are
joined by key and never gathered.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_ERROR = ("gate", "fixture", "detail")


def _errors(rows: DataFrame, gate: str, fixture: str, detail) -> DataFrame:
    return rows.select(F.lit(gate).alias("gate"), F.col(fixture).alias("fixture"), detail.cast("string").alias("detail"))


def members_gate(members: DataFrame, expected: DataFrame) -> DataFrame:
    """Errors of fixtures (fixture, member) against members (pid, member).

    miss: no member is known; split: the known ones have several pids; incomplete: one pid
    holds them, but not this member (a row for each).
    """
    found = expected.join(members.select("member", "pid").distinct(), "member", "left")
    per = found.groupBy("fixture").agg(F.count("pid").alias("known"), F.count_distinct("pid").alias("pids"))
    miss = _errors(per.where("known = 0"), "miss", "fixture", F.lit(""))
    split = _errors(per.where("pids > 1"), "split", "fixture", F.col("pids"))
    absent = found.where("pid IS NULL").join(per.where("pids = 1").select("fixture"), "fixture")
    return miss.unionByName(split).unionByName(_errors(absent, "incomplete", "fixture", F.col("member")))


def apart_gate(members: DataFrame, pairs: DataFrame) -> DataFrame:
    """Errors of pairs (fixture, a, b) of members that must not share a pid; unknown ones pass."""
    m = members.select("member", "pid").distinct()
    both = pairs.join(m.select(F.col("member").alias("a"), "pid"), "a").join(m.select(F.col("member").alias("b"), F.col("pid").alias("other")), "b")
    return _errors(both.where("pid = other"), "merged", "fixture", F.col("pid"))


def shared_link_gate(persons: DataFrame, link: str, day: str) -> DataFrame:
    """Links and days that more than one pid has; detail is the number of pids."""
    known = persons.where(F.col(link).isNotNull() & F.col(day).isNotNull() & F.col("pid").isNotNull())
    rows = known.groupBy(F.concat_ws("|", link, day).alias("fixture")).agg(F.count_distinct("pid").alias("pids")).where("pids > 1")
    return _errors(rows, "same_link_and_day", "fixture", F.col("pids"))


def contests_gate(contests: DataFrame, rules: DataFrame) -> DataFrame:
    """Errors of rules (fixture, rule, contest, most) against contests (pid, contest, seat, source_row).

    fixture is a pid. exact: its contests are those of these rules and no others; contains:
    it has this one; excludes: none of its source rows is contest; seats: it has at most
    `most` distinct seats.
    """
    have = contests.select(F.col("pid").alias("fixture"), "contest").distinct()
    rule = lambda name: rules.where(F.col("rule") == name).select("fixture", "contest").distinct()
    exact = rule("exact")
    missing = _errors(exact.unionByName(rule("contains")).distinct().join(have, ["fixture", "contest"], "left_anti"), "missing", "fixture", F.col("contest"))
    extra = _errors(have.join(exact.select("fixture").distinct(), "fixture", "left_semi").join(exact, ["fixture", "contest"], "left_anti"), "extra", "fixture", F.col("contest"))
    rows = contests.select(F.col("pid").alias("fixture"), F.col("source_row").cast("string").alias("contest")).distinct()
    wrong = _errors(rule("excludes").join(rows, ["fixture", "contest"]), "wrongly_included", "fixture", F.col("contest"))
    seats = contests.where("seat <> ''").groupBy(F.col("pid").alias("fixture")).agg(F.count_distinct(F.lower("seat")).alias("seats"))
    many = rules.where("rule = 'seats'").join(seats, "fixture").where("seats > most")
    return reduce(DataFrame.unionByName, [missing, extra, wrong, _errors(many, "seats", "fixture", F.col("seats"))])


def namesakes_gate(persons: DataFrame, contests: DataFrame, expected: DataFrame) -> DataFrame:
    """Errors of fixtures (fixture, contest), where fixture is a part of a lower-case name.

    Of the persons (pid, name) whose name contains it the one with most contests must have
    the contest; equal ones by the least pid. nobody: no name contains it.
    """
    fixtures = expected.select("fixture").distinct()
    # fixtures are a short list kept by hand; a name is looked for in each
    named = persons.select("pid", F.lower("name").alias("name")).join(F.broadcast(fixtures), F.contains(F.col("name"), F.col("fixture"))).select("fixture", "pid").distinct()
    held = contests.groupBy("pid").agg(F.count("*").alias("n"))
    best = named.join(held, "pid", "left").groupBy("fixture").agg(F.min(F.struct((-F.coalesce("n", F.lit(0))).alias("o"), "pid")).alias("b")).select("fixture", "b.pid")
    nobody = _errors(fixtures.join(best, "fixture", "left_anti"), "nobody", "fixture", F.lit(""))
    missing = expected.join(best, "fixture").join(contests.select("pid", "contest").distinct(), ["pid", "contest"], "left_anti")
    return nobody.unionByName(_errors(missing, "missing", "fixture", F.col("contest")))
