"""Person-centred roll-ups: feeds, careers, boards, rosters and their orders."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollcall.functions import dates, names, places
from rollcall.operators import resolve
from rollcall.operators.ordinals import number_rows
from rollcall.session import load

CONTEST = ["year", "state_name", "constituency_name"]


def _questions(spark, sf_dir):
    """Each question of each member, with the pid its name stands for or none; listed twice is asked twice."""
    forms = resolve.lookup(load(spark, sf_dir, "persons"), "pid", "canonical_name").where("pids = 1").select("form", "pid")
    q = load(spark, sf_dir, "ls_questions").select("lok_sabha", "session", "type", "question_no", "ministry", "subject", F.explode("members").alias("raw")).where("trim(raw) <> ''")
    return q.withColumn("form", names.normal_form(F.col("raw"))).join(forms, "form", "left").drop("form")


def q_person_feed(spark, sf_dir):
    """A10: questions of each person by the resolver, starred ones and the latest term; unresolved names under none."""
    q = _questions(spark, sf_dir)
    return q.groupBy("pid").agg(F.count("*").alias("questions"), F.sum((F.upper("type") == "STARRED").cast("long")).alias("starred"), F.max("lok_sabha").alias("last_term"), F.count_distinct("raw").alias("spellings"))


def q_corpus_stats(spark, sf_dir):
    """The counters of a corpus, each key with its count and its place, most first.

    Ministries count records with a member; sessions and types those of the newest term;
    states and parties persons of the lower house; houses and kinds of debates their days.
    """
    q = load(spark, sf_dir, "ls_questions")
    asked = q.where(F.exists("members", lambda m: F.trim(m) != ""))
    newest = q.agg(F.max("lok_sabha")).first()[0]
    t = load(spark, sf_dir, "tenures").where("office_type = 'ls'")
    d = load(spark, sf_dir, "rs_debate_days").select(F.explode("file_versions").alias("v"))
    count = lambda df, what, key, n=F.count("*"): df.groupBy(key.cast("string").alias("key")).agg(n.alias("n")).select(F.lit(what).alias("what"), "key", "n")
    counters = [
        count(asked, "ministry", F.lower(F.trim("ministry"))), count(q.where(F.col("lok_sabha") == newest), "session", F.col("session")), count(q.where(F.col("lok_sabha") == newest), "type", F.upper("type")),
        count(t, "state", places.state(F.col("state")), F.count_distinct("pid")), count(t, "party", places.party(F.col("party_short")), F.count_distinct("pid")), count(d, "version", F.lower(F.trim("v.version"))), count(load(spark, sf_dir, "documents"), "source", F.col("source")),
    ]
    return number_rows(reduce(DataFrame.unionByName, counters), ["what"], [F.desc("n"), F.col("key")], "place")


def q_career_terms(spark, sf_dir):
    """Terms of each person by house and together, distinct lists, the latest term, and whether both houses."""
    t = load(spark, sf_dir, "tenures").where("pid IS NOT NULL").withColumns({"party": places.party(F.col("party_short")), "st": places.state(F.col("state")), "year": F.year(dates.parse_day(F.col("term_start")))})
    houses = lambda h: F.sum((F.col("office_type") == h).cast("long"))
    listed = lambda c: F.array_join(F.array_sort(F.collect_set(F.nullif(F.col(c), F.lit("")))), "|")
    latest = F.max(F.struct(F.coalesce("year", F.lit(0)).alias("y"), "id", "office_type"))
    c = t.groupBy("pid").agg(houses("ls").alias("ls_terms"), houses("rs").alias("rs_terms"), F.count("*").alias("terms"), listed("party").alias("parties"), listed("st").alias("states"), F.min("year").alias("first_year"), F.max("year").alias("last_year"), latest.alias("l"))
    return c.select("pid", "ls_terms", "rs_terms", "terms", "parties", "states", "first_year", "last_year", F.col("l.id").alias("latest_id"), F.col("l.office_type").alias("latest_house"), ((F.col("ls_terms") > 0) & (F.col("rs_terms") > 0)).alias("spans_houses"))


def _shares(spark, sf_dir):
    """Candidates of each contest, equal rows once, with their share of its votes and the winner's margin."""
    c = load(spark, sf_dir, "tcpd_tuples").select("pid", *CONTEST, "position", "votes").distinct()
    total = c.groupBy(*CONTEST).agg(F.sum("votes").alias("total"), F.max(F.when(F.col("position") == 1, F.col("votes"))).alias("won"), F.max(F.when(F.col("position") > 1, F.col("votes"))).alias("next"))
    return c.join(total, CONTEST)  # null keys are no contest


def q_contest_shares(spark, sf_dir):
    """Votes of each contest, the winner's share of them and the margin to the next."""
    s = _shares(spark, sf_dir).where("position = 1 AND total > 0")
    return s.select("pid", *CONTEST, "total", F.round(F.col("votes") / F.col("total"), 4).alias("share"), F.round((F.col("won") - F.col("next")) / F.col("total"), 4).alias("margin"))


def q_boards(spark, sf_dir):
    """Four more boards of a hundred: crossovers between kinds of contests, first timers who won, dominant and closest wins."""
    c = load(spark, sf_dir, "tcpd_tuples").where("pid IS NOT NULL")
    newest = c.agg(F.max("year")).first()[0]
    won = F.coalesce((F.col("position") == 1).cast("long"), F.lit(0))
    cid = c.groupBy(F.substring("pid", 3, 100).alias("who")).agg(F.count_distinct(F.substring("pid", 1, 2)).alias("kinds"), F.count("*").alias("contests"), F.sum(won).alias("wins"), F.min("year").alias("first_year"))
    s = _shares(spark, sf_dir).where("position = 1 AND total > 0 AND pid IS NOT NULL AND next IS NOT NULL").select(F.concat_ws("|", F.substring("pid", 3, 100), *CONTEST).alias("who"), ((F.col("won") - F.col("next")) / F.col("total")).alias("margin"), F.col("votes").cast("double").alias("v")).distinct()
    board = lambda df, name, a, b, order: df.select(F.lit(name).alias("board"), "who", a.cast("double").alias("first_value"), b.cast("double").alias("second_value")).orderBy(*order, "who").limit(100)
    down = [F.desc("first_value"), F.desc("second_value")]
    boards = [
        board(cid.where("kinds > 1"), "crossovers", F.col("kinds"), F.col("contests"), down), board(cid.where(F.col("first_year") == newest).where("wins > 0"), "first_timers", F.col("wins"), F.col("contests"), down),
        board(s, "dominant_wins", F.round("margin", 6), F.col("v"), down), board(s, "closest_wins", F.round("margin", 6), F.col("v"), [F.asc("first_value"), F.desc("second_value")]),
    ]
    return reduce(DataFrame.unionByName, boards)


def q_rosters(spark, sf_dir):
    """Persons by state and party and by party and state, each with its place within the outer key."""
    t = load(spark, sf_dir, "tenures").where("office_type IN ('ls', 'rs') AND pid IS NOT NULL").select("pid", places.state(F.col("state")).alias("state"), places.party(F.col("party_short")).alias("party"), "questions_count", "speeches_count", "bills_count")
    n = t.groupBy("state", "party").agg(F.count_distinct("pid").alias("persons"), *[F.coalesce(F.sum(f"{c}_count"), F.lit(0)).alias(c) for c in ("questions", "speeches", "bills")])
    both = n.select(F.lit("state").alias("kind"), F.col("state").alias("outer_key"), F.col("party").alias("inner_key"), "persons", "questions", "speeches", "bills").union(n.select(F.lit("party"), "party", "state", "persons", "questions", "speeches", "bills"))
    rank = F.row_number().over(Window.partitionBy("kind", "outer_key").orderBy(F.desc("persons"), "inner_key"))  # as many rows as states or parties
    return both.withColumn("place", rank)


def q_slim_person_index(spark, sf_dir):
    """Rosters of states by sitting, activity and name, and the states by their totals."""
    t = load(spark, sf_dir, "tenures").where("office_type = 'ls' AND pid IS NOT NULL").groupBy("pid").agg(F.max(F.coalesce("sitting", F.lit(0))).alias("current"), F.sum(F.coalesce("questions_count", F.lit(0)) + F.coalesce("speeches_count", F.lit(0))).alias("activity"), F.min(places.state(F.col("state"))).alias("state"))
    name = load(spark, sf_dir, "persons").groupBy("pid").agg(F.min(names.normal_form(F.col("canonical_name"))).alias("name"))
    t = number_rows(t.join(name, "pid", "left"), ["state"], [F.desc("current"), F.desc("activity"), F.asc_nulls_first("name"), F.col("pid")], "place")
    totals = t.groupBy("state").agg(F.sum("activity").alias("total"))
    totals = totals.withColumn("state_place", F.row_number().over(Window.orderBy(F.desc("total"), "state")))  # a row for each state
    return t.join(totals.withColumnRenamed("state", "s"), F.col("state").eqNullSafe(F.col("s"))).select("state", "state_place", "place", "pid", "name", "current", "activity")


def q_export_orders(spark, sf_dir):
    """Places of records in the exports of debates and questions, and in the queue of bundles."""
    place = lambda df, feed, order, key: number_rows(df.distinct(), [], order, "place").select(F.lit(feed).alias("feed"), F.concat_ws("|", *key).alias("key"), "place")
    d = load(spark, sf_dir, "rs_debate_days").select("session", "date_iso")
    q = load(spark, sf_dir, "ls_questions").select("lok_sabha", "session", "type", "question_no")
    b = load(spark, sf_dir, "rs_question_bundles").where("coalesce(pdf_url, '') <> ''").select("session", "date_iso", "type")
    starred = F.when(F.upper("type") == "STARRED", 0).otherwise(1)
    return (
        place(d, "debates", [F.desc("session"), F.desc_nulls_last("date_iso")], ["session", "date_iso"])
        .union(place(q, "questions", [F.desc("lok_sabha"), F.desc("session"), F.asc("type"), F.asc("question_no")], ["lok_sabha", "session", "type", "question_no"]))
        .union(place(b, "bundle_queue", [F.desc("session"), F.desc_nulls_last("date_iso"), starred, F.asc("type")], ["session", "date_iso", "type"]))
    )


def q_person_contests(spark, sf_dir):
    """Each candidate's contests in one list by year (none as 0), kind and place, with their summary."""
    c = load(spark, sf_dir, "tcpd_tuples").where("pid IS NOT NULL").select(F.substring("pid", 3, 100).alias("who"), F.substring("pid", 1, 2).alias("kind"), F.coalesce("year", F.lit(0)).alias("year"), names.slug(F.col("constituency_name")).alias("seat"), "position", "tuple_id")
    listed = F.array_sort(F.collect_list(F.struct("year", "kind", "seat", "tuple_id", F.coalesce(F.col("position").cast("string"), F.lit("?")).alias("position"))))
    text = F.array_join(F.transform(listed, lambda x: F.concat_ws(":", x["year"], x["kind"], x["seat"], x["position"])), "|")
    won = F.sum(F.coalesce((F.col("position") == 1).cast("long"), F.lit(0)))
    return c.groupBy("who").agg(text.alias("contests"), F.count("*").alias("n"), won.alias("wins"), F.min(F.nullif("year", F.lit(0))).alias("first_year"), F.max(F.nullif("year", F.lit(0))).alias("last_year"))


QUERIES = {f.__name__: f for f in (q_person_feed, q_corpus_stats, q_career_terms, q_contest_shares, q_boards, q_rosters, q_slim_person_index, q_export_orders, q_person_contests)}

from rollcall.plans.intervals import _day  # noqa: E402
from rollcall.plans.scalars import NORMAL, PARTY, SLUG, STATE  # noqa: E402

_ST = STATE.replace("state_name", "state")
_PS = PARTY.format(c="party_short")
_SH = "c AS (SELECT DISTINCT pid, year, state_name, constituency_name, position, votes FROM tcpd_tuples), k AS (SELECT year, state_name, constituency_name, sum(votes)::BIGINT AS total, max(votes) FILTER (position = 1) AS won, max(votes) FILTER (position > 1) AS nxt FROM c GROUP BY ALL), s AS (SELECT c.*, total, won, nxt FROM c JOIN k USING (year, state_name, constituency_name))"
_LISTED = "coalesce(array_to_string(list_sort(list(DISTINCT nullif({c}, '')) FILTER (nullif({c}, '') IS NOT NULL)), '|'), '')"


def _board(table: str, name: str, where: str, a: str, b: str, order: str) -> str:
    return f"(SELECT '{name}' AS board, who, ({a})::DOUBLE AS first_value, ({b})::DOUBLE AS second_value FROM {table} WHERE {where} ORDER BY {order}, who LIMIT 100)"


SQL = {
    "q_person_feed": f"WITH f AS (SELECT {NORMAL.format(c='canonical_name')} AS form, min(pid) AS pid FROM persons WHERE pid IS NOT NULL GROUP BY 1 HAVING count(DISTINCT pid) = 1 AND form <> ''), q AS (SELECT lok_sabha, type, unnest(members) AS raw FROM ls_questions) SELECT pid, count(*) AS questions, count(*) FILTER (upper(type) = 'STARRED') AS starred, max(lok_sabha) AS last_term, count(DISTINCT raw) AS spellings FROM q LEFT JOIN f ON f.form = {NORMAL.format(c='raw')} WHERE trim(raw, ' ') <> '' GROUP BY pid",
    "q_corpus_stats": f"""WITH m AS (SELECT max(lok_sabha) AS newest FROM ls_questions), x AS (
SELECT 'ministry' AS what, lower(trim(ministry, ' ')) AS key, count(*) AS n FROM ls_questions WHERE len(list_filter(members, lambda m: trim(m, ' ') <> '')) > 0 GROUP BY 2
UNION ALL SELECT 'session', session::VARCHAR, count(*) FROM ls_questions, m WHERE lok_sabha = newest GROUP BY 2 UNION ALL SELECT 'type', upper(type), count(*) FROM ls_questions, m WHERE lok_sabha = newest GROUP BY 2
UNION ALL SELECT 'state', {_ST}, count(DISTINCT pid) FROM tenures WHERE office_type = 'ls' GROUP BY 2 UNION ALL SELECT 'party', {_PS}, count(DISTINCT pid) FROM tenures WHERE office_type = 'ls' GROUP BY 2
UNION ALL SELECT 'version', lower(trim(v.version, ' ')), count(*) FROM (SELECT unnest(file_versions) AS v FROM rs_debate_days) GROUP BY 2 UNION ALL SELECT 'source', source, count(*) FROM documents GROUP BY 2)
SELECT *, row_number() OVER (PARTITION BY what ORDER BY n DESC, key NULLS FIRST) AS place FROM x""",
    "q_career_terms": f"""WITH t AS (SELECT *, {_PS} AS party, {_ST} AS st, year({_day('term_start')}) AS y FROM tenures WHERE pid IS NOT NULL)
SELECT pid, count(*) FILTER (office_type = 'ls') AS ls_terms, count(*) FILTER (office_type = 'rs') AS rs_terms, count(*) AS terms, {_LISTED.format(c='party')} AS parties, {_LISTED.format(c='st')} AS states, min(y)::INT AS first_year, max(y)::INT AS last_year,
arg_max(id, {{'y': coalesce(y, 0), 'i': id}}) AS latest_id, arg_max(office_type, {{'y': coalesce(y, 0), 'i': id}}) AS latest_house, bool_or(office_type = 'ls') AND bool_or(office_type = 'rs') AS spans_houses FROM t GROUP BY pid""",
    "q_contest_shares": f"WITH {_SH} SELECT pid, year, state_name, constituency_name, total, round(votes / total::DOUBLE, 4) AS share, round((won - nxt) / total::DOUBLE, 4) AS margin FROM s WHERE position = 1 AND total > 0",
    "q_boards": f"""WITH {_SH}, d AS (SELECT substr(pid, 3) AS who, count(DISTINCT substr(pid, 1, 2)) AS kinds, count(*) AS contests, count(*) FILTER (position = 1) AS wins, min(year) AS first_year FROM tcpd_tuples WHERE pid IS NOT NULL GROUP BY 1),
m AS (SELECT DISTINCT concat_ws('|', substr(pid, 3), year, state_name, constituency_name) AS who, round((won - nxt) / total::DOUBLE, 6) AS margin, votes::DOUBLE AS v FROM s WHERE position = 1 AND total > 0 AND pid IS NOT NULL AND nxt IS NOT NULL)
"""
    + " UNION ALL ".join([
        _board("d", "crossovers", "kinds > 1", "kinds", "contests", "kinds DESC, contests DESC"), _board("d", "first_timers", "wins > 0 AND first_year = (SELECT max(year) FROM tcpd_tuples WHERE pid IS NOT NULL)", "wins", "contests", "wins DESC, contests DESC"),
        _board("m", "dominant_wins", "true", "margin", "v", "margin DESC, v DESC"), _board("m", "closest_wins", "true", "margin", "v", "margin, v DESC"),
    ]),
    "q_rosters": f"""WITH t AS (SELECT pid, {_ST} AS st, {_PS} AS party, questions_count AS q, speeches_count AS s, bills_count AS b FROM tenures WHERE office_type IN ('ls', 'rs') AND pid IS NOT NULL),
n AS (SELECT st, party, count(DISTINCT pid) AS persons, coalesce(sum(q), 0)::BIGINT AS questions, coalesce(sum(s), 0)::BIGINT AS speeches, coalesce(sum(b), 0)::BIGINT AS bills FROM t GROUP BY st, party),
x AS (SELECT 'state' AS kind, st AS outer_key, party AS inner_key, persons, questions, speeches, bills FROM n UNION ALL SELECT 'party', party, st, persons, questions, speeches, bills FROM n)
SELECT *, row_number() OVER (PARTITION BY kind, outer_key ORDER BY persons DESC, inner_key) AS place FROM x""",
    "q_slim_person_index": f"""WITH t AS (SELECT pid, max(coalesce(sitting, 0)) AS current, sum(coalesce(questions_count, 0) + coalesce(speeches_count, 0))::BIGINT AS activity, min({_ST}) AS state FROM tenures WHERE office_type = 'ls' AND pid IS NOT NULL GROUP BY pid),
n AS (SELECT pid, min({NORMAL.format(c='canonical_name')}) AS name FROM persons GROUP BY pid), s AS (SELECT state, row_number() OVER (ORDER BY sum(activity) DESC, state) AS state_place FROM t GROUP BY state)
SELECT t.state, state_place, row_number() OVER (PARTITION BY t.state ORDER BY current DESC, activity DESC, name NULLS FIRST, t.pid) AS place, t.pid, name, current, activity FROM t LEFT JOIN n ON n.pid = t.pid JOIN s ON s.state = t.state""",
    "q_export_orders": """SELECT 'debates' AS feed, concat_ws('|', session, date_iso) AS key, row_number() OVER (ORDER BY session DESC, date_iso DESC NULLS LAST) AS place FROM (SELECT DISTINCT session, date_iso FROM rs_debate_days)
UNION ALL SELECT 'questions', concat_ws('|', lok_sabha, session, type, question_no), row_number() OVER (ORDER BY lok_sabha DESC, session DESC, type, question_no) FROM (SELECT DISTINCT lok_sabha, session, type, question_no FROM ls_questions)
UNION ALL SELECT 'bundle_queue', concat_ws('|', session, date_iso, type), row_number() OVER (ORDER BY session DESC, date_iso DESC NULLS LAST, CASE WHEN upper(type) = 'STARRED' THEN 0 ELSE 1 END, type) FROM (SELECT DISTINCT session, date_iso, type FROM rs_question_bundles WHERE coalesce(pdf_url, '') <> '')""",
    "q_person_contests": f"""WITH c AS (SELECT substr(pid, 3) AS who, substr(pid, 1, 2) AS kind, coalesce(year, 0) AS y, {SLUG.format(c='constituency_name')} AS seat, position, tuple_id FROM tcpd_tuples WHERE pid IS NOT NULL)
SELECT who, string_agg(concat_ws(':', y, kind, seat, coalesce(position::VARCHAR, '?')), '|' ORDER BY y, kind, seat, tuple_id) AS contests, count(*) AS n, count(*) FILTER (position = 1) AS wins, min(nullif(y, 0)) AS first_year, max(nullif(y, 0)) AS last_year FROM c GROUP BY who""",
}
