"""Deduplication, ranking, top-k and roll-ups."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from rollcall.functions import dates, names, places
from rollcall.operators.dedupe import descending, keep_best, nulls_last
from rollcall.operators.ordinals import number_rows
from rollcall.session import load


def _micros(c):
    return F.unix_micros(F.col(c).cast("timestamp"))


def q_last_wins(spark, sf_dir):
    """The last build of each person."""
    p = load(spark, sf_dir, "persons").select("pid", "rec_id", "canonical_name", "built_at")
    return keep_best(p, ["pid"], [descending(_micros("built_at")), descending(F.col("rec_id"))]).select("pid", "rec_id", "canonical_name")


def q_first_wins(spark, sf_dir):
    """The first build of each person."""
    p = load(spark, sf_dir, "persons").select("pid", "rec_id", "canonical_name", "built_at")
    return keep_best(p, ["pid"], [_micros("built_at"), F.col("rec_id")]).select("pid", "rec_id", "canonical_name")


def q_dedupe_priority(spark, sf_dir):
    """Terms by the priority of their status, then first."""
    t = load(spark, sf_dir, "tenures")
    priority = F.when(F.col("status") == "Sitting", 3).when(F.col("status").isin("Former", "Retirement"), 2).when(F.col("sitting") == 1, 1).otherwise(0)
    t = t.select("office_type", "external_id", "term_label", "id", "pid", priority.alias("priority"))
    return keep_best(t, ["office_type", "external_id", "term_label"], [-F.col("priority"), F.col("id")]).select("office_type", "external_id", "term_label", "id", "priority")


def q_cross_house(spark, sf_dir):
    """One term for each person, the lower house before the upper, sitting first."""
    t = load(spark, sf_dir, "tenures").where("office_type IN ('ls', 'rs')").select("pid", "id", "office_type", F.coalesce("sitting", F.lit(0)).alias("sitting"))
    return keep_best(t, ["pid"], [F.when(F.col("office_type") == "ls", 0).otherwise(1), -F.col("sitting"), F.col("id")])


def q_contest_dedupe(spark, sf_dir):
    """Of each contest of a candidate the best position, unknown ones last."""
    c = load(spark, sf_dir, "tcpd_tuples").select("pid", "year", "state_name", "constituency_name", "position", "tuple_id")
    return keep_best(c, ["pid", "year", "state_name", "constituency_name"], [nulls_last(F.col("position")), F.col("tuple_id")])


def q_alias_history(spark, sf_dir):
    """Contests across a candidate's ids, the general-election id first."""
    c = load(spark, sf_dir, "tcpd_tuples").select(F.substring("pid", 3, 100).alias("cid"), "pid", "year", F.upper(F.trim("constituency_name")).alias("seat"), "position", "tuple_id")
    return keep_best(c, ["cid", "year", "seat", "position"], [F.when(F.startswith("pid", F.lit("GE")), 0).otherwise(1), F.col("tuple_id")])


def q_latest(spark, sf_dir):
    """The latest term of each person; sitting only in the current term."""
    t = load(spark, sf_dir, "tenures").where("office_type = 'ls'").select("pid", "id", dates.term_number(F.col("term_label")).alias("term"), "sitting", "party_short")
    t = t.where("term IS NOT NULL")
    current = t.agg(F.max("term")).first()[0]
    latest = keep_best(t, ["pid"], [-F.col("term"), F.col("id")])
    return latest.select("pid", "term", "party_short", F.when((F.col("sitting") == 1) & (F.col("term") == current), "Sitting").otherwise("Former").alias("status"))


def q_latest_contest(spark, sf_dir):
    """The latest contest, once with the first and once with the last row of a tie."""
    c = load(spark, sf_dir, "tcpd_tuples").select("pid", "year", "tuple_id").where("year IS NOT NULL AND pid IS NOT NULL")
    return c.groupBy("pid").agg(F.max("year").alias("last_year"), (-F.max(F.struct("year", (-F.col("tuple_id")).alias("t")))["t"]).alias("first_of_tie"), F.max(F.struct("year", "tuple_id"))["tuple_id"].alias("last_of_tie"))


def q_modal(spark, sf_dir):
    """The most frequent party of each candidate, ties to the first seen."""
    c = load(spark, sf_dir, "tcpd_tuples").groupBy("pid", places.party(F.col("party")).alias("party")).agg(F.count("*").alias("n"), F.min("tuple_id").alias("seen"))
    return keep_best(c, ["pid"], [-F.col("n"), F.col("seen")]).select("pid", "party", "n")


def q_counts(spark, sf_dir):
    """Counts, first and last years, and states of each candidate."""
    c = load(spark, sf_dir, "tcpd_tuples")
    return c.groupBy("pid").agg(F.count("*").alias("n"), F.min("year").alias("first_year"), F.max("year").alias("last_year"), F.array_join(F.array_sort(F.collect_set(places.state(F.col("state_name")))), "|").alias("states"))


def _careers(spark, sf_dir):
    c = load(spark, sf_dir, "tcpd_tuples").where("pid IS NOT NULL")
    party, state, seat = places.party(F.col("party")), places.state(F.col("state_name")), places.constituency(F.col("constituency_name"))
    won = F.sum(F.coalesce((F.col("position") == 1).cast("long"), F.lit(0)))
    return c.groupBy("pid").agg(
        F.count("*").alias("contests"), won.alias("wins"), F.count_distinct(party).alias("n_parties"), F.count_distinct(seat).alias("n_seats"), F.count_distinct(state).alias("n_states"),
        F.min("year").alias("first_year"), F.max("year").alias("last_year"), F.max("votes").alias("most_votes"), F.count_distinct(F.substring("pid", 1, 2)).alias("kinds"),
    )


def q_careers(spark, sf_dir):
    """One wide row for each candidate."""
    return _careers(spark, sf_dir)


def q_leaderboards(spark, sf_dir):
    """Boards of a hundred, in one table."""
    c = _careers(spark, sf_dir)
    boards = [("turncoats", c.where("n_parties > 1"), ["n_parties", "contests"]), ("seat_hoppers", c.where("n_seats > 1"), ["n_seats", "contests"]), ("veterans", c, ["contests", "wins"]), ("top_winners", c.where("wins > 0"), ["wins", "contests"])]
    out = None
    for name, rows, order in boards:
        top = rows.orderBy(*[F.desc(o) for o in order], "pid").limit(100).select(F.lit(name).alias("board"), "pid", *[F.col(o).alias(a) for o, a in zip(order, ("first_value", "second_value"))])
        out = top if out is None else out.union(top)
    return out


def q_party_history(spark, sf_dir):
    """Contests and terms of each party in one list, with their source."""
    c = load(spark, sf_dir, "tcpd_tuples").select(F.lit("contest").alias("kind"), places.party(F.col("party")).alias("party"), "year")
    t = load(spark, sf_dir, "tenures").select(F.lit("term").alias("kind"), places.party(F.col("party_short")).alias("party"), F.year(dates.parse_day(F.col("term_start"))).alias("year"))
    return c.unionByName(t).groupBy("kind", "party").agg(F.count("*").alias("n"), F.min("year").alias("first_year"), F.max("year").alias("last_year"))


def q_stats_counter(spark, sf_dir):
    """Questions of each ministry with at least one member, most first."""
    q = load(spark, sf_dir, "ls_questions").where(F.exists("members", lambda m: F.trim(m) != ""))
    n = q.groupBy(F.lower(F.trim("ministry")).alias("ministry")).agg(F.count("*").alias("n"), F.count_distinct("session").alias("sessions"))
    return n


def q_pivot_feeds(spark, sf_dir):
    """what each spelling of a member asked; twice in a record counts twice."""
    q = load(spark, sf_dir, "ls_questions").select("lok_sabha", "type", F.explode("members").alias("member")).where("trim(member) <> ''")
    return q.groupBy("member").agg(F.count("*").alias("questions"), F.sum((F.upper("type") == "STARRED").cast("long")).alias("starred"), F.max("lok_sabha").alias("last_term"))


def q_roster_rollup(spark, sf_dir):
    """Members and sums by state and house; states of either house survive."""
    t = load(spark, sf_dir, "tenures").select(places.state(F.col("state")).alias("state"), "office_type", "pid", "speeches_count", "questions_count", "bills_count")
    ls = t.where("office_type = 'ls'").groupBy("state").agg(F.count_distinct("pid").alias("ls_members"), F.sum("questions_count").alias("questions"), F.sum("speeches_count").alias("speeches"))
    rs = t.where("office_type = 'rs'").groupBy("state").agg(F.count_distinct("pid").alias("rs_members"))
    return ls.join(rs, "state", "full_outer").select("state", F.coalesce("ls_members", F.lit(0)).alias("ls_members"), F.coalesce("rs_members", F.lit(0)).alias("rs_members"), F.coalesce("questions", F.lit(0)).alias("questions"), F.coalesce("speeches", F.lit(0)).alias("speeches"))


def q_ministry(spark, sf_dir):
    """Spellings of a ministry under one slug, and its twenty busiest members."""
    q = load(spark, sf_dir, "ls_questions").select(names.slug(F.col("ministry")).alias("slug"), "ministry", "members")
    by = q.select("slug", F.explode("members").alias("member")).where("trim(member) <> ''").groupBy("slug", "member").agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy("slug").orderBy(F.desc("n"), "member"))
    return by.withColumn("place", rank).where("place <= 20")


def q_ministry_names(spark, sf_dir):
    """The name shown for each slug, the first that is not all capitals."""
    q = load(spark, sf_dir, "ls_questions").where("ministry IS NOT NULL").select(names.slug(F.col("ministry")).alias("slug"), "ministry").groupBy("slug", "ministry").agg(F.count("*").alias("n"))
    shouted = (F.upper("ministry") == F.col("ministry")).cast("int")
    total = q.groupBy("slug").agg(F.sum("n").alias("n"), F.count("*").alias("spellings"))
    return keep_best(q.select("slug", "ministry", shouted.alias("shouted")), ["slug"], [F.col("shouted"), F.col("ministry")]).select("slug", "ministry").join(total, "slug")


def q_index_totals(spark, sf_dir):
    """Totals over all tables in one row."""
    totals = []
    for table, column, expr in (("ls_questions", "questions", F.count("*")), ("persons", "persons", F.count_distinct("pid")), ("tenures", "terms", F.count("*")), ("tcpd_tuples", "wins", F.sum(F.coalesce((F.col("position") == 1).cast("long"), F.lit(0)))), ("documents", "texts", F.count("text"))):
        totals.append(load(spark, sf_dir, table).agg(expr.alias("n")).select(F.lit(column).alias("what"), "n"))
    out = totals[0]
    for t in totals[1:]:
        out = out.union(t)
    return out


def q_slim_roster(spark, sf_dir):
    """each state's roster, sitting first, then by activity and name."""
    t = load(spark, sf_dir, "tenures").where("office_type = 'ls' AND pid IS NOT NULL").groupBy("pid").agg(F.max(F.coalesce("sitting", F.lit(0))).alias("current"), F.sum(F.coalesce("questions_count", F.lit(0)) + F.coalesce("speeches_count", F.lit(0))).alias("activity"), F.min(places.state(F.col("state"))).alias("state"))
    return number_rows(t, ["state"], [F.desc("current"), F.desc("activity"), F.col("pid")], "place")


def q_feed_order(spark, sf_dir):
    """Places within each question feed, newest day first, unknown days last."""
    q = load(spark, sf_dir, "ls_questions").select("lok_sabha", "session", "type", "question_no", dates.sort_key(F.col("date"), ".").alias("day")).distinct()
    return number_rows(q, ["lok_sabha", "session", "type"], [F.desc("day"), F.desc("question_no")], "place")


QUERIES = {f.__name__: f for f in (q_last_wins, q_first_wins, q_dedupe_priority, q_cross_house, q_contest_dedupe, q_alias_history, q_latest, q_latest_contest, q_modal, q_counts, q_careers, q_leaderboards, q_party_history, q_stats_counter, q_pivot_feeds, q_roster_rollup, q_ministry, q_ministry_names, q_index_totals, q_slim_roster, q_feed_order)}

from rollcall.plans.intervals import _day  # noqa: E402
from rollcall.plans.scalars import CONS, PARTY, SLUG, STATE  # noqa: E402

_P = PARTY.format(c="party")
_C = CONS.format(c="constituency_name")
_ST = STATE.replace("state_name", "state")
_CAREERS = f"c AS (SELECT pid, count(*) AS contests, count(*) FILTER (position = 1) AS wins, count(DISTINCT {_P}) AS n_parties, count(DISTINCT {_C}) AS n_seats, count(DISTINCT {STATE}) AS n_states, min(year) AS first_year, max(year) AS last_year, max(votes) AS most_votes, count(DISTINCT substr(pid, 1, 2)) AS kinds FROM tcpd_tuples WHERE pid IS NOT NULL GROUP BY pid)"
_TERM = "CASE WHEN regexp_full_match(term_label, 'LS[0-9]+') THEN cast(substr(term_label, 3) AS INT) END"
_KEY4 = "CASE WHEN len(string_split(date, '.')) = 3 THEN string_split(date, '.')[3] || '-' || string_split(date, '.')[2] || '-' || string_split(date, '.')[1] ELSE coalesce(date, '') END"


def _first(columns: str, table: str, keys: str, order: str) -> str:
    return f"SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS r__ FROM {table}) WHERE r__ = 1"


def _board(name: str, where: str, a: str, b: str) -> str:
    return f"(SELECT '{name}' AS board, pid, {a} AS first_value, {b} AS second_value FROM c WHERE {where} ORDER BY {a} DESC, {b} DESC, pid LIMIT 100)"


SQL = {
    "q_last_wins": _first("pid, rec_id, canonical_name", "persons", "pid", "built_at DESC NULLS LAST, rec_id DESC"),
    "q_first_wins": _first("pid, rec_id, canonical_name", "persons", "pid", "built_at NULLS FIRST, rec_id"),
    "q_dedupe_priority": _first("office_type, external_id, term_label, id, priority", "(SELECT *, CASE WHEN status = 'Sitting' THEN 3 WHEN status IN ('Former', 'Retirement') THEN 2 WHEN sitting = 1 THEN 1 ELSE 0 END AS priority FROM tenures)", "office_type, external_id, term_label", "priority DESC, id"),
    "q_cross_house": _first("pid, id, office_type, coalesce(sitting, 0) AS sitting", "(SELECT * FROM tenures WHERE office_type IN ('ls', 'rs'))", "pid", "CASE WHEN office_type = 'ls' THEN 0 ELSE 1 END, coalesce(sitting, 0) DESC, id"),
    "q_contest_dedupe": _first("pid, year, state_name, constituency_name, position, tuple_id", "tcpd_tuples", "pid, year, state_name, constituency_name", "coalesce(position, 1000000000), tuple_id"),
    "q_alias_history": _first("cid, pid, year, seat, position, tuple_id", "(SELECT substr(pid, 3) AS cid, pid, year, upper(trim(constituency_name, ' ')) AS seat, position, tuple_id FROM tcpd_tuples)", "cid, year, seat, position", "CASE WHEN pid LIKE 'GE%' THEN 0 ELSE 1 END, tuple_id"),
    "q_latest": f"WITH t AS (SELECT pid, id, {_TERM} AS term, sitting, party_short FROM tenures WHERE office_type = 'ls'), l AS ({_first('*', '(SELECT * FROM t WHERE term IS NOT NULL)', 'pid', 'term DESC, id')}) SELECT pid, term, party_short, CASE WHEN sitting = 1 AND term = (SELECT max(term) FROM t) THEN 'Sitting' ELSE 'Former' END AS status FROM l",
    "q_latest_contest": "SELECT pid, max(year) AS last_year, arg_max(tuple_id, {'y': year, 't': -tuple_id}) AS first_of_tie, arg_max(tuple_id, {'y': year, 't': tuple_id}) AS last_of_tie FROM tcpd_tuples WHERE year IS NOT NULL AND pid IS NOT NULL GROUP BY pid",
    "q_modal": _first("pid, party, n", f"(SELECT pid, {_P} AS party, count(*) AS n, min(tuple_id) AS seen FROM tcpd_tuples GROUP BY 1, 2)", "pid", "n DESC, seen"),
    "q_counts": f"SELECT pid, count(*) AS n, min(year) AS first_year, max(year) AS last_year, array_to_string(list_sort(list(DISTINCT {STATE})), '|') AS states FROM tcpd_tuples GROUP BY pid",
    "q_careers": f"WITH {_CAREERS} SELECT * FROM c",
    "q_leaderboards": f"WITH {_CAREERS} " + " UNION ALL ".join([_board("turncoats", "n_parties > 1", "n_parties", "contests"), _board("seat_hoppers", "n_seats > 1", "n_seats", "contests"), _board("veterans", "true", "contests", "wins"), _board("top_winners", "wins > 0", "wins", "contests")]),
    "q_party_history": f"SELECT kind, party, count(*) AS n, min(year) AS first_year, max(year) AS last_year FROM (SELECT 'contest' AS kind, {_P} AS party, year FROM tcpd_tuples UNION ALL SELECT 'term', {PARTY.format(c='party_short')}, year({_day('term_start')}) FROM tenures) GROUP BY kind, party",
    "q_stats_counter": "SELECT lower(trim(ministry, ' ')) AS ministry, count(*) AS n, count(DISTINCT session) AS sessions FROM ls_questions WHERE len(list_filter(members, lambda m: trim(m, ' ') <> '')) > 0 GROUP BY 1",
    "q_pivot_feeds": "SELECT member, count(*) AS questions, count(*) FILTER (upper(type) = 'STARRED') AS starred, max(lok_sabha) AS last_term FROM (SELECT lok_sabha, type, unnest(members) AS member FROM ls_questions) WHERE trim(member, ' ') <> '' GROUP BY member",
    "q_roster_rollup": f"WITH t AS (SELECT *, {_ST} AS st FROM tenures), l AS (SELECT st, count(DISTINCT pid) AS n, sum(questions_count) AS q, sum(speeches_count) AS s FROM t WHERE office_type = 'ls' GROUP BY st), r AS (SELECT st, count(DISTINCT pid) AS n FROM t WHERE office_type = 'rs' GROUP BY st) SELECT coalesce(l.st, r.st) AS state, coalesce(l.n, 0) AS ls_members, coalesce(r.n, 0) AS rs_members, cast(coalesce(q, 0) AS BIGINT) AS questions, cast(coalesce(s, 0) AS BIGINT) AS speeches FROM l FULL OUTER JOIN r ON l.st = r.st",
    "q_ministry": f"WITH m AS (SELECT {SLUG.format(c='ministry')} AS slug, unnest(members) AS member FROM ls_questions), n AS (SELECT slug, member, count(*) AS n FROM m WHERE trim(member, ' ') <> '' GROUP BY slug, member) SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY n DESC, member) AS place FROM n) WHERE place <= 20",
    "q_ministry_names": f"WITH q AS (SELECT {SLUG.format(c='ministry')} AS slug, ministry, count(*) AS n FROM ls_questions WHERE ministry IS NOT NULL GROUP BY 1, 2), t AS (SELECT slug, cast(sum(n) AS BIGINT) AS n, count(*) AS spellings FROM q GROUP BY slug), f AS ({_first('slug, ministry', 'q', 'slug', 'CASE WHEN upper(ministry) = ministry THEN 1 ELSE 0 END, ministry')}) SELECT f.slug, f.ministry, t.n, t.spellings FROM f JOIN t USING (slug)",
    "q_index_totals": "SELECT 'questions' AS what, count(*) AS n FROM ls_questions UNION ALL SELECT 'persons', count(DISTINCT pid) FROM persons UNION ALL SELECT 'terms', count(*) FROM tenures UNION ALL SELECT 'wins', count(*) FILTER (position = 1) FROM tcpd_tuples UNION ALL SELECT 'texts', count(text) FROM documents",
    "q_slim_roster": f"WITH t AS (SELECT pid, max(coalesce(sitting, 0)) AS current, cast(sum(coalesce(questions_count, 0) + coalesce(speeches_count, 0)) AS BIGINT) AS activity, min({_ST}) AS state FROM tenures WHERE office_type = 'ls' AND pid IS NOT NULL GROUP BY pid) SELECT *, row_number() OVER (PARTITION BY state ORDER BY current DESC, activity DESC, pid) AS place FROM t",
    "q_feed_order": f"WITH q AS (SELECT DISTINCT lok_sabha, session, type, question_no, {_KEY4} AS day FROM ls_questions) SELECT *, row_number() OVER (PARTITION BY lok_sabha, session, type ORDER BY day DESC, question_no DESC) AS place FROM q",
}
