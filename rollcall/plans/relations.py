"""Joins, sets, search and checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollcall.functions import names, places
from rollcall.operators import search
from rollcall.operators.dedupe import keep_best
from rollcall.session import load

Q = ["lok_sabha", "session", "type", "question_no"]


def q_four_way_left(spark, sf_dir):
    """Four left joins, one of them on two columns."""
    li, o, c, n, p = (load(spark, sf_dir, t) for t in ("lineitem", "orders", "customer", "nation", "part"))
    j = li.join(o, li.l_orderkey == o.o_orderkey, "left").join(c, o.o_custkey == c.c_custkey, "left").join(n, c.c_nationkey == n.n_nationkey, "left").join(p, li.l_partkey == p.p_partkey, "left")
    return j.groupBy("n_name", "p_brand").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


def q_in_subquery(spark, sf_dir):
    """Rows of a given party or of a candidate who ever won."""
    c = load(spark, sf_dir, "tcpd_tuples")
    winners = c.where("position = 1 AND pid IS NOT NULL").select("pid").distinct().withColumn("is_winner", F.lit(True))
    j = c.join(winners, "pid", "left").where(F.coalesce("is_winner", F.lit(False)) | (places.party(F.col("party")) == "IND"))
    return j.groupBy("state_name").agg(F.count("*").alias("n"))


def q_unmatched(spark, sf_dir):
    """Documents whose question was never listed, and listed ones without a text."""
    q = load(spark, sf_dir, "ls_questions").select(F.concat(F.lit("ls|LS"), "lok_sabha", F.lit("_S"), "session", F.lit("_"), F.when(F.upper("type") == "STARRED", "S").otherwise("U"), F.lit("_"), "question_no").alias("k")).distinct()
    d = load(spark, sf_dir, "documents").where("composite_id LIKE 'ls|%'").select(F.col("composite_id").alias("k")).distinct()
    return d.join(q, "k", "left_anti").agg(F.count("*").alias("n")).select(F.lit("unlisted").alias("what"), "n").union(q.join(d, "k", "left_anti").agg(F.count("*").alias("n")).select(F.lit("without_text"), "n"))


def q_prefix_join(spark, sf_dir):
    """Seats of contests without an exact seat of a term in the state and year, by beginning."""
    t = load(spark, sf_dir, "tenures").select(places.state(F.col("state")).alias("state"), places.constituency(F.col("constituency")).alias("seat")).where("seat <> ''").distinct()
    c = load(spark, sf_dir, "tcpd_tuples").select(places.state(F.regexp_replace("state_name", "_", " ")).alias("state"), places.constituency(F.col("constituency_name")).alias("seat")).where("seat <> ''").distinct()
    left = c.join(t, ["state", "seat"], "left_anti")
    u = t.withColumnRenamed("seat", "t_seat")
    j = left.join(u, (left.state == u.state) & (F.substring("seat", 1, 12) == F.substring("t_seat", 1, 12)) & places.same_constituency(F.col("seat"), F.col("t_seat")))
    return j.select(left.state, "seat", "t_seat")


def q_set_diff(spark, sf_dir):
    """Party names only in contests, only in terms, and in both."""
    c = load(spark, sf_dir, "tcpd_tuples").select(places.party(F.col("party")).alias("party")).distinct()
    t = load(spark, sf_dir, "tenures").select(places.party(F.col("party_short")).alias("party")).distinct()
    tag = lambda df, x: df.select(F.lit(x).alias("side"), "party")
    return tag(c.subtract(t), "contests").union(tag(t.subtract(c), "terms")).union(tag(c.intersect(t), "both"))


def q_token_sets(spark, sf_dir):
    """The union of the tokens of all names of a pid."""
    n = load(spark, sf_dir, "persons").where("pid IS NOT NULL").select("pid", names.name_tokens(F.col("canonical_name")).alias("t"))
    every = n.select("pid", F.explode("t").alias("token")).groupBy("pid").agg(F.array_join(F.array_sort(F.collect_set("token")), " ").alias("tokens"), F.count_distinct("token").alias("n"))
    return every


def q_filters(spark, sf_dir):
    """Null keys, the current roster, blocked rows."""
    t = load(spark, sf_dir, "tenures").where("pid IS NOT NULL AND external_id IS NOT NULL AND office_type IN ('ls', 'rs')")
    blocked = spark.createDataFrame([("rs", "MC")], "office_type string, kind string")  # by-election entries
    kept = t.withColumn("kind", F.substring_index("term_label", "-", 1)).join(blocked, ["office_type", "kind"], "left_anti")
    sitting = (F.col("status") == "Sitting") & ((F.col("office_type") == "rs") | (F.col("term_label") == "LS18"))
    return kept.groupBy("office_type", F.coalesce(sitting, F.lit(False)).alias("is_sitting")).agg(F.count("*").alias("n"), F.count_distinct("pid").alias("persons"))


def q_fold_aliases(spark, sf_dir):
    """Contests re-keyed through candidates' aliases, the dropped ones counted."""
    c = load(spark, sf_dir, "tcpd_tuples").select("pid", "tuple_id")
    alias = c.where("pid IS NOT NULL").select("pid", F.substring("pid", 3, 100).alias("c")).distinct()
    alias = alias.groupBy("c").agg(F.min("pid").alias("canonical")).join(alias, "c").select("pid", "canonical")
    return c.join(alias, "pid", "left").groupBy(F.coalesce("canonical", F.lit("dropped")).alias("candidate")).agg(F.count("*").alias("n"))


def q_split_override(spark, sf_dir):
    """Listed rows moved to another id, and rows by id before and after."""
    c = load(spark, sf_dir, "tcpd_tuples").select("pid", "year", "tuple_id")
    over = spark.createDataFrame([("AE", 1990)], "kind string, until int")
    moved = c.withColumn("kind", F.substring("pid", 1, 2)).join(F.broadcast(over), "kind", "left")
    pid = F.when(F.col("year") <= F.col("until"), F.concat("pid", F.lit("-split"))).otherwise(F.col("pid"))
    return moved.groupBy(pid.alias("candidate")).agg(F.count("*").alias("n"))


# which of a record's texts is searched: scanned ones first, then parsed bodies, then heads
ORIGINS = {"ls_question_pdf": 0, "rs_bundle_pdf": 0, "rs_debate_floor": 0, "rs_debate_english": 0, "committee_scan": 0, "ls_debate_html": 1, "search_head": 2}


def q_search_source(spark, sf_dir):
    """One text for each record of all sources, scans before bodies before heads before others."""
    d = load(spark, sf_dir, "documents").where("composite_id IS NOT NULL AND text IS NOT NULL")
    rank = F.lit(3)
    for source, place in ORIGINS.items():
        rank = F.when(F.col("source") == source, place).otherwise(rank)
    best = keep_best(d.select("composite_id", "doc_id", "source", rank.alias("origin")), ["composite_id"], [F.col("origin"), F.col("doc_id")])
    return best.join(d.select("doc_id", F.md5("text").alias("text_hash")), "doc_id").select("composite_id", "text_hash", "origin")


def q_search_heads(spark, sf_dir):
    """Entries, truncated heads and largest size of each group of heads."""
    h = search.search_heads(load(spark, sf_dir, "documents").where("composite_id IS NOT NULL"), "composite_id", "text")
    return h.groupBy("grp").agg(F.count("*").alias("n"), F.sum(F.col("truncated").cast("long")).alias("truncated"), F.max(F.length("head")).alias("longest"))


def q_tokens_df(spark, sf_dir):
    """tokens in at least two and at most half of all documents."""
    return search.document_frequency(load(spark, sf_dir, "documents"), "doc_id", "text")


def _members(index):
    """A hash of a list's members in any order, added up before the shuffle."""
    return F.sum(F.conv(F.substring(F.md5(F.col(index).cast("string")), 1, 12), 16, 10).cast("decimal(20,0)")).cast("string")


def q_postings_grouped(spark, sf_dir):
    """The inverted index of each bucket, each list by its length, ends and the hash of its members."""
    p = search.postings(load(spark, sf_dir, "documents"), "doc_id", "text", F.col("bucket"))
    return p.groupBy("grp", "token").agg(F.count("*").alias("n"), F.min("doc_index").alias("first"), F.max("doc_index").alias("last"), _members("doc_index").alias("members"))


def q_postings_positional(spark, sf_dir):
    """The inverted index in shards of 2500 documents, each list by its length, first and the hash of its members."""
    p = search.positional_postings(load(spark, sf_dir, "documents"), "doc_id", "text")
    return p.groupBy("shard", "token").agg(F.count("*").alias("n"), F.min("doc_ordinal").alias("first"), _members("doc_ordinal").alias("members"))


def q_checks_unique(spark, sf_dir):
    """Keys that should be unique, and how often they are not."""
    t, c, q = load(spark, sf_dir, "tenures"), load(spark, sf_dir, "tcpd_tuples"), load(spark, sf_dir, "ls_questions")
    many = lambda df, keys, name: df.groupBy(*keys).count().where("count > 1").agg(F.count("*").alias("n")).select(F.lit(name).alias("what"), "n")
    owners = c.groupBy("year", "state_name", "constituency_name", "position").agg(F.count_distinct("pid").alias("o")).where("o > 1").agg(F.count("*").alias("n")).select(F.lit("two_owners").alias("what"), "n")
    return many(t.where("sitting = 1"), ["pid"], "two_sitting").union(many(t, ["office_type", "jurisdiction", "external_id", "term_label"], "term_twice")).union(many(q, Q, "question_twice")).union(many(c, ["pid", "year", "state_name", "constituency_name"], "seat_twice")).union(owners)


def q_checks_outliers(spark, sf_dir):
    """Persons with very many terms or parties, and the spread of identity sources."""
    t = load(spark, sf_dir, "tenures").where("pid IS NOT NULL").groupBy("pid").agg(F.count("*").alias("terms"), F.count_distinct("party_short").alias("parties"))
    p = load(spark, sf_dir, "persons").groupBy(F.coalesce("identity_source", F.lit("-")).alias("pid")).agg(F.count("*").alias("terms"), F.count_distinct("pid").alias("parties"))
    return t.where("terms > 12 OR parties > 5").select(F.lit("outlier").alias("what"), "pid", "terms", "parties").union(p.select(F.lit("source"), "pid", "terms", "parties"))


def q_name_pairs(spark, sf_dir):
    """Of each pid its first and last name by spelling: equal, meeting, contained token sets and shared tokens."""
    n = load(spark, sf_dir, "persons").where("pid IS NOT NULL AND canonical_name IS NOT NULL").select("pid", "canonical_name", names.name_tokens(F.col("canonical_name")).alias("t"))
    p = n.groupBy("pid").agg(F.min_by("t", "canonical_name").alias("a"), F.max_by("t", "canonical_name").alias("b"))
    text = lambda c: F.array_join(c, " ")
    return p.select("pid", (F.col("a") == F.col("b")).alias("same"), F.arrays_overlap("a", "b").alias("meets"), (F.size(F.array_except("a", "b")) == 0).alias("is_within"), names.shared_tokens(text("a"), text("b")).alias("shared"))


def q_constraints(spark, sf_dir):
    """Rows that break a check, a foreign key, or a not-null rule."""
    p, t = load(spark, sf_dir, "persons"), load(spark, sf_dir, "tenures")
    sources = ["both", "dob_only", "tcpd_only", "fallback", "tcpd_backfill", "rs_tcpd"]
    count = lambda df, name: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("rule"), "n")
    orphan = t.join(p.select("pid").distinct(), "pid", "left_anti")
    return count(p.where(~F.col("identity_source").isin(sources)), "source").union(count(p.where("canonical_name IS NULL OR slug IS NULL"), "not_null")).union(count(orphan, "foreign_key")).union(count(p.where("confidence < 0 OR confidence > 1"), "range"))


QUERIES = {f.__name__: f for f in (q_four_way_left, q_in_subquery, q_unmatched, q_prefix_join, q_set_diff, q_token_sets, q_filters, q_fold_aliases, q_split_override, q_search_source, q_search_heads, q_tokens_df, q_postings_grouped, q_postings_positional, q_checks_unique, q_checks_outliers, q_name_pairs, q_constraints)}

from rollcall.plans.scalars import _GROUP, CONS, PARTY, STATE, TOKENS  # noqa: E402

_K = "'ls|LS' || lok_sabha || '_S' || session || '_' || CASE WHEN upper(type) = 'STARRED' THEN 'S' ELSE 'U' END || '_' || question_no"
_P = PARTY.format(c="party")
_SPACED = STATE.replace("state_name", "replace(state_name, '_', ' ')")
_TOK = "list_distinct(regexp_extract_all(lower(text), '[a-z0-9]{3,}'))"
_MEMBERS = "cast(sum(cast('0x' || substr(md5(cast(i AS VARCHAR)), 1, 12) AS HUGEINT)) AS VARCHAR)"
_DF = f"p AS (SELECT doc_id, unnest({_TOK}) AS token FROM documents), f AS (SELECT token, count(*) AS df FROM p GROUP BY token HAVING df >= 2 AND df <= greatest(2, (SELECT count(text) FROM documents) // 2))"
SQL = {
    "q_four_way_left": "SELECT n_name, p_brand, count(*) AS n, round(sum(l_quantity), 2) AS quantity FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN part ON l_partkey = p_partkey GROUP BY n_name, p_brand",
    "q_in_subquery": f"SELECT state_name, count(*) AS n FROM tcpd_tuples WHERE {_P} = 'IND' OR pid IN (SELECT pid FROM tcpd_tuples WHERE position = 1 AND pid IS NOT NULL) GROUP BY state_name",
    "q_unmatched": f"WITH q AS (SELECT DISTINCT {_K} AS k FROM ls_questions), d AS (SELECT DISTINCT composite_id AS k FROM documents WHERE composite_id LIKE 'ls|%') SELECT 'unlisted' AS what, count(*) AS n FROM d ANTI JOIN q USING (k) UNION ALL SELECT 'without_text', count(*) FROM q ANTI JOIN d USING (k)",
    "q_prefix_join": f"WITH t AS (SELECT DISTINCT {STATE.replace('state_name', 'state')} AS st, {CONS.format(c='constituency')} AS t_seat FROM tenures), c AS (SELECT DISTINCT {_SPACED} AS state, {CONS.format(c='constituency_name')} AS seat FROM tcpd_tuples), l AS (SELECT * FROM c WHERE seat <> '' AND (state, seat) NOT IN (SELECT (st, t_seat) FROM t)) SELECT state, seat, t_seat FROM l JOIN t ON l.state = t.st AND length(seat) >= 12 AND length(t_seat) >= 12 AND (starts_with(seat, t_seat) OR starts_with(t_seat, seat))",
    "q_set_diff": f"WITH c AS (SELECT DISTINCT {_P} AS party FROM tcpd_tuples), t AS (SELECT DISTINCT {PARTY.format(c='party_short')} AS party FROM tenures) SELECT 'contests' AS side, party FROM (SELECT * FROM c EXCEPT SELECT * FROM t) UNION ALL SELECT 'terms', party FROM (SELECT * FROM t EXCEPT SELECT * FROM c) UNION ALL SELECT 'both', party FROM (SELECT * FROM c INTERSECT SELECT * FROM t)",
    "q_token_sets": f"SELECT pid, array_to_string(list_sort(list(DISTINCT token)), ' ') AS tokens, count(DISTINCT token) AS n FROM (SELECT pid, unnest({TOKENS.format(c='canonical_name')}) AS token FROM persons WHERE pid IS NOT NULL) GROUP BY pid",
    "q_filters": "SELECT office_type, coalesce(status = 'Sitting' AND (office_type = 'rs' OR term_label = 'LS18'), false) AS is_sitting, count(*) AS n, count(DISTINCT pid) AS persons FROM tenures WHERE pid IS NOT NULL AND external_id IS NOT NULL AND office_type IN ('ls', 'rs') AND NOT coalesce(office_type = 'rs' AND split_part(term_label, '-', 1) = 'MC', false) GROUP BY 1, 2",
    "q_fold_aliases": "WITH a AS (SELECT substr(pid, 3) AS c, min(pid) AS canonical FROM tcpd_tuples WHERE pid IS NOT NULL GROUP BY 1) SELECT coalesce(canonical, 'dropped') AS candidate, count(*) AS n FROM tcpd_tuples LEFT JOIN a ON substr(pid, 3) = c GROUP BY 1",
    "q_split_override": "SELECT CASE WHEN substr(pid, 1, 2) = 'AE' AND year <= 1990 THEN pid || '-split' ELSE pid END AS candidate, count(*) AS n FROM tcpd_tuples GROUP BY 1",
    "q_search_source": "SELECT composite_id, md5(text) AS text_hash, origin FROM (SELECT *, row_number() OVER (PARTITION BY composite_id ORDER BY origin, doc_id) AS k FROM (SELECT *, CASE " + " ".join(f"WHEN source = '{s}' THEN {n}" for s, n in ORIGINS.items()) + " ELSE 3 END AS origin FROM documents WHERE composite_id IS NOT NULL AND text IS NOT NULL)) WHERE k = 1",
    "q_search_heads": f"SELECT {_GROUP.format(n=1000)} AS grp, count(*) AS n, count(*) FILTER (length(text) > 5000) AS truncated, max(length(substring(text, 1, 5000)))::INT AS longest FROM documents WHERE composite_id IS NOT NULL AND coalesce(text, '') <> '' GROUP BY 1",
    "q_tokens_df": f"WITH {_DF} SELECT * FROM f",
    "q_postings_grouped": f"WITH d AS (SELECT bucket AS grp, {_TOK} AS t, row_number() OVER (PARTITION BY bucket ORDER BY doc_id) - 1 AS i FROM documents WHERE coalesce(text, '') <> ''), e AS (SELECT grp, unnest(t) AS token, i FROM d) SELECT grp, token, count(*) AS n, min(i) AS first, max(i) AS last, {_MEMBERS} AS members FROM e GROUP BY grp, token",
    "q_postings_positional": f"WITH {_DF}, d AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM documents WHERE coalesce(text, '') <> '') SELECT i // 2500 AS shard, token, count(*) AS n, min(i) AS first, {_MEMBERS} AS members FROM p JOIN f USING (token) JOIN d USING (doc_id) GROUP BY 1, 2",
    "q_checks_unique": "SELECT 'two_sitting' AS what, count(*) AS n FROM (SELECT pid FROM tenures WHERE sitting = 1 GROUP BY pid HAVING count(*) > 1) UNION ALL SELECT 'term_twice', count(*) FROM (SELECT 1 FROM tenures GROUP BY office_type, jurisdiction, external_id, term_label HAVING count(*) > 1) UNION ALL SELECT 'question_twice', count(*) FROM (SELECT 1 FROM ls_questions GROUP BY lok_sabha, session, type, question_no HAVING count(*) > 1) UNION ALL SELECT 'seat_twice', count(*) FROM (SELECT 1 FROM tcpd_tuples GROUP BY pid, year, state_name, constituency_name HAVING count(*) > 1) UNION ALL SELECT 'two_owners', count(*) FROM (SELECT 1 FROM tcpd_tuples GROUP BY year, state_name, constituency_name, position HAVING count(DISTINCT pid) > 1)",
    "q_checks_outliers": "SELECT 'outlier' AS what, pid, count(*) AS terms, count(DISTINCT party_short) AS parties FROM tenures WHERE pid IS NOT NULL GROUP BY pid HAVING terms > 12 OR parties > 5 UNION ALL SELECT 'source', coalesce(identity_source, '-'), count(*), count(DISTINCT pid) FROM persons GROUP BY 2",
    "q_name_pairs": f"""WITH n AS (SELECT pid, list_sort(list_distinct({TOKENS.format(c='canonical_name')})) AS t, canonical_name FROM persons WHERE pid IS NOT NULL AND canonical_name IS NOT NULL),
p AS (SELECT pid, arg_min(t, canonical_name) AS a, arg_max(t, canonical_name) AS b FROM n GROUP BY pid)
SELECT pid, a = b AS same, list_has_any(a, b) AS meets, list_has_all(b, a) AS is_within, len(list_filter(list_intersect(a, b), lambda x: length(x) >= 3))::INT AS shared FROM p""",
    "q_constraints": "SELECT 'source' AS rule, count(*) AS n FROM persons WHERE identity_source NOT IN ('both', 'dob_only', 'tcpd_only', 'fallback', 'tcpd_backfill', 'rs_tcpd') UNION ALL SELECT 'not_null', count(*) FROM persons WHERE canonical_name IS NULL OR slug IS NULL UNION ALL SELECT 'foreign_key', count(*) FROM tenures WHERE pid IS NULL OR pid NOT IN (SELECT pid FROM persons WHERE pid IS NOT NULL) UNION ALL SELECT 'range', count(*) FROM persons WHERE confidence < 0 OR confidence > 1",
}
