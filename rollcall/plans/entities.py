"""Identity: components, aliases, resolution and attribution."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollcall.functions import dates, names, places
from rollcall.operators import resolve
from rollcall.operators.attribute import attribute
from rollcall.operators.components import connected_components
from rollcall.operators.dedupe import keep_best
from rollcall.operators.identity import identity_edges, refused_pairs
from rollcall.session import load


def _identity_edges(spark, sf_dir):
    """Persons under one name and day of birth are one; each edge goes to the group's least."""
    p = load(spark, sf_dir, "persons").select("pid", names.name_bag(F.col("canonical_name")).alias("bag"), dates.strict_dob(F.col("dob")).alias("day")).where("pid IS NOT NULL AND bag <> ''")
    known = p.where("day IS NOT NULL")
    star = known.groupBy("bag", "day").agg(F.min("pid").alias("a"))
    own = p.select(F.col("pid").alias("a"), F.col("pid").alias("b"))
    return known.join(star, ["bag", "day"]).select("a", F.col("pid").alias("b")).union(own)


def q_components(spark, sf_dir):
    """Persons joined by name and day of birth, labelled by the least pid."""
    return connected_components(_identity_edges(spark, sf_dir)).select(F.col("node").alias("pid"), "component")


def _nodes(spark, sf_dir):
    p = load(spark, sf_dir, "persons")
    return p.select(F.col("rec_id").alias("node"), names.name_bag(F.col("canonical_name")).alias("name"), dates.strict_dob(F.col("dob")).alias("day"), F.nullif(F.trim("rs_tcpd_id"), F.lit("")).alias("link"))


def q_identity(spark, sf_dir):
    """All records joined by name and day, and by external link where days or names do not conflict."""
    return connected_components(identity_edges(_nodes(spark, sf_dir))).select(F.col("node").alias("rec_id"), "component")


def q_refused_pairs(spark, sf_dir):
    """Pairs of records of one external link that days or names keep apart, by link."""
    return refused_pairs(_nodes(spark, sf_dir))


def q_lookup_house(spark, sf_dir):
    """Members by normal form; of several persons the only one of the lower house."""
    house = load(spark, sf_dir, "tenures").select("pid", F.col("office_type").alias("house")).distinct()
    p = load(spark, sf_dir, "persons").select("pid", names.normal_form(F.col("canonical_name")).alias("form")).join(house, "pid", "left")
    m = load(spark, sf_dir, "ls_questions").select(F.explode("members").alias("raw"))
    return resolve.lookup_in_house(m, p, "ls")


def q_bipartite_components(spark, sf_dir):
    """Candidates joined through the seats where they share a name."""
    c = load(spark, sf_dir, "tcpd_tuples").where("pid IS NOT NULL").select("pid", F.concat_ws("|", names.name_bag(F.col("candidate")), places.state(F.col("state_name"))).alias("k"))
    star = c.groupBy("k").agg(F.min("pid").alias("a"))
    return connected_components(c.join(star, "k").select("a", F.col("pid").alias("b"))).select(F.col("node").alias("pid"), "component")


def q_aliases(spark, sf_dir):
    """Pids under one person key, all one unless two days of birth contradict."""
    p = load(spark, sf_dir, "persons").select("pid", names.person_key(F.col("canonical_name")).alias("key"), dates.strict_dob(F.col("dob")).alias("day")).where("pid IS NOT NULL AND key <> ''").distinct()
    one = p.groupBy("pid").agg(F.min("key").alias("key"), F.min("day").alias("day"))
    days = one.groupBy("key").agg(F.count_distinct("day").alias("days"), F.min("pid").alias("least"))
    same = one.where("day IS NOT NULL").groupBy("key", "day").agg(F.min("pid").alias("least_of_day"))
    j = one.join(days, "key").join(same, ["key", "day"], "left")
    canonical = F.when(F.col("days") >= 2, F.coalesce("least_of_day", "pid")).otherwise(F.col("least"))
    return j.select("pid", canonical.alias("canonical")).where("pid <> canonical")


def q_person_fields(spark, sf_dir):
    """Identity source and confidence of each person by what is known."""
    p = load(spark, sf_dir, "persons").where("pid IS NOT NULL").groupBy("pid").agg(F.max(dates.strict_dob(F.col("dob"))).alias("dob"), F.max(F.nullif(F.trim("rs_tcpd_id"), F.lit(""))).alias("link"))
    d, t = F.col("dob").isNotNull(), F.col("link").isNotNull()
    return p.select("pid", "dob", F.when(d & t, "both").when(d, "dob_only").when(t, "tcpd_only").otherwise("fallback").alias("source"), F.when(d & t, 1.0).when(d, 0.9).when(t, 0.8).otherwise(0.5).alias("confidence"))


def q_unified_master(spark, sf_dir):
    """Persons and candidates in one roster with their variants."""
    p = load(spark, sf_dir, "persons").select(names.name_bag(F.col("canonical_name")).alias("bag"), F.col("canonical_name").alias("variant"), F.lit(1).alias("p"), F.lit(0).alias("c"))
    c = load(spark, sf_dir, "tcpd_tuples").select(names.name_bag(F.col("candidate")).alias("bag"), F.col("candidate").alias("variant"), F.lit(0).alias("p"), F.lit(1).alias("c"))
    return p.unionByName(c).where("bag <> ''").groupBy("bag").agg(F.count_distinct("variant").alias("variants"), F.min("variant").alias("first_variant"), F.sum("p").alias("person_rows"), F.sum("c").alias("contest_rows"))


def q_lookup_exact(spark, sf_dir):
    """Members by normal form, ambiguous ones marked."""
    forms = resolve.lookup(load(spark, sf_dir, "persons"), "pid", "canonical_name")
    m = load(spark, sf_dir, "ls_questions").select(F.explode("members").alias("raw")).distinct().withColumn("form", names.normal_form(F.col("raw"))).where("form <> ''")
    return m.join(forms, "form").select("raw", F.when(F.col("pids") == 1, F.col("pid")).alias("pid"), F.when(F.col("pids") == 1, "exact").otherwise("ambiguous_exact").alias("status"))


def q_fuzzy(spark, sf_dir):
    """Every distinct member resolved once, exactly or by likeness."""
    forms = resolve.lookup(load(spark, sf_dir, "persons"), "pid", "canonical_name")
    m = load(spark, sf_dir, "ls_questions").select(F.explode("members").alias("raw")).where("raw IS NOT NULL")
    return resolve.resolve(m, forms)


CONTEST = ["year", "state_name", "constituency_name"]


def q_name_score(spark, sf_dir):
    """Agreement of each candidate's name with the one of the contest's winner."""
    c = load(spark, sf_dir, "tcpd_tuples").select(*CONTEST, "position", names.name_tokens(F.col("candidate")).alias("t"), "tuple_id")
    won = keep_best(c.where("position = 1").select(*CONTEST, "tuple_id", "t"), CONTEST, [F.col("tuple_id")]).select(*CONTEST, F.col("t").alias("w"))
    return c.join(won, CONTEST).select("tuple_id", names.name_score(F.col("t"), F.col("w")).alias("score"), names.strong_name(F.col("t"), F.col("w")).alias("strong"))


# planted rows, as the tables have none for two of the rules: (row_id, is of the newest year, seat, party, name, won, source_id)
PLANTED = [(-1, True, "alpha", "P", "gopal ram", False, "T1"), (-2, True, "bangalore cent", "P", "hari zed", True, None), (-3, False, "beta", "Q", "x", False, "T2"), (-4, True, "old", "Z", "gopal ram", False, "T9"), (-5, True, "gamma", "R", "y", True, "T3"), (-6, False, "delta", "R", "y", False, "T3"), (-7, True, "none", "Z", "n", False, "T8")]
PLANTED_TERMS = [("p-a", "alpha", "P", "gopal ram"), ("p-b", "bangalore central", "P", "hari zed")]
PLANTED_PAST, PLANTED_LINK = [("p-a", "old", "gopal ram")], [("T2", "p-c")]


def _waterfall(spark, sf_dir):
    state = lambda c: places.state(F.regexp_replace(c, "_", " "))
    c = load(spark, sf_dir, "tcpd_tuples")
    newest = c.agg(F.max("year")).first()[0]
    rows = c.select(F.col("tuple_id").alias("row_id"), "year", state("state_name").alias("state"), places.constituency(F.col("constituency_name")).alias("seat"), places.party(F.col("party")).alias("party"), names.name_set(F.col("candidate")).alias("name"), F.coalesce(F.col("position") == 1, F.lit(False)).alias("won"), F.col("pid").alias("source_id"))
    person = keep_best(load(spark, sf_dir, "persons").select("pid", "canonical_name", "rec_id"), ["pid"], [F.col("rec_id")])
    terms = load(spark, sf_dir, "tenures").where("office_type IN ('ls', 'ac')").join(person, "pid").select("pid", F.year(dates.parse_day(F.col("term_start"))).alias("year"), state("state").alias("state"), places.constituency(F.col("constituency")).alias("seat"), places.party(F.col("party_short")).alias("party"), names.name_set(F.col("canonical_name")).alias("name"))
    bridge = load(spark, sf_dir, "persons").where("rs_tcpd_id IS NOT NULL").select(F.col("rs_tcpd_id").alias("source_id"), "pid")
    planted = spark.createDataFrame([(r[0], newest if r[1] else newest - 5, "planted", *r[2:]) for r in PLANTED], "row_id long, year int, state string, seat string, party string, name string, won boolean, source_id string")
    terms_ = spark.createDataFrame([(p, newest, "planted", *rest) for p, *rest in PLANTED_TERMS], "pid string, year int, state string, seat string, party string, name string")
    past = terms.select("pid", "state", "seat", "name").unionByName(spark.createDataFrame([(p, "planted", *rest) for p, *rest in PLANTED_PAST], "pid string, state string, seat string, name string"))
    bridge = bridge.unionByName(spark.createDataFrame(PLANTED_LINK, "source_id string, pid string"))
    return attribute(rows.unionByName(planted), terms.unionByName(terms_), bridge, past, newest)


def q_waterfall(spark, sf_dir):
    """The owner of each contest row and the rule that found it."""
    return _waterfall(spark, sf_dir)


def q_waterfall_counts(spark, sf_dir):
    """Rows by rule."""
    return _waterfall(spark, sf_dir).groupBy("method").agg(F.count("*").alias("n"))


QUERIES = {f.__name__: f for f in (q_components, q_identity, q_refused_pairs, q_lookup_house, q_bipartite_components, q_aliases, q_person_fields, q_unified_master, q_lookup_exact, q_fuzzy, q_name_score, q_waterfall, q_waterfall_counts)}

from rollcall.plans.intervals import _day  # noqa: E402
from rollcall.plans.scalars import _H, BAG, CONS, NORMAL, PARTY, SET, STATE, STRICT, TOKENS  # noqa: E402

_KEY = f"coalesce(lower(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(trim(canonical_name), '^([^,]+),\\s*(.+)$', '\\2 \\1'), '(?i)^\\s*{_H}\\s+', ''), '(?i)\\s+{_H}\\s*$', ''), '[^a-zA-Z0-9\\s]+', ' ', 'g'), '\\s+', ' ', 'g'))), '')"
_BAG = BAG.format(c="canonical_name")
_DAY = STRICT.format(c="dob")
_REACH = "r AS (SELECT node, node AS seen FROM (SELECT a AS node FROM e UNION SELECT b FROM e) UNION SELECT r.node, x.b FROM r JOIN (SELECT a, b FROM e UNION SELECT b, a FROM e) x ON x.a = r.seen)"
_COMMON = ", ".join(f"'{t}'" for t in names.COMMON_TOKENS)


def _rare(tokens: str) -> str:
    return f"list_filter({tokens}, lambda t: length(t) > 1 AND t NOT IN ({_COMMON}))"


def _any(list_: str, name: str, condition: str) -> str:
    return f"len(list_filter({list_}, lambda {name}: {condition})) > 0"


def _score(x: str, y: str) -> str:
    """The agreement of two lists of rare tokens."""
    common = _any(x, "t", "length(t) >= 6 AND " + _any(y, "u", "length(u) >= 6 AND " + _any("range(1, length(t) - 4)", "i", "contains(u, substr(t, i, 6))")))
    joined = lambda a, b: _any(a, "t", "length(t) >= 6 AND " + _any(b, "u", _any(b, "v", "u <> v AND u || v = t")))
    return f"CASE WHEN len({x}) = 0 OR len({y}) = 0 THEN 0.0 WHEN list_sort({x}) = list_sort({y}) THEN 1.0 WHEN list_has_any({x}, {y}) THEN 0.8 WHEN {common} OR {joined(x, y)} OR {joined(y, x)} THEN 0.6 ELSE 0.0 END::DOUBLE"


def _strong(x: str, y: str) -> str:
    return f"((len({x}) > 0 AND list_sort({x}) = list_sort({y})) OR (len({x}) >= 2 AND len({y}) >= 2 AND (list_has_all({y}, {x}) OR list_has_all({x}, {y}))))"


def _literals(rows: list[tuple]) -> str:
    text = lambda v: "NULL" if v is None else str(v).lower() if isinstance(v, (bool, int)) else f"'{v}'"
    return ", ".join("(" + ", ".join(map(text, r)) + ")" for r in rows)


_SPACED = lambda c: STATE.replace("state_name", f"replace({c}, '_', ' ')")
_WATERFALL = f"""z AS (SELECT max(year) AS newest FROM tcpd_tuples),
r0 AS (SELECT tuple_id AS row_id, year, {_SPACED("state_name")} AS state, {CONS.format(c="constituency_name")} AS seat, {PARTY.format(c="party")} AS party, {SET.format(c="candidate")} AS name, coalesce(position = 1, false) AS won, pid AS source_id FROM tcpd_tuples
 UNION ALL SELECT row_id, CASE WHEN is_new THEN newest ELSE newest - 5 END, 'planted', seat, party, name, won, source_id FROM (VALUES {_literals(PLANTED)}) v(row_id, is_new, seat, party, name, won, source_id), z),
r AS (SELECT *, {_rare("string_split(name, ' ')")} AS x FROM r0),
p1 AS (SELECT pid, canonical_name FROM persons WHERE rec_id IN (SELECT min(rec_id) FROM persons GROUP BY pid)),
t0 AS (SELECT pid AS owner, year({_day("term_start")}) AS year, {_SPACED("state")} AS state, {CONS.format(c="constituency")} AS seat, {PARTY.format(c="party_short")} AS party, {SET.format(c="canonical_name")} AS name FROM tenures JOIN p1 USING (pid) WHERE office_type IN ('ls', 'ac')),
t AS (SELECT DISTINCT *, {_rare("string_split(name, ' ')")} AS y FROM (SELECT * FROM t0 UNION ALL SELECT owner, newest, 'planted', seat, party, name FROM (VALUES {_literals(PLANTED_TERMS)}) v(owner, seat, party, name), z)),
h AS (SELECT DISTINCT owner, state, seat, {_rare("string_split(name, ' ')")} AS y FROM (SELECT owner, state, seat, name FROM t0 UNION ALL SELECT owner, 'planted', seat, name FROM (VALUES {_literals(PLANTED_PAST)}) v(owner, seat, name))),
e AS (SELECT row_id, owner, x, y, r.party, t.party AS t_party FROM r JOIN t ON r.year = t.year AND r.state = t.state AND r.seat = t.seat),
n AS (SELECT row_id, owner, x, y, r.party, t.party AS t_party FROM r JOIN t ON r.year = t.year AND r.state = t.state AND length(r.seat) >= 12 AND length(t.seat) >= 12 AND (starts_with(r.seat, t.seat) OR starts_with(t.seat, r.seat)) WHERE row_id NOT IN (SELECT row_id FROM e)),
s AS (SELECT row_id, owner, {_score("x", "y")} + CASE WHEN party <> '' AND party = t_party THEN 0.5 ELSE 0.0 END::DOUBLE AS points FROM (SELECT * FROM e UNION ALL SELECT * FROM n)),
a AS (SELECT row_id, owner, 'A' AS method FROM (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY points DESC, owner) AS k FROM s WHERE points >= 1) WHERE k = 1),
b AS (SELECT row_id, k.owner, 'B' AS method FROM r JOIN (SELECT source_id, min(pid) AS owner FROM (SELECT rs_tcpd_id AS source_id, pid FROM persons WHERE rs_tcpd_id IS NOT NULL UNION ALL VALUES {_literals(PLANTED_LINK)}) GROUP BY source_id) k USING (source_id) WHERE row_id NOT IN (SELECT row_id FROM a)),
d AS (SELECT row_id, min(h.owner) AS owner, 'D' AS method FROM r JOIN h ON r.state = h.state AND r.seat = h.seat AND {_strong("x", "y")} WHERE year = (SELECT newest FROM z) AND row_id NOT IN (SELECT row_id FROM a UNION SELECT row_id FROM b) GROUP BY row_id),
l AS (SELECT * FROM r WHERE row_id NOT IN (SELECT row_id FROM a UNION SELECT row_id FROM b UNION SELECT row_id FROM d)),
w AS (SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM d UNION ALL SELECT row_id, 'TCPD:' || source_id, 'C' FROM l WHERE source_id IN (SELECT source_id FROM l WHERE won AND source_id IS NOT NULL))"""
_NODES = f"""n AS (SELECT rec_id AS node, {BAG.format(c="canonical_name")} AS name, {STRICT.format(c="dob")} AS day, nullif(trim(rs_tcpd_id, ' '), '') AS link FROM persons WHERE rec_id IS NOT NULL),
l AS (SELECT a.link, a.node AS i, b.node AS j, CASE WHEN a.day IS NOT NULL AND b.day IS NOT NULL THEN a.day = b.day ELSE a.name = '' OR b.name = '' OR a.name = b.name END AS joined FROM n a JOIN n b ON a.link = b.link AND a.node < b.node)"""
_TOK = TOKENS.format(c="candidate")
SQL = {
    "q_name_score": f"""WITH c AS (SELECT tuple_id, year, state_name, constituency_name, position, {_rare(f"list_sort(list_distinct({_TOK}))")} AS x FROM tcpd_tuples),
w AS (SELECT year, state_name, constituency_name, arg_min(x, tuple_id) AS y FROM c WHERE position = 1 GROUP BY ALL)
SELECT tuple_id, {_score("coalesce(x, [])", "coalesce(y, [])")} AS score, {_strong("coalesce(x, [])", "coalesce(y, [])")} AS strong FROM c JOIN w USING (year, state_name, constituency_name)""",
    "q_waterfall": f"WITH {_WATERFALL} SELECT * FROM w",
    "q_waterfall_counts": f"WITH {_WATERFALL} SELECT method, count(*) AS n FROM w GROUP BY method",
    "q_components": f"WITH RECURSIVE p AS (SELECT pid, {_BAG} AS bag, {_DAY} AS day FROM persons WHERE pid IS NOT NULL), e AS (SELECT DISTINCT min(pid) OVER (PARTITION BY bag, day) AS a, pid AS b FROM p WHERE bag <> '' AND day IS NOT NULL UNION SELECT pid, pid FROM p WHERE bag <> ''), {_REACH} SELECT node AS pid, min(seen) AS component FROM r GROUP BY node",
    "q_identity": f"WITH RECURSIVE {_NODES}, e AS (SELECT i AS a, j AS b FROM l WHERE joined UNION SELECT min(node) OVER (PARTITION BY name, day), node FROM n WHERE name <> '' AND day IS NOT NULL UNION SELECT node, node FROM n), {_REACH} SELECT node AS rec_id, min(seen) AS component FROM r GROUP BY node",
    "q_refused_pairs": f"WITH {_NODES} SELECT link, count(*) AS refused FROM l WHERE NOT joined GROUP BY link",
    "q_lookup_house": f"WITH p AS (SELECT DISTINCT pid, {NORMAL.format(c='canonical_name')} AS form FROM persons WHERE pid IS NOT NULL), h AS (SELECT DISTINCT pid FROM tenures WHERE office_type = 'ls'), f AS (SELECT form, count(DISTINCT pid) AS pids, min(pid) AS pid, count(DISTINCT pid) FILTER (pid IN (SELECT pid FROM h)) AS ins, min(pid) FILTER (pid IN (SELECT pid FROM h)) AS in_pid FROM p WHERE form <> '' GROUP BY form), m AS (SELECT DISTINCT raw, {NORMAL.format(c='raw')} AS form FROM (SELECT unnest(members) AS raw FROM ls_questions)) SELECT raw, CASE WHEN pids = 1 THEN pid WHEN ins = 1 THEN in_pid END AS pid, CASE WHEN pids = 1 THEN 'exact' WHEN ins = 1 THEN 'exact_house' ELSE 'ambiguous_exact' END AS status FROM m JOIN f USING (form)",
    "q_bipartite_components": f"WITH RECURSIVE c AS (SELECT pid, {BAG.format(c='candidate')} || '|' || {STATE} AS k FROM tcpd_tuples WHERE pid IS NOT NULL), e AS (SELECT DISTINCT min(pid) OVER (PARTITION BY k) AS a, pid AS b FROM c), {_REACH} SELECT node AS pid, min(seen) AS component FROM r GROUP BY node",
    "q_aliases": f"WITH o AS (SELECT pid, min({_KEY}) AS key, min({_DAY}) AS day FROM persons WHERE pid IS NOT NULL AND {_KEY} <> '' GROUP BY pid), d AS (SELECT key, count(DISTINCT day) AS days, min(pid) AS least FROM o GROUP BY key), s AS (SELECT key, day, min(pid) AS lod FROM o WHERE day IS NOT NULL GROUP BY key, day), j AS (SELECT o.pid, CASE WHEN days >= 2 THEN coalesce(lod, o.pid) ELSE least END AS canonical FROM o JOIN d USING (key) LEFT JOIN s ON s.key = o.key AND s.day = o.day) SELECT * FROM j WHERE pid <> canonical",
    "q_person_fields": f"WITH p AS (SELECT pid, max({_DAY}) AS dob, max(nullif(trim(rs_tcpd_id, ' '), '')) AS link FROM persons WHERE pid IS NOT NULL GROUP BY pid) SELECT pid, dob, CASE WHEN dob IS NOT NULL AND link IS NOT NULL THEN 'both' WHEN dob IS NOT NULL THEN 'dob_only' WHEN link IS NOT NULL THEN 'tcpd_only' ELSE 'fallback' END AS source, CASE WHEN dob IS NOT NULL AND link IS NOT NULL THEN 1.0 WHEN dob IS NOT NULL THEN 0.9 WHEN link IS NOT NULL THEN 0.8 ELSE 0.5 END::DOUBLE AS confidence FROM p",
    "q_unified_master": f"SELECT bag, count(DISTINCT variant) AS variants, min(variant) AS first_variant, cast(sum(p) AS BIGINT) AS person_rows, cast(sum(c) AS BIGINT) AS contest_rows FROM (SELECT {_BAG} AS bag, canonical_name AS variant, 1 AS p, 0 AS c FROM persons UNION ALL SELECT {BAG.format(c='candidate')}, candidate, 0, 1 FROM tcpd_tuples) WHERE bag <> '' GROUP BY bag",
    "q_lookup_exact": f"WITH f AS (SELECT {NORMAL.format(c='canonical_name')} AS form, count(DISTINCT pid) AS pids, min(pid) AS pid FROM persons WHERE pid IS NOT NULL GROUP BY 1), m AS (SELECT DISTINCT raw, {NORMAL.format(c='raw')} AS form FROM (SELECT unnest(members) AS raw FROM ls_questions)) SELECT raw, CASE WHEN pids = 1 THEN pid END AS pid, CASE WHEN pids = 1 THEN 'exact' ELSE 'ambiguous_exact' END AS status FROM m JOIN f USING (form) WHERE form <> ''",
}
