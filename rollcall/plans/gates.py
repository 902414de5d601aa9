"""Gates (V01-V03, V06, V07): planted builds with known errors, and real tables where they have the columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollcall.functions import dates
from rollcall.operators import gates
from rollcall.session import load

# a build as planted: members of persons, pairs kept apart, contests, names
MEMBERS = [("p1", "ls-1"), ("p1", "rs-1"), ("p2", "ls-2"), ("p3", "rs-2"), ("p4", "ls-4"), ("p5", "ls-5"), ("p5", "ls-6")]
EXPECTED = [("whole", "ls-1"), ("whole", "rs-1"), ("parted", "ls-2"), ("parted", "rs-2"), ("short", "ls-4"), ("short", "rs-4"), ("unknown", "ls-9")]
APART = [("held", "ls-1", "ls-2"), ("joined", "ls-5", "ls-6"), ("unknown", "ls-1", "ls-9")]
CONTESTS = [("p1", "2014|alpha|P|won", "alpha", 11), ("p1", "2019|beta|P|lost", "beta", 12), ("p2", "2014|gamma|Q|won", "Gamma", 21), ("p2", "2019|gamma|Q|won", "gamma", 22), ("p3", "2009|delta|R|lost", "delta", 31)]
RULES = [("p1", "exact", "2014|alpha|P|won", None), ("p1", "exact", "2024|beta|P|won", None), ("p2", "contains", "2014|gamma|Q|won", None), ("p2", "excludes", "22", None), ("p2", "excludes", "99", None), ("p2", "seats", None, 1), ("p1", "seats", None, 1)]
NAMES = [("p1", "Gopal Ram"), ("p2", "Gopal Ram Das"), ("p3", "Hari Zed")]
NAMESAKES = [("gopal", "2014|alpha|P|won"), ("hari", "2009|delta|R|won"), ("nobody", "2009|delta|R|won")]


def _table(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def q_gate_members(spark, sf_dir):
    """Planted persons that must hold their members, and pairs that must stay apart."""
    m = _table(spark, MEMBERS, "pid string, member string")
    return gates.members_gate(m, _table(spark, EXPECTED, "fixture string, member string")).unionByName(gates.apart_gate(m, _table(spark, APART, "fixture string, a string, b string")))


def q_gate_links(spark, sf_dir):
    """External links with one day of birth under several pids, in all persons."""
    p = load(spark, sf_dir, "persons").select("pid", F.nullif(F.trim("rs_tcpd_id"), F.lit("")).alias("link"), dates.strict_dob(F.col("dob")).alias("day"))
    return gates.shared_link_gate(p, "link", "day")


def q_gate_contests(spark, sf_dir):
    """Planted contests against exact, contained and excluded ones, seats and namesakes."""
    c = _table(spark, CONTESTS, "pid string, contest string, seat string, source_row long")
    one = gates.contests_gate(c, _table(spark, RULES, "fixture string, rule string, contest string, most int"))
    return one.unionByName(gates.namesakes_gate(_table(spark, NAMES, "pid string, name string"), c, _table(spark, NAMESAKES, "fixture string, contest string")))


QUERIES = {f.__name__: f for f in (q_gate_members, q_gate_links, q_gate_contests)}

from rollcall.plans.scalars import STRICT  # noqa: E402


def _values(name: str, columns: str, rows: list[tuple]) -> str:
    text = lambda v: "NULL" if v is None else str(v) if isinstance(v, int) else f"'{v}'"
    return f"{name}({columns}) AS (VALUES " + ", ".join("(" + ", ".join(map(text, r)) + ")" for r in rows) + ")"


SQL = {
    "q_gate_members": f"""WITH {_values('m', 'pid, member', MEMBERS)}, {_values('x', 'fixture, member', EXPECTED)}, {_values('a', 'fixture, a, b', APART)},
f AS (SELECT x.fixture, x.member, m.pid FROM x LEFT JOIN m USING (member)), g AS (SELECT fixture, count(pid) AS known, count(DISTINCT pid) AS pids FROM f GROUP BY fixture)
SELECT 'miss' AS gate, fixture, '' AS detail FROM g WHERE known = 0 UNION ALL SELECT 'split', fixture, pids::VARCHAR FROM g WHERE pids > 1
UNION ALL SELECT 'incomplete', fixture, member FROM f WHERE pid IS NULL AND fixture IN (SELECT fixture FROM g WHERE pids = 1)
UNION ALL SELECT 'merged', a.fixture, m.pid FROM a JOIN m ON m.member = a.a JOIN m n ON n.member = a.b AND n.pid = m.pid""",
    "q_gate_links": f"SELECT 'same_link_and_day' AS gate, link || '|' || day AS fixture, count(DISTINCT pid)::VARCHAR AS detail FROM (SELECT pid, nullif(trim(rs_tcpd_id, ' '), '') AS link, {STRICT.format(c='dob')} AS day FROM persons) WHERE link IS NOT NULL AND day IS NOT NULL GROUP BY 2 HAVING count(DISTINCT pid) > 1",
    "q_gate_contests": f"""WITH {_values('c', 'pid, contest, seat, source_row', CONTESTS)}, {_values('r', 'fixture, rule, contest, most', RULES)}, {_values('n', 'pid, name', NAMES)}, {_values('x', 'fixture, contest', NAMESAKES)},
e AS (SELECT fixture, contest FROM r WHERE rule = 'exact'), h AS (SELECT pid AS fixture, contest FROM c),
b AS (SELECT fixture, pid FROM (SELECT f.fixture, n.pid, row_number() OVER (PARTITION BY f.fixture ORDER BY (SELECT count(*) FROM c WHERE c.pid = n.pid) DESC, n.pid) AS k FROM (SELECT DISTINCT fixture FROM x) f JOIN n ON contains(lower(n.name), f.fixture)) WHERE k = 1)
SELECT 'missing' AS gate, fixture, contest AS detail FROM (SELECT fixture, contest FROM r WHERE rule IN ('exact', 'contains') EXCEPT SELECT * FROM h)
UNION ALL SELECT 'extra', fixture, contest FROM (SELECT * FROM h WHERE fixture IN (SELECT fixture FROM e) EXCEPT SELECT * FROM e)
UNION ALL SELECT 'wrongly_included', fixture, r.contest FROM r JOIN c ON r.fixture = c.pid AND r.contest = c.source_row::VARCHAR WHERE rule = 'excludes'
UNION ALL SELECT 'seats', pid, seats::VARCHAR FROM (SELECT pid, count(DISTINCT lower(seat)) AS seats FROM c GROUP BY pid) JOIN r ON r.fixture = pid AND rule = 'seats' AND seats > most
UNION ALL SELECT 'nobody', fixture, '' FROM (SELECT DISTINCT fixture FROM x) WHERE fixture NOT IN (SELECT fixture FROM b)
UNION ALL SELECT 'missing', x.fixture, x.contest FROM x JOIN b USING (fixture) WHERE (b.pid, x.contest) NOT IN (SELECT (pid, contest) FROM c)""",
}
