"""Query of problem 1 and its SQL."""

from __future__ import annotations

from rollcall.operators.tenures import office_periods
from rollcall.session import load


def p1_found(spark, sf_dir):
    return office_periods(load(spark, sf_dir, "tenures"))


_DAY = """CASE
  WHEN regexp_full_match({s}, '[0-9]{{4}}[-/.][0-9]{{1,2}}[-/.][0-9]{{1,2}}([T ].*)?') THEN try_cast(regexp_replace({s}, '^([0-9]{{4}})[-/.]([0-9]{{1,2}})[-/.]([0-9]{{1,2}}).*$', '\\1-\\2-\\3') AS DATE)
  WHEN regexp_full_match({s}, '[0-9]{{1,2}}[-/.][0-9]{{1,2}}[-/.][0-9]{{4}}([T ].*)?') THEN try_cast(regexp_replace({s}, '^([0-9]{{1,2}})[-/.]([0-9]{{1,2}})[-/.]([0-9]{{4}}).*$', '\\3-\\2-\\1') AS DATE)
  ELSE coalesce(try_strptime({s}, '%d-%b-%Y'), try_strptime({s}, '%d %B %Y'), try_strptime({s}, '%d %b %Y'))::DATE END"""


def _day(column: str) -> str:
    return _DAY.format(s=f"trim(regexp_replace({column}, '\\s+', ' ', 'g'))")


QUERIES = {"p1_found": p1_found}
SQL = {
    "p1_found": f"""
WITH d AS (SELECT pid, {_day("term_start")} AS s, {_day("term_end")} AS e0, sitting FROM tenures),
r AS (SELECT pid, s, CASE WHEN e0 IS NOT NULL AND year(e0) < 2090 THEN e0 WHEN sitting = 1 THEN DATE '9999-12-31' END AS e FROM d),
u AS (SELECT DISTINCT pid, s, e FROM r WHERE pid IS NOT NULL AND s IS NOT NULL AND e >= s),
m AS (SELECT *, max(e) OVER (PARTITION BY pid ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM u),
i AS (SELECT *, sum(CASE WHEN before IS NULL OR (before < DATE '9999-12-31' AND s > before + 1) THEN 1 ELSE 0 END) OVER (PARTITION BY pid ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM m),
p AS (SELECT pid, island, min(s) AS s, max(e) AS e FROM i GROUP BY pid, island),
g AS (SELECT pid, e, lead(s) OVER (PARTITION BY pid ORDER BY s) AS nxt FROM p)
SELECT pid, 'period' AS kind, strftime(s, '%Y-%m-%d') AS start_day, CASE WHEN e = DATE '9999-12-31' THEN 'open' ELSE strftime(e, '%Y-%m-%d') END AS end_day FROM p
UNION ALL
SELECT pid, 'gap', strftime(e + INTERVAL 1 DAY, '%Y-%m-%d'), strftime(nxt - INTERVAL 1 DAY, '%Y-%m-%d') FROM g WHERE nxt IS NOT NULL
"""
}
