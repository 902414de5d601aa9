"""Queries of problem 5."""

from __future__ import annotations

from rollcall.llm.matching import match_candidates
from rollcall.session import load


def p5_matches(spark, sf_dir):
    """Each matched row with the confidence of its match."""
    return match_candidates(*(load(spark, sf_dir, t) for t in ("tcpd_tuples", "persons", "tenures", "parties")))


def p5_found(spark, sf_dir):
    return p5_matches(spark, sf_dir).select("tuple_id", "pid")


QUERIES = {"p5_found": p5_found, "p5_matches": p5_matches}
SQL = {}
