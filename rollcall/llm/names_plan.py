"""Query of problem 2."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollcall.llm.names import link_spellings
from rollcall.session import load


def p2_found(spark, sf_dir):
    members = load(spark, sf_dir, "ls_questions").select(F.explode("members").alias("spelling"))
    candidates = load(spark, sf_dir, "tcpd_tuples").select(F.col("candidate").alias("spelling"))
    return link_spellings(members.union(candidates), load(spark, sf_dir, "persons"))


QUERIES = {"p2_found": p2_found}
SQL = {}
