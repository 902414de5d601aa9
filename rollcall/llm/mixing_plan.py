"""Queries of problem 7: the mix itself, and the actual share of each source."""

from __future__ import annotations

from rollcall.llm.mixing import mix
from rollcall.llm.tokens import token_counts
from rollcall.session import load


def _mix(spark, sf_dir):
    sized = token_counts(load(spark, sf_dir, "documents"), ["doc_id", "source"])
    return mix(sized, load(spark, sf_dir, "mix_targets"))


def p7_mix(spark, sf_dir):
    return _mix(spark, sf_dir)[0]


def p7_shares(spark, sf_dir):
    return _mix(spark, sf_dir)[1]


QUERIES = {"p7_mix": p7_mix, "p7_shares": p7_shares}
SQL = {}
