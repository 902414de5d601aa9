"""Query of problem 6."""

from __future__ import annotations

from rollcall.llm.tokens import encode
from rollcall.session import load


def p6_ids(spark, sf_dir):
    return encode(load(spark, sf_dir, "documents"))


QUERIES = {"p6_ids": p6_ids}
SQL = {}
