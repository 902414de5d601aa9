"""Queries of problem 8."""

from __future__ import annotations

from rollcall.llm.truncation import truncated, truncation_rates
from rollcall.session import load


def p8_found(spark, sf_dir):
    return truncated(load(spark, sf_dir, "documents")).where("is_cut").select("doc_id")


def p8_rates(spark, sf_dir):
    return truncation_rates(truncated(load(spark, sf_dir, "documents")))


QUERIES = {"p8_found": p8_found, "p8_rates": p8_rates}
SQL = {}
