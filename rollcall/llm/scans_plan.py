"""Queries of problem 4."""

from __future__ import annotations

from rollcall.llm.scans import noisy_lines, readable_texts
from rollcall.session import load


def p4_found(spark, sf_dir):
    return noisy_lines(load(spark, sf_dir, "documents"))


def p4_texts(spark, sf_dir):
    return readable_texts(load(spark, sf_dir, "documents"))


QUERIES = {"p4_found": p4_found, "p4_texts": p4_texts}
SQL = {}
