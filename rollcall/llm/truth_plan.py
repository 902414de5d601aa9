"""Queries of problem 3."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollcall.llm.truth import best_values, surviving_rows
from rollcall.session import load


def p3_found(spark, sf_dir):
    return surviving_rows(load(spark, sf_dir, "persons"))


def p3_values(spark, sf_dir):
    """Every claimed value with its support, as truth discovery leaves it."""
    return best_values(load(spark, sf_dir, "persons")).select("pid", "field", "value", F.round("support", 6).alias("support"), F.round("share", 6).alias("share"))


QUERIES = {"p3_found": p3_found, "p3_values": p3_values}
SQL = {}
