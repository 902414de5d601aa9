"""Versions of a day's debates: their codes, plain addresses, and whether an address is of its day."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def plain_url(url: Column) -> Column:
    return F.translate(url, "\\", "/")


def version_code(version: Column) -> Column:
    v = F.lower(F.trim(version))
    return F.when(F.startswith(v, F.lit("floor")), "floor").when(F.startswith(v, F.lit("english")), "english").when(v.rlike("^part ?-?1"), "part1")


def is_of_day(url: Column, date_iso: Column) -> Column:
    """Whether a plain address names the day in one of its usual forms; false for none."""
    y, m, d = F.substring(date_iso, 1, 4), F.substring(date_iso, 6, 2), F.substring(date_iso, 9, 2)
    bare = lambda c: F.regexp_replace(c, "^0", "")
    forms = [F.concat(y, m, d), F.concat(d, m, y), F.concat(bare(d), m, y), F.concat(bare(d), bare(m), y), F.concat_ws(".", d, m, y)]
    hit = reduce(Column.__or__, (F.contains(url, f) for f in forms))
    return F.coalesce(hit & (url != "") & date_iso.isNotNull(), F.lit(False))
