"""Day values typed in many ways, as Column expressions (no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_YMD = r"^([0-9]{4})[-/.]([0-9]{1,2})[-/.]([0-9]{1,2})(?:[T ].*)?$"
_DMY = r"^([0-9]{1,2})[-/. ]+([0-9]{1,2}|[A-Za-z]{3,9})[-/., ]+([0-9]{4})(?:[T ].*)?$"


def parse_day(raw: Column) -> Column:
    """DATE of a typed day, or NULL when it is no calendar day.

    Year-first values are year-month-day, all others day-first. Month names may be
    cut to three letters. A time after the day is ignored. 31 February is NULL.
    """
    s = F.trim(F.regexp_replace(raw, r"[\s ]+", " "))
    day = F.regexp_replace(F.regexp_replace(s, _YMD, "$1-$2-$3"), _DMY, "$3-$2-$1")
    # a text in neither form stays as it is and fails all three formats
    return F.coalesce(*(F.try_to_date(day, f"yyyy-{month}-d") for month in ("M", "MMM", "MMMM")))


def slash_day(raw: Column) -> Column:
    """ISO text of d/m/yyyy without a calendar check, else NULL."""
    form = r"^\s*([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})\s*$"
    part = lambda k: F.regexp_extract(raw, form, k)
    return F.when(raw.rlike(form), F.concat_ws("-", part(3), F.lpad(part(2), 2, "0"), F.lpad(part(1), 2, "0")))


def strict_dob(raw: Column) -> Column:
    """ISO text of dd/mm/yyyy or yyyy-mm-dd, else NULL."""
    s, slash = F.trim(raw), r"^([0-9]{2})/([0-9]{2})/([0-9]{4})$"
    return F.when(s.rlike(slash), F.regexp_replace(s, slash, "$3-$2-$1")).when(s.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), s)


def lenient_dob(raw: Column) -> Column:
    """Padded ISO text where the form is known, else the trimmed text itself."""
    s = F.nullif(F.trim(raw), F.lit(""))
    dashed = r"^([0-9]{4})-([0-9]{1,2})-([0-9]{1,2})$"
    part = lambda k: F.regexp_extract(s, dashed, k)
    return F.coalesce(slash_day(s), F.when(s.rlike(dashed), F.concat_ws("-", part(1), F.lpad(part(2), 2, "0"), F.lpad(part(3), 2, "0"))), s)


def sort_key(raw: Column, separator: str) -> Column:
    """Day-first text turned year-first when it has exactly three parts."""
    p = F.split(raw, f"[{separator}]")
    return F.when(F.size(p) == 3, F.concat_ws("-", p[2], p[1], p[0])).otherwise(F.coalesce(raw, F.lit("")))


# fixed values: the year in which each lower house was constituted
TERM_YEARS = {14: 2004, 15: 2009, 16: 2014, 17: 2019, 18: 2024}


def term_number(label: Column) -> Column:
    return F.when(label.rlike("^LS[0-9]+$"), F.regexp_replace(label, "^LS", "").cast("int"))


def term_year(term: Column) -> Column:
    out = F.lit(None).cast("int")
    for n, year in TERM_YEARS.items():
        out = F.when(term == n, F.lit(year)).otherwise(out)
    return out
