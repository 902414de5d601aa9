"""States, constituencies and parties as Column expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: other names of states
STATE_ALIASES = {"orissa": "odisha", "pondicherry": "puducherry", "nct of delhi": "delhi"}
# fixed values: other names of constituencies
CONSTITUENCY_ALIASES = {
    "sarguja": "surguja", "purnea": "purnia", "allahabad": "prayagraj", "burdwan": "bardhaman", "burdwan durgapur": "bardhaman durgapur",
    "burdwan purba": "bardhaman purba", "calcutta north": "kolkata uttar", "calcutta south": "kolkata dakshin", "malda": "maldaha",
    "maldah": "maldaha", "maldah dakshin": "maldaha dakshin", "maldah uttar": "maldaha uttar", "trivandrum": "thiruvananthapuram",
    "mysore": "mysuru", "bombay north": "mumbai north", "bombay south": "mumbai south", "bombay north central": "mumbai north central",
    "bombay south central": "mumbai south central", "bombay north east": "mumbai north east", "bombay north west": "mumbai north west",
}


def _alias(key: Column, table: dict[str, str]) -> Column:
    found = F.create_map(*[F.lit(x) for x in chain.from_iterable(table.items())])[key]
    return F.coalesce(found, key, F.lit(""))


def _squeeze(s: Column) -> Column:
    return F.trim(F.regexp_replace(s, r"\s+", " "))


def state(raw: Column) -> Column:
    s = F.regexp_replace(F.regexp_replace(F.lower(raw), r"\[.*?\]", " "), "&", " and ")
    return _alias(_squeeze(F.regexp_replace(F.regexp_replace(s, "[0-9]+", " "), "[^a-z ]+", " ")), STATE_ALIASES)


def state_display(raw: Column) -> Column:
    return F.coalesce(F.trim(F.regexp_replace(F.regexp_replace(raw, r"\[.*?\]", ""), "[0-9]+$", "")), F.lit(""))


def constituency(raw: Column) -> Column:
    s = F.regexp_replace(F.regexp_replace(F.lower(F.trim(raw)), r"\(.*?\)", " "), "&", " and ")
    return _alias(_squeeze(F.regexp_replace(s, "[^a-z0-9 ]+", " ")), CONSTITUENCY_ALIASES)


def same_constituency(a: Column, b: Column, least: int = 12) -> Column:
    """Equal, or one the beginning of the other where both are long."""
    long = (F.length(a) >= least) & (F.length(b) >= least)
    return (a != "") & (b != "") & ((a == b) | (long & (F.startswith(a, b) | F.startswith(b, a))))


def party(raw: Column) -> Column:
    return F.regexp_replace(F.upper(F.trim(F.coalesce(raw, F.lit("")))), r"\.+$", "")


def title_case(raw: Column) -> Column:
    """Every run of letters capitalised, a type in brackets in capitals; null for ''."""
    s = F.nullif(F.trim(raw), F.lit(""))
    title = lambda x: F.array_join(F.transform(F.regexp_extract_all(x, F.lit("([A-Za-z]+|[^A-Za-z]+)"), F.lit(0)), lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 1000000)))), "")
    seat = r"^(.*?)\s*\(([^)]+)\)\s*$"
    return F.when(s.rlike(seat), F.concat(title(F.regexp_extract(s, seat, 1)), F.lit(" ("), F.upper(F.regexp_extract(s, seat, 2)), F.lit(")"))).otherwise(title(s))
