"""Names of persons as Column expressions: bags, sets, normal forms and slugs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: honorifics that are no part of a name
HONORIFICS = ["shri", "smt", "shrimati", "dr", "ms", "mr", "mrs", "prof", "adv", "sh", "km", "kumari"]
# fixed values: tokens too common to tell two people apart, besides single letters
COMMON_TOKENS = [
    "singh", "kumar", "yadav", "gandhi", "sharma", "shah", "rao", "reddy", "patel", "naidu", "lal", "prasad", "das", "devi",
    "khan", "verma", "varma", "iyer", "menon", "gupta", "chowdhury", "chowdhary", "thakur", "tiwari", "mishra", "pandey", "pandit", "begum",
]
_HON = r"(?:shri|shrimati|smt\.?|dr\.?|ms\.?|mr\.?|mrs\.?|prof\.?|adv\.?|sh\.?|km\.?)"
_DEVANAGARI = r"^(?:(?:श्री|श्रीमती|डॉ\.?|डा\.?|कुमारी|कु\.?)\s+)+"
_PUNCTUATION = r"[.,;:()\[\]'\"]"


def _tokens(name: Column) -> Column:
    words = F.split(F.trim(F.regexp_replace(F.regexp_replace(F.lower(name), _PUNCTUATION, " "), r"\s+", " ")), " ")
    return F.filter(words, lambda t: (t != "") & ~t.isin(HONORIFICS))


def name_bag(name: Column) -> Column:
    """Tokens in sorted order, repeats kept; '' for a null."""
    return F.coalesce(F.array_join(F.array_sort(_tokens(name)), " "), F.lit(""))


def name_tokens(name: Column) -> Column:
    """Sorted distinct tokens; an empty array for a null."""
    return F.coalesce(F.array_sort(F.array_distinct(_tokens(name))), F.array().cast("array<string>"))


def name_set(name: Column) -> Column:
    return F.array_join(name_tokens(name), " ")


def normal_form(name: Column) -> Column:
    """Lower-case name without honorifics at either end."""
    s = F.regexp_replace(F.trim(name), _DEVANAGARI, "")
    s = F.regexp_replace(s, rf"(?i)^\s*(?:{_HON}\s+)+", "")
    s = F.regexp_replace(s, rf"(?i)(?:\s+{_HON})+\s*$", "")
    return F.coalesce(F.lower(F.trim(F.regexp_replace(F.regexp_replace(s, _PUNCTUATION, " "), r"\s+", " "))), F.lit(""))


def person_key(name: Column) -> Column:
    """A key under which "Last, First" and "First Last" are one; '' for other scripts."""
    s = F.regexp_replace(F.trim(name), r"^([^,]+),\s*(.+)$", "$2 $1")
    s = F.regexp_replace(F.regexp_replace(s, rf"(?i)^\s*{_HON}\s+", ""), rf"(?i)\s+{_HON}\s*$", "")
    return F.coalesce(F.lower(F.trim(F.regexp_replace(F.regexp_replace(s, r"[^a-zA-Z0-9\s]+", " "), r"\s+", " "))), F.lit(""))


def shared_tokens(a: Column, b: Column) -> Column:
    long = lambda s: F.array_distinct(F.filter(F.split(s, " "), lambda t: F.length(t) >= 3))
    return F.size(F.array_intersect(long(a), long(b)))


def slug(text: Column) -> Column:
    """'' when nothing is left."""
    return F.coalesce(F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), "^-+|-+$", ""), F.lit(""))


def name_slug(name: Column) -> Column:
    """Slug in reading order without honorifics; 'anon' when nothing is left."""
    joined = F.regexp_replace(F.array_join(_tokens(name), "-"), "[^a-z0-9-]+", "-")
    return F.coalesce(F.nullif(F.regexp_replace(joined, "^-+|-+$", ""), F.lit("")), F.lit("anon"))


def gender(raw: Column) -> Column:
    g = F.nullif(F.upper(F.trim(raw)), F.lit(""))
    return F.when(g == "MALE", "M").when(g == "FEMALE", "F").otherwise(g)


def name_score(a: Column, b: Column, longest_common: int = 6) -> Column:
    """Agreement of two token arrays without common tokens: 1.0, 0.8, 0.6 or 0.0."""
    rare = lambda s: F.filter(s, lambda t: ~t.isin(COMMON_TOKENS) & (F.length(t) > 1))
    x, y = rare(a), rare(b)
    long = lambda s: F.filter(s, lambda t: F.length(t) >= longest_common)
    pieces = lambda t: F.transform(F.sequence(F.lit(1), F.length(t) - longest_common + 1), lambda i: F.substring(t, i, F.lit(longest_common)))
    common = F.exists(long(x), lambda t: F.exists(long(y), lambda u: F.exists(pieces(t), lambda p: F.contains(u, p))))

    def joined(one: Column, two: Column) -> Column:
        return F.exists(long(one), lambda t: F.exists(two, lambda u: F.exists(two, lambda v: (u != v) & (F.concat(u, v) == t))))

    score = (
        F.when((F.size(x) == 0) | (F.size(y) == 0), 0.0)
        .when(F.array_sort(x) == F.array_sort(y), 1.0)
        .when(F.size(F.array_intersect(x, y)) > 0, 0.8)
        .when(common | joined(x, y) | joined(y, x), 0.6)
        .otherwise(0.0)
    )
    return score


def strong_name(a: Column, b: Column) -> Column:
    """Equal rare tokens, or one set within the other where both have two or more."""
    rare = lambda s: F.filter(s, lambda t: ~t.isin(COMMON_TOKENS) & (F.length(t) > 1))
    x, y = rare(a), rare(b)
    within = (F.size(F.array_except(x, y)) == 0) | (F.size(F.array_except(y, x)) == 0)
    return ((F.size(x) > 0) & (F.array_sort(x) == F.array_sort(y))) | ((F.size(x) >= 2) & (F.size(y) >= 2) & within)
