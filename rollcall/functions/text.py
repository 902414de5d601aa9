"""Text of bodies as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HEAD = 5000


def tokens(text: Column) -> Column:
    """Runs of three or more ASCII letters and digits, in lower case."""
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]{3,}"), F.lit(0))


def head(text: Column, length: int = HEAD) -> Column:
    return F.substring(text, 1, length)


def strip_html(body: Column) -> Column:
    """Text of a body by patterns alone: tags to spaces, blank lines to one."""
    bare = F.regexp_replace(body, "<[^>]+>", " ")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        bare = F.replace(bare, F.lit(entity), F.lit(char))
    return F.regexp_replace(F.regexp_replace(bare, r"\n[ \t]*\n[ \t\n]*", "\n\n"), r"^[ \t\n]+|[ \t\n]+$", "")
