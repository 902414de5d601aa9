"""Rows of listings turned into records: what is refused, which wins, how fields are named."""

from __future__ import annotations

from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions import dates, versions
from rollcall.operators.dedupe import descending, keep_best

# fixed values: fields of a roster, and where each house's listing has them ("" for nowhere)
ROSTER_FIELDS = {
    "status": ("status", "status"), "initial": ("initial", "initial"), "first_name": ("firstName", "firstName"), "last_name": ("lastName", "lastName"),
    "full_name_lastfirst": ("mpLastFirstName", "name"), "full_name_firstlast": ("mpFirstLastName", ""), "gender": ("gender", "gender"), "party_full": ("partyFname", "party"),
    "party_short": ("partySname", "partyCode"), "state": ("stateName", "state"), "constituency": ("constName", ""), "profession": ("profession", ""),
    "dob": ("dob", "dob"), "image_url": ("imageUrl", "imageUrl"), "email": ("email", "emailID"),
}
# fixed values: fields that a house without them leaves null, where others are ''
_NULL_WHERE_ABSENT = ("constituency", "profession")


def question_scopes(terms: list[int], sessions: list[int], kinds: tuple[str, ...] = ("STARRED", "UNSTARRED")) -> list[dict]:
    """One scope of a paged listing for each term, session and type."""
    return [{"term": t, "session": s, "type": k} for t, s, k in product(terms, sessions, kinds)]


def debate_days(files: DataFrame) -> DataFrame:
    """One row (session, date, date_iso, file_versions) for each session and day of a listing's files.

    files has session, date, version, url and place, the file's place in the listing. Days
    that are no days are refused, and addresses that name another day; of each version the
    first address wins. A day all of whose files are refused keeps an empty list.
    """
    rows = files.select("session", "date", F.date_format(dates.parse_day(F.col("date")), "yyyy-MM-dd").alias("date_iso"), versions.version_code(F.col("version")).alias("version"), versions.plain_url(F.col("url")).alias("url"), "place")
    rows = rows.where("date_iso IS NOT NULL")
    days = rows.groupBy("session", "date_iso").agg(F.min("date").alias("date"))
    fit = rows.where(versions.is_of_day(F.col("url"), F.col("date_iso")) & F.col("version").isNotNull())
    first = keep_best(fit.select("session", "date_iso", "version", "url", "place"), ["session", "date_iso", "version"], [F.col("place")])
    listed = first.groupBy("session", "date_iso").agg(F.array_sort(F.collect_list(F.struct("version", "url"))).alias("file_versions"))
    none = F.array().cast("array<struct<version:string,url:string>>")
    return days.join(listed, ["session", "date_iso"], "left").select("session", "date", "date_iso", F.coalesce("file_versions", none).alias("file_versions"))


def question_bundles(rows: DataFrame) -> DataFrame:
    """Rows (session, date, date_iso, type, pdf_url) of a listing, without those of a bad day or no address."""
    day = F.date_format(dates.parse_day(F.col("date")), "yyyy-MM-dd")
    out = rows.select("session", "date", day.alias("date_iso"), F.upper(F.trim("type")).alias("type"), F.trim("pdf_url").alias("pdf_url"))
    return out.where("date_iso IS NOT NULL AND coalesce(pdf_url, '') <> ''")


def roster_terms(ls: DataFrame, rs: DataFrame) -> DataFrame:
    """All terms of both houses' listings in one schema, names and places trimmed.

    ls has its listing's fields and loksabha and sitting, which the scope gives; rs has mpFlag.
    """

    def one(df: DataFrame, house: str, at: int, loksabha, sitting, terms: str) -> DataFrame:
        def field(name: str, source: str):
            if source:
                return F.coalesce(F.trim(F.col(source)), F.lit("")).alias(name)
            return F.lit(None if name in _NULL_WHERE_ABSENT else "").cast("string").alias(name)

        fields = [field(name, sources[at]) for name, sources in ROSTER_FIELDS.items()]
        return df.select("mpsno", F.lit(house).alias("house"), loksabha.cast("int").alias("loksabha"), F.coalesce(sitting, F.lit(False)).alias("sitting"), *fields, F.col("age").cast("int").alias("age"), F.col(terms).cast("int").alias("terms"))

    lower = one(ls, "ls", 0, F.col("loksabha"), F.col("sitting"), "noOfTerms")
    return lower.unionByName(one(rs, "rs", 1, F.lit(None), F.col("mpFlag") == 1, "termCount"))


def roster_master(terms: DataFrame) -> DataFrame:
    """One row for each member of a house: the newest term of the lower house, its sitting row first; of the upper house the sitting row."""
    return keep_best(terms, ["house", "mpsno"], [F.when(F.col("house") == "rs", F.lit(0)).otherwise(1), descending(F.when(F.col("house") == "ls", F.col("loksabha"))), F.when(F.col("sitting"), 0).otherwise(1)])


def with_history(terms: DataFrame, histories: DataFrame) -> DataFrame:
    """Terms with the link of the member's election history, by house and number; none where there is no file."""
    h = keep_best(histories.select("house", "mpsno", "link"), ["house", "mpsno"], [F.col("link").isNull(), F.col("link")])
    return terms.join(h, ["house", "mpsno"], "left")
