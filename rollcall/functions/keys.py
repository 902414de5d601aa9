"""Record keys, buckets and shard names as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Records of one band of a bucket, for texts and for the search files.
TEXT_STRIDE, SEARCH_STRIDE = 250, 1000


def type_letter(kind: Column) -> Column:
    return F.when(F.upper(kind) == "STARRED", F.lit("S")).otherwise(F.lit("U"))


def ls_question_id(term: Column, session: Column, kind: Column, number: Column) -> Column:
    return F.concat(F.lit("LS"), term, F.lit("_S"), session, F.lit("_"), type_letter(kind), F.lit("_"), number)


def rs_day_id(session: Column, day: Column, version: Column | None = None) -> Column:
    base = F.concat(F.lit("RS"), session, F.lit("_"), day)
    return base if version is None else F.when(version.isNull(), base).otherwise(F.concat(base, F.lit("_"), version))


def rs_bundle_id(session: Column, day: Column, kind: Column) -> Column:
    return F.concat(F.lit("RS"), session, F.lit("_"), day, F.lit("_"), type_letter(kind))


def report_key(corpus: str, house: str, *fields: Column) -> Column:
    return F.concat_ws("|", F.lit(corpus), F.lit(house), *[f.cast("string") for f in fields])


def bucket(key: Column) -> Column:
    """House and the first two parts of a composite id; 'misc' when nothing is left."""
    has_house = F.contains(key, F.lit("|"))
    house = F.when(has_house, F.substring_index(key, "|", 1)).otherwise(F.lit(""))
    body = F.when(has_house, F.regexp_replace(key, r"^[^|]*\|", "")).otherwise(key)
    fields = F.slice(F.filter(F.split(body, r"[_|]"), lambda p: p != ""), 1, 2)
    raw = F.array_join(F.filter(F.concat(F.array(house), fields), lambda p: p != ""), "-")
    return F.coalesce(F.nullif(F.regexp_replace(raw, "[^A-Za-z0-9-]", ""), F.lit("")), F.lit("misc"))


def shard_group(key: Column, stride: int = TEXT_STRIDE) -> Column:
    """The bucket, and the band of the id's last number where it has one."""
    number = F.try_to_number(F.nullif(F.regexp_extract(key, r"([0-9]+)[^0-9]*$", 1), F.lit("")), F.lit("999999999999999999"))
    band = F.floor(number.cast("long") / F.lit(stride))
    return F.when(number.isNull(), bucket(key)).otherwise(F.concat(bucket(key), F.lit("-"), F.format_string("%04d", band)))


def shard_file(key: Column, stride: int = TEXT_STRIDE) -> Column:
    return F.concat(F.lit("texts-"), shard_group(key, stride), F.lit(".json"))


def short_hash(text: Column) -> Column:
    return F.substring(F.sha2(text, 256), 1, 16)
