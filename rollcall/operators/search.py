"""Search heads, document-frequency cut and inverted indexes, as sparse rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions import keys, text
from rollcall.operators.ordinals import number_rows
from rollcall.session import spill


def _pairs(docs: DataFrame, key: str, body: str) -> DataFrame:
    """Rows (k, token) of each document's distinct tokens, and one with the token '' for each that has a text."""
    tokens = F.concat(F.array(F.lit("")), F.array_distinct(text.tokens(F.col(body))))
    return docs.where(F.col(body).isNotNull()).select(F.col(key).alias("k"), F.explode(tokens).alias("token"))


def _frequent(pairs: DataFrame, share: float) -> DataFrame:
    # the texts are read once; what is asked of the counts is asked of their table
    counts = spill(pairs.groupBy("token").agg(F.count("*").alias("df")))
    total = counts.where("token = ''").agg(F.max("df")).first()[0] or 0
    kept = counts.where("token <> ''").where((F.col("df") >= 2) & (F.col("df") <= max(2, int(share * total))))
    return counts.where("token <> ''") if kept.isEmpty() else kept


def document_frequency(docs: DataFrame, key: str, body: str, share: float = 0.5) -> DataFrame:
    """Rows (token, df) of tokens in at least 2 and at most max(2, share * N) documents.

    Where no token is left, all tokens stay.
    """
    return _frequent(_pairs(docs, key, body), share)


def postings(docs: DataFrame, key: str, body: str, group: Column) -> DataFrame:
    """Rows (grp, token, doc_index): for each token of a group the documents' indexes in it.

    The index counts a group's documents with a text in the order of their keys.
    """
    rows = docs.where(F.coalesce(F.col(body), F.lit("")) != "").select(F.col(key).alias("k"), group.alias("grp"), body)
    # only keys are ranked; the tokens join afterwards
    index = number_rows(rows.select("grp", "k"), ["grp"], [F.col("k")], "place").select(F.col("grp").alias("g"), F.col("k").alias("key"), (F.col("place") - 1).alias("doc_index"))
    rows = rows.join(index, F.col("grp").eqNullSafe(F.col("g")) & (F.col("k") == F.col("key")))
    return rows.select("grp", F.explode(F.array_distinct(text.tokens(F.col(body)))).alias("token"), "doc_index")


def positional_postings(docs: DataFrame, key: str, body: str, size: int = 2500) -> DataFrame:
    """Rows (shard, token, doc_ordinal) over the whole corpus in shards of size documents."""
    pairs = spill(_pairs(docs, key, body))
    ids = docs.where(F.coalesce(F.col(body), F.lit("")) != "").select(F.col(key).alias("k"))
    ordinal = number_rows(ids, [], [F.col("k")], "place").select("k", (F.col("place") - 1).alias("doc_ordinal"))
    rows = pairs.join(_frequent(pairs, 0.5).select("token"), "token", "left_semi").join(ordinal, "k")
    return rows.select(F.floor(F.col("doc_ordinal") / F.lit(size)).alias("shard"), "token", "doc_ordinal")


def search_heads(docs: DataFrame, key: str, body: str) -> DataFrame:
    """Rows (k, head, truncated, grp) of documents with a text."""
    rows = docs.where(F.coalesce(F.col(body), F.lit("")) != "")
    return rows.select(F.col(key).alias("k"), text.head(F.col(body)).alias("head"), (F.length(body) > text.HEAD).alias("truncated"), keys.shard_group(F.col(key), keys.SEARCH_STRIDE).alias("grp"))
