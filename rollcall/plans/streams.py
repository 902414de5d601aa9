"""Streaming queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollcall.functions.bodies import parsed_html
from rollcall.operators.dedupe import descending
from rollcall.session import load
from rollcall.streaming.upsert import state_folder, stream_upsert


def q_stream_upsert(spark, sf_dir):
    """The last event of each user, kept up as a stream of several files with late rows."""
    columns = ["event_id", "ts", "user_id", "event_type", "value"]
    events, source = load(spark, sf_dir, "events").select(*columns), state_folder(spark)
    # four arrivals, of which each has events from all days
    events.repartition(4, "event_id").write.parquet(f"{source}/arrived")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(f"{source}/arrived")
    last = stream_upsert(stream, ["user_id"], [descending(F.unix_micros(F.col("ts").cast("timestamp"))), descending(F.col("event_id"))], source)
    return last.select("user_id", "event_id", "event_type", "value")


def q_html_parsed(spark, sf_dir):
    """Bodies of all documents by the parser, and whether anything is left."""
    d = load(spark, sf_dir, "documents").select("doc_id", parsed_html(F.col("text")).alias("plain"))
    return d.select("doc_id", F.length("plain").alias("n_chars"), F.when(F.coalesce("plain", F.lit("")) == "", "empty").otherwise("text").alias("status"))


QUERIES = {"q_stream_upsert": q_stream_upsert, "q_html_parsed": q_html_parsed}
SQL = {"q_stream_upsert": "SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1"}
