"""File sources: report shards, text shards, markers, tuples of elections, text folders."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# explicit schemas: records of the two houses have other fields, so none is inferred
LS_QUESTION = "house STRING, lok_sabha INT, session INT, question_no INT, type STRING, subject STRING, members ARRAY<STRING>, ministry STRING, date STRING, pdf_url STRING, pdf_url_hindi STRING, supplementary BOOLEAN"
RS_BUNDLE = "house STRING, session INT, date_iso STRING, date STRING, type STRING, pdf_url STRING, subject STRING"
LS_DEBATE = "house STRING, lok_sabha INT, session INT, db_slno INT, title STRING, debate_date STRING, debate_type INT, debate_type_desc STRING, members ARRAY<STRUCT<mp_name:STRING,mp_code:INT,mp_part_code:INT>>, keywords ARRAY<STRING>"
RS_DEBATE_DAY = "house STRING, session INT, date STRING, date_iso STRING, file_versions ARRAY<STRUCT<version:STRING,url:STRING>>, title STRING"
TUPLE = "pid STRING, Year INT, State_Name STRING, Constituency_Name STRING, Party STRING, Candidate STRING, Sex STRING"


BILL = "billNumber STRING, billName STRING, billType STRING, billCategory STRING, ministryName STRING, billIntroducedInHouse STRING, billYear INT, billIntroducedDate STRING, status STRING, compositeId STRING, billIntroducedBy STRING"


class Folder:
    """Names and small texts of a folder on the file system its path names."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def names(self) -> list[str]:
        at = self._path(self.path)
        return sorted(s.getPath().getName() for s in self._files.listStatus(at)) if self._files.exists(at) else []

    def text(self, name: str) -> str:
        return self.spark.read.text(f"{self.path}/{name}", wholetext=True).first()[0]


def read_reports(spark: SparkSession, folder: str, house: str, schema: str) -> DataFrame:
    """Records of the shards that the manifest names; a missing shard is skipped."""
    at = Folder(spark, folder)
    there = set(at.names())
    if "manifest.json" not in there:
        if "reports.json" not in there:
            return spark.createDataFrame([], schema)
        rows = spark.read.schema(f"{house} ARRAY<STRUCT<{_fields(schema)}>>").json(f"{at.path}/reports.json", multiLine=True)
        return rows.select(F.explode(house).alias("r")).select("r.*")
    shards = json.loads(at.text("manifest.json"))["shards"].get(house, [])
    return _records(spark, [f"{at.path}/{s['file']}" for s in shards if s["file"] in there], schema)


def read_bills(spark: SparkSession, folder: str) -> DataFrame:
    """Records of all index-*.json files of a folder."""
    at = Folder(spark, folder)
    return _records(spark, [f"{at.path}/{n}" for n in at.names() if n.startswith("index-") and n.endswith(".json")], BILL)


def _records(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(f"records ARRAY<STRUCT<{_fields(schema)}>>").json(paths, multiLine=True).select(F.explode("records").alias("r")).select("r.*")


def read_bundled_ids(spark: SparkSession, folder: str) -> DataFrame:
    """The composite ids that text shards hold: keys of an old manifest's map of records, else of the shards."""
    at = Folder(spark, folder)
    names = at.names()
    if "manifest.json" in names and "record_to_shard" in json.loads(at.text("manifest.json")):
        rows = spark.read.schema("record_to_shard MAP<STRING, STRING>").json(f"{at.path}/manifest.json", multiLine=True)
        return rows.select(F.explode(F.map_keys("record_to_shard")).alias("composite_id"))
    paths = [f"{at.path}/{n}" for n in names if n.startswith("texts-") and n.endswith(".json")]
    return read_text_shards(spark, paths).select("composite_id") if paths else spark.createDataFrame([], "composite_id string")


def _fields(schema: str) -> str:
    depth, out = 0, ""
    for c in schema:
        depth += (c == "<") - (c == ">")
        out += c
    return ", ".join(f.strip().replace(" ", ": ", 1) for f in _split(out))


def _split(schema: str) -> list[str]:
    parts, depth, at = [], 0, 0
    for i, c in enumerate(schema):
        depth += (c == "<") - (c == ">")
        if c == "," and depth == 0:
            parts.append(schema[at:i])
            at = i + 1
    return [*parts, schema[at:]]


def read_text_shards(spark: SparkSession, paths) -> DataFrame:
    """(composite_id, text, is_external) of text shards; a value is a text or a sentinel."""
    rows = spark.read.schema("shard STRING, records MAP<STRING, STRING>").json(paths, multiLine=True)
    rows = rows.select(F.explode("records").alias("composite_id", "v"))
    external = F.coalesce(F.get_json_object("v", "$.r2") == "true", F.lit(False))
    return rows.select("composite_id", F.when(~external, F.col("v")).alias("text"), external.alias("is_external"))


def read_markers(spark: SparkSession, path: str) -> DataFrame:
    """(composite_id, marker)."""
    return spark.read.schema("markers MAP<STRING, STRING>").json(path, multiLine=True).select(F.explode("markers").alias("composite_id", "marker"))


def read_tuples(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the newest gzip CSV file of election results, by name."""
    at = Folder(spark, folder)
    newest = max(n for n in at.names() if n.endswith(".csv.gz"))
    return spark.read.schema(TUPLE).csv(f"{at.path}/{newest}", header=True, enforceSchema=False)


def read_histories(spark: SparkSession, folder: str) -> DataFrame:
    """(house, mpsno, link) of one JSON file for each person; unreadable files are skipped."""
    rows = spark.read.schema("mpsno INT, house STRING, ge_pid STRING, ae_pid STRING").json(folder, multiLine=True, mode="DROPMALFORMED")
    link = F.coalesce(F.nullif("ge_pid", F.lit("")), F.nullif("ae_pid", F.lit("")))
    return rows.where("mpsno IS NOT NULL").select("house", "mpsno", link.alias("link"))


def read_texts(spark: SparkSession, folder: str, pattern: str = r"(LS[0-9]+_S[0-9]+_[0-9A-Z_]+|RS[0-9]+_[0-9-]+(?:_\w+)?)\.txt$") -> DataFrame:
    """(file_id, text) of a folder of text files whose names fit."""
    rows = spark.read.text(folder, wholetext=True).select(F.regexp_extract(F.input_file_name(), pattern, 1).alias("file_id"), F.col("value").alias("text"))
    return rows.where("file_id <> ''")


def read_table(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A table of a relational database over JDBC."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def parse_terms(value: str | None, every: list[int]) -> list[int]:
    """P35: "all", "3-5" (inclusive) or "3,7" (a covering range) as a list."""
    if not value or value == "all":
        return every
    numbers = [int(x) for x in value.replace("-", ",").split(",")]
    return list(range(min(numbers), max(numbers) + 1))
