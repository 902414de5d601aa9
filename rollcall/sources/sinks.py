"""Sinks: partitioned tables with a manifest, JSON shards, and writes that change nothing."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_reports(df: DataFrame, path: str, partition: list[str], order: list) -> DataFrame:
    """Df by partition columns, sorted in each; returns the manifest."""
    df.repartition(*partition).sortWithinPartitions(*partition, *order).write.mode("overwrite").partitionBy(*partition).parquet(path)
    return df.sparkSession.read.parquet(path).groupBy(*partition).agg(F.count("*").alias("count"))


def content_hash(df: DataFrame, ignore: list[str] = ()) -> str:
    """A hash of the rows without volatile columns; the order of rows is no matter."""
    columns = sorted(c for c in df.columns if c not in ignore)
    one = F.conv(F.substring(F.md5(F.to_json(F.struct(*columns))), 1, 12), 16, 10).cast("decimal(20,0)")
    row = df.agg(F.sum(one).alias("h"), F.count("*").alias("n")).first()
    return f"{row['h']}-{row['n']}"


def write_idempotent(df: DataFrame, path: str, ignore: list[str] = ()) -> bool:
    """Writes df unless the table at path already has its content; whether it wrote."""
    try:
        old = df.sparkSession.read.parquet(path)
        if old.columns == df.columns and content_hash(old, ignore) == content_hash(df, ignore):
            return False
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
    df.write.mode("overwrite").parquet(path)
    return True


def export_shards(df: DataFrame, folder: str, file: str, key: str, value: str, overlay: bool = True) -> None:
    """One JSON file for each value of file, its records sorted by key.

    With overlay records that a file has already stay under the fresh ones, else a file
    holds the fresh ones alone. A shared folder is needed; files are replaced whole, so a
    task may run twice.
    """

    def write(rows) -> None:
        name, records = None, {}

        def flush() -> None:
            if name is not None:
                path, kept = os.path.join(folder, name), {}
                if overlay and os.path.exists(path):
                    with open(path, encoding="utf-8") as f:
                        kept = json.load(f)["records"]
                merged = kept | records
                part = os.path.join(folder, f".{name}.part")
                with open(part, "w", encoding="utf-8") as f:
                    json.dump({"shard": name, "records": {k: merged[k] for k in sorted(merged)}}, f, ensure_ascii=False, indent=2)
                os.replace(part, path)

        for r in rows:
            if r[file] != name:
                flush()
                name, records = r[file], {}
            records[r[key]] = r[value] if r[value] is not None else {"r2": True}
        flush()

    os.makedirs(folder, exist_ok=True)
    df.select(file, key, value).repartition(file).sortWithinPartitions(file, key).foreachPartition(write)


def cooled_down(last_limited: float | None, now: float, hours: float = 6) -> bool:
    """Whether a source that limited us may be asked again."""
    return last_limited is None or now - last_limited >= hours * 3600


def may_replace(fresh: DataFrame, state_rows: int) -> bool:
    """An empty result never replaces derived output while there is state."""
    return state_rows == 0 or not fresh.isEmpty()
