import os
import shutil

from pyspark.sql import functions as F

from rollcall.operators.dedupe import descending
from rollcall.streaming.upsert import stream_upsert

SCHEMA = "k string, n int"


def run(spark, src, out, **options):
    stream = spark.readStream.schema(SCHEMA).options(**options).parquet(src)
    return {tuple(r) for r in stream_upsert(stream, ["k"], [descending(F.col("n"))], out, buckets=8).collect()}


def add(spark, src, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(src)


def test_batches_build_on_each_other(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "state")
    add(spark, src, [("a", 1), ("b", 5)])
    assert run(spark, src, out) == {("a", 1), ("b", 5)}
    # late rows do not replace later ones
    add(spark, src, [("a", 3), ("b", 2), ("c", 1), (None, 4)])
    assert run(spark, src, out) == {("a", 3), ("b", 5), ("c", 1), (None, 4)}


def test_a_restart_without_news_keeps_the_state(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "state")
    add(spark, src, [("a", 1)])
    assert run(spark, src, out) == run(spark, src, out) == {("a", 1)}


def test_many_batches_and_one_that_runs_again(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "state")
    for i in range(5):
        add(spark, src, [("a", i * (-1) ** i), (f"k{i}", i)])
    want = {("a", 4), *((f"k{i}", i) for i in range(5))}
    assert run(spark, src, out, maxFilesPerTrigger=1) == want
    # only two manifests and the buckets they name are left
    names = sorted(n for n in os.listdir(f"{out}/manifests") if n.startswith("m"))
    assert names == ["m3.json", "m4.json"]
    held = {d: os.listdir(f"{out}/state/{d}") for d in os.listdir(f"{out}/state")}
    assert sum(n.startswith("__bucket=") for names in held.values() for n in names) <= 2 * 8
    # a batch that was written but not committed by the stream is written again
    for kind in ("commits",):
        newest = max((n for n in os.listdir(f"{out}/checkpoint/{kind}") if n.isdigit()), key=int)
        os.remove(f"{out}/checkpoint/{kind}/{newest}")
        crc = f"{out}/checkpoint/{kind}/.{newest}.crc"
        if os.path.exists(crc):
            os.remove(crc)
    assert run(spark, src, out, maxFilesPerTrigger=1) == want
    shutil.rmtree(out)
