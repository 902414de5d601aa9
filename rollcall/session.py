"""Session settings, table loading and lineage cuts shared by every operator."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Confs every result of this package is defined under.
CONFS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


_own: str | None = None  # the folder of a local session that names none


def session(app: str = "rollcall", master: str | None = None, **confs: str) -> SparkSession:
    """A session under CONFS; an existing session is returned as it is."""
    builder = SparkSession.builder.appName(app).config(map=CONFS | confs)
    if master:
        builder = builder.master(master)
    return builder.getOrCreate()


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in spark.checkpoint.dir.

    Only a local session that names none gets a folder of its own.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    set_already = spark.sparkContext._jsc.sc().getCheckpointDir()
    if set_already.isDefined():
        return set_already.get()
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    global _own
    if _own is None:
        _own = tempfile.mkdtemp(prefix="rollcall-checkpoint-")
        atexit.register(shutil.rmtree, _own, ignore_errors=True)
    return _own


def cut(df: DataFrame) -> DataFrame:
    """Write df to the shared checkpoint folder and continue from those files."""
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(checkpoint_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def spill(df: DataFrame) -> DataFrame:
    """Write df as a Parquet table in the shared folder and continue from it.

    For tables that several branches of a query read: columns and filters still reach
    the scan, and the files are compressed. They are deleted when the driver ends.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/rollcall-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_delete, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, path: str) -> None:
    try:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
    except Exception:  # the session may be gone before
        local = "/" + path[5:].lstrip("/") if path.startswith("file:") else path
        if "://" not in local and os.path.isdir(local):
            shutil.rmtree(local, ignore_errors=True)


def local_path(spark: SparkSession, path: str) -> str | None:
    """The path in the machines' own file system that the default file system gives a folder, else None."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.makeQualified(hadoop).toUri().getPath() if files.getUri().getScheme() == "file" else None
