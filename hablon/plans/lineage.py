"""Cutting lineage with tables in a folder that every executor shares."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []
_own: list[str] = []  # the temporary folder of this process, if it needs one


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary folder only where none is set and the master is local."""
    known = spark.conf.get("spark.checkpoint.dir", None)
    if known:
        return known.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="hablon-"))
        atexit.register(shutil.rmtree, _own[0], True)
    return f"file://{_own[0]}"


def scratch(spark: SparkSession) -> str:
    """A fresh path in the shared folder, removed when the driver's Python ends."""
    path = f"{shared_dir(spark)}/tables/{uuid.uuid4().hex}"
    if not _written:
        atexit.register(drop_tables)
    _written.append((spark, path))
    return path


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as a compressed columnar table in the shared folder and read it back.

    The result has no lineage: a lost executor costs a re-read, not a recomputation. Files are removed when the
    driver's Python ends.
    """
    spark = df.sparkSession
    path = scratch(spark)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let the driver's JVM collect plans that are no longer referenced, so that their shuffle files go at once."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def drop_tables() -> None:
    """Remove every table that ``cut`` wrote in this process."""
    while _written:
        spark, path = _written.pop()
        try:
            jvm = spark.sparkContext._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # the JVM may be gone already
            continue
