"""Intermediate tables in the folder that the whole cluster shares."""

from __future__ import annotations

import atexit
import shutil
import uuid

from pyspark.sql import DataFrame, SparkSession

LOCAL_DEFAULT = "file:///tmp/checkpoints/heddle"
#: Shuffle files go when the query that wrote them ends, not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: What Spark hands to a Python worker at once is bounded in bytes: by rows alone (10,000), texts take as much as they please, on either side.
BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 1 << 21


def shared_dir(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir. Where it is unset, a local session gets LOCAL_DEFAULT, emptied when the driver ends, and a cluster an error."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    atexit.register(shutil.rmtree, f"{LOCAL_DEFAULT.removeprefix('file://')}/heddle/{spark.sparkContext.applicationId}", ignore_errors=True)
    return LOCAL_DEFAULT


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/heddle/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def _bytes(spark: SparkSession, size: str) -> int:
    return int(size) if size.lstrip("-").isdigit() else spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: its lineage is cut, lost executors cost nothing of it."""
    path = new_path(df.sparkSession, name)
    conf = df.sparkSession.conf
    before = {k: conf.get(k) for k in (CLEANUP, BATCH)}
    conf.set(CLEANUP, "true")
    if not 0 < _bytes(df.sparkSession, before[BATCH]) <= BATCH_BYTES:
        conf.set(BATCH, str(BATCH_BYTES))
    try:
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            conf.set(k, v)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._heddle_path = path  # for drop()
    return out


def drop(*tables: DataFrame) -> None:
    """Delete tables that stored() wrote and that nothing reads any more."""
    for df in tables:
        spark, path = df.sparkSession, getattr(df, "_heddle_path", None)
        if path:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def drop_all(spark: SparkSession) -> None:
    """Delete every intermediate table of this application, once its results are written elsewhere."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/heddle/{spark.sparkContext.applicationId}")
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def unused(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have, in any case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
        taken.add(name.lower())
    return out
