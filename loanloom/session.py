"""Where a job may keep intermediate tables, and how it cuts lineage."""

from __future__ import annotations

import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession


RELEASE_SECONDS = 20.0
_released = 0.0


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, not yet existing folder under the shared folder named by ``spark.checkpoint.dir``.

    A machine-local folder is only taken in local mode with the setting unset; on a
    cluster other executors could not see it, so that case is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="loanloom-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def home_folder(spark: SparkSession, base: str) -> str:
    """The current user's own folder under ``base``, ending in a slash."""
    user = spark.sql("select current_user() as user").first()["user"]
    return f"{base.rstrip('/')}/{user}/"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in a fresh scratch folder and read it back.

    Used where several jobs read one result (ratio, split, iterations of a fit): the
    joins and parsing behind it run once, and a lost executor costs a re-read of files
    rather than a replay of the whole plan.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    release_shuffles(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_shuffles(spark: SparkSession, now: bool = False) -> None:
    """Let executors delete the shuffle files of plans that have been written.

    Spark deletes them when the driver's collector finds that nothing refers to the plan any
    more, by default once in half an hour; a job of many steps would keep them all until then.
    At most once in ``RELEASE_SECONDS``, so that many small steps do not wait for the collector;
    with ``now`` at once, and again until the plan just written is let go, between steps that
    each shuffle much.
    """
    global _released
    if now or time.monotonic() - _released >= RELEASE_SECONDS:
        spark._jvm.System.gc()
        _released = time.monotonic()
    if now:  # the end of a job reaches all who refer to its plan a moment later only
        for _ in range(2):
            time.sleep(0.7)
            spark._jvm.System.gc()


def discard(df: DataFrame) -> None:
    """Delete the folder of a table that :func:`materialize` returned, when it is not needed any more."""
    folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    spark = df.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None) or tempfile.gettempdir()
    for folder in folders:
        if folder.split(":", 1)[-1].lstrip("/").startswith(base.split(":", 1)[-1].strip("/")):
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
