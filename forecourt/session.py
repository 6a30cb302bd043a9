"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_SHUFFLE_PARTITION_BYTES = 256 * 1024 * 1024


def shuffle_partitions(shuffle_bytes: int) -> int:
    """Partitions for the largest shuffle of a job, at about 256 MB each.

    Adaptive execution merges partitions that turn out small, but it only splits
    those of skewed joins, so the number has to be set for the largest shuffle.
    """
    return max(200, -(-shuffle_bytes // _SHUFFLE_PARTITION_BYTES))


def build_session(app_name: str = "forecourt", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library's results rely on (ANSI, UTC, AQE).

    Further settings are keywords with ``__`` for the dots.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    A machine-local folder is only ever used by a local session that names none.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(root)
        return root.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", root)
    context.setCheckpointDir(root)
    return root


def _own_folder(spark: SparkSession) -> str:
    """The part of the shared folder that belongs to this application."""
    return f"{scratch_root(spark)}/forecourt/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{_own_folder(spark)}/{uuid.uuid4().hex}/{name}"


def release_scratch(spark: SparkSession) -> None:
    """Drop the databases and delete the files that this application has put in the shared folder.

    Results are lazy and read these files, so call it when they are no longer needed: at the end of a job.
    """
    folder = _own_folder(spark)
    for database in spark.catalog.listDatabases():
        if f"/forecourt/{spark.sparkContext.applicationId}/" in (database.locationUri or ""):
            spark.sql(f"DROP DATABASE IF EXISTS `{database.name}` CASCADE")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where a result feeds many later jobs: it cuts the lineage, and an
    executor that is lost takes no finished work with it.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
