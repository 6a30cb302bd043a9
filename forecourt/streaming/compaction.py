"""Small files of a streamed folder, rewritten into large ones under a commit log.

``<folder>.compacted`` holds a folder per compaction with the rewritten rows, the list of files that are now
read (``live``) and the list of stream files that they replace (``replaced``). A compaction counts from the moment
its number appears in ``commits``, which is one step, so a reader sees a row in a small file or in a large one,
never in both or neither, and a compaction that fails changes nothing. The stream goes on meanwhile: what it
commits behind the fence is read from its own files until the next compaction.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.sources.csv_listings import literal_path
from forecourt.streaming import commit_log as log

FILE_BYTES = 128 * 1024 * 1024
_LISTING = "path string, size long"


def _last(spark: SparkSession, folder: str) -> tuple[int, str | None]:
    """Number and folder of the compaction that counts."""
    numbers = [int(name) for name in log.names_in(spark, f"{folder}.compacted/commits") if name.isdigit()]
    if not numbers:
        return 0, None
    return max(numbers), f"{folder}.compacted/{log.read_text(spark, f'{folder}.compacted/commits/{max(numbers)}').strip()}"


def _listing(spark: SparkSession, version: str | None, name: str) -> DataFrame:
    return spark.read.schema(_LISTING).parquet(f"{version}/{name}") if version else spark.createDataFrame([], _LISTING)


def _read(spark: SparkSession, schema, files: DataFrame) -> DataFrame:
    paths = [literal_path(path) for path in log.plain_paths(files)]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _files_now(spark: SparkSession, folder: str, version: str | None) -> tuple[DataFrame, DataFrame]:
    """Large files that are read, and stream files that none of them replaces."""
    streamed = log.logged_files(spark, f"{folder}/{log.SINK_LOG}")
    return _listing(spark, version, "live"), streamed.join(_listing(spark, version, "replaced"), "path", "left_anti")


def streamed_rows(spark: SparkSession, folder: str, schema) -> DataFrame:
    """All rows that a stream has committed to a folder, whether compacted or not."""
    _, version = _last(spark, folder)
    if version is None:
        return spark.read.schema(schema).parquet(folder)
    live, rest = _files_now(spark, folder, version)
    return _read(spark, schema, live.unionByName(rest))


def compact(spark: SparkSession, folder: str, schema, file_bytes: int = FILE_BYTES) -> int:
    """Rewrite the files below ``file_bytes`` into files of about that size; returns how many were rewritten.

    Large files stay as they are, so a byte is rewritten only while its file is small. Of compactions that run
    at once, one takes effect and the others fail.
    """
    number, version = _last(spark, folder)
    live, rest = _files_now(spark, folder, version)
    small = live.where(F.col("size") < file_bytes).unionByName(rest)
    count, size = small.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    if count < 2:
        return 0
    name = uuid.uuid4().hex
    new = f"{folder}.compacted/{name}"
    _read(spark, schema, small).repartition(-(-size // file_bytes)).write.parquet(f"{new}/data")
    written = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(f"{new}/data")
    written = written.select(F.col("_metadata.file_path").alias("path"), F.col("length").alias("size"))
    live.where(F.col("size") >= file_bytes).unionByName(written).write.parquet(f"{new}/live")
    _listing(spark, version, "replaced").unionByName(rest).write.parquet(f"{new}/replaced")
    log.write_new(spark, f"{folder}.compacted/commits/{number + 1}", name)
    return count


def drop_replaced(spark: SparkSession, folder: str) -> int:
    """Delete stream files that a compaction before the last has replaced, when no reader can be at them any more.

    From then on the folder must be read through ``streamed_rows``: the stream's own log still names the files.
    """
    number, _ = _last(spark, folder)
    if number < 2:
        return 0
    earlier = log.read_text(spark, f"{folder}.compacted/commits/{number - 1}").strip()
    gone = log.plain_paths(_listing(spark, f"{folder}.compacted/{earlier}", "replaced"))
    for path in gone:
        log.delete(spark, path)
    return len(gone)
