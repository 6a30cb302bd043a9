"""The logs that Spark keeps for file streams: which files a source has taken and a sink has committed.

A log is a folder with a file per number, and now and then a ``<number>.compact`` with everything up to it.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SINK_LOG = "_spark_metadata"
_ENTRY = "path string, size long, action string"


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the files in a folder; none if there is no folder."""
    folder, files = _folder(spark, path)
    return [entry.getPath().getName() for entry in files.listStatus(folder)] if files.exists(folder) else []


def _numbers(names: list[str]) -> list[int]:
    return sorted(int(name) for name in names if name.isdigit())


def last_committed(spark: SparkSession, checkpoint: str) -> int | None:
    """The number of the last micro-batch that the stream has finished, sink included."""
    return max(_numbers(names_in(spark, f"{checkpoint}/commits")), default=None)


def source_number(spark: SparkSession, checkpoint: str, batch: int, source: int = 0) -> int:
    """The number in a file source's log up to which a micro-batch has read; -1 if it has read nothing."""
    lines = [row.value for row in spark.read.text(f"{checkpoint}/offsets/{batch}", wholetext=True).collect()]
    offset = lines[0].split("\n")[2 + source]  # a version, the batch's settings, then a line per source
    return -1 if offset == "-" else int(json.loads(offset)["logOffset"])


def logged_files(spark: SparkSession, log: str, upto: int | None = None) -> DataFrame:
    """path and size (sinks only) of the files that a log holds, up to a number."""
    names = names_in(spark, log)
    known = [n for n in _numbers(names) if upto is None or n <= upto]
    compacts = _numbers([name.removesuffix(".compact") for name in names if name.endswith(".compact")])
    start = max((n for n in compacts if upto is None or n <= upto), default=None)
    files = [f"{log}/{n}" for n in known if start is None or n > start]
    files += [] if start is None else [f"{log}/{start}.compact"]
    if not files:
        return spark.createDataFrame([], "path string, size long")
    # The text reader takes a sink's log for hidden files; as an RDD its lines stay distributed all the same.
    lines = spark.createDataFrame(spark.sparkContext.textFile(",".join(files)).map(lambda line: (line,)), "value string")
    entries = lines.where(F.col("value").startswith("{")).select(F.from_json("value", _ENTRY).alias("entry")).select("entry.*")
    deleted = entries.where(F.col("action") == "delete").select("path")
    return entries.join(deleted, "path", "left_anti").select("path", "size").distinct()


def plain_paths(files: DataFrame) -> list[str]:
    """The paths as a reader takes them; logs hold them URL-encoded."""
    decoded = F.url_decode(F.replace(F.col("path"), F.lit("+"), F.lit("%2B")))
    return [row[0] for row in files.select(decoded).toLocalIterator()]


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file in one step; fails if it is there already."""
    target, files = _folder(spark, path)
    files.mkdirs(target.getParent())
    stream = files.create(target, False)
    stream.write(bytearray(text.encode()))
    stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first().value


def delete(spark: SparkSession, path: str) -> None:
    target, files = _folder(spark, path)
    files.delete(target, True)
