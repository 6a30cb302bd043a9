"""Per-brand CSV files as typed listings, in batch and as a stream."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.functions.text import whole_number
from forecourt.schemas import CSV_LISTING, columns_of

_CORRUPT = "_corrupt"


def brand_from_filename(path: Column) -> Column:
    """Upper-case stem of ``<brand>.csv`` or ``<brand>.csv.gz``.

    A brand too large for one file may be a folder ``<brand>.csv`` of part
    files; its brand is the stem of the folder. Plain string functions, since
    this runs for every row and a pattern over the whole path is slow.
    """
    file = F.substring_index(path, "/", -1)
    folder = F.substring_index(F.substring_index(path, "/", -2), "/", 1)
    source = F.when(file.startswith("part-") & folder.endswith(".csv"), folder).otherwise(file)
    plain = F.when(source.endswith(".gz"), F.left(source, F.length(source) - 3)).otherwise(source)
    stem = F.left(plain, F.length(plain) - len(".csv"))
    return F.upper(F.url_decode(F.replace(stem, F.lit("+"), F.lit("%2B"))))


def _typed(text: Column, type_name: str) -> Column:
    if type_name == "string":
        return text
    return whole_number(text, type_name) if type_name == "int" else text.try_cast(type_name)


_FILES = "*.csv{,.gz}"


def load_id() -> Column:
    """A name for the content of the file that a row comes from: a digest of its path, time and length."""
    about = [F.col(f"_metadata.{name}") for name in ("file_path", "file_modification_time", "file_size")]
    return F.md5(F.concat_ws("|", about[0], F.unix_micros(about[1]), about[2]))


def csv_files(spark: SparkSession, path: str) -> DataFrame:
    """path, modified, length and load id of the CSV files below ``path``; their content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", _FILES)
    return files.load(path).select("path", F.col("modificationTime").alias("modified"), "length", load_id().alias("load"))


def literal_path(path: str) -> str:
    """The path with the characters escaped that a reader would take as a pattern."""
    return re.sub(r"([\\*?{}\[\]])", r"\\\1", path)


def read_csv_lines(
    spark: SparkSession, path: str | list[str], stream: bool = False, max_files_per_batch: int | None = None
) -> DataFrame:
    """Every line of every CSV file below ``path``: typed fields, brand and load id, ``rejected``, and ``line`` if it is.

    A row is rejected if it has too few or too many fields or a field that does not
    parse; an empty field is a NULL. Fields are read as text and cast one by
    one, with column pruning off for this read, so that which rows count as bad
    does not depend on the columns a query asks for.
    """
    types = columns_of(CSV_LISTING)
    reader = (
        (spark.readStream if stream else spark.read)
        .schema(", ".join(f"{name} string" for name in [*types, _CORRUPT]))
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .option("columnPruning", False)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv" if stream else _FILES)
    )
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    raw = reader.csv(path)
    bad = F.col(_CORRUPT).isNotNull()
    for name, type_name in types.items():
        if type_name != "string":
            bad = bad | (F.col(name).isNotNull() & _typed(F.col(name), type_name).isNull())
    line = F.coalesce(F.col(_CORRUPT), F.concat_ws(",", *[F.coalesce(F.col(name), F.lit("")) for name in types]))
    return raw.select(
        brand_from_filename(F.col("_metadata.file_path")).alias("brand"),
        *[_typed(F.col(name), type_name).alias(name) for name, type_name in types.items()],
        load_id().alias("load"),
        bad.alias("rejected"),
        F.when(bad, line).alias("line"),
    )


def read_csv_listings(
    spark: SparkSession, path: str | list[str], stream: bool = False, max_files_per_batch: int | None = None
) -> DataFrame:
    """The lines of ``read_csv_lines`` that are not rejected, as listings with the brand of their file."""
    lines = read_csv_lines(spark, path, stream, max_files_per_batch)
    return lines.where(~F.col("rejected")).select("brand", *columns_of(CSV_LISTING))
