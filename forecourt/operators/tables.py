"""Tables, views and namespaces of the bronze, silver and gold layers."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.operators.shape import fit_columns
from forecourt.schemas import columns_of

LAYER_COMMENTS = {
    "bronze": "Raw listings as they arrived",
    "silver": "Cleaned, typed and tagged listings",
    "gold": "Aggregates and model output for reports",
}


@dataclass(frozen=True)
class Layers:
    bronze: str
    silver: str
    gold: str


def create_layers(spark: SparkSession, root: str, prefix: str = "") -> Layers:
    """Create the three namespaces, if absent, with their tables below ``root``."""
    names = {layer: f"{prefix}{layer}" for layer in LAYER_COMMENTS}
    for layer, comment in LAYER_COMMENTS.items():
        spark.sql(
            f"CREATE DATABASE IF NOT EXISTS `{names[layer]}` "
            f"COMMENT '{comment}' LOCATION '{root}/{names[layer]}'"
        )
    return Layers(**names)


def create_if_absent(
    spark: SparkSession,
    table: str,
    ddl: str,
    defaults: dict[str, str] | None = None,
    partition_by: Sequence[str] = (),
) -> None:
    columns = [
        f"`{name}` {type_name}" + (f" DEFAULT {defaults[name]}" if defaults and name in defaults else "")
        for name, type_name in columns_of(ddl).items()
    ]
    layout = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(columns)}) USING parquet{layout}")


def add_missing_columns(spark: SparkSession, table: str, ddl: str) -> list[str]:
    """Add the columns the table lacks; returns their names."""
    have = {name.lower() for name in spark.table(table).columns}
    missing = {name: kind for name, kind in columns_of(ddl).items() if name.lower() not in have}
    if missing:
        added = ", ".join(f"`{name}` {kind}" for name, kind in missing.items())
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({added})")
    return list(missing)


def insert_columns(df: DataFrame, table: str) -> None:
    """Append into the columns ``df`` has; the others take their default, or NULL."""
    names = ", ".join(f"`{name}`" for name in df.columns)
    df.sparkSession.sql(f"INSERT INTO {table} ({names}) SELECT {names} FROM {{rows}}", rows=df)


_OVERWRITE = "spark.sql.sources.partitionOverwriteMode"


def replace_partitions(df: DataFrame, table: str) -> None:
    """Make the rows the whole content of every partition that they fall in; others stay."""
    spark = df.sparkSession
    mode = spark.conf.get(_OVERWRITE)
    spark.conf.set(_OVERWRITE, "dynamic")
    try:
        df.select(*spark.table(table).columns).write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(_OVERWRITE, mode)


_CATALOG_PARTITIONS = "spark.sql.hive.manageFilesourcePartitions"
_VERSIONS = "__versions"


def _layout(spark: SparkSession, table: str) -> tuple[dict[str, str], list[str], dict[str, str]]:
    """Columns with types, partition columns, and the description of a table."""
    columns = {field.name: field.dataType.simpleString() for field in spark.table(table).schema}
    parts = [column.name for column in spark.catalog.listColumns(table) if column.isPartition]
    return columns, parts, {row.col_name: row.data_type for row in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}


def _new_version(spark: SparkSession, table: str) -> str:
    """A folder for the next version of a table; names sort by time."""
    database, _, name = table.replace("`", "").rpartition(".")
    root = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
    return f"{root}/{name}{_VERSIONS}/{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def _drop_old_versions(spark: SparkSession, current: str, before: str | None) -> None:
    """Delete the versions older than the one before the current; a reader may still be at that one."""
    if not before or f"{_VERSIONS}/" not in before:
        return
    path = spark._jvm.org.apache.hadoop.fs.Path
    folder = path(current).getParent()
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for entry in files.listStatus(folder):
        if entry.getPath().getName() < before.rstrip("/").rpartition("/")[2]:
            files.delete(entry.getPath(), True)


def _swap_in(rows: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
    """Write the rows as a new version of the table, then point the table to it.

    Until the version is complete the table shows the old rows, and a job that fails leaves them. The switch is
    one change of the catalog, as the table's partitions are found by their folders. Only a change of the columns
    takes two, the table being described anew. One old version is kept.
    """
    spark = rows.sparkSession
    version = _new_version(spark, table)
    rows = rows.select(*[name for name in rows.columns if name not in partition_by], *partition_by)
    laid = rows.hint("rebalance", *partition_by) if partition_by else rows
    writer = laid.write.partitionBy(*partition_by) if partition_by else laid.write
    writer.parquet(version)
    columns = {field.name: field.dataType.simpleString() for field in rows.schema}
    before = None
    if spark.catalog.tableExists(table):
        have, parts, about = _layout(spark, table)
        before = about.get("Location")
        if (have, parts) == (columns, list(partition_by)) and about.get("Partition Provider") != "Catalog":
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{version}'")
            spark.catalog.refreshTable(table)
            _drop_old_versions(spark, version, before)
            return
        spark.sql(f"DROP TABLE {table}")
    layout = f" PARTITIONED BY ({', '.join(f'`{name}`' for name in partition_by)})" if partition_by else ""
    listed = ", ".join(f"`{name}` {kind}" for name, kind in columns.items())
    managed = spark.conf.get(_CATALOG_PARTITIONS)
    spark.conf.set(_CATALOG_PARTITIONS, "false")
    try:
        spark.sql(f"CREATE TABLE {table} ({listed}) USING parquet{layout} LOCATION '{version}'")
    finally:
        spark.conf.set(_CATALOG_PARTITIONS, managed)
    _drop_old_versions(spark, version, before)


def replace_rows(df: DataFrame, table: str) -> None:
    """Replace all rows, keep the table and its schema; the old rows show until the new ones are complete."""
    columns, parts, _ = _layout(df.sparkSession, table)
    _swap_in(fit_columns(df, columns), table, parts)


def table_materialize(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Full rebuild of a table; the old rows show until the new ones are complete.

    With partition columns the rows are rebalanced on them first. That gives
    each folder files of a good size, and splits a folder that holds most rows.
    """
    _swap_in(df, table, partition_by)
    return df.sparkSession.table(table).select(*df.columns)


def view_materialize(df: DataFrame, name: str) -> DataFrame:
    """A view that is computed again on each read."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def bronze_append(rows: DataFrame, table: str) -> None:
    """Append listings with an explicit column list; the table stamps the load time."""
    insert_columns(rows, table)


def read_or_empty(spark: SparkSession, table: str, ddl: str) -> DataFrame:
    """The table, or an empty frame with its schema if it does not exist."""
    if spark.catalog.tableExists(table):
        return spark.table(table)
    return spark.createDataFrame([], ddl)


def layer_inventory(spark: SparkSession, layers: Layers) -> DataFrame:
    """Namespace, comment, table and row count of every table in the layers."""
    counts = None
    for layer in LAYER_COMMENTS:
        database = getattr(layers, layer)
        comment = spark.catalog.getDatabase(database).description
        for table in spark.catalog.listTables(database):
            if table.isTemporary:
                continue
            one = spark.table(f"`{database}`.`{table.name}`").agg(F.count("*").alias("row_count"))
            one = one.select(
                F.lit(layer).alias("layer"),
                F.lit(comment).alias("layer_comment"),
                F.lit(table.name).alias("table_name"),
                "row_count",
            )
            counts = one if counts is None else counts.unionByName(one)
    if counts is None:
        return spark.createDataFrame(
            [], "layer string, layer_comment string, table_name string, row_count bigint"
        )
    return counts
