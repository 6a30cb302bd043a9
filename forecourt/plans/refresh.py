"""One-shot jobs that load or rebuild tables of the layers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.operators.keyed import backfill_anti_join
from forecourt.operators.shape import fit_columns
from forecourt.operators.tables import (
    Layers,
    bronze_append,
    create_if_absent,
    insert_columns,
    replace_partitions,
    table_materialize,
    view_materialize,
)
from forecourt.plans.facts import api_feed_facts, enrich
from forecourt.plans.marts import diesel_devaluation_top, impact_summary
from forecourt.plans.quality import cluster_distribution
from forecourt.plans.segments import cluster_mart
from forecourt.schemas import API_LISTING, CSV_LISTING, FACT, columns_of
from forecourt.sources.api_responses import bronze_rows, fetch_listings
from forecourt.session import stage
from forecourt.sources.csv_listings import csv_files, literal_path, read_csv_lines
from forecourt.streaming.change_feed import all_facts
from forecourt.streaming.commit_log import SINK_LOG, last_committed, logged_files, plain_paths, source_number


_LOAD_PARTS = ("rejected", "brand", "load")


def load_csv(spark: SparkSession, path: str, table: str) -> None:
    """Load the CSV files below ``path`` that the table has not loaded yet, each exactly once.

    A file's lines become partitions of their own, named by a digest of its path, time and length, and replace
    what such a partition held. ``<table>_loads`` lists the loaded files afterwards. So a job that fails anywhere
    can be run again: files that are not listed are loaded once more, over their own partitions. A file that has
    changed since counts as new. Lines that do not parse are kept apart, as text, in the same pass.
    """
    create_if_absent(spark, table, f"{CSV_LISTING}, line string, rejected boolean, brand string, load string", partition_by=_LOAD_PARTS)
    create_if_absent(spark, f"{table}_loads", "path string, modified timestamp, length bigint, load string")
    known = spark.table(f"{table}_loads").select("load")
    new = stage(csv_files(spark, path).join(known, "load", "left_anti"), "new_files")
    paths = [row.path for row in new.select("path").toLocalIterator()]
    if paths:
        lines = read_csv_lines(spark, [literal_path(name) for name in paths])
        replace_partitions(lines.hint("rebalance", *_LOAD_PARTS), table)
        insert_columns(new, f"{table}_loads")


def loaded_csv(spark: SparkSession, table: str) -> DataFrame:
    """The listings that ``load_csv`` has loaded."""
    return spark.table(table).where(~F.col("rejected")).select("brand", *columns_of(CSV_LISTING))


def load_report(spark: SparkSession, table: str) -> DataFrame:
    """Lines loaded and rejected per brand and file; counted from the partitions' row counts alone."""
    files = spark.table(f"{table}_loads").select("load", "path").distinct()
    counts = spark.table(table).groupBy("brand", "load").agg(
        F.count_if(~F.col("rejected")).alias("loaded"), F.count_if("rejected").alias("rejected")
    )
    return counts.join(files, "load", "left").select("brand", "path", "loaded", "rejected")


def ingest_responses(responses: DataFrame, table: str) -> None:
    """Append the listings of all answered requests to the bronze API table."""
    defaults = {"search_timestamp": "current_timestamp()"}
    create_if_absent(responses.sparkSession, table, API_LISTING, defaults)
    bronze_append(bronze_rows(fetch_listings(responses)), table)


def build_layers(
    spark: SparkSession, staged: DataFrame, layers: Layers, top_view: str, stream_path: str | None = None
) -> None:
    """Staging view to fact table, impact mart and the devaluation view; the marts include streamed facts."""
    rows = fit_columns(enrich(staged), columns_of(FACT))
    table_materialize(rows, f"{layers.silver}.fct_cars", partition_by=["brand"])
    facts = all_facts(spark, f"{layers.silver}.fct_cars", stream_path)
    table_materialize(impact_summary(facts), f"{layers.gold}.mart_ulez_impact")
    view_materialize(diesel_devaluation_top(facts), top_view)


def stream_backfill(raw: DataFrame, fact_table: str, stream_path: str | None = None) -> None:
    """Load the raw rows that are in neither the loaded nor the streamed facts yet."""
    _add_missing(raw, all_facts(raw.sparkSession, fact_table, stream_path), fact_table)


def _add_missing(raw: DataFrame, facts: DataFrame, fact_table: str) -> None:
    types = {k: v for k, v in columns_of(FACT).items() if k not in ("tax", "mpg")}
    insert_columns(fit_columns(api_feed_facts(backfill_anti_join(raw, facts)), types), fact_table)


def fenced_backfill(spark: SparkSession, changes_schema: str, fact_table: str, stream_path: str, checkpoint: str) -> int | None:
    """Load what the stream has passed by, up to a fence, while the stream may go on; returns the fence.

    The fence is the last micro-batch that the stream's checkpoint shows as finished. Raw rows are those of the
    change-log files that its source had taken by then, whatever their action; facts are the loaded ones and
    those that its sink had committed by then. What arrives later is the stream's, or the next backfill's, so
    the result does not depend on how far the stream gets meanwhile.
    """
    fence = last_committed(spark, checkpoint)
    if fence is None:
        return None
    taken = logged_files(spark, f"{checkpoint}/sources/0", source_number(spark, checkpoint, fence))
    raw = spark.read.schema(changes_schema).parquet(*[literal_path(path) for path in plain_paths(taken)]).drop("_action")
    committed = plain_paths(logged_files(spark, f"{stream_path}/{SINK_LOG}", fence))
    loaded = spark.table(fact_table).select(*columns_of(FACT))
    streamed = [spark.read.schema(FACT).parquet(*map(literal_path, committed))] if committed else []
    _add_missing(raw, reduce(DataFrame.unionByName, streamed, loaded), fact_table)
    return fence


def daily_refresh(spark: SparkSession, facts: DataFrame, layers: Layers, **options) -> DataFrame | None:
    """Rebuild the cluster mart; returns its segment sizes, or None without usable rows."""
    mart = cluster_mart(spark, facts, f"{layers.gold}.mart_market_clusters", **options)
    return None if mart is None else cluster_distribution(mart)
