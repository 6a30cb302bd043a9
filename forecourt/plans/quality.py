"""Row counts that tell whether the tables are usable."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.operators.shape import all_known
from forecourt.operators.tables import read_or_empty
from forecourt.schemas import CLUSTER_MART


def row_counts(facts: DataFrame) -> DataFrame:
    """All rows and the rows a model can use, in one pass."""
    usable = all_known(["price", "mileage", "year"])
    return facts.agg(F.count("*").alias("total"), F.count_if(usable).alias("valid"))


def cluster_distribution(mart: DataFrame) -> DataFrame:
    """Rows per cluster name, largest first; rows without a name are left out."""
    return (
        mart.where(F.col("cluster_name").isNotNull())
        .groupBy("cluster_name")
        .agg(F.count("*").alias("listings"))
        .orderBy(F.col("listings").desc(), "cluster_name")
    )


def quality_counts(spark: SparkSession, facts: DataFrame, mart_table: str) -> DataFrame:
    """Fact counts and cluster sizes as one report; a missing cluster mart adds no rows."""
    counts = row_counts(facts).unpivot([], ["total", "valid"], "measure", "row_count")
    clusters = cluster_distribution(read_or_empty(spark, mart_table, CLUSTER_MART)).select(
        F.concat(F.lit("cluster: "), "cluster_name").alias("measure"),
        F.col("listings").alias("row_count"),
    )
    return counts.unionByName(clusters)
