"""The listings relation that the registered queries read, derived from the given tables.

The column expressions are the same text for Spark and for the SQL check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

LISTING_EXPRESSIONS = {
    "id": "l_orderkey*10 + l_linenumber",
    "brand": "upper(p_brand)",
    "model": "p_type",
    "title": "p_brand || ' ' || p_name || ' ' || p_type",
    "year": "CAST(1998 + (l_partkey*7 + l_suppkey*3 + l_linenumber*5) % 27 AS INT)",
    "price": "CAST(floor(l_extendedprice) AS BIGINT)",
    "mileage": (
        "CAST(CASE WHEN l_suppkey % 11 = 0 THEN 0 WHEN l_partkey % 13 = 0 THEN NULL "
        "ELSE l_quantity*2000 END AS BIGINT)"
    ),
    "fuel_type": (
        "CASE l_orderkey % 8 WHEN 0 THEN 'Petrol' WHEN 1 THEN 'Petrol' WHEN 2 THEN 'Diesel' "
        "WHEN 3 THEN 'Diesel' WHEN 4 THEN 'Hybrid' WHEN 5 THEN 'Electric' "
        "WHEN 6 THEN 'Other' ELSE 'Unknown' END"
    ),
    "transmission": "CASE WHEN l_returnflag = 'A' THEN 'Automatic' ELSE 'Manual' END",
    "engine_size": "CAST(10 + p_size % 30 AS DOUBLE) / 10",
    "tax": "CAST(l_linenumber*20 AS INT)",
    "mpg": "CAST(p_size AS DOUBLE)",
    "price_text": (
        "CASE WHEN l_suppkey % 17 = 0 THEN 'None' "
        "WHEN l_suppkey % 3 = 0 THEN '£' || CAST(CAST(floor(l_extendedprice/1000) AS BIGINT) AS VARCHAR(20)) "
        "|| ',' || lpad(CAST(CAST(floor(l_extendedprice) AS BIGINT) % 1000 AS VARCHAR(20)), 3, '0') "
        "ELSE CAST(CAST(floor(l_extendedprice) AS BIGINT) AS VARCHAR(20)) END"
    ),
    "change_action": "CASE WHEN l_linestatus = 'O' THEN 'INSERT' ELSE 'DELETE' END",
    "search_timestamp": "l_shipdate",
}

LISTINGS_SQL = (
    "SELECT "
    + ", ".join(f"{expression} AS {name}" for name, expression in LISTING_EXPRESSIONS.items())
    + " FROM lineitem JOIN part ON l_partkey = p_partkey"
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shape_listings(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Listings from a line-item frame, batch or stream, and the part table."""
    return lineitem.join(part, lineitem["l_partkey"] == part["p_partkey"]).selectExpr(
        *[f"{expression} AS {name}" for name, expression in LISTING_EXPRESSIONS.items()]
    )


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape_listings(read_table(spark, sf_dir, "lineitem"), read_table(spark, sf_dir, "part"))
