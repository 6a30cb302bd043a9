"""Operators that work per key: deduplication, backfill, first rows of a group.

A key may hold a third of all rows. The row_number filters below are planned
with a group limit in front of the shuffle, so each map task sends at most the
wanted rows per key. The backfill's two shuffles are plain join shuffles, which
adaptive execution can split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], rows: int = 1) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(window)).where(F.col("_n") <= rows).drop("_n")


def newest_per_key(listings: DataFrame, key: str, newest: str) -> DataFrame:
    """Newest row per known key; ties go to the smallest remaining columns, in column order."""
    ties = [F.col(name).asc_nulls_last() for name in listings.columns if name not in (key, newest)]
    known = listings.where(F.col(key).isNotNull())
    return first_per_key(known, [key], [F.col(newest).desc_nulls_last(), *ties])


def listing_dedup(listings: DataFrame, key: str = "id", newest: str = "search_timestamp") -> DataFrame:
    """Newest listing per advert.

    An unknown advert is not the same as another unknown one, so rows without a key all pass.
    """
    return newest_per_key(listings, key, newest).unionByName(listings.where(F.col(key).isNull()))


def distinct_keys(df: DataFrame, key: str, alias: str) -> DataFrame:
    """The distinct non-NULL values of ``key``, laid out for a join that may be skewed.

    The grouping key carries a hash of the value next to the value. The groups
    are the same, but the join then has to shuffle the (small) distinct values
    once more. Adaptive execution only splits the skewed side of a join if both
    sides come straight from a join shuffle.
    """
    layout = F.xxhash64(key)
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias(alias), layout.alias("_layout"))
        .agg(F.lit(1).alias("_one"))
        .select(alias)
    )


def backfill_anti_join(raw: DataFrame, facts: DataFrame, raw_key: str = "title", fact_key: str = "model") -> DataFrame:
    """Raw rows whose key is not yet in the facts.

    A NULL key matches nothing, so its row passes; repeats inside ``raw`` all pass.
    """
    known = distinct_keys(facts.select(fact_key), fact_key, "_known")
    return raw.join(known, raw[raw_key] == F.col("_known"), "left_anti")


def net_changes(changes: DataFrame, key: str, order: str, action: str = "_action") -> DataFrame:
    """The changes of an increment as one step per key: at most a DELETE of the first image and an INSERT of the last.

    A key that was not there before (its first change is an INSERT) gives no DELETE, one that is gone afterwards
    no INSERT, so a row that came and went gives nothing; both together are an update. Of changes with one order
    number DELETE comes first, then the smallest remaining columns. Changes without a key stay as they are.

    One aggregation with a partial one in front: a hot key is one row per map task.
    """
    others = [name for name in changes.columns if name not in (order, action)]
    known = changes.where(F.col(key).isNotNull())
    image = F.struct(order, action, *others)
    folded = known.groupBy(F.col(key).alias("_key")).agg(F.min(image).alias("_first"), F.max(image).alias("_last"))
    gone = F.when(F.col(f"_first.{action}") == "DELETE", F.col("_first"))
    come = F.when(F.col(f"_last.{action}") == "INSERT", F.col("_last"))
    rows = folded.select(F.explode(F.filter(F.array(gone, come), lambda row: row.isNotNull())).alias("_row"))
    return rows.select("_row.*").select(*changes.columns).unionByName(changes.where(F.col(key).isNull()))
