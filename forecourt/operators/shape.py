"""Column selection, renaming, union and reshaping."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def recase_columns(df: DataFrame, upper: bool = False) -> DataFrame:
    return df.toDF(*[name.upper() if upper else name.lower() for name in df.columns])


def dimension_filter(
    df: DataFrame, brands: Sequence[str] | None = None, fuels: Sequence[str] | None = None
) -> DataFrame:
    """Keep the chosen brands and fuels; None means all."""
    for name, chosen in (("brand", brands), ("fuel_type", fuels)):
        if chosen is not None:
            df = df.where(F.col(name).isin(*chosen))
    return df


def all_known(columns: Sequence[str]) -> Column:
    """True where no column is NULL; unlike dropna, the scan can use each part."""
    return reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in columns])


def filter_complete(df: DataFrame, columns: Sequence[str] = ("price", "mileage", "year")) -> DataFrame:
    return df.where(all_known(columns))


def filter_inserts(changes: DataFrame) -> DataFrame:
    """Insert rows of a change log, without the action column."""
    return changes.where(F.col("_action") == "INSERT").drop("_action")


def union_listings(first: DataFrame, *others: DataFrame) -> DataFrame:
    """UNION ALL by name; a column one side lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), others, first)


def fit_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Exactly the given columns in order and type; those ``df`` lacks become NULL."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(name) if name in have else F.lit(None)).cast(type_name).alias(name)
            for name, type_name in types.items()
        ]
    )


def melt(df: DataFrame, ids: Sequence[str], labels: dict[str, str], category: str, value: str) -> DataFrame:
    """One row per value column, under its report label; NULL values are kept."""
    long = df.unpivot(list(ids), list(labels), "_column", value)
    label = F.coalesce(*[F.when(F.col("_column") == name, F.lit(text)) for name, text in labels.items()])
    return long.select(*ids, label.alias(category), value)


def present(df: DataFrame, labels: dict[str, str], formats: dict[str, Column] | None = None) -> DataFrame:
    """Format the given columns as text, then rename to report labels."""
    return df.withColumns(formats or {}).withColumnsRenamed(labels)
