"""Gold aggregates over the facts.

Every mart is one pass: a hash aggregate before and after a single shuffle on
its keys, so a hot key costs one partial row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecourt.functions.rules import percent_change
from forecourt.functions.text import percent_text, pounds
from forecourt.operators.shape import melt, present

# Report labels.
COMPLIANT_LABEL = "Compliant Average Price"
NON_COMPLIANT_LABEL = "Non-Compliant Average Price"
PERCENT_LABEL = "Devaluation (%)"
DROP_LABEL = "Price Drop (£)"


def conditional_avg_pair(value: Column, flag: Column) -> dict[str, Column]:
    """Average of ``value`` where the flag holds and where it does not."""
    return {
        "avg_price_compliant": F.avg(F.when(flag, value)),
        "avg_price_non_compliant": F.avg(F.when(~flag, value)),
    }


def _price_pair() -> list[Column]:
    pair = conditional_avg_pair(F.col("price"), F.col("is_ulez_compliant"))
    return [column.alias(name) for name, column in pair.items()]


def having_both_classes(grouped_counts: DataFrame) -> DataFrame:
    """Groups with at least one compliant and one non-compliant row."""
    return grouped_counts.where((F.col("n_compliant") >= 1) & (F.col("n_non_compliant") >= 1))


def class_counts() -> list[Column]:
    flag = F.col("is_ulez_compliant")
    return [F.count_if(flag).alias("n_compliant"), F.count_if(~flag).alias("n_non_compliant")]


def price_efficiency(avg_price: Column, avg_age: Column) -> Column:
    """Ratio of the already rounded averages."""
    return avg_price / F.nullif(avg_age, F.lit(0.0))


def impact_summary(facts: DataFrame) -> DataFrame:
    """Listing count and rounded averages by brand, year, fuel and compliance."""
    summary = facts.groupBy("brand", "year", "fuel_type", "is_ulez_compliant").agg(
        F.count("*").alias("total_listings"),
        F.round(F.avg("price"), 2).alias("avg_price"),
        F.round(F.avg("mileage"), 2).alias("avg_mileage"),
        F.round(F.avg("vehicle_age"), 1).alias("avg_age"),
    )
    return summary.withColumn("price_efficiency", price_efficiency(F.col("avg_price"), F.col("avg_age")))


def diesel_devaluation(facts: DataFrame, fuel: str = "Diesel", with_totals: bool = False) -> DataFrame:
    """Per brand and model with both classes: rounded averages, drop and percent drop."""
    stats = having_both_classes(
        facts.where(F.col("fuel_type") == fuel)
        .groupBy("brand", "model")
        .agg(*_price_pair(), F.count("*").alias("total_listings"), *class_counts())
    )
    compliant, non_compliant = F.col("avg_price_compliant"), F.col("avg_price_non_compliant")
    totals = ["total_listings"] if with_totals else []
    return stats.select(
        "brand",
        "model",
        *totals,
        F.round(compliant, 0).alias("avg_price_compliant"),
        F.round(non_compliant, 0).alias("avg_price_non_compliant"),
        F.round(compliant - non_compliant, 0).alias("devaluation_amount"),
        percent_change(non_compliant, compliant).alias("devaluation_percent"),
    )


def _by_devaluation() -> list[Column]:
    return [F.col("devaluation_percent").asc_nulls_last(), F.col("brand"), F.col("model")]


def top_k_devaluation(devaluation: DataFrame, k: int = 10) -> DataFrame:
    """The k largest drops; ties by brand and model."""
    return devaluation.orderBy(*_by_devaluation()).limit(k)


def diesel_devaluation_top(facts: DataFrame, k: int = 10) -> DataFrame:
    return top_k_devaluation(diesel_devaluation(facts), k)


def devaluation_rank(top: DataFrame) -> DataFrame:
    """Number the rows of a top-k report from 1. The input is k rows, so one task is enough."""
    position = F.row_number().over(Window.orderBy(*_by_devaluation()))
    return top.select(position.alias("rank"), *top.columns)


def brand_price_gap(facts: DataFrame) -> DataFrame:
    """Per brand: both averages and their percent difference, NULL if a class is missing."""
    gap = facts.groupBy("brand").agg(*_price_pair())
    return gap.withColumn(
        "percent_diff", percent_change(F.col("avg_price_non_compliant"), F.col("avg_price_compliant"))
    )


def sort_by_gap(gap: DataFrame) -> DataFrame:
    return gap.select("brand", "percent_diff").orderBy(F.col("percent_diff").asc_nulls_last(), "brand")


def melt_price_gap(gap: DataFrame) -> DataFrame:
    """The two price columns as labelled rows, for a grouped bar chart."""
    labels = {"avg_price_compliant": COMPLIANT_LABEL, "avg_price_non_compliant": NON_COMPLIANT_LABEL}
    return melt(gap, ["brand"], labels, "category", "avg_price")


def present_devaluation(top: DataFrame) -> DataFrame:
    """The ranking under report labels, with prices and percents as text."""
    return present(
        top,
        {
            "avg_price_compliant": COMPLIANT_LABEL,
            "avg_price_non_compliant": NON_COMPLIANT_LABEL,
            "devaluation_percent": PERCENT_LABEL,
            "devaluation_amount": DROP_LABEL,
        },
        {
            "avg_price_compliant": pounds(F.col("avg_price_compliant")),
            "avg_price_non_compliant": pounds(F.col("avg_price_non_compliant")),
            "devaluation_percent": percent_text(F.col("devaluation_percent")),
        },
    )
