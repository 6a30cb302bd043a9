"""Bronze listings to the fact table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.functions import rules, text
from forecourt.operators.shape import union_listings

STAGING_COLUMNS = [
    "brand", "model", "year", "price", "transmission", "mileage", "fuel_type", "tax", "mpg", "engine_size",
]


def rename_constants(api: DataFrame) -> DataFrame:
    """Snake-case names; the feed has no tax and no mpg, so both are 0."""
    return api.withColumnsRenamed({"fuelType": "fuel_type", "engineSize": "engine_size"}).withColumns(
        {"tax": F.lit(0), "mpg": F.lit(0.0)}
    )


def title_as_model(df: DataFrame) -> DataFrame:
    """Model is the context's model where the feed has one, else the full title."""
    model = F.coalesce(F.col("model"), F.col("title")) if "model" in df.columns else F.col("title")
    return df.withColumn("model", model)


def stage_api(
    api: DataFrame, clean_price: Callable[[Column], Column] = text.price_clean_try
) -> DataFrame:
    """Staging view over the API feed: brand from the title, cleaned price.

    Prices are whole: whatever cleans them, a fraction is rounded half up.
    """
    price = F.round(clean_price(F.col("price"))).cast("bigint")
    staged = title_as_model(rename_constants(api)).withColumns(
        {"brand": text.brand_from_title(F.col("title")), "price": price}
    )
    return staged.select(*STAGING_COLUMNS)


def stage_csv(listings: DataFrame) -> DataFrame:
    """Staging view over the per-brand CSV listings."""
    renamed = listings.withColumnsRenamed({"fuelType": "fuel_type", "engineSize": "engine_size"})
    return renamed.withColumn("price", F.col("price").cast("bigint")).select(*STAGING_COLUMNS)


def unified_listings(csv_listings: DataFrame, api: DataFrame) -> DataFrame:
    """One relation over all brand files and the API feed."""
    return union_listings(stage_csv(csv_listings), stage_api(api))


def enrich(
    staged: DataFrame,
    per_mile: Callable[[Column, Column], Column] = rules.price_per_mile_zero,
    reference_year: int = rules.REFERENCE_YEAR,
) -> DataFrame:
    """The fact rows: staging plus compliance, age and price per mile.

    Used unchanged on batch frames and on streams.
    """
    return staged.withColumns(
        {
            "is_ulez_compliant": rules.ulez_compliance(F.col("fuel_type"), F.col("year")),
            "vehicle_age": rules.vehicle_age(F.col("year"), reference_year),
            "price_per_mile": per_mile(F.col("price"), F.col("mileage")),
        }
    )


def brand_literal(listings: DataFrame, brand: str) -> DataFrame:
    """Staging view over a feed that carries one brand only, named by a constant."""
    return stage_csv(listings.withColumn("brand", F.lit(brand)))


def brand_feed_facts(inserts: DataFrame, brand: str) -> DataFrame:
    return enrich(brand_literal(inserts, brand), rules.price_per_mile_null)


def api_feed_facts(inserts: DataFrame) -> DataFrame:
    """Facts of the API feed: cleaned text price, title as model, no tax and mpg."""
    staged = title_as_model(
        inserts.withColumnsRenamed({"fuelType": "fuel_type", "engineSize": "engine_size"})
    ).withColumn("price", text.price_clean_try(F.col("price")))
    columns = [name for name in STAGING_COLUMNS if name not in ("tax", "mpg")]
    return enrich(staged.select(*columns), rules.price_per_mile_null)
