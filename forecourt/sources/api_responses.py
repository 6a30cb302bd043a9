"""Stored listing-search responses as one row per listing.

A response row holds the request's ``make``, ``fuel_filter`` and ``page``, the
``status_code`` and the JSON ``body``. All requests are one DataFrame, so
gathering makes, fuels and pages is a plain scan with no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.functions import text
from forecourt.schemas import API_ADVERT, API_REQUEST, api_response

LISTING_COLUMNS = ["id", "title", "price", "year", "mileage", "fuelType", "engineSize", "transmission"]


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """Responses stored as JSON lines with the request columns."""
    return spark.read.schema(API_REQUEST).json(path)


def answered(responses: DataFrame) -> DataFrame:
    """Responses with status 200; any other status stands for no listings."""
    return responses.where(F.col("status_code") == 200)


def _listings(advert: dict[str, str]) -> Column:
    """The document's listings with the fields of ``advert``.

    A text without a closing bracket holds no array: a parse that fails costs more than one that does not.
    """
    document = F.when(F.contains("body", F.lit("]")), F.from_json("body", api_response(advert)))
    return F.try_element_at(document, F.lit(1))["data"]["searchResults"]["listings"]


def with_listings(responses: DataFrame, *fields: str) -> DataFrame:
    """Add the array of listings; NULL where the document is broken or lacks it.

    ``fields`` are the listing fields that are wanted, all if none is named.
    The others are read over, as converting the nested ones is most of the
    cost; of a tracking context not named only its presence is kept.
    """
    listings = _listings(API_ADVERT)
    if fields:
        wanted = {"trackingContext": "struct<>"} | {name: API_ADVERT[name] for name in fields}

        def narrow(listing: Column) -> Column:
            present = F.when(listing["trackingContext"].isNotNull(), F.struct())
            values = [(listing[name] if name in fields else present).alias(name) for name in wanted]
            return F.when(listing.isNotNull(), F.struct(*values))

        # A bad escape spoils the field that holds it, but the document if that field is read over: then all are read.
        listings = F.coalesce(_listings(wanted), F.transform(listings, narrow))
    return responses.withColumn("listings", listings).drop("body")


def explode_listings(parsed: DataFrame) -> DataFrame:
    """One row per listing that has a tracking context.

    The outer form is used for its plan: for a plain explode the optimizer adds
    a filter on the array, which parses every document again. The row it gives
    for an empty page has no tracking context.
    """
    return (
        parsed.withColumn("listing", F.explode_outer("listings"))
        .drop("listings")
        .where(F.col("listing.trackingContext").isNotNull())
    )


def listing_record(exploded: DataFrame) -> DataFrame:
    """The eight listing fields next to the request columns.

    Price and year come from the tracking context, not from the display text.
    """
    listing = F.col("listing")
    context = listing["trackingContext"]["advertContext"]
    subtitle, attention = listing["subTitle"], listing["attentionGrabber"]
    request = [name for name in exploded.columns if name != "listing"]
    return exploded.select(
        *request,
        listing["advertId"].alias("id"),
        listing["title"].alias("title"),
        context["price"].alias("price"),
        context["year"].alias("year"),
        text.mileage_from_badges(listing["badges"]).alias("mileage"),
        text.fuel_from_text(F.col("fuel_filter"), subtitle, attention).alias("fuelType"),
        text.engine_size_regex(subtitle).alias("engineSize"),
        text.transmission_from_text(subtitle, attention).alias("transmission"),
    )


def fetch_listings(responses: DataFrame) -> DataFrame:
    """Every listing of every answered request; empty and broken pages add nothing."""
    return listing_record(explode_listings(with_listings(answered(responses))))


def bronze_rows(listings: DataFrame) -> DataFrame:
    """The nine columns written to bronze: brand is the requested make, price is cleaned text."""
    return listings.select(
        "id",
        F.col("make").alias("brand"),
        "title",
        text.price_clean_ingest(F.col("price")).alias("price"),
        "year",
        "mileage",
        "fuelType",
        "engineSize",
        "transmission",
    )
