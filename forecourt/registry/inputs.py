"""Inputs in the shapes the sources read, written from the listings view.

CSV files and response documents are written once per session and data folder
to the shared scratch folder, then read by the queries like any other input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.registry.listings_view import listings, read_table, shape_listings
from forecourt.schemas import CSV_LISTING, columns_of
from forecourt.session import scratch_path
from forecourt.streaming.change_feed import read_parquet_stream

_written: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        path = scratch_path(spark, name)
        write(path)
        _written[key] = path
    return _written[key]


def as_csv_listing(view: DataFrame) -> DataFrame:
    """The listings under the column names and types of the CSV files."""
    renamed = view.withColumnsRenamed({"fuel_type": "fuelType", "engine_size": "engineSize"})
    types = columns_of(CSV_LISTING)
    return renamed.select("brand", *[F.col(n).cast(t).alias(n) for n, t in types.items()])


def _csv_line(fields: list[Column]) -> Column:
    return F.concat_ws(",", *[F.coalesce(field.cast("string"), F.lit("")) for field in fields])


def csv_folder(spark: SparkSession, sf_dir: str) -> str:
    """``<brand>.csv`` folders of part files, with bad lines between the good ones.

    Each listing without an asking price also yields three bad lines: a word
    for the year, too few fields and too many fields.
    """

    def write(path: str) -> None:
        view = listings(spark, sf_dir)
        renamed = view.withColumnsRenamed({"fuel_type": "fuelType", "engine_size": "engineSize"})
        names = list(columns_of(CSV_LISTING))
        fields = [F.col(name) for name in names]
        good = _csv_line(fields)
        bad = [
            _csv_line([fields[0], F.lit("n/a"), *fields[2:]]),
            _csv_line(fields[:3]),
            _csv_line([*fields, F.lit("extra")]),
        ]
        unpriced = F.col("price_text") == "None"
        line = F.explode(F.when(unpriced, F.array(good, *bad)).otherwise(F.array(good)))
        lines = renamed.select("brand", line.alias(",".join(names)))
        # A separator and quote that no line holds: each line is one field, its name the header.
        lines.hint("rebalance", "brand").write.partitionBy("brand").option("header", True).option("sep", "\u0001").option(
            "quote", "\u0002"
        ).csv(path)
        _name_folders_by_brand(spark, path)

    return _once(spark, sf_dir, "csv", write)


def _name_folders_by_brand(spark: SparkSession, path: str) -> None:
    """``brand=X`` folders become ``X.csv``."""
    to_path = spark._jvm.org.apache.hadoop.fs.Path
    unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    files = to_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for entry in files.listStatus(to_path(path)):
        name = entry.getPath().getName()
        if name.startswith("brand="):
            brand = unescape(name.removeprefix("brand="))
            files.rename(entry.getPath(), to_path(f"{path}/{brand}.csv"))


def subtitle() -> Column:
    """Engine size, trim and gearbox; electric manuals have none."""
    gearbox = F.when(F.col("transmission") == "Automatic", " Auto").otherwise("")
    text = F.concat(F.col("engine_size").cast("string"), F.lit(" SE"), gearbox, F.lit(" 5dr"))
    return F.when((F.col("fuel_type") == "Electric") & (F.col("transmission") == "Manual"), None).otherwise(text)


def attention() -> Column:
    """A line that names the fuel, or a misleading one where the request has a fuel filter."""
    texts = {
        "Petrol": "Petrol Hybrid offer",
        "Diesel": "Swap your Petrol",
        "Hybrid": "Great Hybrid car",
        "Electric": "Electric drive",
    }
    return F.coalesce(*[F.when(F.col("fuel_type") == fuel, F.lit(text)) for fuel, text in texts.items()])


def badges() -> Column:
    """No badges, a badge without text, or several of which the last number counts."""

    def badge(kind: str, text: Column) -> Column:
        return F.struct(F.lit(kind).alias("type"), text.alias("displayText"))

    miles = F.concat(F.format_number("mileage", 0), F.lit(" miles"))
    no_text = F.lit(None).cast("string")
    return F.when(F.col("mileage") == 0, F.array(badge("MILEAGE", no_text))).when(
        F.col("mileage").isNotNull(),
        F.array(
            badge("MILEAGE", F.lit("10 miles")),
            badge("REGISTERED", F.col("year").cast("string")),
            badge("MILEAGE", miles),
            badge("MILEAGE", F.lit("n/a")),
        ),
    )


def _document() -> Column:
    """A response body with the listing and an advert that has no tracking context.

    Both have the ``subtitle``, ``attention`` and ``badges`` of the row.
    """
    context = F.struct(
        F.struct(F.col("brand").alias("make"), F.col("model"), F.col("year"), F.col("price")).alias(
            "advertContext"
        )
    )

    def listing(title: Column, tracking: Column) -> Column:
        return F.struct(
            F.col("id").cast("string").alias("advertId"),
            title.alias("title"),
            F.col("subtitle").alias("subTitle"),
            F.col("attention").alias("attentionGrabber"),
            F.col("price_text").alias("price"),
            F.col("badges"),
            tracking.alias("trackingContext"),
        )

    advert = listing(F.lit("Advertisement"), F.when(F.lit(False), context))
    results = F.struct(F.array(listing(F.col("title"), context), advert).alias("listings"))
    return F.to_json(F.array(F.struct(F.struct(results.alias("searchResults")).alias("data"))))


def response_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored responses, with the listing's id as ``request_id``.

    Each listing is page 1 of a request; requests for listings without an
    asking price failed. First line numbers also have a page 2 that is empty or
    broken.
    """

    def write(path: str) -> None:
        # Page numbers are exploded, not bodies, which would be copied into an array first.
        pages = F.when(F.col("tax") == 20, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
        texts = {"subtitle": subtitle(), "attention": attention(), "badges": badges()}
        paged = listings(spark, sf_dir).withColumns(texts).withColumn("page", F.explode(pages))
        second = F.when(F.col("transmission") == "Automatic", F.lit("[{}]")).otherwise(F.lit("[{broken"))
        filtered = F.col("fuel_type").isin("Diesel", "Other")
        requests = paged.select(
            F.col("id").alias("request_id"),
            F.col("brand").alias("make"),
            F.when(filtered, F.col("fuel_type")).otherwise("").alias("fuel_filter"),
            F.when(F.col("price_text") == "None", 500).otherwise(200).alias("status_code"),
            "page",
            F.when(F.col("page") == 1, _document()).otherwise(second).alias("body"),
        )
        # Small row groups: parsing a document costs far more than reading it.
        requests.write.option("parquet.block.size", 8 * 1024 * 1024).parquet(path, compression="zstd")

    return spark.read.parquet(_once(spark, sf_dir, "responses", write))


def _api_columns() -> list[Column]:
    return [
        F.col("id").cast("string").alias("id"),
        F.col("brand"),
        F.col("title"),
        F.col("price_text").alias("price"),
        F.col("year"),
        F.col("mileage").cast("int").alias("mileage"),
        F.col("fuel_type").alias("fuelType"),
        F.col("engine_size").alias("engineSize"),
        F.col("transmission"),
        F.col("search_timestamp").cast("timestamp").alias("search_timestamp"),
    ]


def as_api_listing(view: DataFrame) -> DataFrame:
    """The listings as bronze API rows with the displayed price text."""
    return view.select(*_api_columns())


def api_changes(view: DataFrame) -> DataFrame:
    """The API feed's change log."""
    return view.select(*_api_columns(), F.col("change_action").alias("_action"))


def brand_changes(view: DataFrame) -> DataFrame:
    """A one-brand feed's change log, in the columns of the CSV files."""
    types = columns_of(CSV_LISTING)
    renamed = view.withColumnsRenamed({"fuel_type": "fuelType", "engine_size": "engineSize"})
    return renamed.select(
        *[F.col(n).cast(t).alias(n) for n, t in types.items()], F.col("change_action").alias("_action")
    )


def brand_change_log(view: DataFrame) -> DataFrame:
    """A one-brand feed's change log in two increments: rows that come, come and go, or are updated.

    A listing is inserted in increment 1 or 2 by its tax. Those whose action is DELETE are deleted, petrol ones of
    the others get a new price (a DELETE and an INSERT): at once, or in increment 2 if their tax is 60 or 80.
    """
    types = columns_of(CSV_LISTING)
    renamed = view.withColumnsRenamed({"fuel_type": "fuelType", "engine_size": "engineSize"})
    first = F.when(F.col("tax") <= 80, 1).otherwise(2)
    later = F.when(F.col("tax").between(60, 80), 2).otherwise(first)

    def change(seq: int, increment: Column, action: str, price: Column) -> Column:
        parts = {"_seq": F.lit(seq), "_increment": increment, "_action": F.lit(action), "price": price.cast("int")}
        return F.struct(*[part.alias(name) for name, part in parts.items()])

    price = F.col("price")
    come, go = change(1, first, "INSERT", price), change(2, later, "DELETE", price)
    changes = F.when(F.col("change_action") == "DELETE", F.array(come, go)).when(
        F.col("fuelType") == "Petrol", F.array(come, go, change(3, later, "INSERT", price + 100))
    )
    exploded = renamed.withColumn("_change", F.explode(F.coalesce(changes, F.array(come))))
    fields = [F.col("_change.price") if n == "price" else F.col(n).cast(t).alias(n) for n, t in types.items()]
    return exploded.select(
        F.col("id").alias("_row_id"), *fields, F.col("_change._seq"), F.col("_change._increment"), F.col("_change._action")
    )


def listings_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listings view over the line-item table, one file or many, as a stream."""
    schema = read_table(spark, sf_dir, "lineitem").schema
    # A pattern, since a file stream takes a single file only by pattern.
    stream = read_parquet_stream(spark, f"{sf_dir}/lineitem.parquet*", schema)
    return shape_listings(stream, read_table(spark, sf_dir, "part"))
