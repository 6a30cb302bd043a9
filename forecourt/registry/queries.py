"""One query per operator, each over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.functions import rules, text
from forecourt.operators import keyed, shape, tables
from forecourt.plans import attribution, facts as fact_plans, marts, pricing, quality, refresh, segments
from forecourt.registry import inputs
from forecourt.registry.listings_view import listings
from forecourt.schemas import API_LISTING, CLUSTER_MART, CSV_LISTING, FACT, columns_of
from forecourt.session import scratch_path, stage
from forecourt.sources import api_responses as api
from forecourt.sources.csv_listings import read_csv_listings
from forecourt.streaming import change_feed as feed, compaction

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

CAR_BRAND = "MERCEDES"  # the constant brand of the one-brand feed
NO_LOAD_TIME = [name for name in columns_of(API_LISTING) if name != "search_timestamp"]


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listings(spark, sf_dir).select(*fact_plans.STAGING_COLUMNS)


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_plans.enrich(staged(spark, sf_dir))


def facts_with_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_plans.enrich(listings(spark, sf_dir).select("id", *fact_plans.STAGING_COLUMNS))


def fetched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return api.fetch_listings(inputs.response_documents(spark, sf_dir))


def bronze_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return api.bronze_rows(fetched(spark, sf_dir))


def new_layers(spark: SparkSession) -> tables.Layers:
    """Namespaces of their own, so that no run meets the tables of another."""
    root = scratch_path(spark, "layers")
    return tables.create_layers(spark, root, prefix=f"run_{root.split('/')[-2][:12]}_")


def price_bands(facts_frame: DataFrame) -> DataFrame:
    """Complete facts with a price band as cluster, in place of a fitted model's."""
    features = segments.ml_feature_extract(facts_frame)
    band = F.when(F.col("price") < 30000, 2).when(F.col("price") < 60000, 0).otherwise(1)
    return features.withColumn("cluster_id", band)


def band_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = segments.cluster_business_names(price_bands(facts(spark, sf_dir)))
    return shape.fit_columns(named, columns_of(CLUSTER_MART))


def raw_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.as_api_listing(listings(spark, sf_dir))


def loaded_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts of an earlier load: the listings of the thriftier cars, title as model."""
    thrifty = listings(spark, sf_dir).where(F.col("mpg") >= 25)
    return fact_plans.api_feed_facts(inputs.as_api_listing(thrifty))


_models: dict[tuple[str, str], object] = {}


def price_model(spark: SparkSession, sf_dir: str):
    """The price model of a data folder, fitted once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _models:
        train, _ = pricing.train_test_split(facts_with_id(spark, sf_dir))
        _models[key] = pricing.train_price_model(train)
    return _models[key]


# --- sources, sinks, tables -------------------------------------------------


@query
def csv_bulk_load(spark, sf_dir):
    """The folder's files are loaded once, however often the job runs."""
    table = f"{new_layers(spark).bronze}.csv_listings"
    for _ in range(2):
        refresh.load_csv(spark, inputs.csv_folder(spark, sf_dir), table)
    return refresh.loaded_csv(spark, table)


@query
def csv_load_report(spark, sf_dir):
    """Lines loaded and rejected per brand."""
    table = f"{new_layers(spark).bronze}.csv_listings"
    refresh.load_csv(spark, inputs.csv_folder(spark, sf_dir), table)
    report = refresh.load_report(spark, table).groupBy("brand")
    return report.agg(F.sum("loaded").alias("loaded"), F.sum("rejected").alias("rejected"))


@query
def brand_from_filename(spark, sf_dir):
    loaded = read_csv_listings(spark, inputs.csv_folder(spark, sf_dir))
    return loaded.groupBy("brand").agg(
        F.count("*").alias("listings"), F.sum(F.col("price").cast("bigint")).alias("total_price")
    )


@query
def file_arrival_stream(spark, sf_dir):
    arrivals = read_csv_listings(spark, inputs.csv_folder(spark, sf_dir), stream=True)
    path, checkpoint = scratch_path(spark, "arrivals"), scratch_path(spark, "checkpoint")
    feed.run_increment(arrivals, path, checkpoint)
    feed.run_increment(arrivals, path, checkpoint)
    return spark.read.schema(arrivals.schema).parquet(path)


@query
def api_response_source(spark, sf_dir):
    return fetched(spark, sf_dir).select("make", *api.LISTING_COLUMNS)


@query
def multi_request_union(spark, sf_dir):
    return fetched(spark, sf_dir).groupBy("make", "fuel_filter", "page").agg(
        F.count("*").alias("listings"), F.sum(F.col("price").try_cast("bigint")).alias("total_price")
    )


@query
def bronze_append(spark, sf_dir):
    table = f"{new_layers(spark).bronze}.api_listings"
    refresh.ingest_responses(inputs.response_documents(spark, sf_dir), table)
    stamped = spark.table(table).where(F.col("search_timestamp").isNotNull())
    return stamped.select(*NO_LOAD_TIME)


@query
def create_if_absent(spark, sf_dir):
    table = f"{new_layers(spark).bronze}.csv_listings"
    tables.create_if_absent(spark, table, CSV_LISTING)
    loaded = read_csv_listings(spark, inputs.csv_folder(spark, sf_dir))
    tables.insert_columns(loaded.drop("brand"), table)
    tables.create_if_absent(spark, table, CSV_LISTING)
    return spark.table(table)


@query
def layered_namespaces(spark, sf_dir):
    layers = new_layers(spark)
    view = listings(spark, sf_dir)
    tables.table_materialize(inputs.as_api_listing(view), f"{layers.bronze}.api_listings")
    refresh.build_layers(spark, view.select(*fact_plans.STAGING_COLUMNS), layers, "layered_top_devaluation")
    return tables.layer_inventory(spark, layers)


@query
def schema_evolve_add(spark, sf_dir):
    table = f"{new_layers(spark).bronze}.api_listings"
    view = listings(spark, sf_dir)
    old = inputs.as_api_listing(view.where(F.col("change_action") == "DELETE")).drop("brand")
    new = inputs.as_api_listing(view.where(F.col("change_action") == "INSERT"))
    ddl = {k: v for k, v in columns_of(API_LISTING).items() if k != "brand"}
    tables.create_if_absent(spark, table, ", ".join(f"{k} {v}" for k, v in ddl.items()))
    tables.insert_columns(old, table)
    tables.add_missing_columns(spark, table, "brand string")
    tables.insert_columns(new, table)
    return spark.table(table).select(*NO_LOAD_TIME)


@query
def partial_column_insert(spark, sf_dir):
    table = f"{new_layers(spark).silver}.fct_cars"
    tables.create_if_absent(spark, table, FACT)
    rows = fact_plans.api_feed_facts(raw_titles(spark, sf_dir))
    types = {k: v for k, v in columns_of(FACT).items() if k in rows.columns}
    tables.insert_columns(shape.fit_columns(rows, types), table)
    return spark.table(table)


@query
def table_materialize(spark, sf_dir):
    return tables.table_materialize(facts(spark, sf_dir), f"{new_layers(spark).silver}.fct_cars")


@query
def view_materialize(spark, sf_dir):
    return tables.view_materialize(staged(spark, sf_dir), "stg_cars")


@query
def truncate_load(spark, sf_dir):
    table = f"{new_layers(spark).gold}.mart_market_clusters"
    tables.create_if_absent(spark, table, CLUSTER_MART)
    mart = band_mart(spark, sf_dir)
    tables.replace_rows(mart, table)
    tables.replace_rows(mart, table)
    return spark.table(table)


@query
def table_scan_project(spark, sf_dir):
    return facts(spark, sf_dir).select(*segments.FEATURE_COLUMNS)


# --- JSON, arrays, strings --------------------------------------------------


@query
def json_path_listings(spark, sf_dir):
    parsed = api.with_listings(inputs.response_documents(spark, sf_dir), "advertId")
    return parsed.select(
        "request_id", "page", F.coalesce(F.array_size("listings"), F.lit(0)).alias("n_listings")
    )


@query
def explode_listings(spark, sf_dir):
    return _exploded(spark, sf_dir, "advertId", "title").select(
        "request_id", F.col("listing.advertId").alias("id"), F.col("listing.title").alias("title")
    )


@query
def response_status_gate(spark, sf_dir):
    kept = api.answered(inputs.response_documents(spark, sf_dir))
    return kept.select("request_id", "make", "page")


def _exploded(spark, sf_dir, *fields: str) -> DataFrame:
    return api.explode_listings(api.with_listings(inputs.response_documents(spark, sf_dir), *fields))


@query
def null_to_empty(spark, sf_dir):
    return _exploded(spark, sf_dir, "subTitle", "attentionGrabber").select(
        "request_id",
        text.null_to_empty(F.col("listing.subTitle")).alias("subtitle"),
        text.null_to_empty(F.col("listing.attentionGrabber")).alias("attention"),
    )


@query
def mileage_from_badges(spark, sf_dir):
    return _exploded(spark, sf_dir, "badges").select(
        "request_id", text.mileage_from_badges(F.col("listing.badges")).alias("mileage")
    )


@query
def fuel_from_text(spark, sf_dir):
    fuel = text.fuel_from_text(
        F.col("fuel_filter"), F.col("listing.subTitle"), F.col("listing.attentionGrabber")
    )
    return _exploded(spark, sf_dir, "subTitle", "attentionGrabber").select("request_id", fuel.alias("fuel_type"))


@query
def transmission_from_text(spark, sf_dir):
    gearbox = text.transmission_from_text(F.col("listing.subTitle"), F.col("listing.attentionGrabber"))
    return _exploded(spark, sf_dir, "subTitle", "attentionGrabber").select("request_id", gearbox.alias("transmission"))


@query
def engine_size_regex(spark, sf_dir):
    return _exploded(spark, sf_dir, "subTitle").select(
        "request_id", text.engine_size_regex(F.col("listing.subTitle")).alias("engine_size")
    )


@query
def listing_record(spark, sf_dir):
    return api.listing_record(_exploded(spark, sf_dir)).select(*api.LISTING_COLUMNS)


@query
def price_clean_ingest(spark, sf_dir):
    return listings(spark, sf_dir).select(
        "id", text.price_clean_ingest(F.col("price_text")).alias("price")
    )


@query
def price_clean_try(spark, sf_dir):
    return listings(spark, sf_dir).select("id", text.price_clean_try(F.col("price_text")).alias("price"))


@query
def price_clean_strict(spark, sf_dir):
    """Strict cleaning needs clean input: no pound sign, NULL where there is no price."""
    plain = F.nullif(F.replace(F.col("price_text"), F.lit("£"), F.lit("")), F.lit("None"))
    return listings(spark, sf_dir).select("id", text.price_clean_strict(plain).alias("price"))


@query
def brand_from_title(spark, sf_dir):
    return listings(spark, sf_dir).select("id", text.brand_from_title(F.col("title")).alias("brand"))


@query
def title_as_model(spark, sf_dir):
    return fact_plans.title_as_model(raw_titles(spark, sf_dir)).select("id", "model")


@query
def rename_constants(spark, sf_dir):
    return fact_plans.rename_constants(raw_titles(spark, sf_dir)).drop("search_timestamp")


@query
def brand_literal(spark, sf_dir):
    changes = inputs.brand_changes(listings(spark, sf_dir))
    return fact_plans.brand_literal(changes, CAR_BRAND)


# --- projections, predicates, math ------------------------------------------


@query
def ulez_compliance(spark, sf_dir):
    flag = rules.ulez_compliance(F.col("fuel_type"), F.col("year"))
    return listings(spark, sf_dir).select("id", "fuel_type", "year", flag.alias("is_ulez_compliant"))


@query
def vehicle_age(spark, sf_dir):
    return listings(spark, sf_dir).select("id", rules.vehicle_age(F.col("year")).alias("vehicle_age"))


def _per_mile(spark, sf_dir, form: Callable[[Column, Column], Column]) -> DataFrame:
    return listings(spark, sf_dir).select(
        "id", form(F.col("price"), F.col("mileage")).alias("price_per_mile")
    )


@query
def price_per_mile_zero(spark, sf_dir):
    return _per_mile(spark, sf_dir, rules.price_per_mile_zero)


@query
def price_per_mile_null(spark, sf_dir):
    return _per_mile(spark, sf_dir, rules.price_per_mile_null)


@query
def enrich_facts(spark, sf_dir):
    return facts(spark, sf_dir)


@query
def price_efficiency(spark, sf_dir):
    return marts.impact_summary(facts(spark, sf_dir)).select(
        "brand", "year", "fuel_type", "is_ulez_compliant", "price_efficiency"
    )


@query
def filter_fuel(spark, sf_dir):
    return shape.dimension_filter(facts(spark, sf_dir), fuels=["Diesel"])


@query
def filter_complete(spark, sf_dir):
    return shape.filter_complete(facts(spark, sf_dir))


@query
def filter_inserts(spark, sf_dir):
    return shape.filter_inserts(inputs.brand_changes(listings(spark, sf_dir)))


@query
def dimension_filter(spark, sf_dir):
    return shape.dimension_filter(
        facts(spark, sf_dir), brands=["BRAND#1", "BRAND#2", "BRAND#3"], fuels=["Petrol", "Diesel"]
    )


@query
def recase_columns(spark, sf_dir):
    return shape.recase_columns(shape.recase_columns(raw_titles(spark, sf_dir), upper=True)).drop(
        "search_timestamp"
    )


@query
def present_columns(spark, sf_dir):
    return marts.present_devaluation(marts.diesel_devaluation_top(facts(spark, sf_dir)))


# --- joins ------------------------------------------------------------------


@query
def backfill_anti_join(spark, sf_dir):
    missing = keyed.backfill_anti_join(raw_titles(spark, sf_dir), loaded_facts(spark, sf_dir))
    return shape.fit_columns(fact_plans.api_feed_facts(missing), columns_of(FACT))


# --- aggregations -----------------------------------------------------------


@query
def impact_summary(spark, sf_dir):
    return marts.impact_summary(facts(spark, sf_dir))


@query
def diesel_devaluation_top10(spark, sf_dir):
    return marts.diesel_devaluation_top(facts(spark, sf_dir))


@query
def conditional_avg_pair(spark, sf_dir):
    pair = marts.conditional_avg_pair(F.col("mileage"), F.col("is_ulez_compliant"))
    return facts(spark, sf_dir).groupBy("fuel_type").agg(
        pair["avg_price_compliant"].alias("avg_mileage_compliant"),
        pair["avg_price_non_compliant"].alias("avg_mileage_non_compliant"),
    )


@query
def having_both_classes(spark, sf_dir):
    counted = facts(spark, sf_dir).groupBy("brand", "model", "fuel_type").agg(*marts.class_counts())
    return marts.having_both_classes(counted)


@query
def brand_price_gap(spark, sf_dir):
    return marts.brand_price_gap(facts(spark, sf_dir))


@query
def devaluation_total_listings(spark, sf_dir):
    return marts.diesel_devaluation(facts(spark, sf_dir), with_totals=True)


@query
def row_counts(spark, sf_dir):
    return quality.row_counts(facts(spark, sf_dir))


@query
def cluster_distribution(spark, sf_dir):
    return quality.cluster_distribution(band_mart(spark, sf_dir))


@query
def cluster_profile_means(spark, sf_dir):
    return segments.cluster_profile_means(price_bands(facts(spark, sf_dir)))


# --- order and position -----------------------------------------------------


@query
def devaluation_rank(spark, sf_dir):
    return marts.devaluation_rank(marts.diesel_devaluation_top(facts(spark, sf_dir)))


@query
def sample_per_cluster(spark, sf_dir):
    return segments.sample_per_cluster(band_mart(spark, sf_dir))


@query
def cluster_price_order(spark, sf_dir):
    profile = segments.cluster_profile_means(price_bands(facts(spark, sf_dir)))
    return segments.cluster_price_order(profile).select("cluster_id", "avg_price", "price_position")


@query
def top_k_devaluation(spark, sf_dir):
    return marts.top_k_devaluation(marts.diesel_devaluation(facts(spark, sf_dir)), k=30)


@query
def sort_by_gap(spark, sf_dir):
    return marts.sort_by_gap(marts.brand_price_gap(facts(spark, sf_dir)))


# --- set operations and reshaping -------------------------------------------


@query
def unified_listings(spark, sf_dir):
    csv_rows = read_csv_listings(spark, inputs.csv_folder(spark, sf_dir))
    return fact_plans.unified_listings(csv_rows, bronze_feed(spark, sf_dir))


@query
def melt_price_gap(spark, sf_dir):
    return marts.melt_price_gap(marts.brand_price_gap(facts(spark, sf_dir)))


def _partly_unknown_ids(view: DataFrame) -> DataFrame:
    """Listings without an asking price have lost their id."""
    return view.withColumn("id", F.when(F.col("price_text") != "None", F.col("id")))


@query
def listing_dedup(spark, sf_dir):
    columns = ["id", "search_timestamp", "price", "brand", "title", "mileage"]
    return keyed.listing_dedup(_partly_unknown_ids(listings(spark, sf_dir)).select(*columns))


# --- streaming --------------------------------------------------------------


def _read_back(spark: SparkSession, facts_stream: DataFrame) -> DataFrame:
    path = scratch_path(spark, "fct_cars")
    feed.run_increment(facts_stream, path, scratch_path(spark, "checkpoint"))
    return spark.read.schema(facts_stream.schema).parquet(path)


@query
def cdc_insert_stream(spark, sf_dir):
    """Facts of the net inserts of a change log that arrives in two increments."""
    log, checkpoint = scratch_path(spark, "changes"), scratch_path(spark, "checkpoint")
    table = f"{new_layers(spark).silver}.fct_cars"
    feed.create_load_table(spark, table, FACT)
    changes = inputs.brand_change_log(listings(spark, sf_dir))
    schema = changes.drop("_increment").schema
    for increment in (1, 2):
        changes.where(F.col("_increment") == increment).drop("_increment").write.mode("append").parquet(log)
        arrived = feed.read_parquet_stream(spark, log, schema)
        feed.run_net_increment(arrived, table, checkpoint, lambda batch: feed.cdc_insert_facts(batch, CAR_BRAND))
    return spark.table(table).select(*columns_of(FACT))


@query
def api_cdc_stream(spark, sf_dir):
    return _read_back(spark, feed.api_cdc_facts(inputs.api_changes(inputs.listings_stream(spark, sf_dir))))


@query
def incremental_trigger(spark, sf_dir):
    """Rows appended by a first and by a second run on the same input."""
    stream = feed.api_cdc_facts(inputs.api_changes(inputs.listings_stream(spark, sf_dir)))
    path, checkpoint = scratch_path(spark, "fct_cars"), scratch_path(spark, "checkpoint")
    counts = []
    for run in (1, 2):
        feed.run_increment(stream, path, checkpoint)
        rows = spark.read.schema(stream.schema).parquet(path)
        counts.append(stage(rows.agg(F.lit(run).alias("run"), F.count("*").alias("fact_rows")), "count"))
    return counts[0].unionByName(counts[1])


@query
def stream_compaction(spark, sf_dir):
    """The API feed's facts after six increments, compacted after the third and the last."""
    changes, streamed, checkpoint = (scratch_path(spark, name) for name in ("changes", "fct_cars", "checkpoint"))
    log = inputs.api_changes(listings(spark, sf_dir)).withColumn("_slice", F.pmod(F.xxhash64("id"), F.lit(6)))
    log.hint("rebalance", "_slice").write.partitionBy("_slice").parquet(changes)
    schema = log.drop("_slice").schema
    for number in range(6):
        # One folder after the other, as files arrive.
        arrived = feed.read_parquet_stream(spark, f"{changes}/_slice={{{','.join(map(str, range(number + 1)))}}}", schema)
        feed.run_increment(feed.api_cdc_facts(arrived), streamed, checkpoint)
        if number in (2, 5):
            compaction.compact(spark, streamed, FACT)
    return compaction.streamed_rows(spark, streamed, FACT)


@query
def stream_dedup(spark, sf_dir):
    """Adverts of a stream, each once; a second run on the same input adds nothing."""
    table = f"{new_layers(spark).bronze}.adverts"
    feed.create_load_table(spark, table, API_LISTING)
    stream = inputs.as_api_listing(_partly_unknown_ids(inputs.listings_stream(spark, sf_dir)))
    checkpoint = scratch_path(spark, "checkpoint")
    for _ in range(2):
        feed.run_dedup_increment(stream, table, checkpoint)
    return spark.table(table).select(*NO_LOAD_TIME)


@query
def stream_backfill(spark, sf_dir):
    """An older load, then stream and backfill of what it has passed by, twice; the facts afterwards."""
    table, streamed = f"{new_layers(spark).silver}.fct_cars", scratch_path(spark, "fct_cars")
    changes, checkpoint = scratch_path(spark, "changes"), scratch_path(spark, "checkpoint")
    view = listings(spark, sf_dir)
    schema = inputs.api_changes(view).schema
    early, late = view.where(F.col("tax") <= 80), view.where(F.col("tax") > 80)
    tables.create_if_absent(spark, table, FACT)
    types = {k: v for k, v in columns_of(FACT).items() if k not in ("tax", "mpg")}
    older = early.where((F.col("mpg") >= 25) & (F.col("change_action") == "DELETE"))
    older_facts = fact_plans.api_feed_facts(inputs.as_api_listing(older))
    tables.insert_columns(shape.fit_columns(older_facts, types), table)
    for rows in (early, late):
        inputs.api_changes(rows).write.mode("append").parquet(changes)
        log = feed.read_parquet_stream(spark, changes, schema)
        feed.run_increment(feed.api_cdc_facts(log), streamed, checkpoint)
        refresh.fenced_backfill(spark, schema, table, streamed, checkpoint)
    return feed.all_facts(spark, table, streamed)


@query
def batch_stream_parity(spark, sf_dir):
    """Row count and price sum per brand and compliance, from the batch and from the stream."""
    batch = feed.api_cdc_facts(inputs.api_changes(listings(spark, sf_dir)))
    streamed = _read_back(
        spark, feed.api_cdc_facts(inputs.api_changes(inputs.listings_stream(spark, sf_dir)))
    )
    both = batch.withColumn("path", F.lit("batch")).unionByName(streamed.withColumn("path", F.lit("stream")))
    of_batch = F.col("path") == "batch"
    return both.groupBy("brand", "is_ulez_compliant").agg(
        F.count_if(of_batch).alias("batch_rows"),
        F.count_if(~of_batch).alias("stream_rows"),
        F.sum(F.when(of_batch, F.col("price"))).alias("batch_price"),
        F.sum(F.when(~of_batch, F.col("price"))).alias("stream_price"),
    )


@query
def daily_refresh(spark, sf_dir):
    """Per class of the segments' names: how many names there are and their listings, loaded and streamed."""
    layers, streamed = new_layers(spark), scratch_path(spark, "fct_cars")
    view = listings(spark, sf_dir)
    old = view.where(F.col("change_action") == "DELETE").select(*fact_plans.STAGING_COLUMNS)
    changes = inputs.api_changes(inputs.listings_stream(spark, sf_dir))
    feed.run_increment(feed.api_cdc_facts(changes), streamed, scratch_path(spark, "checkpoint"))
    refresh.build_layers(spark, old, layers, "refreshed_top_devaluation", streamed)
    every = feed.all_facts(spark, f"{layers.silver}.fct_cars", streamed)
    sizes = refresh.daily_refresh(spark, every, layers)
    compliant = F.col("cluster_name").endswith("(ULEZ Compliant)").alias("compliant")
    return sizes.groupBy(compliant).agg(F.count("*").alias("segments"), F.sum("listings").alias("listings"))


# --- machine learning -------------------------------------------------------


@query
def ml_feature_extract(spark, sf_dir):
    return segments.ml_feature_extract(facts(spark, sf_dir))


@query
def standard_scale(spark, sf_dir):
    features = listings(spark, sf_dir).select("id", *segments.FEATURES)
    scaled = segments.standard_scale(shape.filter_complete(features))
    return scaled.select(
        "id", *[F.round(f"scaled_{name}", 6).alias(f"scaled_{name}") for name in segments.FEATURES]
    )


@query
def kmeans_segments(spark, sf_dir):
    """Every complete listing, and whether its segment's centre is the mean of the segment's listings."""
    columns = ["id", *segments.FEATURE_COLUMNS]
    features = stage(segments.ml_feature_extract(facts_with_id(spark, sf_dir), columns), "features")
    segmenter = segments.fit_segments(features)
    scored = segmenter.transform(features)
    means = segments.cluster_profile_means(scored).toDF("cluster_id", *[f"mean_{name}" for name in segments.FEATURES])
    centres = spark.createDataFrame(segmenter.profile(), segments.PROFILE)
    off = [
        F.abs(F.col(f"mean_{name}") - F.col(f"avg_{name}")) / (deviation or 1.0)
        for name, deviation in zip(segments.FEATURES, segmenter.deviations)
    ]
    centred = means.join(centres, "cluster_id").select("cluster_id", (F.greatest(*off) < 1e-3).alias("centred"))
    return scored.join(F.broadcast(centred), "cluster_id").select("id", *segments.FEATURES, "centred")  # a row per cluster


@query
def cluster_business_names(spark, sf_dir):
    return segments.cluster_business_names(price_bands(facts(spark, sf_dir)))


@query
def cluster_mart(spark, sf_dir):
    """The mart's listings, and whether the families of names follow their mean prices."""
    table = f"{new_layers(spark).gold}.mart_market_clusters"
    mart = segments.cluster_mart(spark, facts(spark, sf_dir), table)
    place = F.coalesce(
        *[F.when(F.col("cluster_name").isin(*names), position) for position, names in segments.SEGMENT_NAMES.items()]
    )
    means = mart.groupBy(place.alias("place")).agg(F.avg("price").alias("mean")).orderBy("place").collect()
    in_order = [r.place for r in means] == [1, 2, 3] and means[0].mean < means[1].mean < means[2].mean
    return mart.drop("cluster_id", "cluster_name").withColumn("in_price_order", F.lit(in_order))


@query
def train_test_split(spark, sf_dir):
    return listings(spark, sf_dir).select("id", "price", pricing.split_side(F.col("id")).alias("side"))


@query
def price_regression(spark, sf_dir):
    """Every test listing, features known or not, and whether it has a finite price."""
    _, test = pricing.train_test_split(facts_with_id(spark, sf_dir))
    scored = pricing.predict_prices(price_model(spark, sf_dir), test)
    finite = F.col("predicted_price").isNotNull() & (F.abs("predicted_price") < float("inf"))
    return scored.select("id", "price", *pricing.FEATURES, finite.alias("finite"))


@query
def regression_metrics(spark, sf_dir):
    """Metrics of a rule-of-thumb prediction, so that SQL can check them."""
    guess = F.col("mileage") + 1000
    scored = listings(spark, sf_dir).where(F.col("mileage").isNotNull()).withColumn("predicted_price", guess)
    return pricing.regression_metrics(scored).select(
        F.round("mae", 6).alias("mae"), F.round("r2", 6).alias("r2")
    )


@query
def shap_contributions(spark, sf_dir):
    """Every test listing, and whether base value and contributions add up to its prediction."""
    _, test = pricing.train_test_split(facts_with_id(spark, sf_dir))
    explained = attribution.shap_contributions(price_model(spark, sf_dir), test)
    total = sum((F.col(name) for name in attribution.value_columns()), F.lit(0.0))
    adds_up = F.abs(total - F.col("predicted_price")) < 1e-6 * (1 + F.abs("predicted_price"))
    return explained.select("id", *pricing.FEATURES, adds_up.alias("adds_up"))


@query
def categorical_encode(spark, sf_dir):
    encoded = pricing.categorical_encode(listings(spark, sf_dir).select("id", "fuel_type", "brand"))
    slots = F.transform(vector_to_array("fuel_type_vector"), lambda x: x.cast("int").cast("string"))
    return encoded.select(
        "id", "fuel_type", "brand", "fuel_type_index", "brand_index", F.concat_ws("", slots).alias("fuel_type_slots")
    )


# --- data quality -----------------------------------------------------------


@query
def quality_counts(spark, sf_dir):
    mart = f"{new_layers(spark).gold}.mart_market_clusters"
    tables.table_materialize(band_mart(spark, sf_dir), mart)
    return quality.quality_counts(spark, facts(spark, sf_dir), mart)


@query
def empty_or_missing_mart(spark, sf_dir):
    """A mart that was never built reads as no rows next to one that was."""
    gold = new_layers(spark).gold
    tables.table_materialize(band_mart(spark, sf_dir), f"{gold}.built")
    built = tables.read_or_empty(spark, f"{gold}.built", CLUSTER_MART)
    return built.unionByName(tables.read_or_empty(spark, f"{gold}.never_built", CLUSTER_MART))
