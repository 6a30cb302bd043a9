"""Plans that hold at scale: pruning, few shuffles, no hot task."""

import re
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from forecourt.operators import keyed
from forecourt.plans import marts, segments
from forecourt.registry import inputs, queries
from forecourt.registry.queries import QUERIES, band_mart, facts
from forecourt.schemas import FACT
from forecourt.session import stage
from forecourt.sources import api_responses as api


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def fact_table(spark, new_dir):
    facts(spark, SF_DIR).write.parquet(f"{new_dir}/facts")
    return spark.read.parquet(f"{new_dir}/facts")


def test_devaluation_reads_four_columns_and_shuffles_once(fact_table):
    plan = plan_of(marts.diesel_devaluation_top(fact_table))
    assert "PushedFilters: [IsNotNull(fuel_type), EqualTo(fuel_type,Diesel)]" in plan
    assert re.search(
        r"ReadSchema: struct<brand:string,model:string,price:bigint,fuel_type:string,is_ulez_compliant:boolean>",
        plan,
    )
    assert plan.count("Exchange") == 1 and "TakeOrderedAndProject" in plan and "partial_avg" in plan


@pytest.mark.parametrize("mart", [marts.impact_summary, marts.brand_price_gap])
def test_marts_aggregate_before_their_only_shuffle(fact_table, mart):
    plan = plan_of(mart(fact_table))
    assert plan.count("Exchange") == 1 and plan.count("HashAggregate") == 2 and "partial_avg" in plan


def test_complete_rows_are_a_filter_the_scan_can_use(fact_table):
    plan = plan_of(segments.ml_feature_extract(fact_table))
    assert "PushedFilters: [IsNotNull(price), IsNotNull(mileage), IsNotNull(year)]" in plan


def test_first_rows_of_a_group_are_picked_before_the_shuffle(spark):
    dedup = plan_of(QUERIES["listing_dedup"](spark, SF_DIR))
    assert re.search(r"WindowGroupLimit.*1, Final[\s\S]*Exchange[\s\S]*WindowGroupLimit.*1, Partial", dedup)
    sample = plan_of(segments.sample_per_cluster(band_mart(spark, SF_DIR)))
    assert re.search(r"WindowGroupLimit.*3, Final[\s\S]*Exchange[\s\S]*WindowGroupLimit.*3, Partial", sample)


def test_each_document_is_parsed_once(spark):
    plan = plan_of(api.fetch_listings(inputs.response_documents(spark, SF_DIR)))
    assert plan.count("from_json") == 1
    assert "EqualTo(status_code,200)" in plan and "Exchange" not in plan


@pytest.mark.parametrize("key, wanted", [("fuel_from_text", ["subTitle", "attentionGrabber"]), ("mileage_from_badges", ["badges"])])
def test_a_query_converts_the_listing_fields_it_wants(spark, monkeypatch, key, wanted):
    parsed, explode = [], api.explode_listings
    monkeypatch.setattr(api, "explode_listings", lambda frame: parsed.append(frame) or explode(frame))
    assert "Exchange" not in plan_of(QUERIES[key](spark, SF_DIR))
    assert parsed[0].schema["listings"].dataType.elementType.names == ["trackingContext", *wanted]


def test_no_registered_batch_query_joins_without_a_key(spark):
    for key in ("backfill_anti_join", "cluster_business_names", "unified_listings", "impact_summary"):
        plan = plan_of(QUERIES[key](spark, SF_DIR))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.fixture
def no_broadcast(settings):
    """Join settings at which a few rows behave like a large skewed table."""
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="10KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
        spark__sql__adaptive__coalescePartitions__minPartitionSize="1KB",
    )


def test_a_hot_title_is_split_over_tasks(spark, no_broadcast):
    """A third of the raw rows share a title, a third have none, and the facts have a hot model."""
    number = F.col("id")
    title = F.when(number % 3 == 0, "hot").when(number % 3 == 1, F.concat(F.lit("t"), number))
    raw = spark.range(0, 60000, 1, 8).select(title.alias("title"), F.sha2(number.cast("string"), 256).alias("pad"))
    model = F.when(number % 3 == 0, "hot model").otherwise(F.concat(F.lit("t"), number))
    known = spark.range(0, 30000, 1, 8).select(model.alias("model"))
    missing = keyed.backfill_anti_join(raw, known)
    assert len(missing.collect()) == 20000 + 20000 + 10000
    assert "SortMergeJoin(skew=true)" in plan_of(missing)


def test_a_hot_brand_gives_the_same_summary(spark, no_broadcast):
    number = F.col("id")
    rows = spark.range(0, 90000, 1, 8).select(
        F.when(number % 3 == 0, "HOT").otherwise(F.concat(F.lit("B"), number % 100)).alias("brand"),
        F.lit("m").alias("model"),
        F.lit(2016).alias("year"),
        number.alias("price"),
        F.lit("Manual").alias("transmission"),
        F.lit(1).alias("mileage"),
        F.lit("Diesel").alias("fuel_type"),
        F.lit(0).alias("tax"),
        F.lit(0.0).alias("mpg"),
        F.lit(2.0).alias("engine_size"),
        (number % 2 == 0).alias("is_ulez_compliant"),
        F.lit(9).alias("vehicle_age"),
        F.lit(0.0).alias("price_per_mile"),
    )
    assert rows.columns == [part.split()[0] for part in FACT.split(", ")]
    hot = [r for r in marts.impact_summary(rows).collect() if r.brand == "HOT"]
    assert sorted((r.is_ulez_compliant, r.total_listings) for r in hot) == [(False, 15000), (True, 15000)]
    newest = keyed.listing_dedup(rows.select("brand", "price"), key="brand", newest="price").collect()
    assert max(r.price for r in newest if r.brand == "HOT") == 89997 and len(newest) == 101


def test_increments_of_the_change_log_are_split_when_large(spark, new_dir, monkeypatch, no_broadcast, settings):
    settings(spark__sql__adaptive__coalescePartitions__enabled="false")
    monkeypatch.setattr(queries, "scratch_path", lambda _, name: f"{new_dir}/{name}")
    assert QUERIES["stream_compaction"](spark, SF_DIR).count() > 0
    assert all(len(list(Path(new_dir).glob(f"changes/_slice={i}/*.parquet"))) > 1 for i in range(6))


def test_the_mart_reads_the_facts_once(spark, new_dir, monkeypatch):
    written = []
    monkeypatch.setattr(segments, "stage", lambda frame, name: written.append(name) or stage(frame, name))
    spark.sql(f"CREATE DATABASE IF NOT EXISTS plan_gold LOCATION '{new_dir}/gold'")
    mart = segments.cluster_mart(spark, facts(spark, SF_DIR), "plan_gold.mart", starts=1)
    assert written[0] == "features" and mart.count() == segments.ml_feature_extract(facts(spark, SF_DIR)).count()


def test_responses_are_stored_compressed(spark):
    path = inputs.response_documents(spark, SF_DIR).inputFiles()[0]
    assert pq.ParquetFile(path.removeprefix("file:")).metadata.row_group(0).column(0).compression == "ZSTD"
