"""Tables, keyed operators and reshaping."""

import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from forecourt.functions import text
from forecourt.operators import keyed, shape, tables
from forecourt.plans import facts as facts_of_feed, marts, quality, refresh
from forecourt.schemas import API_LISTING, CLUSTER_MART, FACT, columns_of
from forecourt.session import scratch_path, scratch_root, shuffle_partitions


@pytest.fixture
def layers(spark):
    root = scratch_path(spark, "layers")
    return tables.create_layers(spark, root, prefix=f"t_{root.split('/')[-2][:8]}_")


def api_row(id="1", title="BMW X", price="£1,000", **other):
    values = {
        "id": id, "brand": "BMW", "title": title, "price": price, "year": 2018, "mileage": 10,
        "fuelType": "Diesel", "engineSize": 2.0, "transmission": "Manual",
        "search_timestamp": datetime.datetime(2024, 1, 1),
    }
    return tuple({**values, **other}.values())


def test_namespaces_carry_comments_and_can_be_created_twice(spark, layers):
    tables.create_layers(spark, scratch_root(spark), prefix=layers.bronze.removesuffix("bronze"))
    assert spark.catalog.getDatabase(layers.gold).description == tables.LAYER_COMMENTS["gold"]


def test_load_time_is_stamped(spark, layers):
    table = f"{layers.bronze}.api_listings"
    for _ in range(2):
        tables.create_if_absent(spark, table, API_LISTING, {"search_timestamp": "current_timestamp()"})
    rows = spark.createDataFrame([api_row()], API_LISTING).drop("search_timestamp")
    for _ in range(2):
        tables.bronze_append(rows, table)
    assert spark.table(table).where("search_timestamp IS NOT NULL").count() == 2


def test_columns_are_added_once(spark, layers):
    table = f"{layers.bronze}.few"
    tables.create_if_absent(spark, table, "id string, title string")
    tables.insert_columns(spark.createDataFrame([("1", "a")], "id string, title string"), table)
    assert tables.add_missing_columns(spark, table, "Title string, brand string") == ["brand"]
    assert tables.add_missing_columns(spark, table, "brand string") == []
    tables.insert_columns(spark.createDataFrame([("2", "BMW")], "id string, brand string"), table)
    rows = {row.id: (row.title, row.brand) for row in spark.table(table).collect()}
    assert rows == {"1": ("a", None), "2": (None, "BMW")}


def test_replace_rows_keeps_the_schema(spark, layers):
    table = f"{layers.gold}.mart"
    tables.create_if_absent(spark, table, CLUSTER_MART)
    for name in ("a", "b"):
        rows = spark.createDataFrame([(name, 5)], "cluster_name string, price int")
        tables.replace_rows(rows, table)
    assert [(r.cluster_name, r.price, r.brand) for r in spark.table(table).collect()] == [("b", 5.0, None)]
    assert spark.table(table).schema["price"].dataType.simpleString() == "double"


def test_materialized_table_is_partitioned_and_rebuilt(spark, layers):
    table = f"{layers.silver}.facts"
    for price in (1, 2):
        rows = spark.createDataFrame([("BMW", price), ("AUDI", price)], "brand string, price int")
        out = tables.table_materialize(rows, table, partition_by=["brand"])
    assert out.columns == ["brand", "price"]
    assert sorted(map(tuple, out.collect())) == [("AUDI", 2), ("BMW", 2)]
    plan = spark.table(table).where("brand = 'BMW'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(brand" in plan


def folder_of(spark, table):
    (row,) = spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Location'").collect()
    return Path(row.data_type.removeprefix("file:"))


@pytest.mark.parametrize("partitions", [[], ["brand"]])
def test_a_job_that_fails_half_way_leaves_the_old_rows(spark, layers, partitions):
    table = f"{layers.gold}.steady{len(partitions)}"
    old = spark.createDataFrame([("BMW", 1), ("AUDI", 2)], "brand string, price int")
    tables.table_materialize(old, table, partition_by=partitions)
    late = F.when(F.col("id") == 90_000, F.raise_error(F.lit("lost")).cast("string")).otherwise("BMW")
    broken = spark.range(0, 100_000, 1, 10).select(late.alias("brand"), F.col("id").cast("int").alias("price"))
    for write in (lambda: tables.table_materialize(broken, table, partitions), lambda: tables.replace_rows(broken, table)):
        with pytest.raises(Exception, match="lost"):
            write()
        assert sorted(map(tuple, spark.table(table).select("brand", "price").collect())) == [("AUDI", 2), ("BMW", 1)]


@pytest.mark.parametrize("partitions", [[], ["brand"]])
def test_a_reader_of_the_old_version_can_finish_and_older_ones_go(spark, layers, partitions):
    table = f"{layers.gold}.versions{len(partitions)}"
    folders, readers = [], []
    for price in range(4):
        rows = spark.createDataFrame([("BMW", price), ("AUDI", price)], "brand string, price int")
        tables.table_materialize(rows, table, partition_by=partitions)
        folders.append(folder_of(spark, table))
        readers.append(spark.read.parquet(str(folders[-1])))
    assert [folder.exists() for folder in folders] == [False, False, True, True]
    assert {r.price for r in readers[2].collect()} == {2} and {r.price for r in spark.table(table).collect()} == {3}
    tables.insert_columns(spark.createDataFrame([("VW", 9)], "brand string, price int"), table)
    assert sorted(r.brand for r in spark.table(table).collect()) == ["AUDI", "BMW", "VW"]


def test_a_rebuilt_table_may_have_other_columns_and_read_itself(spark, layers):
    table = f"{layers.gold}.changing"
    tables.table_materialize(spark.createDataFrame([(1,)], "price int"), table)
    tables.table_materialize(spark.createDataFrame([("a", 2.5)], "brand string, price double"), table)
    assert list(map(tuple, spark.table(table).collect())) == [("a", 2.5)]
    tables.table_materialize(spark.table(table).withColumn("price", F.col("price") + 1), table)
    assert list(map(tuple, spark.table(table).collect())) == [("a", 3.5)]


def test_view_is_computed_on_read(spark, layers):
    table = f"{layers.silver}.grows"
    tables.create_if_absent(spark, table, "id string")
    view = tables.view_materialize(spark.table(table).groupBy().count(), "how_many")
    assert view.first()[0] == 0
    tables.insert_columns(spark.createDataFrame([("1",)], "id string"), table)
    assert spark.sql("SELECT * FROM how_many").first()[0] == 1


def test_missing_mart_is_empty(spark, layers):
    empty = tables.read_or_empty(spark, f"{layers.gold}.none", CLUSTER_MART)
    assert empty.count() == 0 and "cluster_name" in empty.columns
    facts = spark.createDataFrame([(1, 2, 3), (None, 2, 3)], "price int, mileage int, year int")
    report = quality.quality_counts(spark, facts, f"{layers.gold}.none").collect()
    assert sorted(map(tuple, report)) == [("total", 2), ("valid", 1)]


def test_backfill_lets_null_titles_and_repeats_pass(spark):
    raw = spark.createDataFrame([("a",), ("b",), ("b",), (None,), (None,)], "title string")
    facts = spark.createDataFrame([("a",), ("a",), (None,)], "model string")
    left = keyed.backfill_anti_join(raw, facts).collect()
    assert sorted(str(row.title) for row in left) == ["None", "None", "b", "b"]


def test_backfill_twice_adds_nothing(spark, layers):
    table = f"{layers.silver}.fct_cars"
    tables.create_if_absent(spark, table, FACT)
    raw = spark.createDataFrame([api_row("1", "BMW X"), api_row("2", "BMW Y", "POA")], API_LISTING)
    refresh.stream_backfill(raw, table)
    refresh.stream_backfill(raw, table)
    rows = {r.model: (r.price, r.tax, r.is_ulez_compliant) for r in spark.table(table).collect()}
    assert spark.table(table).count() == 2
    assert rows == {"BMW X": (1000, None, True), "BMW Y": (None, None, True)}


def test_backfill_sees_what_the_stream_has_appended(spark, layers, new_dir):
    table = f"{layers.silver}.backfilled"
    tables.create_if_absent(spark, table, FACT)
    streamed = spark.createDataFrame([api_row("1", "BMW X")], API_LISTING)
    shape.fit_columns(facts_of_feed.api_feed_facts(streamed), columns_of(FACT)).write.parquet(f"{new_dir}/facts")
    raw = spark.createDataFrame([api_row("1", "BMW X"), api_row("2", "BMW Y")], API_LISTING)
    refresh.stream_backfill(raw, table, f"{new_dir}/facts")
    assert [r.model for r in spark.table(table).collect()] == ["BMW Y"]


@pytest.mark.parametrize("clean", [text.price_clean_try, text.price_clean_strict])
def test_prices_are_rounded_whatever_cleans_them(spark, clean):
    rows = spark.createDataFrame([api_row("1", price="1,012.5"), api_row("2", price="12.4")], API_LISTING)
    staged = facts_of_feed.stage_api(rows, clean)
    assert [r.price for r in staged.collect()] == [1013, 12]
    assert dict(staged.dtypes)["price"] == "bigint"


def test_dedup_keeps_the_newest_and_repeats_to_the_same(spark):
    ddl = "id string, search_timestamp int, price int"
    unknown = [(None, 1, 1), (None, 1, 1), (None, 2, 5)]
    rows = [("1", 1, 9), ("1", 2, 8), ("1", 2, 7), ("2", None, 1), ("2", 0, 2), *unknown]
    once = keyed.listing_dedup(spark.createDataFrame(rows, ddl))
    got = sorted(map(tuple, once.collect()), key=str)
    assert got == [("1", 2, 7), ("2", 0, 2), *unknown]
    assert sorted(map(tuple, keyed.listing_dedup(once).collect()), key=str) == got


def test_union_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "id int, brand string")
    b = spark.createDataFrame([(2,)], "id int")
    assert sorted(map(tuple, shape.union_listings(a, b, b).collect())) == [(1, "x"), (2, None), (2, None)]


def test_filters_are_optional(spark):
    frame = spark.createDataFrame([("A", "Petrol"), ("B", "Diesel")], "brand string, fuel_type string")
    assert shape.dimension_filter(frame).count() == 2
    assert shape.dimension_filter(frame, brands=["A"], fuels=["Diesel"]).count() == 0
    assert shape.dimension_filter(frame, fuels=[]).count() == 0


def facts(spark, rows):
    ddl = "brand string, model string, year int, fuel_type string, is_ulez_compliant boolean, price bigint, " \
        "mileage bigint, vehicle_age int"  # fmt: skip
    return spark.createDataFrame(rows, ddl)


def test_devaluation_edges(spark):
    rows = [
        ("A", "m", 2016, "Diesel", True, 200, 1, 9),
        ("A", "m", 2010, "Diesel", False, 150, 1, 15),
        ("B", "only", 2016, "Diesel", True, 100, 1, 9),
        ("C", "free", 2016, "Diesel", True, 0, 1, 9),
        ("C", "free", 2010, "Diesel", False, 50, 1, 15),
        ("D", "petrol", 2016, "Petrol", True, 1, 1, 9),
        ("D", "petrol", 2000, "Petrol", False, 1, 1, 25),
    ]
    top = marts.diesel_devaluation_top(facts(spark, rows))
    assert [tuple(r) for r in marts.devaluation_rank(top).orderBy("rank").collect()] == [
        (1, "A", "m", 200.0, 150.0, 50.0, -25.0),
        (2, "C", "free", 0.0, 50.0, -50.0, None),
    ]
    gap = {r.brand: r.percent_diff for r in marts.brand_price_gap(facts(spark, rows)).collect()}
    assert gap == {"A": -25.0, "B": None, "C": None, "D": 0.0}
    melted = marts.melt_price_gap(marts.brand_price_gap(facts(spark, rows)))
    assert melted.count() == 8 and melted.where("avg_price IS NULL").count() == 1
    assert [r.brand for r in marts.sort_by_gap(marts.brand_price_gap(facts(spark, rows))).collect()] == [
        "A", "D", "B", "C",
    ]


def test_empty_top_has_no_rank(spark):
    assert marts.devaluation_rank(marts.diesel_devaluation_top(facts(spark, []))).count() == 0


def test_price_efficiency_uses_rounded_values(spark):
    rows = [("A", "m", 2024, "Petrol", True, 10, 1, 1), ("A", "m", 2024, "Petrol", True, 11, 1, 1)]
    row = marts.impact_summary(facts(spark, rows)).first()
    assert (row.total_listings, row.avg_price, row.price_efficiency) == (2, 10.5, 10.5)
    new = marts.impact_summary(facts(spark, [("A", "m", 2025, "Petrol", True, 10, 1, 0)])).first()
    assert new.price_efficiency is None


def test_recase(spark):
    frame = spark.createDataFrame([(1, 2)], "fuelType int, ID int")
    assert shape.recase_columns(frame).columns == ["fueltype", "id"]
    assert shape.recase_columns(frame, upper=True).columns == ["FUELTYPE", "ID"]


def test_shuffle_partitions_follow_the_data():
    assert shuffle_partitions(10**9) == 200
    assert shuffle_partitions(100 * 10**12) == 372_530


def test_filter_complete(spark):
    frame = spark.createDataFrame([(1, 1, 1), (None, 1, 1), (1, None, 1)], "price int, mileage int, year int")
    assert shape.filter_complete(frame).agg(F.count("*")).first()[0] == 1
