"""Response documents and CSV files."""

import gzip
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from forecourt.operators import tables
from forecourt.plans import refresh
from forecourt.schemas import API_ADVERT, API_REQUEST, api_response
from forecourt.session import scratch_path
from forecourt.sources import api_responses as api
from forecourt.sources.csv_listings import brand_from_filename, read_csv_listings

LISTING = {
    "advertId": "adv-71",
    "title": "Volvo V60 Estate",
    "subTitle": "1.6 D2 Business Auto 5dr",
    "attentionGrabber": "One owner, Diesel",
    "price": "£7,450",
    "badges": [{"type": "MILEAGE", "displayText": "81,300 miles"}],
    "trackingContext": {
        "advertContext": {"make": "Volvo", "model": "V60", "year": 2014, "price": 7450}
    },
}


def body(*listings):
    return json.dumps([{"data": {"searchResults": {"listings": list(listings)}}}])


def fetch(spark, *requests):
    rows = [(make, fuel, page, status, text) for make, fuel, page, status, text in requests]
    return api.fetch_listings(spark.createDataFrame(rows, API_REQUEST))


def test_one_listing(spark):
    rows = fetch(spark, ("BMW", None, 1, 200, body(LISTING))).select(*api.LISTING_COLUMNS).collect()
    assert [tuple(row) for row in rows] == [
        ("adv-71", "Volvo V60 Estate", "7450", 2014, 81300, "Diesel", 1.6, "Automatic")
    ]


def test_failed_request_gives_nothing(spark):
    assert fetch(spark, ("BMW", None, 1, 500, body(LISTING))).count() == 0


def test_documents_without_listings_give_nothing(spark):
    bodies = ["[{}]", "[]", "", "{broken", '[{"data": null}]', '[{"data": {"searchResults": {}}}]', body(), None]
    assert fetch(spark, *[("BMW", None, 1, 200, text) for text in bodies]).count() == 0


def test_listing_without_context_is_dropped(spark):
    bare = {k: v for k, v in LISTING.items() if k != "trackingContext"}
    rows = fetch(spark, ("BMW", None, 1, 200, body(bare, LISTING, {**LISTING, "advertId": "2"})))
    assert sorted(row.id for row in rows.collect()) == ["2", "adv-71"]


def test_pages_are_gathered_and_make_is_the_brand(spark):
    other = {**LISTING, "advertId": "7", "badges": [], "subTitle": None, "attentionGrabber": None}
    requests = [
        ("Audi", "Petrol", 1, 200, body(LISTING)),
        ("Audi", "Petrol", 2, 200, body()),
        ("BMW", "", 1, 200, body(other)),
    ]
    rows = api.bronze_rows(fetch(spark, *requests)).orderBy("brand").collect()
    assert [(r.id, r.brand, r.fuelType, r.mileage, r.price) for r in rows] == [
        ("adv-71", "Audi", "Petrol", 81300, "7450"),
        ("7", "BMW", "Unknown", 0, "7450"),
    ]


def test_fields_that_are_not_wanted_change_nothing(spark):
    values = ['"a"', "7", "null", "true", "{}", "[]", '{"x": [1]}', r'"a\qb"', r'"\u12"', '"a\nb"', "tru", '"cut']
    values += ['[{"type": "MILEAGE", "displayText": 5}]', '{"advertContext": {"year": "x"}}', '{"advertContext": "q"}']
    document = body(LISTING, "odd", LISTING, None, {**LISTING, "subTitle": None})
    odd = ['{"subTitle": "s", "trackingContext": {}, "%s": %s}', '{"%s": %s, "subTitle": "s", "trackingContext": {}}']
    names = ["title", "badges", "trackingContext", "subTitle", "other"]
    bodies = [document.replace('"odd"', form % (name, value)) for form in odd for name in names for value in values]
    bodies += [document[:end] for end in range(0, len(document), 9)]
    bodies += [document + "]", "[]", "[{}]", "{broken", "<p>[503]</p>", '{"data": null}', document[1:-1], None]
    frame = spark.createDataFrame(list(enumerate(bodies)), "id int, body string")

    def listings(parsed):
        fields = F.transform("listings", lambda x: F.struct(x["subTitle"], x["trackingContext"].isNotNull()))
        found = parsed.select("id", F.array_size("listings").alias("size"), F.to_json(fields).alias("fields"))
        return [tuple(row) for row in found.orderBy("id").collect()]

    wanted = api.with_listings(frame, "subTitle")
    assert wanted.schema["listings"].dataType.elementType.names == ["trackingContext", "subTitle"]
    whole = listings(api.with_listings(frame))
    assert listings(wanted) == whole == listings(api.with_listings(frame, "subTitle", "trackingContext"))
    assert sum(size is not None for _, size, _ in whole) > 100
    # What they gave when every document was parsed whole.
    plain = F.try_element_at(F.from_json("body", api_response(API_ADVERT)), F.lit(1))["data"]["searchResults"]["listings"]
    assert listings(frame.withColumn("listings", plain)) == whole


def test_stored_responses_are_read(spark, new_dir):
    line = {"make": "BMW", "fuel_filter": None, "page": 1, "status_code": 200, "body": body(LISTING)}
    Path(new_dir, "day1.json").write_text(json.dumps(line) + "\n")
    assert api.fetch_listings(api.read_responses(spark, new_dir)).count() == 1


HEADER = "model,year,price,transmission,mileage,fuelType,tax,mpg,engineSize\n"
GOOD = "A4,2017,12500,Manual,15735,Petrol,150,55.4,1.4\n"


def write_csv(folder):
    Path(folder, "audi.csv").write_text(
        HEADER
        + GOOD
        + "A1,word,12500,Manual,15735,Petrol,150,55.4,1.4\n"
        + "A2,2017,12500\n"
        + "A3,2017,12500,Manual,15735,Petrol,150,55.4,1.4,extra\n"
        + "A5,2016,,Manual,15735,Diesel,150,55.4,2.0\n"
    )
    with gzip.open(Path(folder, "land rover.csv.gz"), "wt") as file:
        file.write(HEADER + GOOD)
    Path(folder, "bmw.csv").mkdir()
    for part in range(2):
        Path(folder, "bmw.csv", f"part-{part:05d}.csv").write_text(HEADER + GOOD)
    Path(folder, "notes.txt").write_text("no listing")


def test_brand_is_the_stem_of_the_file(spark):
    paths = {
        "file:/lake/audi.csv": "AUDI",
        "s3a://lake/in/land%20rover.csv.gz": "LAND ROVER",
        "s3a://lake/in/bmw.csv/part-00000-x.c000.csv": "BMW",
        "s3a://lake/in/part-time.csv": "PART-TIME",
        "s3a://lake/in.csv/vw.csv": "VW",
        "s3a://lake/in/a+b%231.v2.csv": "A+B#1.V2",
    }
    frame = spark.createDataFrame([(path,) for path in paths], "path string").coalesce(1)
    got = [row[0] for row in frame.select(brand_from_filename(F.col("path"))).collect()]
    assert got == list(paths.values())


def test_bad_rows_are_skipped(spark, new_dir):
    write_csv(new_dir)
    frame = read_csv_listings(spark, new_dir)
    rows = sorted((r.brand, r.model, r.price) for r in frame.collect())
    assert rows == [
        ("AUDI", "A4", 12500), ("AUDI", "A5", None), ("BMW", "A4", 12500), ("BMW", "A4", 12500),
        ("LAND ROVER", "A4", 12500),
    ]


def test_what_is_bad_does_not_depend_on_the_columns_read(spark, new_dir):
    write_csv(new_dir)
    frame = read_csv_listings(spark, new_dir)
    assert frame.count() == 5
    assert len(frame.select("model").collect()) == 5
    assert frame.agg(F.count("price").alias("n")).first().n == 4
    assert frame.where(F.col("year") > 2000).count() == 5


def test_loads_append_to_bronze_tables(spark, new_dir):
    root = scratch_path(spark, "layers")
    bronze = tables.create_layers(spark, root, prefix=f"b_{root.split('/')[-2][:8]}_").bronze
    write_csv(new_dir)

    def load():
        refresh.load_csv(spark, new_dir, f"{bronze}.csv_listings")
        return dict(map(tuple, refresh.loaded_csv(spark, f"{bronze}.csv_listings").groupBy("brand").count().collect()))

    first = {"AUDI": 2, "BMW": 2, "LAND ROVER": 1}
    assert load() == first and load() == first
    Path(new_dir, "a[b]{c}.csv").write_text(HEADER + GOOD)
    assert load() == first | {"A[B]{C}": 1}
    with Path(new_dir, "audi.csv").open("a") as file:
        file.write(GOOD)
    assert load() == first | {"A[B]{C}": 1, "AUDI": 5}

    requests = [("Audi", "Petrol", 1, 200, body(LISTING)), ("Audi", "Petrol", 2, 500, body(LISTING))]
    refresh.ingest_responses(spark.createDataFrame(requests, API_REQUEST), f"{bronze}.api_listings")
    (row,) = spark.table(f"{bronze}.api_listings").collect()
    assert (row.brand, row.price, row.fuelType) == ("Audi", "7450", "Petrol") and row.search_timestamp


def test_a_load_that_fails_between_its_two_writes_is_repeated_exactly(spark, new_dir, monkeypatch):
    root = scratch_path(spark, "layers")
    table = f"{tables.create_layers(spark, root, prefix=f'f_{root.split('/')[-2][:8]}_').bronze}.csv_listings"
    folder = Path(new_dir, "in")
    folder.mkdir()
    write_csv(folder)

    def fail(rows, name):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(refresh, "insert_columns", fail)
        with pytest.raises(RuntimeError):
            refresh.load_csv(spark, str(folder), table)
    assert spark.table(f"{table}_loads").count() == 0
    Path(folder, "vw.csv").write_text(HEADER + GOOD)  # arrives before the second try
    for _ in range(2):
        refresh.load_csv(spark, str(folder), table)
    assert refresh.loaded_csv(spark, table).count() == 6 and spark.table(f"{table}_loads").count() == 5
    report = refresh.load_report(spark, table).groupBy("brand").agg(F.sum("loaded"), F.sum("rejected")).collect()
    assert sorted(map(tuple, report)) == [("AUDI", 2, 3), ("BMW", 2, 0), ("LAND ROVER", 1, 0), ("VW", 1, 0)]
    lines = sorted(row.line for row in spark.table(table).where("rejected").collect())
    assert lines == ["A1,word,12500,Manual,15735,Petrol,150,55.4,1.4", "A2,2017,12500",
                     "A3,2017,12500,Manual,15735,Petrol,150,55.4,1.4,extra"]
