"""Change feeds and file arrival: parity with batch, and second runs that add nothing."""

import datetime
from pathlib import Path

import pytest
from conftest import SF_DIR
from py4j.protocol import Py4JJavaError
from test_operators import api_row
from test_sources import GOOD, HEADER

from forecourt.operators import keyed, tables
from forecourt.plans import refresh
from forecourt.registry.inputs import listings_stream
from forecourt.schemas import API_LISTING, CSV_LISTING, FACT, columns_of
from forecourt.session import scratch_path
from forecourt.sources.csv_listings import read_csv_listings
from forecourt.streaming import change_feed as feed, commit_log, compaction

CHANGES = API_LISTING + ", _action string"


def write_changes(spark, path, rows):
    spark.createDataFrame(rows, CHANGES).coalesce(1).write.mode("append").parquet(path)


def ordered(frame):
    return sorted(map(str, frame.collect()))


def test_inserts_reach_the_facts_once_and_like_in_batch(spark, new_dir):
    source, sink, checkpoint = f"{new_dir}/changes", f"{new_dir}/facts", f"{new_dir}/checkpoint"
    write_changes(
        spark,
        source,
        [
            (*api_row("1", "BMW X", "£12,500"), "INSERT"),
            (*api_row("1", "BMW X", "£12,500"), "DELETE"),
            (*api_row("1", "BMW X", "POA", mileage=0), "INSERT"),
        ],
    )
    stream = feed.api_cdc_facts(feed.read_parquet_stream(spark, source, CHANGES))
    assert feed.run_increment(stream, sink, checkpoint) == 3
    assert feed.run_increment(stream, sink, checkpoint) == 0
    write_changes(spark, source, [(*api_row("2", "BMW Y", None, fuelType="Petrol"), "INSERT")])
    assert feed.run_increment(stream, sink, checkpoint) == 1

    got = spark.read.schema(FACT).parquet(sink)
    assert got.columns == list(columns_of(FACT))
    assert ordered(got) == ordered(feed.api_cdc_facts(spark.read.parquet(source)))
    by_price = {(r.model, r.price): r.price_per_mile for r in got.collect()}
    assert by_price == {("BMW X", 12500): 1250.0, ("BMW X", None): None, ("BMW Y", None): None}


def test_one_brand_feed(spark, new_dir):
    rows = [("C", 2016, 100, "Manual", 0, "Diesel", 20, 50.0, 2.0, action) for action in ("INSERT", "DELETE")]
    spark.createDataFrame(rows, CSV_LISTING + ", _action string").write.parquet(f"{new_dir}/changes")
    changes = feed.read_parquet_stream(spark, f"{new_dir}/changes", CSV_LISTING + ", _action string")
    feed.run_increment(feed.cdc_insert_facts(changes, "MERCEDES"), f"{new_dir}/facts", f"{new_dir}/cp")
    (row,) = spark.read.parquet(f"{new_dir}/facts").collect()
    assert (row.brand, row.is_ulez_compliant, row.price_per_mile, row.tax) == ("MERCEDES", True, None, 20)


def test_service_trigger(spark, new_dir):
    write_changes(spark, f"{new_dir}/changes", [(*api_row(), "INSERT")])
    stream = feed.api_cdc_facts(feed.read_parquet_stream(spark, f"{new_dir}/changes", CHANGES))
    service = feed.start_append(stream, f"{new_dir}/facts", f"{new_dir}/cp", every="1 second")
    try:
        service.processAllAvailable()
    finally:
        service.stop()
    assert spark.read.parquet(f"{new_dir}/facts").count() == 1


def test_new_files_are_loaded_once_and_others_ignored(spark, new_dir):
    source = Path(new_dir, "in")
    source.mkdir()
    (source / "audi.csv").write_text(HEADER + GOOD + "broken line\n")
    (source / "readme.txt").write_text(HEADER + GOOD)
    arrivals = read_csv_listings(spark, str(source), stream=True, max_files_per_batch=1)
    sink, checkpoint = f"{new_dir}/bronze", f"{new_dir}/cp"
    feed.run_increment(arrivals, sink, checkpoint)
    assert feed.run_increment(arrivals, sink, checkpoint) == 0
    (source / "bmw.csv").write_text(HEADER + GOOD)
    feed.run_increment(arrivals, sink, checkpoint)
    assert sorted(r.brand for r in spark.read.parquet(sink).collect()) == ["AUDI", "BMW"]


@pytest.fixture
def silver(spark):
    root = scratch_path(spark, "layers")
    return tables.create_layers(spark, root, prefix=f"s_{root.split('/')[-2][:8]}_").silver


def test_adverts_are_added_once_and_the_seen_ones_survive_a_restart(spark, new_dir, silver):
    table = f"{silver}.adverts"
    feed.create_load_table(spark, table, API_LISTING)
    late = datetime.datetime(2024, 6, 1)
    nameless = [api_row(None)] * 3
    first = [api_row("1"), api_row("1", price="5", search_timestamp=late), api_row("2"), *nameless]
    spark.createDataFrame(first, API_LISTING).write.parquet(f"{new_dir}/in")
    for _ in range(2):
        stream = feed.read_parquet_stream(spark, f"{new_dir}/in", API_LISTING)
        feed.run_dedup_increment(stream, table, f"{new_dir}/cp")
    again = [api_row("2"), api_row("3"), api_row("1", search_timestamp=late + datetime.timedelta(1)), *nameless]
    spark.createDataFrame(again, API_LISTING).write.mode("append").parquet(f"{new_dir}/in")
    feed.run_dedup_increment(feed.read_parquet_stream(spark, f"{new_dir}/in", API_LISTING), table, f"{new_dir}/cp")
    rows = [(r.id, r.price) for r in spark.table(table).collect()]
    price = api_row()[3]
    assert sorted(rows, key=str) == sorted([("1", "5"), ("2", price), ("3", price)] + [(None, price)] * 6, key=str)
    state = [p.name for p in Path(new_dir, "cp", "state").rglob("*.zip")]
    assert state  # RocksDB snapshots in the shared checkpoint


def test_files_per_batch_do_not_grow(spark, new_dir, silver):
    table = f"{silver}.steady"
    feed.create_load_table(spark, table, API_LISTING)
    counts = []
    for number in range(3):
        rows = [api_row(str(i)) for i in range(number * 150, number * 150 + 200)]
        spark.createDataFrame(rows, API_LISTING).write.mode("append").parquet(f"{new_dir}/in")
        feed.run_dedup_increment(feed.read_parquet_stream(spark, f"{new_dir}/in", API_LISTING), table, f"{new_dir}/cp")
        counts.append(len(spark.table(table).inputFiles()))
    assert counts == [1, 2, 3] and spark.table(table).count() == 500


def test_a_replayed_batch_replaces_itself(spark, new_dir, silver):
    """The last commit is lost, so the micro-batch runs again: from the same state, into the same partition."""
    table, checkpoint = f"{silver}.replayed", f"{new_dir}/cp"
    feed.create_load_table(spark, table, API_LISTING)
    for number, rows in enumerate([[api_row("1"), api_row(None)], [api_row("1"), api_row("2"), api_row(None)]]):
        spark.createDataFrame(rows, API_LISTING).write.mode("append").parquet(f"{new_dir}/in")
        feed.run_dedup_increment(feed.read_parquet_stream(spark, f"{new_dir}/in", API_LISTING), table, checkpoint)
        for name in (f"{number}", f".{number}.crc"):
            Path(checkpoint, "commits", name).unlink(missing_ok=True)
        feed.run_dedup_increment(feed.read_parquet_stream(spark, f"{new_dir}/in", API_LISTING), table, checkpoint)
    assert sorted(str(r.id) for r in spark.table(table).collect()) == ["1", "2", "None", "None"]


NET = API_LISTING + ", _row_id bigint, _seq bigint, _action string"


def test_net_changes_per_key(spark):
    def change(key, seq, action, price="1"):
        return (*api_row(str(key), price=price), key, seq, action)

    rows = [
        change(1, 1, "INSERT"), change(1, 2, "DELETE"),  # came and went
        change(2, 1, "INSERT", "1"), change(2, 2, "DELETE", "1"), change(2, 3, "INSERT", "2"),  # came, updated
        change(3, 1, "DELETE", "1"), change(3, 2, "INSERT", "2"), change(3, 3, "DELETE", "2"), change(3, 4, "INSERT", "3"),
        change(4, 1, "DELETE"),  # went
        change(5, 1, "DELETE", "1"), change(5, 2, "INSERT", "2"), change(5, 3, "DELETE", "2"),  # updated, then went
        change(6, 7, "INSERT", "b"), change(6, 7, "DELETE", "a"),  # a tie: the DELETE comes first
        change(None, 1, "INSERT"), change(None, 1, "INSERT"), change(None, 2, "DELETE"),  # no key: as they are
    ]
    net = keyed.net_changes(spark.createDataFrame(rows, NET).repartition(4), "_row_id", "_seq")
    assert net.columns == [name for name in columns_of(NET)]
    found = sorted((str(r["_row_id"]), r["_action"], r.price) for r in net.collect())
    assert found == sorted([
        ("2", "INSERT", "2"), ("3", "DELETE", "1"), ("3", "INSERT", "3"), ("4", "DELETE", "1"), ("5", "DELETE", "1"),
        ("6", "DELETE", "a"), ("6", "INSERT", "b"), ("None", "INSERT", "1"), ("None", "INSERT", "1"), ("None", "DELETE", "1"),
    ])


def test_increments_are_folded_one_by_one(spark, new_dir, silver):
    table = f"{silver}.net"
    feed.create_load_table(spark, table, FACT)
    increments = [
        [(*api_row("1", "A"), 1, 1, "INSERT"), (*api_row("2", "B"), 2, 1, "INSERT"), (*api_row("2", "B"), 2, 2, "DELETE")],
        [(*api_row("1", "A"), 1, 2, "DELETE"), (*api_row("1", "A2"), 1, 3, "INSERT")],
    ]
    for rows in increments:
        spark.createDataFrame(rows, NET).coalesce(1).write.mode("append").parquet(f"{new_dir}/log")
        log = feed.read_parquet_stream(spark, f"{new_dir}/log", NET)
        for _ in range(2):
            feed.run_net_increment(log, table, f"{new_dir}/cp", feed.api_cdc_facts)
    assert sorted(r.model for r in spark.table(table).collect()) == ["A", "A2"]


def test_many_increments_compact_into_few_files(spark, new_dir):
    source, sink, checkpoint = f"{new_dir}/changes", f"{new_dir}/facts", f"{new_dir}/cp"
    rows = [(*api_row(str(i), f"CAR {i}"), "INSERT") for i in range(100)]
    spark.createDataFrame(rows, CHANGES).repartition(100).write.option("maxRecordsPerFile", 1).parquet(source)
    n_files = len(spark.read.parquet(source).inputFiles())
    stream = feed.api_cdc_facts(feed.read_parquet_stream(spark, source, CHANGES, max_files_per_batch=1))
    feed.run_increment(stream, sink, checkpoint)
    assert n_files == 100 and len(spark.read.parquet(sink).inputFiles()) == 100  # one per increment
    assert compaction.compact(spark, sink, FACT) == 100
    compacted = compaction.streamed_rows(spark, sink, FACT)
    assert len(compacted.inputFiles()) == 1 and sorted(r.model for r in compacted.collect()) == sorted(r[2] for r in rows)

    # The stream goes on, then a compaction fails before its commit, then one succeeds.
    write_changes(spark, source, [(*api_row("x", "NEW"), "INSERT")])
    feed.run_increment(stream, sink, checkpoint)
    every = sorted([r[2] for r in rows] + ["NEW"])
    assert sorted(r.model for r in compaction.streamed_rows(spark, sink, FACT).collect()) == every
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(compaction.log, "write_new", lambda *args: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            compaction.compact(spark, sink, FACT)
    assert sorted(r.model for r in compaction.streamed_rows(spark, sink, FACT).collect()) == every
    assert compaction.compact(spark, sink, FACT) == 2
    assert compaction.drop_replaced(spark, sink) == 100
    again = compaction.streamed_rows(spark, sink, FACT)
    assert len(again.inputFiles()) == 1 and sorted(r.model for r in again.collect()) == every
    assert compaction.compact(spark, sink, FACT, file_bytes=1) == 0  # nothing is small


def test_of_two_compactions_at_once_one_fails(spark, new_dir):
    commit_log.write_new(spark, f"{new_dir}/commits/1", "a")
    with pytest.raises(Py4JJavaError):
        commit_log.write_new(spark, f"{new_dir}/commits/1", "b")
    assert commit_log.read_text(spark, f"{new_dir}/commits/1") == "a"


def test_logs_are_read_up_to_a_number_and_through_their_own_compaction(spark, new_dir):
    source, sink, checkpoint = f"{new_dir}/changes", f"{new_dir}/facts", f"{new_dir}/cp"
    stream = None
    for i in range(12):
        write_changes(spark, source, [(*api_row(str(i), f"CAR {i}"), "INSERT")])
        stream = stream or feed.api_cdc_facts(feed.read_parquet_stream(spark, source, CHANGES))
        feed.run_increment(stream, sink, checkpoint)
    assert commit_log.last_committed(spark, checkpoint) == 11
    assert any(name.endswith(".compact") for name in commit_log.names_in(spark, f"{sink}/{commit_log.SINK_LOG}"))
    for upto in (0, 8, 9, 10, 11):
        taken = commit_log.logged_files(spark, f"{checkpoint}/sources/0", commit_log.source_number(spark, checkpoint, upto))
        committed = commit_log.plain_paths(commit_log.logged_files(spark, f"{sink}/{commit_log.SINK_LOG}", upto))
        assert taken.count() == upto + 1
        assert spark.read.schema(FACT).parquet(*committed).count() == upto + 1


def test_backfill_stops_at_the_fence(spark, new_dir, silver):
    """What the stream takes or commits behind the fence does not change the backfill."""
    source, sink, checkpoint = f"{new_dir}/a b/changes", f"{new_dir}/facts", f"{new_dir}/cp"
    table = f"{silver}.fenced"
    tables.create_if_absent(spark, table, FACT)
    write_changes(spark, source, [(*api_row("1", "NEW"), "INSERT"), (*api_row("2", "GONE"), "DELETE"), (*api_row("3", "LATER"), "DELETE")])
    stream = feed.api_cdc_facts(feed.read_parquet_stream(spark, source, CHANGES))
    assert refresh.fenced_backfill(spark, CHANGES, table, sink, checkpoint) is None
    feed.run_increment(stream, sink, checkpoint)
    write_changes(spark, source, [(*api_row("4", "LATER"), "INSERT"), (*api_row("5", "LAST"), "DELETE")])
    feed.run_increment(stream, sink, checkpoint)
    for name in ("1", ".1.crc"):  # the second micro-batch is not finished yet, its files are there
        Path(checkpoint, "commits", name).unlink(missing_ok=True)
    assert refresh.fenced_backfill(spark, CHANGES, table, sink, checkpoint) == 0
    assert sorted(r.model for r in spark.table(table).collect()) == ["GONE", "LATER"]
    feed.run_increment(stream, sink, checkpoint)
    assert refresh.fenced_backfill(spark, CHANGES, table, sink, checkpoint) == 1
    assert sorted(r.model for r in feed.all_facts(spark, table, sink).collect()) == ["GONE", "LAST", "LATER", "LATER", "NEW"]


def test_no_batch_is_forgotten_in_the_count(spark, new_dir):
    rows = [(*api_row(str(i)), "INSERT") for i in range(110)]
    spark.createDataFrame(rows, CHANGES).repartition(110).write.option("maxRecordsPerFile", 1).parquet(f"{new_dir}/changes")
    changes = feed.read_parquet_stream(spark, f"{new_dir}/changes", CHANGES, max_files_per_batch=1)
    assert feed.run_increment(feed.api_cdc_facts(changes), f"{new_dir}/facts", f"{new_dir}/cp") == 110


def test_batch_loaded_and_streamed_facts_are_read_together(spark, new_dir, silver):
    table = f"{silver}.fct_cars"
    tables.create_if_absent(spark, table, FACT)
    tables.insert_columns(spark.createDataFrame([("OLD", 1)], "model string, price bigint"), table)
    write_changes(spark, f"{new_dir}/changes", [(*api_row("1", "NEW"), "INSERT")])
    stream = feed.api_cdc_facts(feed.read_parquet_stream(spark, f"{new_dir}/changes", CHANGES))
    feed.run_increment(stream, f"{new_dir}/facts", f"{new_dir}/cp")
    assert sorted(r.model for r in feed.all_facts(spark, table, f"{new_dir}/facts").collect()) == ["NEW", "OLD"]


def test_the_listings_stream_reads_one_file_or_many(spark, new_dir):
    spark.read.parquet(f"{SF_DIR}/lineitem.parquet").repartition(3).write.parquet(f"{new_dir}/lineitem.parquet")
    spark.read.parquet(f"{SF_DIR}/part.parquet").write.parquet(f"{new_dir}/part.parquet")
    counts = [
        feed.run_increment(listings_stream(spark, folder), scratch_path(spark, "out"), scratch_path(spark, "cp"))
        for folder in (SF_DIR, new_dir)
    ]
    assert counts[0] == counts[1] > 0


def test_the_state_of_an_advert_holds_each_value_once(spark):
    early, late = (datetime.datetime(2024, 1, day) for day in (1, 2))
    rows = [("a", early, "x", 1), ("a", late, "z", 2), ("a", late, None, 3), ("b", None, "y", None), ("b", None, None, 5), (None, late, None, 6)]
    first = feed.new_adverts(spark.createDataFrame(rows, "id string, search_timestamp timestamp, title string, year int"))
    assert ordered(first) == ordered(spark.createDataFrame([rows[1], rows[3], rows[5]], first.schema))
    assert "row, struct" not in first._jdf.queryExecution().analyzed().toString()
