import gzip

import pytest
from oracle import connect, differences

from forecourt.llm import warc
from forecourt.llm.oracles import ORACLES
from forecourt.llm.queries import QUERIES

PAGES = "page_id long, url string, html string, digest string, last string, original string"


def pages(spark, rows):
    return spark.createDataFrame([(*row, "x", "x", "x") for row in rows], PAGES)


ROWS = [
    (1, "http://a/1", "same"), (2, "http://a/2", "same"), (9, "http://a/9", "same"), (4, "http://b/ x\r\n", "other\r\n\r\nbody"),
    (5, None, None), (6, "u", ""), (7, "ü", "é" * 200_000), (None, "n", "same"), (None, "n", "alone"), (4, "http://b/ x\r\n", "other\r\n\r\nbody"),
]


def test_records_come_back(spark):
    found = {(r.page_id, r.payload_digest): r for r in warc.round_trip(spark, pages(spark, ROWS)).collect()}
    for page_id, url, page in ROWS:
        payload = (page or "").encode()
        row = found[page_id, warc.digest_of(payload)]
        original = {"same": 9, "": 6}.get(page or "")
        revisit = original not in (None, page_id)
        assert row.record_type == ("revisit" if revisit else "response")
        assert row.refers_to == (original if revisit else None)
        assert row.payload_bytes == len(payload)
        assert row.html == (None if revisit else page or "")
    assert found[4, warc.digest_of(b"other\r\n\r\nbody")].url == "http://b/%20x%0D%0A"


def test_sql_gives_the_same(spark, new_dir):
    rows = [(i, f"u{i % 5}", f"page {i % 40}" if i % 7 else None) for i in range(300)]
    spark.createDataFrame(rows, "page_id long, url string, html string").toPandas().to_parquet(f"{new_dir}/pages.parquet")
    found = QUERIES["op7_warc"](spark, new_dir).toArrow()
    assert differences(found, connect(new_dir).sql(ORACLES["op7_warc"]).to_arrow_table()) == []


def test_small_payloads_are_all_responses(spark, new_dir):
    index = warc.write_archives(pages(spark, ROWS), new_dir, least_bytes=5)
    types = [r.record_type for r in warc.read_archives(index, new_dir).collect()]
    assert types.count("revisit") == 0 and len(types) == len(ROWS)


def test_some_records_are_read_by_their_ranges(spark, new_dir):
    rows = [(i, f"http://x/{i}", f"text {i} " * i) for i in range(500)]
    index = warc.write_archives(pages(spark, rows), new_dir)
    chosen = warc.read_archives(index.where("url LIKE '%7'"), new_dir).collect()
    assert sorted((r.page_id, r.html) for r in chosen) == [(i, text) for i, _, text in rows if i % 10 == 7]


def test_archives_are_plain_warc(spark, new_dir):
    index = warc.write_archives(pages(spark, ROWS), new_dir)
    files = {r.file for r in index.collect()}
    text = b"".join(gzip.open(f"{new_dir}/{name}").read() for name in files)
    assert text.count(b"WARC/1.1\r\n") == len(ROWS)
    assert text.count(b"WARC-Type: revisit\r\n") == 4


def test_a_damaged_payload_is_noticed(spark, new_dir):
    member = warc.record(1, "u", b"text", None, warc.digest_of(b"other"))
    with open(f"{new_dir}/x", "wb") as file:
        file.write(member)
    index = spark.createDataFrame([("x", 0, len(member))], "file string, offset long, length long")
    with pytest.raises(Exception, match="does not have its digest"):
        warc.read_archives(index, new_dir).collect()


def test_empty_table(spark):
    assert warc.round_trip(spark, pages(spark, [])).count() == 0
