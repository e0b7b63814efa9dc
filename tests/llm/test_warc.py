import gzip
import hashlib
import os

import pytest

from larder.llm import warc

LONG = "<p>" + "x\r\n\r\n" * 400 + "é</p>"
PAGES = [
    (1, "http://www.Example.com:80/a?b=1#c", LONG, "clash"),
    (2, "https://example.com/a", LONG, "clash"),
    (3, "https://example.com:8080/a", LONG, "clash"),
    (4, "http://b.org", "short", ""),
    (5, "http://b.org", "short", ""),
    (6, None, None, ""),
    (7, "", "", ""),
    (8, "not a url \n at all", "x" * 1000, ""),
    (None, "http://b.org", LONG + "!", ""),
    (9, "http://[bad", "y" * 999, ""),
    (10, "http://b.org/" + "z" * 5000, "y" * 999, ""),
    (4, "http://b.org", "short", ""),
]


@pytest.fixture(scope="module")
def made(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string, digest string").repartition(3)
    narrow = df.select("page_id", "url", "html")
    archives, index = warc.new_path(spark, "w"), warc.new_path(spark, "i")
    captures = warc.write_archives(narrow, archives, archive_bytes=300)
    directory = warc.write_index(captures, index, block_lines=2)
    return captures, directory, archives, index


def test_keys():
    assert warc.url_key("http://www.Example.com:80/a?b=1#c") == "com,example,www)/a?b=1"
    assert warc.url_key("https://example.com:8080") == "com,example:8080)/"
    assert warc.url_key(None) == ")" and " " not in warc.url_key("a b\nc") and "\n" not in warc.url_key("a b\nc")


def test_round_trip_of_all_captures(made):
    captures, directory, archives, index = made
    assert directory.count() >= 5 and captures.count() == len(PAGES)
    got = warc.look_up(captures, directory, index, archives).collect()
    want = []
    for i, url, html, _ in PAGES:
        payload = (html or "").encode()
        again = i in (1, 2)
        want.append((str(i) if i is not None else None, url, "revisit" if again else "response", None if again else payload, hashlib.sha1(payload).hexdigest(), len(payload), "3" if again else None))
    names = ("page_id", "url", "record_type", "payload", "digest", "payload_bytes", "refers_to")
    rows = [tuple(bytes(r[n]) if n == "payload" and r[n] is not None else r[n] for n in names) for r in got]
    assert sorted(rows, key=str) == sorted(want, key=str)


def test_archives_are_sequences_of_gzip_members(made):
    captures, _, archives, _ = made
    used = {r["file"] for r in captures.select("file").distinct().collect()}
    assert len(used) > 3
    for name in used:
        data = gzip.decompress(open(os.path.join(archives, name), "rb").read())
        assert data.startswith(b"WARC/1.1\r\n") and data.endswith(b"\r\n\r\n")


def test_a_task_reads_a_bounded_number_of_records(spark, made, monkeypatch):
    captures, directory, archives, index = made
    monkeypatch.setattr(warc, "LOOK_UP_KEYS", 3)
    got = warc.look_up(captures, directory, index, archives)
    tasks = [r["count"] for r in got.groupBy(warc.F.spark_partition_id()).count().collect()]
    assert sum(tasks) == len(PAGES) and len(tasks) >= 3


def test_look_up_of_chosen_and_missing_keys(spark, made):
    _, directory, archives, index = made
    keys = [warc.sort_key("http://b.org", "4"), warc.sort_key("http://b.org", "77"), warc.sort_key(None, "6"), "zzz", ""]
    got = warc.look_up(spark.createDataFrame([(k,) for k in keys * 2], "key string"), directory, index, archives).collect()
    assert sorted(r["page_id"] for r in got) == ["4", "4", "6"]


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    captures, directory, archives, index = warc.archive(df)
    assert warc.look_up(captures, directory, index, archives).count() == 0


def test_damaged_record_is_noticed(spark, made):
    data = warc._record("http://a", "1", b"payload", None, False)
    assert warc.parse_record(data)[1] == b"payload"
    with pytest.raises(ValueError):
        warc.parse_record(data[:-3])
