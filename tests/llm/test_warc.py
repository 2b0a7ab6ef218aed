from hashlib import sha1

import pytest

from quartergrid.llm.common import scratch
from quartergrid.llm.warc import VERSION, chained, read_archives, write_archives

FAKE = f"{VERSION}WARC-Type: response\r\nWARC-Record-ID: <urn:x-page:999>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"


def pages(spark, rows):
    return spark.createDataFrame([(*r, 3) for r in rows], "page_id long, url string, html string, offset int")


def round_trip(spark, rows, tasks=2, **options):
    folder = write_archives(pages(spark, rows).repartition(tasks), scratch(spark, "archives"), **options)
    return read_archives(spark, folder)


def expected(rows, least=1000):
    keeper = {}
    for i, _, t in rows:
        b = (t or "").encode()
        if len(b) >= least and i is not None:
            keeper[b] = max(keeper.get(b, i), i)
    out = []
    for i, u, t in rows:
        b = (t or "").encode()
        copy = keeper.get(b, i) != i
        out.append((i, u, len(b), sha1(b).hexdigest(), "revisit" if copy else "response",
                    keeper[b] if copy else None, None if copy else b))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r["page_id"], r["url"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"],
                    None if r["payload"] is None else bytes(r["payload"])) for r in df.collect()), key=repr)


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_round_trip_with_records_inside_payloads(spark, small_splits):
    rows = [(i, f"http://h/{i}?q=é ä", f"page {i} é " + "x" * (i * 37 % 900)) for i in range(60)]
    rows += [(100, "http://h/", FAKE), (101, "http://h/", "before" + FAKE + FAKE + "after"), (102, None, VERSION * 3),
             (103, "u", FAKE * 200), (104, "u", "\r\n\r\n" + VERSION), (105, "u", "")]
    for tasks in (1, 3):
        assert got(round_trip(spark, rows, tasks)) == expected(rows)


def test_revisits(spark):
    same, other = "s" * 1000, "t" * 999
    rows = [(5, "a", same), (9, "b", same), (7, "c", same), (1, "d", other), (2, "d", other), (9, "b2", same), (None, "e", same)]
    result = got(round_trip(spark, rows))
    assert result == expected(rows)
    assert sum(r[4] == "revisit" for r in result) == 3


@pytest.mark.parametrize("length", ["9" * 20, "9" * 5000, "9" * 18, "-1", "", "1e3", "٣", "0x10"])
def test_payloads_with_impossible_lengths(spark, small_splits, length):
    fake = f"{VERSION}WARC-Type: response\r\nContent-Length: {length}\r\n\r\n"
    rows = [(1, "u", f"before {fake}"), (2, "u", fake * 3), (3, "u", "plain"), (4, "u", f"x{fake}\r\n\r\n" + "y" * 5000)]
    assert got(round_trip(spark, rows)) == expected(rows)


def test_archives_of_other_writers(spark):
    def record(kind, name, block, more=""):
        return (f"{VERSION}WARC-Type: {kind}\r\nWARC-Record-ID: {name}\r\n{more}Content-Length: {len(block)}\r\n\r\n{block}\r\n\r\n")

    http = "HTTP/1.1 200 OK\r\n\r\n"
    text = record("warcinfo", "<urn:uuid:12345678-1234-1234-1234-123456789012>", "software: x")
    text += record("response", "<urn:other:123456789>", f"{http}<p>one")
    text += record("revisit", "<urn:x-page:abc>", "HTTP/1.1 200 OK\r\nContent-Length: many\r\n\r\n", "WARC-Refers-To: <urn:uuid:5>\r\n")
    text += record("response", "<urn:x-page:77>", f"{http}two")
    folder = scratch(spark, "foreign")
    spark.createDataFrame([(text.removesuffix("\r\n\r\n"),)], "value string").coalesce(1).write.option("lineSep", "\r\n\r\n").text(folder)
    found = read_archives(spark, folder).orderBy("offset").collect()
    assert [(r["record_type"], r["page_id"], r["refers_to"], r["payload_bytes"]) for r in found][1:] == [
        ("response", None, None, 6), ("revisit", None, None, 0), ("response", 77, None, 3)]
    assert len(found) == 4 and found[0]["page_id"] is None


def test_awkward_rows(spark):
    rows = [(1, None, None), (2, "x\r\nContent-Length: 7", ""), (3, "u", "z" * 2_000_000), (3, "u", "z" * 2_000_000)]
    by = {(r[0], r[2]) for r in got(round_trip(spark, rows))}
    assert by == {(1, 0), (2, 0), (3, 2_000_000)}
    assert round_trip(spark, rows[:0]).count() == 0


def test_pointer_jumping_keeps_what_the_chain_reaches(spark):
    steps = [("f", i * 10, i * 10 + 10) for i in range(100)] + [("f", 15, 20), ("f", 33, 34), ("g", 5, 9), ("h", 0, 7)]
    df = spark.createDataFrame(steps, "file string, offset long, next long")
    reached = sorted((r["file"], r["offset"]) for r in chained(df).collect())
    assert reached == [*(("f", i * 10) for i in range(100)), ("h", 0)]
