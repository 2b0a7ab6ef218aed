"""WARC archives: a writer, and a reader that proves where records begin.

The writer is Spark's text sink with the record end as line separator. The
reader splits archives at the version line, in any number of tasks, so payloads
that hold that line give false beginnings too. Each beginning names the offset
its header says the next record has. Pointer jumping from the start of each file
keeps the beginnings that this chain reaches, in a number of rounds that grows
with the logarithm of the records of a file; bytes after a false beginning belong
to the record before it.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha1

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quartergrid.llm.common import of_checked_size, staged

#: Fixed values of the format.
VERSION = "WARC/1.1\r\n"
RECORD_END = "\r\n\r\n"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MIN_REVISIT_BYTES = 1000
_ID = "urn:x-page:"


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def records(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """(value): the text of one WARC record per page, without its end."""
    named = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce("html", F.lit("")).alias("payload"),
    ).withColumns({"bytes": F.octet_length("payload"), "digest": F.sha1(F.col("payload").cast("binary"))})
    copies = staged(
        named.filter(F.col("bytes") >= min_bytes).groupBy("digest").agg(
            F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1").select("digest", "keeper"), "copies",
    )
    placed = named.join(of_checked_size(copies), "digest", "left")
    revisit = F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))

    def urn(name: str) -> Column:
        return F.concat(F.lit(f"<{_ID}"), F.coalesce(F.col(name).cast("string"), F.lit("")), F.lit(">"))

    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"),
        _line("Content-Length", F.col("bytes").cast("string")), F.lit("\r\n"))
    block = F.concat(http, F.when(revisit, "").otherwise(F.col("payload")))
    refers = F.concat(_line("WARC-Refers-To", urn("keeper")), _line("WARC-Profile", F.lit(REVISIT)))
    address = F.regexp_replace("url", r"[\x00-\x1f\x7f]", "")
    return placed.select(F.concat(
        F.lit(VERSION), _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", urn("page_id")), _line("WARC-Date", F.lit(date)),
        F.when(F.col("url").isNull(), "").otherwise(_line("WARC-Target-URI", address)),
        F.when(revisit, refers).otherwise(""),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        _line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"), block,
    ).alias("value"))


def write_archives(pages: DataFrame, path: str, **options) -> str:
    """Write the records of ``pages``, one archive per task, and return the folder.

    Of pages with equal payloads of at least ``min_bytes`` bytes the one with the
    largest page_id is a response and the others revisit it; rows that repeat that
    page_id are responses, a page without an id revisits the others. A null html
    is an empty payload, a null url leaves its line out. Other columns are ignored.
    """
    records(pages, **options).write.option("lineSep", RECORD_END).text(path)
    return path


def _fields(header: bytes) -> dict[str, str]:
    pairs = (line.partition(b": ") for line in header.split(b"\r\n"))
    return {name.decode("latin-1").lower(): value.decode("utf-8", "replace") for name, _, value in pairs}


def _number(text: str) -> int | None:
    """A length; no file is as long as one of more than 18 digits says."""
    return int(text) if len(text) <= 18 and text.isascii() and text.isdigit() else None


def _page(name: str) -> str:
    """The page of a record id of this writer; ids of others name none."""
    return name[len(_ID) + 1 : -1] if name.startswith(f"<{_ID}") and name.endswith(">") else ""


def parse(rest: bytes) -> dict | None:
    """What follows a version line, or None if no record can begin there.

    ``size`` counts the whole record with its version line and end; the payload
    facts are there if ``rest`` holds all of it.
    """
    header, sep, body = rest.partition(b"\r\n\r\n")
    fields = _fields(header)
    length = _number(fields.get("content-length", ""))
    if not sep or length is None or "warc-type" not in fields:
        return None
    out = {"size": len(VERSION) + len(header) + 4 + length + len(RECORD_END), "type": fields["warc-type"],
           "page": _page(fields.get("warc-record-id", "")), "refers": _page(fields.get("warc-refers-to", "")),
           "url": fields.get("warc-target-uri"),
           "digest": fields.get("warc-payload-digest", "").removeprefix("sha1:")}
    block = body[:length]
    if len(block) == length and body[length:] == RECORD_END.encode():
        http, _, payload = block.partition(b"\r\n\r\n")
        if out["type"] == "revisit":
            out |= {"bytes": _number(_fields(http).get("content-length", "")) or 0, "payload": None}
        else:
            out |= {"bytes": len(payload), "digest": sha1(payload).hexdigest(), "payload": payload}
    return out


_FACTS = (("size", "long", pa.int64()), ("type", "string", pa.string()), ("page", "string", pa.string()),
          ("refers", "string", pa.string()), ("url", "string", pa.string()), ("digest", "string", pa.string()),
          ("bytes", "long", pa.int64()))


def _chunks(spark: SparkSession, path: str, raw: bool, payload: bool) -> DataFrame:
    """(file, block, local, length, facts...[, raw][, payload]) of all that version lines separate.

    ``local`` is the place within the task's block of the file: lengths are
    summed in the order in which the block is read.
    """
    found = spark.read.option("lineSep", VERSION).text(path).select(
        F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"))
    names = [n for n, _, _ in _FACTS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, at = None, 0
        for batch in batches:
            values = batch.column(0).to_pylist()
            files, blocks = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            local, facts = [], []
            for value, *here in zip(values, files, blocks):
                if here != where:
                    where, at = here, 0
                local.append(at)
                at += len(value) + len(VERSION)
                facts.append(parse(value) or {})
            columns = [batch.column(1), batch.column(2), pa.array(local, pa.int64()),
                       pa.array([len(v) for v in values], pa.int64())]
            columns += [pa.array([f.get(n) for f in facts], t) for n, _, t in _FACTS]
            columns += [batch.column(0)] * raw
            columns += [pa.array([f.get("payload") for f in facts], pa.binary())] * payload
            yield pa.RecordBatch.from_arrays(columns, names=all_names)

    all_names = ["file", "block", "local", "length", *names, *["raw"] * raw, *["payload"] * payload]
    schema = "file string, block long, local long, length long, " + ", ".join(f"{n} {t}" for n, t, _ in _FACTS)
    return found.mapInArrow(run, schema + ", raw binary" * raw + ", payload binary" * payload)


def _bases(chunks: DataFrame) -> DataFrame:
    """(file, block, base): offset of the first version line of each block."""
    lengths = chunks.groupBy("file", "block").agg(F.sum(F.col("length") + len(VERSION)).alias("total"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("total").over(before), F.lit(0)) - len(VERSION)
    return lengths.select("file", "block", base.alias("base"))


def chained(candidates: DataFrame) -> DataFrame:
    """(file, offset) of candidates (file, offset, next) that the chain from 0 reaches.

    Each round doubles the length of all jumps and of the part that is reached.
    """
    jumps = staged(candidates.select("file", "offset", "next"), "jumps")
    reached = staged(jumps.filter("offset = 0").select("file", "offset").distinct(), "reached")
    while not jumps.isEmpty():
        more = reached.join(jumps, ["file", "offset"]).select("file", F.col("next").alias("offset"))
        reached = staged(reached.unionByName(more).distinct(), "reached")
        second = jumps.select("file", F.col("offset").alias("next"), F.col("next").alias("after"))
        jumps = staged(
            jumps.join(second, ["file", "next"]).select("file", "offset", F.col("after").alias("next")), "jumps")
    return reached.join(candidates.select("file", "offset"), ["file", "offset"], "left_semi")


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The records of all archives below ``path``, one row each.

    (file, offset, page_id, url, payload_bytes, payload_digest, record_type,
    refers_to[, payload]). The digest of a response is taken from its payload, that
    of a revisit and its length from its header; a revisit has no payload. Version
    lines inside payloads begin no record, whatever lengths they claim. The page_id
    is null for records of other writers, the length of a revisit 0 if it is no number. Files that don't begin with a record
    have none; no archive gives an empty table.
    """
    chunks = staged(_chunks(spark, path, raw=False, payload=False), "chunks")
    bases = staged(_bases(chunks), "bases")
    placed = chunks.join(bases, ["file", "block"]).withColumn("offset", F.col("base") + F.col("local"))
    placed = staged(placed.withColumn("next", F.col("offset") + F.col("size")), "offsets")
    true = staged(chained(placed.filter("next is not null")), "records")
    begun = placed.join(true.withColumn("real", F.lit(True)), ["file", "offset"], "left")
    facts = [n for n, _, _ in _FACTS]
    whole = begun.filter("real and bytes is not null").select("file", "offset", *facts)
    broken = staged(begun.filter("real and bytes is null").select("file", "offset", "next"), "broken")
    if with_payload:
        own = _chunks(spark, path, raw=False, payload=True).join(bases, ["file", "block"])
        payloads = own.select("file", (F.col("base") + F.col("local")).alias("offset"), "payload")
        whole = whole.join(payloads, ["file", "offset"])
    if not broken.isEmpty():
        whole = whole.unionByName(_joined(spark, path, placed, true, broken, bases, with_payload))
    page = F.when(F.col("page") != "", F.col("page").try_cast("long"))
    refers = F.when(F.col("refers") != "", F.col("refers").try_cast("long"))
    return whole.select(
        "file", "offset", page.alias("page_id"), "url",
        F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"), refers.alias("refers_to"), *["payload"] * with_payload)


def _joined(spark, path, placed, true, broken, bases, with_payload: bool) -> DataFrame:
    """Records whose payload holds version lines, from the chunks that make them up."""
    owner = F.last(F.when(F.col("real"), F.col("offset")), ignorenulls=True).over(
        Window.partitionBy("file").orderBy("offset").rowsBetween(Window.unboundedPreceding, 0))
    owned = placed.select("file", "offset").join(
        true.withColumn("real", F.lit(True)), ["file", "offset"], "left").withColumn("record", owner)
    parts = staged(owned.join(
        broken.select("file", F.col("offset").alias("record")), ["file", "record"]
    ).select("file", "offset", "record"), "parts")
    raw = _chunks(spark, path, raw=True, payload=False).join(bases, ["file", "block"]).select(
        "file", (F.col("base") + F.col("local")).alias("offset"), "raw")
    held = raw.join(of_checked_size(parts), ["file", "offset"]).groupBy("file", "record").agg(
        F.array_sort(F.collect_list(F.struct("offset", "raw"))).alias("parts"))
    names = [n for n, _, _ in _FACTS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            joined = [VERSION.encode().join(p["raw"] for p in row) for row in batch.column(2).to_pylist()]
            facts = [parse(rest) or {} for rest in joined]
            columns = [batch.column(0), batch.column(1)] + [
                pa.array([f.get(n) for f in facts], t) for n, _, t in _FACTS]
            columns += [pa.array([f.get("payload") for f in facts], pa.binary())] * with_payload
            yield pa.RecordBatch.from_arrays(columns, names=["file", "offset", *names, *["payload"] * with_payload])

    schema = "file string, offset long, " + ", ".join(f"{n} {t}" for n, t, _ in _FACTS)
    return held.select("file", "record", "parts").mapInArrow(run, schema + ", payload binary" * with_payload)
