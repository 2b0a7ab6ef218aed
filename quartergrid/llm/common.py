"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quartergrid.session import shared_folder

#: ASCII white space, the only characters that separate words.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the cluster shares."""
    return f"{shared_folder(spark)}/{name}-{uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """The table written to the shared folder and read back: lineage ends here.

    A lost executor costs no more than the tasks of the stage it was in.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


#: Stored tables are broadcast up to so many bytes as they lie in memory.
BROADCAST_BYTES = 64 << 20
#: What a row takes in a broadcast table beside its values, and a value of fixed size.
ROW_BYTES = 32
VALUE_BYTES = 8


def bytes_in_memory(df: DataFrame) -> int:
    """An estimate from the count of rows and the lengths of texts and nested values."""
    size, fixed = F.lit(0).cast("long"), ROW_BYTES
    for name, kind in df.dtypes:
        if kind in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(name), F.lit(0))
        elif kind.startswith(("array", "map", "struct")):
            size = size + F.octet_length(F.to_json(F.struct(name)))
        fixed += VALUE_BYTES
    n, more = df.agg(F.count(F.lit(1)), F.sum(size)).first()
    return n * fixed + (more or 0)


def of_checked_size(df: DataFrame, limit: int | None = None) -> DataFrame:
    """A stored table, marked for broadcast if it takes at most ``limit`` bytes of memory.

    Beyond that it is joined by a shuffle, with the same result.
    """
    return F.broadcast(df) if fits(df, limit) else df


def fits(df: DataFrame, limit: int | None = None) -> bool:
    """Whether a stored table may be broadcast."""
    return bytes_in_memory(df) <= (BROADCAST_BYTES if limit is None else limit)


#: A key is marked in a bitmap of so many bits for each key, and 2 ** 28 (32 MB) at most.
BITS_PER_KEY = 32
BITMAP_BITS = 1 << 28
#: Bits of one row of a bitmap, as Spark's bitmap functions have it.
ROW_BITS = 1 << 15


def flagged(df: DataFrame, stored: DataFrame, on: list[str], flag: str) -> DataFrame:
    """``df`` and whether the key of a row may be in ``stored``: true for all that are, and for a few others.

    Keys are marked by hash in a bitmap, which is broadcast whatever their number; rows
    stay where they are.
    """
    size = ROW_BITS
    while size < min(BITMAP_BITS, stored.count() * BITS_PER_KEY):
        size *= 2
    place = F.pmod(F.xxhash64(*on), F.lit(size))
    row, bit = F.shiftright(place, 15).alias("row_"), F.expr(f"bit_ % {ROW_BITS}")
    # Dealt by row first: else every task sends bitmaps of its own.
    marks = stored.select(row, place.alias("bit_")).repartition("row_").groupBy("row_").agg(
        F.bitmap_construct_agg(bit).alias("marks_"))
    byte = F.expr(f"substring(marks_, cast(bit_ % {ROW_BITS} div 8 as int) + 1, 1)")
    is_set = F.expr("1 << cast(bit_ % 8 as int)").bitwiseAND(F.conv(F.hex(byte), 16, 10).cast("int")) != 0
    asked = df.select("*", row, place.alias("bit_")).join(F.broadcast(marks), "row_", "left")
    return asked.withColumn(flag, F.coalesce(is_set, F.lit(False))).drop("row_", "bit_", "marks_")


def matching(df: DataFrame, stored: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """``df.join(stored, on, how)``, an inner or left semi join with a stored table.

    If ``stored`` is too large for a broadcast, rows that can't match are left out
    before the shuffle.
    """
    on = [on] if isinstance(on, str) else on
    if fits(stored):
        return df.join(F.broadcast(stored), on, how)
    return flagged(df, stored, on, "may_match_").filter("may_match_").drop("may_match_").join(stored, on, how)


def missing(df: DataFrame, stored: DataFrame, on: str) -> DataFrame:
    """``df.join(stored, on, "left_anti")`` with a stored table; rows that can't match are not shuffled."""
    if fits(stored):
        return df.join(F.broadcast(stored), on, "left_anti")
    asked = flagged(df, stored, [on], "may_match_")
    some = asked.filter("may_match_").drop("may_match_").join(stored, on, "left_anti")
    return asked.filter("not may_match_").drop("may_match_").unionByName(some)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """What runs meanwhile sends fewer rows at a time to Python.

    Batches are buffered several times, in and beside the heap of an executor and in
    its workers; rows are whole texts.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def text_bytes(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null gives no bytes."""
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


#: Rows of a batch that are turned into Python objects at a time.
SLICE_ROWS = 1000


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in parts, so that a worker holds the objects of few rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(at, SLICE_ROWS)


def arrow_map(
    df: DataFrame, each: Callable[[pa.RecordBatch], Iterator[dict]], schema: str, **types,
) -> DataFrame:
    """``mapInArrow`` of a function from a batch to dictionaries of columns.

    ``types`` gives the Arrow type of each column of ``schema``, in order.
    """
    fields = pa.schema(list(types.items()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            for columns in each(batch):
                arrays = [pa.array(columns[f.name], f.type) for f in fields]
                yield pa.RecordBatch.from_arrays(arrays, schema=fields)

    return df.mapInArrow(run, schema)


def digest_of(words: Column) -> Column:
    """Lower-case hex SHA-256 of words joined by one space."""
    return F.sha2(F.array_join(words, " "), 256)
