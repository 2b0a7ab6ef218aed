"""Packing of tokenised documents into sequences by minimum bin slack.

The bins depend on nothing but how many pieces there are of each length, a
histogram of at most ``capacity`` numbers. From it the driver works out patterns:
the longest length left, filled up by the subset of lengths that a bitset
dynamic programme finds fullest, used as often as the counts allow. Executors
number the pieces of each length, in cells so that one frequent length is many
groups, and look up which pattern, bin and place a number belongs to.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quartergrid.llm.common import arrow_map, staged
from quartergrid.llm.tokens import BYTE_RANKS, token_ids

CAPACITY = 1024
END_ID = 2
#: Pieces that one numbering group should hold; the number of cells follows from it.
CELL_ROWS = 100_000
LEAST_CELLS = 256


def cut(total: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; only the first may be shorter."""
    if total <= capacity:
        return [(0, total)]
    head = total % capacity
    starts = ([0] if head else []) + list(range(head, total, capacity))
    return [(s, min(capacity, total - s) if s or not head else head) for s in starts]


def pieces(
    docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = BYTE_RANKS, end_id: int = END_ID,
    with_ids: bool = True, added: bool = False,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document."""
    def each(batch: pa.RecordBatch) -> Iterator[dict]:
        out: dict[str, list] = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")}
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids = np.append(token_ids(vocabulary, text or "", added), np.uint32(end_id)).astype("<u4")
            for k, (start, length) in enumerate(cut(len(ids), capacity)):
                part = ids[start : start + length]
                row = (doc_id, k, start, length, crc32(part.tobytes()), part if with_ids else None)
                for name, value in zip(out, row):
                    out[name].append(value)
        yield out

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    types = {"doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(),
             "ids_crc32": pa.int64()}
    if with_ids:
        schema, types = f"{schema}, ids array<int>", types | {"ids": pa.list_(pa.int32())}
    return arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), each, schema, **types)


def fullest(counts: np.ndarray, room: int) -> dict[int, int]:
    """How many of each length fill ``room`` best, by a bitset of reachable sums.

    Longer lengths come first, and the search ends when the room is full. Bit s
    of ``reach`` tells whether s can be made of the lengths seen so far.
    """
    reach, mask = 1, (1 << (room + 1)) - 1
    steps: list[tuple[int, int, int]] = []
    for length in (int(x) for x in np.flatnonzero(counts[: room + 1])[::-1]):
        left, part = min(int(counts[length]), room // length), 1
        while left and not reach >> room & 1:
            take = min(part, left)
            more = (reach | reach << (take * length)) & mask
            if more != reach:
                steps.append((length, take, reach))
                reach = more
            left, part = left - take, part * 2
        if reach >> room & 1:
            break
    at, out = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> at & 1:
            at -= take * length
            out[length] = out.get(length, 0) + take
    return out


@dataclass
class Plan:
    """Runs of numbers of one length that go to consecutive bins of one pattern."""

    key: np.ndarray  # length and first number of the run
    need: np.ndarray  # pieces of this length per bin
    bin: np.ndarray  # first bin of the run
    offset: np.ndarray  # place of the length's first piece in its bins

    SHIFT = 1 << 44

    def place(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        run = np.searchsorted(self.key, length * self.SHIFT + number, side="right") - 1
        nth = number - self.key[run] % self.SHIFT
        need = self.need[run]
        return self.bin[run] + nth // need, self.offset[run] + nth % need * length


def plan(histogram: dict[int, int], capacity: int) -> Plan:
    """Minimum bin slack over a histogram of lengths.

    Each pattern uses up a length, so there are at most a few per length.
    """
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    used, rows, bins = np.zeros(capacity + 1, np.int64), [], 0
    while len(left := np.flatnonzero(counts)):
        longest = int(left[-1])
        counts[longest] -= 1
        pattern = fullest(counts, capacity - longest)
        counts[longest] += 1
        pattern[longest] = pattern.get(longest, 0) + 1
        times = min(int(counts[length]) // n for length, n in pattern.items())
        offset = 0
        for length in sorted(pattern, reverse=True):
            n = pattern[length]
            rows.append((length * Plan.SHIFT + int(used[length]), n, bins, offset))
            offset += n * length
            used[length] += n * times
            counts[length] -= n * times
        bins += times
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 4)
    return Plan(*(np.ascontiguousarray(table[:, i]) for i in range(4)))


def place(held: DataFrame, capacity: int, *identity: str) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with a ``length`` of 1 to capacity.

    ``identity`` names columns that tell rows apart; rows equal in all of them
    may change places. ``held`` should be a stored table.
    """
    sizes = {r[0]: r[1] for r in held.groupBy("length").count().collect()}  # at most capacity rows
    if any(not 0 < n <= capacity for n in sizes):
        raise ValueError("lengths must be from 1 to the capacity")
    runs = held.sparkSession.sparkContext.broadcast(plan(sizes, capacity))
    cells = max(LEAST_CELLS, sum(sizes.values()) // CELL_ROWS)
    split = held.withColumn("cell_", F.pmod(F.xxhash64(*identity), F.lit(cells)).cast("int"))
    in_cells = split.groupBy("length", "cell_").count()
    before = Window.partitionBy("length").orderBy("cell_").rowsBetween(Window.unboundedPreceding, -1)
    begins = in_cells.select("length", "cell_", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("begin_"))
    nth = F.row_number().over(Window.partitionBy("length", "cell_").orderBy(*identity))
    numbered = split.join(begins, ["length", "cell_"]).withColumn("number_", F.col("begin_") + nth - 1)
    names = [*held.columns, "sequence_id", "offset"]

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = (batch.column(c).to_numpy() for c in ("length", "number_"))
            where, offset = runs.value.place(length, number)
            columns = [batch.column(c) for c in names[:-2]] + [pa.array(where), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = StructType([*held.schema.fields]).add("sequence_id", "long").add("offset", "long")
    return numbered.select(*held.columns, "number_").mapInArrow(put, schema)


def pack_documents(
    docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = BYTE_RANKS, end_id: int = END_ID,
    with_ids: bool = True, added: bool = False,
) -> DataFrame:
    """One row per piece: (doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset).

    Every text is tokenised whole and ends with ``end_id``; a null or empty text
    is that id alone. With ``added`` a ``<|endoftext|>`` in a text is its one token, as
    the tokenizers library has it by default, else ordinary text. Only documents longer than ``capacity`` are cut. Sequences
    have no gaps and hold at most ``capacity`` tokens. Repeated rows and null
    doc_ids are documents of their own; other columns are ignored; an empty table
    gives an empty table.
    """
    held = staged(pieces(docs, capacity, vocabulary, end_id, with_ids, added), "pieces")
    return place(held, capacity, "doc_id", "piece", "ids_crc32", "start")
