"""Packing of documents as they come, by sums of squares over fill levels.

Each task packs the documents of its own partition, in the order it reads them,
so nothing is shuffled and a lost task is made again by itself. It keeps an array
of how many open windows there are of each fill level. A piece goes to the level
at which the sum of the squared counts comes out least: popular levels are left,
rare ones are reached, and windows of all levels stay at hand to be filled to the
brim. What stays open at the end is filled up by taking the emptiest windows
apart, and the last rest is cut into powers of two, which need no padding.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartergrid.llm.common import sliced
from quartergrid.llm.tokens import BYTE_RANKS, token_ids

CAPACITY = 1024
END_ID = 0
#: Windows a task keeps open; beyond them the emptiest fill up the fullest.
MOST_OPEN = 4096
#: Sequences of a task are numbered from its partition's number times this.
SHIFT = 1 << 40


class Piece(NamedTuple):
    """A run of ids of one document."""

    doc_id: int | None
    doc_tokens: int
    start: int
    ids: np.ndarray

    def cut(self, room: int) -> tuple[Piece, Piece | None]:
        """The first ``room`` ids, and the rest if there is one."""
        if len(self.ids) <= room:
            return self, None
        return self._replace(ids=self.ids[:room]), self._replace(start=self.start + room, ids=self.ids[room:])


Window = list[Piece]


def level(window: Window) -> int:
    return sum(len(p.ids) for p in window)


class Levels:
    """The open windows of a task by their fill level."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.counts = np.zeros(capacity + 1, np.int64)  # ends stay 0: empty and full windows are not open
        self.windows: list[list[Window]] = [[] for _ in range(capacity)]

    def choose(self, size: int) -> int:
        """The level to put ``size`` ids on, 0 for a new window; of ties the fullest.

        A window that goes from level h to h + size changes the sum of squares by
        2 n[h + size] + 1 - (2 n[h] - 1); empty and full ones are not counted.
        """
        last = self.capacity - size
        left, reached = self.counts[: last + 1], self.counts[size:]
        change = 2 * (reached - left) + 2
        change[0] -= 1
        change[last] -= 1  # reached[last] is the full level
        change[1:][left[1:] == 0] = np.iinfo(np.int64).max
        return last - int(np.argmin(change[::-1]))

    def put(self, piece: Piece) -> Window | None:
        """Place a piece; returns the window if that made it full."""
        size = len(piece.ids)
        at = self.choose(size)
        window = self.windows[at].pop() if at else []
        window.append(piece)
        self.counts[at] -= at > 0
        if at + size == self.capacity:
            return window
        self.add(window, at + size)
        return None

    def add(self, window: Window, at: int) -> None:
        self.windows[at].append(window)
        self.counts[at] += 1

    def take_all(self) -> list[Window]:
        """All open windows, fullest first; none stays."""
        found = [w for held in reversed(self.windows) for w in held]
        self.__init__(self.capacity)
        return found


def filled_up(windows: list[Window], capacity: int) -> tuple[list[Window], Window]:
    """(full windows, the rest) of open windows that come fullest first.

    The emptiest windows are taken apart to fill the fullest, so most documents
    stay whole: each full window cuts one at most.
    """
    queue, full, donor = deque(windows), [], []
    while queue:
        window = list(queue.popleft())
        room = capacity - level(window)
        while room:
            if not donor:
                if not queue:
                    return full, window
                donor = list(queue.pop())
            piece, rest = donor.pop().cut(room)
            window.append(piece)
            room -= len(piece.ids)
            if rest:
                donor.append(rest)
        full.append(window)
    return full, donor


def powers_of_two(rest: Window) -> list[Window]:
    """The window cut into windows of powers of two, the largest first."""
    total, left, out = level(rest), deque(rest), []
    for bit in reversed(range(total.bit_length())):
        room = total & 1 << bit
        if room:
            out.append([])
        while room:
            piece, more = left.popleft().cut(room)
            out[-1].append(piece)
            room -= len(piece.ids)
            if more:
                left.appendleft(more)
    return out


def packed(documents: Iterator[tuple[int | None, np.ndarray]], capacity: int, most_open: int) -> Iterator[Window]:
    """The closed windows of a stream of (doc_id, ids), as they close."""
    levels, n_open = Levels(capacity), 0
    for doc_id, ids in documents:
        whole = len(ids) - len(ids) % capacity
        for start in range(0, whole, capacity):
            yield [Piece(doc_id, len(ids), start, ids[start : start + capacity])]
        if whole == len(ids):
            continue
        closed = levels.put(Piece(doc_id, len(ids), whole, ids[whole:]))
        if closed:
            yield closed
        n_open = int(levels.counts.sum())
        if n_open > most_open:
            full, rest = filled_up(levels.take_all(), capacity)
            yield from full
            if rest:
                levels.add(rest, level(rest))
    left = levels.take_all()
    even = [w for w in left if level(w).bit_count() == 1]
    yield from even
    full, rest = filled_up([w for w in left if level(w).bit_count() != 1], capacity)
    yield from full
    yield from powers_of_two(rest)


def pack_online(
    docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = BYTE_RANKS, end_id: int = END_ID,
    with_ids: bool = True, added: bool = False, most_open: int = MOST_OPEN,
) -> DataFrame:
    """One row per piece: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]).

    Every text is tokenised whole and ends with ``end_id``; a null or empty text
    is that id alone. With ``added`` a ``<|endoftext|>`` in a text is its one token.
    Documents longer than ``capacity`` are cut into full sequences and a tail; tails
    and short documents stay whole but where a sequence would need padding.
    Sequences are full or hold a power of two of ids, so none is padded. Repeated
    rows and null doc_ids are documents of their own; other columns are ignored; an
    empty table gives an empty table. A task holds ``most_open`` open windows.
    """
    if capacity < 1 or capacity.bit_count() != 1:
        raise ValueError("the capacity must be a power of two")
    kinds = {"doc_id": pa.int64(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(),
             "doc_tokens": pa.int64(), "sequence_id": pa.int64(), "offset": pa.int64()}
    schema = ", ".join(f"{name} long" for name in kinds)
    if with_ids:
        kinds, schema = kinds | {"ids": pa.list_(pa.int32())}, f"{schema}, ids array<int>"

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, np.ndarray]]:
        for batch in sliced(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = token_ids(vocabulary, text or "", added)
                yield doc_id, np.append(ids, np.uint32(end_id)).astype("<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() * SHIFT
        rows: list[tuple] = []

        def batch_of() -> pa.RecordBatch:
            columns = zip(*rows) if rows else [()] * len(kinds)
            arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds.values())]
            return pa.RecordBatch.from_arrays(arrays, names=list(kinds))

        for window in packed(documents(batches), capacity, most_open):
            offset = 0
            for doc_id, doc_tokens, start, ids in window:
                row = (doc_id, start, len(ids), crc32(ids.tobytes()), doc_tokens, number, offset)
                rows.append((*row, ids) if with_ids else row)
                offset += len(ids)
            number += 1
            if len(rows) >= 2000:
                yield batch_of()
                rows.clear()
        yield batch_of()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)
