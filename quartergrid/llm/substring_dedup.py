"""Removal of passages that an earlier document has, found by difference covers.

Hashing every window of every text would shuffle the corpus many times over.
Here a text hashes only the stretches that begin at cover positions: those whose
place modulo a period is in a difference cover. For any two places i and j some
shift below the period brings both onto the cover, so two equal windows always
share one equal, aligned stretch (the anchor) inside them. Anchors that stand in
two documents mark where whole windows are worth comparing; only those windows
are hashed, with 128 bits, and extended into the words they cover.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartergrid.llm.common import arrow_map, of_checked_size, staged, text_bytes
from quartergrid.llm.hashing import Words, batches

#: 6 of 31 places are in the least cover, and 50-word windows leave 20-word anchors.
PERIOD = 31


@lru_cache(maxsize=8)
def difference_cover(period: int) -> tuple[int, ...]:
    """A smallest set of residues whose differences give every residue."""
    every = (1 << period) - 1

    def grow(chosen: tuple[int, ...], seen: int, size: int) -> tuple[int, ...] | None:
        if seen == every:
            return chosen
        room = size - len(chosen)
        missing = period - seen.bit_count()
        if room == 0 or missing > sum(2 * (len(chosen) + k) for k in range(room)):
            return None
        for x in range(chosen[-1] + 1, period):
            more = seen
            for c in chosen:
                more |= 1 << (x - c) | 1 << (period - (x - c))
            if (found := grow((*chosen, x), more, size)) is not None:
                return found
        return None

    size = 1
    while (found := grow((0,), 1, size)) is None:
        size += 1
    return found


class _Anchors:
    """Windows and cover positions of a batch of texts."""

    def __init__(self, texts: list[bytes], size: int, period: int) -> None:
        self.words = words = Words(texts)
        self.n = np.diff(words.first)
        self.text_of = np.repeat(np.arange(len(texts)), self.n)
        self.place = np.arange(len(words.hash)) - words.first[self.text_of]
        self.size, self.reach = size, period - 1
        span = size - self.reach
        cover = np.zeros(period, bool)
        cover[list(difference_cover(period))] = True
        total = self.n[self.text_of]
        at = cover[self.place % period] & (self.place + span <= total) & (total >= size)
        self.at = np.flatnonzero(at)
        self.anchor = words.windows(span)[self.at].view(np.int64)

    def windows_around(self, shared: np.ndarray) -> np.ndarray:
        """Places of whole windows that hold one of the marked anchors."""
        opened = np.zeros(len(self.place) + 1, np.int64)
        at = self.at[shared]
        low = np.maximum(at - self.reach, self.words.first[self.text_of[at]])
        np.add.at(opened, low, 1)
        np.add.at(opened, at + 1, -1)
        fits = self.place + self.size <= self.n[self.text_of]
        return np.flatnonzero((np.cumsum(opened)[:-1] > 0) & fits)


def _among(values: np.ndarray, owner: np.ndarray, wanted: list[np.ndarray | None]) -> np.ndarray:
    """Whether each value is in the list of its owner; values are grouped by owner."""
    out = np.zeros(len(values), bool)
    edges = np.searchsorted(owner, np.arange(len(wanted) + 1))
    for i, some in enumerate(wanted):
        if some is not None and len(some) and edges[i] < edges[i + 1]:
            out[edges[i] : edges[i + 1]] = np.isin(values[edges[i] : edges[i + 1]], some)
    return out


def _lists(column: pa.Array) -> list[np.ndarray | None]:
    return [x.values.to_numpy(zero_copy_only=False) if x.is_valid else None for x in column]


def anchors(docs: DataFrame, size: int, period: int) -> DataFrame:
    """(anchor, doc_id) of every cover position."""
    def each(batch: pa.RecordBatch) -> Iterator[dict]:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for begun, texts in batches(text_bytes(batch.column(1))):
            found = _Anchors(texts, size, period)
            yield {"anchor": found.anchor, "doc_id": ids[begun + found.text_of[found.at]]}

    return arrow_map(docs, each, "anchor long, doc_id long", anchor=pa.int64(), doc_id=pa.int64())


def candidate_windows(marked: DataFrame, size: int, period: int) -> DataFrame:
    """(h1, h2, doc_id) of the windows around the anchors listed in ``marks``."""
    def each(batch: pa.RecordBatch) -> Iterator[dict]:
        ids, marks = batch.column(0).to_numpy(zero_copy_only=False), _lists(batch.column(2))
        for begun, texts in batches(text_bytes(batch.column(1))):
            found = _Anchors(texts, size, period)
            owner = found.text_of[found.at]
            shared = _among(found.anchor, owner, marks[begun : begun + len(texts)])
            at = found.windows_around(shared)
            if len(at):
                yield {"h1": found.words.windows(size, 2)[at].view(np.int64),
                       "h2": found.words.windows(size, 4)[at].view(np.int64),
                       "doc_id": ids[begun + found.text_of[at]]}

    return arrow_map(marked.select("doc_id", "text", "marks"), each, "h1 long, h2 long, doc_id long",
                     h1=pa.int64(), h2=pa.int64(), doc_id=pa.int64())


def _kept(judged: DataFrame, size: int, with_text: bool) -> DataFrame:
    """Results per row of (doc_id, text, copy, gone).

    ``gone`` lists the hashes of windows that go; of a ``copy`` all windows go.
    """
    def each(batch: pa.RecordBatch) -> Iterator[dict]:
        ids, copies, gone = batch.column(0).to_pylist(), batch.column(2).to_pylist(), _lists(batch.column(3))
        counts, removed, digests, kept_texts = [], [], [], []
        for text, copy, hashes in zip(text_bytes(batch.column(1)), copies, gone):
            kept = text.split()  # bytes split at ASCII white space only
            n = len(kept)
            if copy and n >= size:
                kept = []
            elif hashes is not None and n >= size:
                held = Words([text])
                start = np.flatnonzero(np.isin(held.windows(size, 2).view(np.int64), hashes))
                change = np.zeros(n + 1, np.int64)
                np.add.at(change, start, 1)
                np.add.at(change, start + size, -1)
                stays = np.cumsum(change)[:-1] == 0
                kept = [w for w, stay in zip(kept, stays.tolist()) if stay]
            joined = b" ".join(kept)
            counts.append(n)
            removed.append(n - len(kept))
            digests.append(sha256(joined).hexdigest())
            if with_text:
                kept_texts.append(joined)
        out = {"doc_id": ids, "n_words": counts, "n_removed": removed, "kept_sha256": digests}
        yield out | ({"kept_text": pa.array(kept_texts, pa.binary()).cast(pa.string())} if with_text else {})

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    types = {"doc_id": pa.int64(), "n_words": pa.int64(), "n_removed": pa.int64(), "kept_sha256": pa.string()}
    if with_text:
        schema, types = f"{schema}, kept_text string", types | {"kept_text": pa.string()}
    return arrow_map(judged.select("doc_id", "text", "copy", "gone"), each, schema, **types)


def _later_copies(known: DataFrame) -> DataFrame:
    """(doc_id, tag) of rows whose whole text an earlier document has."""
    named = known.select("doc_id", "tag", F.md5("text").alias("whole"))
    first = named.groupBy("whole").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    later = named.join(first.filter("low != high"), "whole").filter("doc_id > low")
    return of_checked_size(staged(later.select("doc_id", "tag").distinct(), "copies"))


def _with_lists(docs: DataFrame, marks: DataFrame, ids: DataFrame, name: str) -> DataFrame:
    """The documents of ``ids`` with their marks (doc_id, value) as a list."""
    lists = marks.groupBy("doc_id").agg(F.collect_list("value").alias(name))
    return docs.join(ids, "doc_id", "left_semi").join(lists, "doc_id")


def remove_repeated_passages(
    docs: DataFrame, size: int = 50, period: int = PERIOD, with_text: bool = True,
) -> DataFrame:
    """One row per document: (doc_id, n_words, n_removed, kept_sha256[, kept_text]).

    A word goes when a window of ``size`` consecutive words covers it that also
    begins in a document with a smaller doc_id. Windows are judged on the input.
    Null and empty texts have no words; texts shorter than a window lose none.
    A row without doc_id is before and after no other and loses nothing. Rows
    that repeat a doc_id are one document for that comparison and keep a result
    each. Other columns are ignored; an empty table gives an empty table.

    Groups of equal anchors and windows are only ever reduced to their least and
    greatest doc_id before joins, so a passage in a third of all documents is one
    row of each aggregate. Of equal texts only the first is searched.
    """
    if not 1 < period <= size:
        raise ValueError("the period must be from 2 to the window size")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tag"))
    known = texts.filter("doc_id is not null and text is not null")
    copies = _later_copies(known)
    firsts = known.join(copies, ["doc_id", "tag"], "left_anti").select("doc_id", "text")

    at = anchors(firsts, size, period)
    common = at.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    marks = staged(at.join(common.filter("low != high").select("anchor"), "anchor").select(
        "doc_id", F.col("anchor").alias("value")).distinct(), "marks")
    marked = of_checked_size(staged(marks.select("doc_id").distinct(), "marked"))
    windows = candidate_windows(_with_lists(firsts, marks, marked, "marks"), size, period)

    first = windows.groupBy("h1", "h2").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    gone = staged(windows.join(first.filter("low != high"), ["h1", "h2"]).filter("doc_id > low").select(
        "doc_id", F.col("h1").alias("value")).distinct(), "gone")
    losing = of_checked_size(staged(gone.select("doc_id").distinct(), "losing"))
    rows = texts.join(copies.withColumn("copy", F.lit(True)), ["doc_id", "tag"], "left").select(
        "doc_id", "text", F.coalesce("copy", F.lit(False)).alias("copy"))
    touched = _with_lists(rows, gone, losing, "gone")
    rest = rows.join(losing, "doc_id", "left_anti").withColumn("gone", F.lit(None).cast("array<long>"))
    return _kept(touched.unionByName(rest), size, with_text)
