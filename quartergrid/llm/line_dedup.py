"""Removal of lines that repeat an earlier line, up to one word.

Two lines are one word edit apart if and only if they agree after at most one
word is deleted from each, at the same place or from the longer one only. So
every line emits its deletion variants as hashed keys, and equal keys meet. Only
lines that share a half with another line emit any: of two halves, one edit
leaves one whole. Keys that occur once are let go before their lines move. Each
key is reduced to its earliest line, so a line or variant that is everywhere is
one row, and each line is verified, word by word, against the one earliest line
it met.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quartergrid.llm.common import arrow_map, fits, flagged, matching, small_batches, staged, text_bytes
from quartergrid.llm.hashing import Words, batches, mix, ranges, sums

#: Words from which on lines are compared, and compared with an edit, unless a caller says otherwise.
MIN_WORDS = 5
MIN_WORDS_EDITED = 8


def one_edit(x: list[bytes], y: list[bytes]) -> bool:
    """Whether at most one word is inserted, deleted or replaced between x and y."""
    if len(x) > len(y):
        x, y = y, x
    if len(y) - len(x) > 1:
        return False
    i = 0
    while i < len(x) and x[i] == y[i]:
        i += 1
    return x[i + (len(x) == len(y)) :] == y[i + 1 :]


class _Lines:
    """The lines of some texts: words, owner, number in the text and hashes."""

    def __init__(self, texts: list[bytes]) -> None:
        split = [t.lower().split(b"\n") for t in texts]
        self.owner = np.repeat(np.arange(len(texts)), [len(s) for s in split])
        self.number = np.concatenate([np.arange(len(s)) for s in split])
        words = Words([line for s in split for line in s])
        self.start, self.end = words.first[:-1], words.first[1:]
        self.n = self.end - self.start
        self.table = sums(words.hash, 2)
        self.words = words.hash

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return ranges(self.table, start, end)

    def half_keys(self, at: np.ndarray) -> list[np.ndarray]:
        """Keys of both halves as a line of n words, and as if one word were missing."""
        out = []
        for more in (0, 1):
            n = self.n[at] + more
            half = n // 2
            tag = mix(n.astype(np.uint64) << np.uint64(1))
            out.append(mix(self.hash(self.start[at], self.start[at] + half) ^ tag))
            out.append(mix(self.hash(self.end[at] - (n - half), self.end[at]) ^ (tag + np.uint64(1))))
        return out

    def variants(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(line, place, hash without the word at that place) of all words of lines."""
        line = np.repeat(at, self.n[at])
        place = np.arange(len(line)) - np.repeat(np.cumsum(self.n[at]) - self.n[at], self.n[at])
        total, down = self.table
        start, end, word = self.start[line], self.end[line], self.start[line] + place
        rest = total[word] - total[start] + (total[end] - total[word + 1]) * down[1]
        return line, place, mix(rest * down[start] + (end - start - 1).astype(np.uint64))


def _signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def line_table(docs: DataFrame, min_words: int = MIN_WORDS, min_words_edited: int = MIN_WORDS_EDITED) -> DataFrame:
    """(doc_id, line, n, h, g, keys) of all lines of at least ``min_words`` words.

    ``h`` and ``g`` together name the words of a line; ``keys`` of its halves are
    null for lines too short to be compared with an edit.
    """
    def each(batch: pa.RecordBatch) -> Iterator[dict]:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for begun, texts in batches(text_bytes(batch.column(1))):
            lines = _Lines(texts)
            at = np.flatnonzero(lines.n >= max(1, min_words))
            again = ranges(sums(lines.words, 5), lines.start[at], lines.end[at])
            short = lines.n[at] < min_words_edited
            keys = {f"k{i}": pa.array(_signed(k), mask=short) for i, k in enumerate(lines.half_keys(at))}
            yield {"doc_id": ids[begun + lines.owner[at]], "line": lines.number[at], "n": lines.n[at],
                   "h": _signed(lines.hash(lines.start[at], lines.end[at])), "g": _signed(again)} | keys

    names = [f"k{i}" for i in range(4)]
    return arrow_map(
        docs, each, "doc_id long, line int, n int, h long, g long, " + ", ".join(f"{k} long" for k in names),
        doc_id=pa.int64(), line=pa.int32(), n=pa.int32(), h=pa.int64(), g=pa.int64(), **{k: pa.int64() for k in names},
    )


def _texts_with(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """Documents that ``marks`` (doc_id, ...) names, with its columns as lists."""
    rest = [F.collect_list(c).alias(c) for c in marks.columns if c != "doc_id"]
    return matching(docs, staged(marks.groupBy("doc_id").agg(*rest), "marked"), "doc_id")


def _variant_rows(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """(v, place, h, doc_id, line): deletion variants of the lines in ``marks``."""
    def each(batch: pa.RecordBatch) -> Iterator[dict]:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        wanted = batch.column(2).to_pylist()
        for begun, texts in batches(text_bytes(batch.column(1))):
            lines = _Lines(texts)
            own = _signed(lines.hash(lines.start, lines.end))
            edge = np.searchsorted(lines.owner, np.arange(len(texts) + 1))
            # The first line of a text with a wanted hash; its other copies are no news.
            at = []
            for i in range(len(texts)):
                found, where = np.unique(own[edge[i] : edge[i + 1]], return_index=True)
                at.append(edge[i] + np.sort(where[np.isin(found, wanted[begun + i])]))
            line, place, v = lines.variants(np.concatenate(at))
            yield {"v": _signed(v), "place": place, "h": own[line],
                   "doc_id": ids[begun + lines.owner[line]], "line": lines.number[line]}

    return arrow_map(
        _texts_with(docs, marks).select("doc_id", "text", "h"), each,
        "v long, place int, h long, doc_id long, line int",
        v=pa.int64(), place=pa.int32(), h=pa.int64(), doc_id=pa.int64(), line=pa.int32())


def _earliest(column: str = "first") -> Column:
    return F.min(F.struct("doc_id", "line")).alias(column)


def _words_of(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """(doc_id, line, words) of marked lines (doc_id, line), lower-cased."""
    def each(batch: pa.RecordBatch) -> Iterator[dict]:
        out: dict[str, list] = {"doc_id": [], "line": [], "words": []}
        for doc_id, text, wanted in zip(
            batch.column(0).to_pylist(), text_bytes(batch.column(1)), batch.column(2).to_pylist(),
        ):
            lines = text.lower().split(b"\n")
            for k in set(wanted):
                if k < len(lines):  # else another text of a repeated doc_id
                    out["doc_id"].append(doc_id)
                    out["line"].append(k)
                    out["words"].append(b" ".join(lines[k].split()))
        yield out

    return arrow_map(
        _texts_with(docs, marks).select("doc_id", "text", "line"), each, "doc_id long, line int, words binary",
        doc_id=pa.int64(), line=pa.int32(), words=pa.binary())


def _near_earlier(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """(h) of lines with an earlier line one edit away."""
    long = lines.filter("k0 is not null").select(
        "h", "g", "doc_id", "line", F.explode(F.array("k0", "k1", "k2", "k3")).alias("key"))
    met = long.groupBy("key").agg(F.min("h").alias("low"), F.max("h").alias("high")).filter("low != high")
    # All copies of a line have its keys, so the earliest of those that share is that of all.
    sharing = matching(long, staged(met.select("key"), "shared_halves"), "key", "left_semi")
    marks = sharing.groupBy("h", "g").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "h")
    rows = staged(_variant_rows(docs, staged(marks, "sharing")), "variants")
    lines = staged(rows.select("h", "doc_id", "line").distinct(), "sharing_lines")
    # A rest that nothing else has, variant or line, is let go by its hash alone.
    rests = rows.select("v").unionByName(lines.select(F.col("h").alias("v")))
    twice = rests.groupBy("v").count().filter("count > 1").select("v")
    rows = staged(matching(rows, staged(twice, "met_rests"), "v", "left_semi"), "met_variants")

    # Replaced words: the same rest with the gap at the same place.
    group = rows.groupBy("v", "place").agg(_earliest(), F.max(F.struct("doc_id", "line")).alias("last"))
    replaced = rows.join(group.filter("first != last"), ["v", "place"]).select("h", "doc_id", "line", "first")
    # A word more or less: the rest is a line itself.
    one_less = rows.select("v", F.struct("doc_id", "line").alias("first"), F.col("h").alias("longer")).join(
        lines.withColumnRenamed("h", "v"), "v")
    longer_first = one_less.select(F.col("v").alias("h"), "doc_id", "line", "first")
    shorter_first = one_less.select(
        F.col("longer").alias("h"), F.col("first.doc_id").alias("doc_id"), F.col("first.line").alias("line"),
        F.struct("doc_id", "line").alias("first"))
    # The earliest line that each line met, if it is earlier: at most one pair per line.
    pairs = staged(
        replaced.unionByName(longer_first).unionByName(shorter_first)
        .filter(F.col("first") < F.struct("doc_id", "line"))
        .groupBy("h", "doc_id", "line").agg(F.min("first").alias("first")), "met",
    )
    sides = pairs.select("doc_id", "line").unionByName(pairs.select("first.doc_id", "first.line")).distinct()
    words = staged(_words_of(docs, staged(sides, "sides")), "words")

    def verify(batch: pa.RecordBatch) -> Iterator[dict]:
        h, x, y = (batch.column(i).to_pylist() for i in range(3))
        yield {"h": [k for k, a, b in zip(h, x, y) if one_edit(a.split(), b.split())]}

    here = words.select("doc_id", "line", F.col("words").alias("x"))
    there = words.select(F.struct("doc_id", "line").alias("first"), F.col("words").alias("y"))
    both = pairs.join(here, ["doc_id", "line"]).join(there, "first").select("h", "x", "y")
    return arrow_map(both, verify, "h long", h=pa.int64()).distinct()


def _without(docs: DataFrame, goes: DataFrame) -> DataFrame:
    """Documents with n_lines, n_removed, kept_text and its hash; ``goes`` has (goes_id, goes).

    Only documents that lose a line may be dealt out; the others stay where they are. No
    text goes to Python: what runs this plan may have any size of batches.
    """
    names = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    own = docs.withColumn("goes_id", F.col("doc_id").cast("long"))
    if fits(goes):
        asked = own.join(F.broadcast(goes), "goes_id", "left")
    else:  # a document that is only taken for one that loses a line has nothing listed
        flags = flagged(own, goes, ["goes_id"], "touched_")
        rest = flags.filter("not touched_").withColumn("goes", F.lit(None).cast(goes.schema["goes"].dataType))
        asked = flags.filter("touched_").join(goes, "goes_id", "left").unionByName(rest)

    def of_lines(lines: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("goes"))
        return F.struct(
            F.size(lines).cast("long").alias("all_lines_"),
            F.when(F.col("goes").isNotNull(), F.transform(stay, lambda i: F.get(lines, i))).alias("kept_lines_"))

    # Generated, so that a text is split once, whatever filters name; a null text gives nulls.
    split = F.when(F.col("text").isNotNull(), F.array(F.split("text", "\n")))
    rows = asked.select(*names, "text", F.inline_outer(F.transform(split, of_lines)))
    kept_text = F.when(F.col("kept_lines_").isNull(), F.col("text")).otherwise(F.array_join("kept_lines_", "\n"))
    n_kept = F.when(F.col("kept_lines_").isNull(), F.col("all_lines_")).otherwise(F.size("kept_lines_"))
    return rows.select(
        *names, F.coalesce("all_lines_", F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.col("all_lines_") - n_kept, F.lit(0)).cast("long").alias("n_removed"), kept_text.alias("kept_text"),
        F.sha2(F.coalesce(kept_text, F.lit("")), 256).alias("kept_sha256"))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, min_words_edited: int = MIN_WORDS_EDITED) -> DataFrame:
    """Every document with its other columns and (n_lines, n_removed, kept_text, kept_sha256).

    Lines are what ``\\n`` separates; their words stand between ASCII white space
    and are compared lower-cased in A-Z. A line goes when an earlier line, by
    doc_id and then by its place, has the same words, or, if both have at least ``min_words_edited``
    words, differs in one word that is inserted, deleted or replaced. Lines of
    fewer than ``min_words`` words, and those without a word, stay. All is judged on the input. A null text has no lines
    and stays null; an empty text is one empty line. A row without doc_id is
    before and after no other and loses nothing. Rows that repeat a doc_id share
    its lines by number: a line goes from all of them or from none. Columns called
    like a result are replaced; an empty table gives an empty table.
    """
    docs = docs.drop("n_lines", "n_removed", "kept_text", "kept_sha256", "goes", "goes_id")
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter(
        "doc_id is not null and text is not null")
    with small_batches(docs.sparkSession):  # all that sends texts to Python is run here
        lines = staged(line_table(known, min_words, min_words_edited), "lines")
        again = lines.groupBy("h", "g").agg(_earliest(), F.count(F.lit(1)).alias("copies")).filter("copies > 1")
        again = staged(again.select("h", "g", "first"), "repeated")
        near = staged(_near_earlier(known, lines), "near")
        goes = matching(lines.select("doc_id", "line", "h"), near, "h", "left_semi").select("doc_id", "line").unionByName(
            matching(lines.select("doc_id", "line", "h", "g"), again, ["h", "g"])
            .filter(F.struct("doc_id", "line") != F.col("first")).select("doc_id", "line"))
        listed = goes.groupBy(F.col("doc_id").alias("goes_id")).agg(F.collect_set("line").alias("goes"))
        listed = staged(listed, "goes")
    return _without(docs, listed)
