"""Exact Jaccard join on word shingles by rare-first prefixes.

Every set of shingles is ordered by how rare its shingles are in the corpus.
Two sets that are similar enough share a shingle within short prefixes of that
order, so only prefixes are joined. Length, position in the order and a profile
of the whole set (the suffix filter) discard most of the pairs; the rest are
verified once each against the whole sets.

A shingle that many documents share would give all pairs of them. Only classes
are wanted, so each prefix shingle first offers the pairs with one hub, the set
that has fewest rarer shingles. Verified hub links make provisional classes, and
only pairs across two classes are joined after that. No link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quartergrid.llm.common import arrow_map, matching, of_checked_size, sliced, small_batches, staged, text_bytes
from quartergrid.llm.components import components
from quartergrid.llm.hashing import Words, batches, ranges, sums

#: Shingles are counted in so many cells (2 ** 18 numbers, 2 MB when broadcast), and the
#: frequent ones each for itself. Counts only order shingles: a shared cell costs time,
#: never a pair.
RARITY_BITS = 18
#: Shingles that a task counts each for itself, and those it takes in at a time.
TASK_SHINGLES = 1 << 16
CHUNK_SHINGLES = 1 << 19
#: At most so many frequent shingles are broadcast (16 bytes each).
FREQUENT_SHINGLES = 1 << 18
#: Cells of a set's profile for the suffix filter.
PROFILE_CELLS = 128
#: Sets that a task remembers to have met.
SENT_SETS = 200_000
_NO_WORDS = 0


def _sets(texts: list[bytes], size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(number of the text, sorted distinct shingle hashes) of each text."""
    for begun, held in batches(texts):
        words = Words([t.lower() for t in held])  # bytes.lower() changes A-Z only
        windows = words.windows(size)
        whole = None
        for i in range(len(held)):
            a, b = words.first[i], words.first[i + 1]
            if b - a >= size:
                yield begun + i, np.unique(windows[a : b - size + 1])
            elif b > a:
                whole = whole if whole is not None else sums(words.hash, 2)
                yield begun + i, ranges(whole, np.array([a]), np.array([b]))
            else:
                yield begun + i, np.zeros(_NO_WORDS, np.uint64)


def _set_key(shingles: np.ndarray) -> int:
    """64 bits that name a set: equal sets have equal keys."""
    whole = ranges(sums(shingles, 3), np.array([0]), np.array([len(shingles)]))
    return int(whole.view(np.int64)[0])


def _cell(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - RARITY_BITS)).astype(np.int64)


def _profile(shingles: np.ndarray) -> np.ndarray:
    """How many shingles fall into each of the profile's cells."""
    return np.bincount((shingles & np.uint64(PROFILE_CELLS - 1)).astype(np.int64), minlength=PROFILE_CELLS)


class Frequent:
    """The shingles that a task has seen often, a mergeable Misra-Gries summary.

    Each is held with a count at most n / TASK_SHINGLES too low, n being all shingles
    seen; one that is not held was seen no more often than that.
    """

    def __init__(self) -> None:
        self.token, self.hits = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.new: list[np.ndarray] = []
        self.size = 0

    def add(self, shingles: np.ndarray) -> None:
        self.new.append(shingles)
        self.size += len(shingles)
        if self.size >= CHUNK_SHINGLES:
            self.fold()

    def fold(self) -> None:
        every = np.concatenate([self.token, *self.new])
        weight = np.concatenate([self.hits, np.ones(self.size, np.int64)])
        self.new, self.size = [], 0
        order = np.argsort(every, kind="stable")
        every, weight = every[order], weight[order]
        first = np.flatnonzero(np.concatenate((np.ones(min(1, len(every)), bool), every[1:] != every[:-1])))
        self.token = every[first]
        self.hits = np.add.reduceat(weight, first) if len(first) else weight
        over = len(first) - TASK_SHINGLES
        if over > 0:
            self.hits = self.hits - np.partition(self.hits, over - 1)[over - 1]
            self.token, self.hits = self.token[self.hits > 0], self.hits[self.hits > 0]


def shingle_sets(docs: DataFrame, size: int) -> DataFrame:
    """Three kinds of rows in one pass over the texts.

    Per document (doc_id, n_shingles, set_key, profile), set_key null for an empty
    set; and per task (cell, hits) and (token, hits), the counts that order shingles.
    Sets that a task has met of late are not counted again.
    """
    kinds = {"doc_id": pa.int64(), "n_shingles": pa.int64(), "set_key": pa.int64(),
             "profile": pa.list_(pa.int32()), "cell": pa.int32(), "token": pa.int64(), "hits": pa.int64()}

    def rows(size: int, **columns) -> pa.RecordBatch:
        full = [pa.array(columns[c], t) if c in columns else pa.nulls(size, t) for c, t in kinds.items()]
        return pa.RecordBatch.from_arrays(full, names=list(kinds))

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits = np.zeros(1 << RARITY_BITS, np.int64)
        frequent, met = Frequent(), Lately()
        for batch in found:
            n, keys, profiles = [], [], []
            for _, s in _sets(text_bytes(batch.column(1)), size):
                n.append(len(s))
                keys.append(_set_key(s) if len(s) else None)
                profiles.append(_profile(s))
                if len(s) and met.is_new(keys[-1]):
                    np.add.at(hits, _cell(s), 1)
                    frequent.add(s)
            yield rows(len(n), doc_id=batch.column(0), n_shingles=n, set_key=keys, profile=profiles)
        cells = np.flatnonzero(hits)
        yield rows(len(cells), cell=cells, hits=hits[cells])
        frequent.fold()
        yield rows(len(frequent.token), token=frequent.token.view(np.int64), hits=frequent.hits)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_shingles long, set_key long, profile array<int>, cell int, token long, hits long")


class Lately:
    """The sets that a task has met of late."""

    def __init__(self) -> None:
        self.keys: set[int] = set()

    def is_new(self, key: int) -> bool:
        if key in self.keys:
            return False
        if len(self.keys) >= SENT_SETS:
            self.keys.clear()
        self.keys.add(key)
        return True


class Rarity(NamedTuple):
    """Orders shingles: those of no note by the counts of their cells, then frequent ones by their own."""

    cells: np.ndarray  # hits of each cell without those of its frequent shingles
    token: np.ndarray  # frequent shingles, sorted
    hits: np.ndarray

    def of(self, shingles: np.ndarray) -> np.ndarray:
        out = self.cells[_cell(shingles)]
        if len(self.token):
            at = np.minimum(np.searchsorted(self.token, shingles), len(self.token) - 1)
            out = np.where(self.token[at] == shingles, self.hits[at], out)
        return out


def rarity(counted: DataFrame) -> Rarity:
    """The order of shingles over all documents, in tables of bounded size."""
    cells = np.zeros(1 << RARITY_BITS, np.int64)
    for cell, hits in counted.filter("cell is not null").groupBy("cell").agg(F.sum("hits")).collect():
        cells[cell] = hits
    summed = staged(
        counted.filter("token is not null").groupBy("token").agg(F.sum("hits").alias("hits")).filter("hits > 1"),
        "frequent")
    # The least level of hits, an eighth of a power of two, from which on there are few enough.
    level = F.floor(F.log2(F.col("hits").cast("double")) * 8).cast("int")
    least, total = None, 0
    for at, n in sorted(summed.groupBy(level).count().collect(), reverse=True):  # at most 8 x 63 rows
        total += n
        if total > FREQUENT_SHINGLES:
            break
        least = at
    if least is None:
        return Rarity(cells, np.zeros(0, np.uint64), np.zeros(0, np.int64))
    held = summed.filter(level >= least).toArrow()
    token, hits = held.column("token").to_numpy().view(np.uint64), held.column("hits").to_numpy()
    order = np.argsort(token)
    token, hits = token[order], hits[order]
    np.subtract.at(cells, _cell(token), hits)
    return Rarity(cells, token, hits + cells.max())


def prefix_entries(docs: DataFrame, size: int, percent: int, order: Rarity) -> DataFrame:
    """(token, set_key, n, place): the prefix of the ordered set of each document.

    A task leaves out the sets that it has sent of late, so copies of a document cost
    one entry per task however many there are; what is left of them is one row after
    the next shuffle.
    """
    known = docs.sparkSession.sparkContext.broadcast(order)
    types = {"token": pa.int64(), "set_key": pa.int64(), "n": pa.int32(), "place": pa.int32()}

    def prefix(s: np.ndarray) -> np.ndarray:
        """Places in ``s`` of its rarest shingles, by (count, hash); s is sorted, so ties keep that order."""
        n = len(s)
        long = n - -(-percent * n // 100) + 1
        rare = known.value.of(s)
        if long >= n:
            return np.argsort(rare, kind="stable")[:long]
        near = np.flatnonzero(rare <= np.partition(rare, long - 1)[long - 1])
        return near[np.argsort(rare[near], kind="stable")][:long]

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent = Lately()
        for batch in sliced(found):
            tokens, keys, sizes, places = [], [], [], []
            for _, s in _sets(text_bytes(batch.column(0)), size):
                key = _set_key(s) if len(s) else None
                if key is None or not sent.is_new(key):
                    continue
                order = prefix(s)
                tokens.append(s[order])
                keys.append(np.full(len(order), key))
                sizes.append(np.full(len(order), len(s)))
                places.append(np.arange(len(order)))
            if tokens:
                columns = np.concatenate(tokens).view(np.int64), *map(np.concatenate, (keys, sizes, places))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types.values())], names=list(types))

    return docs.select("text").mapInArrow(run, "token long, set_key long, n int, place int")


def _needed(a: Column, b: Column, percent: int) -> Column:
    """Least overlap of two sets of sizes a and b that are similar enough."""
    return F.ceil((a + b) * percent / (100 + percent) - 1e-9)


def _may_link(percent: int) -> Column:
    """Length filter and positional filter on the columns n, place, n2, place2."""
    n, n2 = F.col("n"), F.col("n2")
    left = F.least(n - F.col("place"), n2 - F.col("place2"))
    return (F.least(n, n2) * 100 >= F.greatest(n, n2) * percent) & (left >= _needed(n, n2, percent))


def _ends(pairs: DataFrame) -> DataFrame:
    """(set_key), stored, of the sets in stored pairs."""
    return staged(pairs.select(F.explode(F.array("a", "b")).alias("set_key")).distinct(), "ends")


def _suffix_filter(pairs: DataFrame, profiles: DataFrame, percent: int) -> DataFrame:
    """Stored pairs whose profiles leave room for the overlap they need."""
    held = matching(profiles.select("set_key", "n", "profile"), _ends(pairs), "set_key", "left_semi")

    def side(name: str) -> DataFrame:
        return held.select(
            F.col("set_key").alias(name), F.col("profile").alias(f"p_{name}"), F.col("n").alias(f"n_{name}"))

    met = F.zip_with("p_a", "p_b", lambda x, y: F.least(x, y))
    room = F.aggregate(met, F.lit(0), lambda s, x: s + x)
    return (
        pairs.join(side("a"), "a").join(side("b"), "b")
        .filter(room >= _needed(F.col("n_a"), F.col("n_b"), percent)).select("a", "b")
    )


def _verify(pairs: DataFrame, docs: DataFrame, owner: DataFrame, size: int, percent: int) -> DataFrame:
    """(a, b) of the pairs whose whole sets are similar enough.

    ``owner`` has one document per set; only the sets of pairs are built.
    """
    chosen = matching(owner.select("set_key", "doc_id"), _ends(pairs), "set_key", "left_semi")
    chosen = staged(chosen.select("doc_id", F.col("set_key").alias("wanted")), "wanted")
    texts = matching(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), chosen, "doc_id")

    def build(batch: pa.RecordBatch) -> Iterator[dict]:
        keys, sets = [], []
        for (_, s), want in zip(_sets(text_bytes(batch.column(0)), size), batch.column(1).to_pylist()):
            # A repeated doc_id may bring another text along.
            if len(s) and _set_key(s) == want:
                keys.append(want)
                sets.append(s.tobytes())
        yield {"set_key": keys, "shingles": sets}

    built = staged(
        arrow_map(texts.select("text", "wanted"), build, "set_key long, shingles binary",
                  set_key=pa.int64(), shingles=pa.binary()), "sets",
    )
    if not built.groupBy("set_key").count().filter("count > 1").isEmpty():  # rows that repeat a doc_id
        built = staged(built.dropDuplicates(["set_key"]), "sets")

    def check(batch: pa.RecordBatch) -> Iterator[dict]:
        a, b, x, y = (batch.column(i).to_pylist() for i in range(4))
        good = []
        for i in range(len(a)):
            one, two = np.frombuffer(x[i], np.uint64), np.frombuffer(y[i], np.uint64)
            met = len(np.intersect1d(one, two, assume_unique=True))
            if 100 * met >= percent * (len(one) + len(two) - met):
                good.append(i)
        yield {"a": [a[i] for i in good], "b": [b[i] for i in good]}

    both = pairs.join(built.select(F.col("set_key").alias("a"), F.col("shingles").alias("x")), "a").join(
        built.select(F.col("set_key").alias("b"), F.col("shingles").alias("y")), "b")
    return arrow_map(both.select("a", "b", "x", "y"), check, "a long, b long", a=pa.int64(), b=pa.int64())


def _ordered(x: Column, y: Column) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def similar_sets(
    docs: DataFrame, counted: DataFrame, size: int, percent: int,
) -> tuple[DataFrame, DataFrame]:
    """(links, classes): verified links (a, b) and (node, root) over set keys."""
    known = counted.filter("set_key is not null")
    owner = staged(
        known.groupBy("set_key").agg(
            F.min("doc_id").alias("doc_id"), F.max("n_shingles").cast("int").alias("n"),
            F.min("profile").alias("profile"),
        ), "owners",
    )
    entries = staged(prefix_entries(docs, size, percent, rarity(counted)), "prefixes")
    # A shingle that stands in one prefix only is let go by its hash alone.
    twice = staged(entries.groupBy("token").count().filter("count > 1").select("token"), "met_twice")
    # The hub of a token: the set with the fewest rarer shingles. All of this is
    # dealt by token once.
    common = matching(entries, twice, "token", "left_semi").repartition("token").dropDuplicates(["token", "set_key"])
    hubs = common.groupBy("token").agg(
        F.min(F.struct("place", "n", "set_key")).alias("hub"), F.count(F.lit(1)).alias("sets"))
    shared = staged(common.join(hubs.filter("sets > 1").drop("sets"), "token"), "shared")
    spokes = shared.filter("set_key != hub.set_key").select(
        "set_key", "n", "place", F.col("hub.set_key").alias("k2"),
        F.col("hub.n").alias("n2"), F.col("hub.place").alias("place2"),
    ).filter(_may_link(percent)).select(*_ordered(F.col("set_key"), F.col("k2"))).distinct()
    tried = staged(_suffix_filter(staged(spokes, "near_hubs"), owner, percent), "spokes")
    found = staged(_verify(tried, docs, owner, size, percent), "hub_links")
    first = of_checked_size(staged(components(found).withColumnRenamed("node", "set_key"), "hub_classes"))

    classed = shared.select("token", "set_key", "n", "place").join(
        first, "set_key", "left",
    ).withColumn("class", F.coalesce("root", "set_key")).drop("root")
    split = classed.groupBy("token").agg(
        F.min("class").alias("low"), F.max("class").alias("high")).filter("low != high").select("token")
    split = of_checked_size(staged(split, "split"))
    # The smaller set meets larger ones in its own size band or the next.
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / percent)) + 1e-9).cast("int")
    left = classed.join(split, "token").withColumn("band", band)
    other = left.select(
        "token", F.col("set_key").alias("k2"), F.col("n").alias("n2"), F.col("place").alias("place2"),
        F.col("class").alias("class2"), F.explode(F.array(F.col("band") - 1, "band")).alias("band"),
    )
    # The smaller set, or the smaller key, comes first: each pair once per token.
    in_order = (F.col("n") < F.col("n2")) | ((F.col("n") == F.col("n2")) & (F.col("set_key") < F.col("k2")))
    across = left.join(other, ["token", "band"]).filter(in_order & (F.col("class") != F.col("class2"))).filter(
        _may_link(percent)).select(*_ordered(F.col("set_key"), F.col("k2"))).distinct()
    untried = staged(across.join(tried, ["a", "b"], "left_anti"), "untried")
    new = staged(_suffix_filter(untried, owner, percent), "across")
    links = found.unionByName(_verify(new, docs, owner, size, percent))
    links = staged(links, "set_links")
    return links, components(links)


def jaccard_classes(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: (doc_id, n_shingles, component_id).

    Documents link when the Jaccard similarity of their shingle sets is at least
    ``percent`` per cent (whole number, 1 to 100); ``component_id`` is the least
    doc_id reachable over links. Texts are taken whole, lower-cased in A-Z only.
    A text of fewer than ``size`` words has one shingle, the whole; null, empty
    and blank texts have none and are their own component. Equal sets are one
    set, so copies cost one entry per task. Repeated rows give repeated results. A row
    without doc_id is in the component of an equal set of a document with one, else
    alone, without a name. Other columns are ignored; an empty table gives an empty
    table.
    """
    with small_batches(docs.sparkSession):
        counted = staged(shingle_sets(docs, size), "shingles")
        _, classes = similar_sets(docs, counted, size, percent)
    rows = counted.filter("n_shingles is not null").select("doc_id", "n_shingles", "set_key")
    rooted = rows.filter("set_key is not null").groupBy("set_key").agg(F.min("doc_id").alias("least")).join(
        classes.withColumnRenamed("node", "set_key"), "set_key", "left",
    ).withColumn("root", F.coalesce("root", "set_key"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = staged(rooted.join(named, "root").select("set_key", "component_id"), "labels")
    return rows.join(labels, "set_key", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
