"""Word-vector averages of descriptions and of cells."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from quartergrid.functions.text import arrow_tokens, lowered


def only_known_cells(events: DataFrame, poi: DataFrame) -> DataFrame:
    """Events in cells that have points of interest."""
    return events.join(poi.select("cell"), "cell", "left_semi")


# Tokens that a task gathers before it counts them, and bytes of text that it splits at a time.
HELD_WEIGHTS, HELD_BYTES = 1 << 21, 4 << 20


def _dealt(texts: DataFrame, key: str, text: str, parts: int) -> DataFrame:
    """(part, key, text): lower-cased texts dealt out by key, equal keys in one part and side by side."""
    part = F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")
    rows = texts.select(part.alias("part"), key, F.col(text).alias("text"))
    dealt = rows.repartitionById(parts, "part").sortWithinPartitions("part", key)
    return dealt.select("part", key, lowered(F.col("text")).alias("text"))


def _counted(words: list[pa.Array], owners: list[np.ndarray], uses: list[np.ndarray]) -> tuple:
    """(list of words, place of a word in it, owner, uses), by word and owner, each pair once."""
    coded = pa.concat_arrays(words).dictionary_encode()
    pair = coded.indices.to_numpy().astype(np.int64) << 32 | np.concatenate(owners)
    order = np.argsort(pair)
    pair = pair[order]
    one = np.flatnonzero(_changes(pair))
    return coded.dictionary, pair[one] >> 32, pair[one] & 0xFFFFFFFF, np.add.reduceat(np.concatenate(uses)[order], one)


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list, pa.Array, np.ndarray, np.ndarray]]:
    """(part, keys so far in it, words, number of the key of each word, ones) from rows of :func:`_dealt`."""
    part, keys = None, []
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        cuts = _changes(batch.column(0).to_numpy()).cumsum() * (sizes.sum() // HELD_BYTES + 1) + sizes.cumsum() // HELD_BYTES
        for first, last in _runs(cuts):
            now, names = batch.column(0)[first].as_py(), batch.column(1).slice(first, last - first).to_pylist()
            if now != part:
                part, keys = now, []
            numbers = np.empty(last - first, np.int64)
            for i, name in enumerate(names):
                if not keys or not (keys[-1] == name or (keys[-1] != keys[-1] and name != name)):
                    keys.append(name)
                numbers[i] = len(keys) - 1
            words, counts = arrow_tokens(batch.column(2).slice(first, last - first))
            yield part, keys, words, np.repeat(numbers, counts), np.ones(len(words), np.int64)


def _lists(words: pa.Array, place: np.ndarray, *columns: pa.Array) -> list[pa.Array]:
    """One row per word, with the values of its owners as lists."""
    row = np.flatnonzero(_changes(place))
    offsets = pa.array(np.append(row, len(place)).astype(np.int32))
    return [words.take(pa.array(place[row])), *(pa.ListArray.from_arrays(offsets, c) for c in columns)]


def postings(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(word, keys, uses): the keys of the texts that use a word, and how often each does.

    A task counts what it gathers and sends one row per word, so a word has several
    rows. A key and a word meet in one row only, however many texts share the key.
    """
    spark = texts.sparkSession
    kind = texts.schema[key].dataType
    dealt = _dealt(texts, key, text, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        total, kept, part, keys = 0, 0, None, []
        types: list[pa.DataType] = []

        def counted(whole: bool) -> Iterator[pa.RecordBatch]:
            """Send what is held; but for the end of a part, the last key may go on and stays."""
            nonlocal held, total, kept
            words, place, owner, uses = _counted(*zip(*held))
            stays = np.zeros(len(owner), bool) if whole else owner == len(keys) - 1
            held, total = [], 0
            if stays.any():
                held = [(words.take(pa.array(place[stays])), owner[stays], uses[stays])]
                total = int(stays.sum())
            kept, goes = total, ~stays
            if goes.any():
                low = int(owner[goes].min())  # few of a part's keys are held at a time
                names = pa.array(keys[low : int(owner[goes].max()) + 1], types[0]).take(pa.array(owner[goes] - low))
                yield pa.RecordBatch.from_arrays(
                    _lists(words, place[goes], names, pa.array(uses[goes])), names=["word", "keys", "uses"])

        def seen() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                types[:] = [batch.column(1).type]
                yield batch

        for now, names, *some in _numbered(seen()):
            if now != part and held:
                yield from counted(True)
            part, keys = now, names
            if len(some[0]):
                held.append(tuple(some))
                total += len(some[0])
            if total > max(HELD_WEIGHTS, 2 * kept):
                yield from counted(False)
        if held:
            yield from counted(True)

    return dealt.mapInArrow(run, StructType([
        StructField("word", StringType()), StructField("keys", ArrayType(kind)), StructField("uses", ArrayType(LongType()))]))


def _owners(found: DataFrame, key: str, *rest: str) -> DataFrame:
    """(word, key, uses) and ``rest``: a row for each key of :func:`postings`."""
    each = F.inline(F.arrays_zip("keys", "uses")).alias(key, "uses")
    return found.select("word", each, *rest)


def token_counts(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(word, key, uses): repeats are counted before anything is shuffled."""
    return _owners(postings(texts, key, text), key)


def token_vectors(texts: DataFrame, vectors: DataFrame, key: str, text: str) -> DataFrame:
    """(word, key, uses, vec) of the known tokens; unknown tokens vanish.

    A word meets its vector with all the keys that a task has seen use it.
    """
    found = postings(texts, key, text).join(vectors, "word")
    return _owners(found, key, *(c for c in vectors.columns if c != "word"))


# Dimensions that are summed side by side: an aggregate of more columns is not compiled.
CHUNK = 32


def weighted_mean(rows: DataFrame, key: str, dims: int) -> DataFrame:
    """(key, vec): mean of the vectors of a key, each counted ``uses`` times.

    One plain sum per dimension, in chunks: fixed-width buffers that are
    combined before the shuffle, however many rows a key has.
    """
    chunks = F.array(*(F.slice("vec", at + 1, CHUNK) for at in range(0, dims, CHUNK)))
    parts = rows.select(key, "uses", F.posexplode(chunks).alias("chunk", "part"))
    sums = parts.groupBy(key, "chunk").agg(
        F.sum("uses").alias("uses"),
        *(F.sum(F.col("uses") * F.get("part", F.lit(i))).alias(f"v{i}") for i in range(CHUNK)),
    )
    means = F.array(*(F.col(f"v{i}") / F.col("uses") for i in range(CHUNK)))
    whole = sums.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("chunk", means.alias("means")))).alias("chunks"))
    return whole.select(key, F.slice(F.flatten(F.col("chunks.means")), 1, dims).alias("vec"))


# Numbers that a task sums at a time: sums of texts, products with vectors.
HELD_CELLS, DENSE_CELLS = 1 << 23, 1 << 17
# A list of words up to so many bytes is sent to every executor; with each word goes a row of a hash table.
DICTIONARY_BYTES, ROW_BYTES = 64 << 20, 48


def text_means(texts: DataFrame, vectors: DataFrame, key: str, text: str, dims: int, stored: bool = False) -> DataFrame:
    """(key, vec): mean vector of a text's known tokens, repeats included.

    A text without any known token has no row. Texts are dealt out in groups, as few
    as the sums of a group fit a task. A word travels with its vector once to each
    group that uses it, along with the numbers of the texts in the group; the group's
    task adds it to their sums as it comes. So what moves grows with the texts, and
    with the words of a group only once. ``stored`` says that texts and vectors are
    stored tables; then unknown words are dropped before they move, if the list of
    words is small.
    """
    spark = texts.sparkSession
    texts = texts.select(key, text).filter(F.col(text).isNotNull())
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = max(spark.sparkContext.defaultParallelism, -(-texts.count() // max(1, HELD_CELLS // (dims + 1))))
    share = -(-tasks // groups)  # parts of a group
    found = _group_postings(_dealt(texts, key, text, groups * share), share)
    if stored:
        words = vectors.select("word")
        size = words.agg(F.sum(F.octet_length("word") + ROW_BYTES)).first()[0] or 0
        if size <= DICTIONARY_BYTES:
            found = found.join(F.broadcast(words), "word", "left_semi")
    parts = F.collect_list(F.struct("numbers", "uses"))
    by_word = found.repartition("word").groupBy("word", "group").agg(parts.alias("parts"))
    exact = F.when(F.size("vec") == dims, F.col("vec")).otherwise(
        F.transform(F.sequence(F.lit(0), F.lit(dims - 1)), lambda i: F.get("vec", i)))
    used = by_word.join(vectors.select("word", exact.alias("vec")), "word").select(
        "group", F.flatten("parts.numbers").alias("numbers"), F.flatten("parts.uses").alias("uses"), "vec")
    part = F.pmod(F.xxhash64(key), F.lit(groups * share)).cast("int")
    place = F.row_number().over(Window.partitionBy("part").orderBy(key)) - 1
    keys = texts.select(key).distinct().select(part.alias("part"), key).select(
        F.expr(f"int(part div {share})").alias("group"), (place * share + F.col("part") % share).alias("number"), key)
    rows = keys.unionByName(used, allowMissingColumns=True).select("group", "number", key, "numbers", "uses", "vec")
    return _group_means(rows.repartitionById(groups, "group"), key, dims)


def _group_postings(dealt: DataFrame, share: int) -> DataFrame:
    """(group, word, numbers, uses) of rows of :func:`_dealt`, ``share`` parts to a group.

    The keys of a part are numbered in their order; keys of a group have different numbers.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        total, part = 0, None

        def counted() -> pa.RecordBatch:
            words, place, owner, uses = _counted(*zip(*held))
            numbers = pa.array((owner * share + part % share).astype(np.int32))
            lists = _lists(words, place, numbers, pa.array(uses.astype(np.int32)))
            group = pa.array(np.full(len(lists[0]), part // share, np.int32))
            return pa.RecordBatch.from_arrays([group, *lists], names=["group", "word", "numbers", "uses"])

        for now, _, *some in _numbered(batches):
            if held and (now != part or total > HELD_WEIGHTS):
                yield counted()
                held, total = [], 0
            part = now
            if len(some[0]):
                held.append(tuple(some))
                total += len(some[0])
        if held:
            yield counted()

    return dealt.mapInArrow(run, "group int, word string, numbers array<int>, uses array<int>")


def _group_means(rows: DataFrame, key: str, dims: int) -> DataFrame:
    """(key, vec) from the texts of a group (number, key) and its words (numbers, uses, vec), in any order."""
    def added(table: np.ndarray, at: np.ndarray, owner: np.ndarray, uses: np.ndarray, values: np.ndarray) -> None:
        """Add the values of the owners, times uses, to the rows of the table; ``at`` is sorted."""
        step = max(1, DENSE_CELLS // (dims + 1))
        for low in range(0, len(at), step):
            some = slice(low, low + step)
            one = np.flatnonzero(_changes(at[some]))
            table[at[some][one]] += np.add.reduceat(values[owner[some]] * uses[some, None], one)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # By group: sums and weights, weights of missing values if there are any, and the texts.
        sums: dict[int, np.ndarray] = {}
        gaps: dict[int, np.ndarray] = {}
        texts: dict[int, list] = {}

        def grown(tables: dict[int, np.ndarray], group: int, size: int) -> np.ndarray:
            table = tables.get(group, np.zeros((0, dims + 1)))
            if len(table) < size:
                table = np.vstack([table, np.zeros((max(size, len(table) * 5 // 4) - len(table), dims + 1))])
                tables[group] = table
            return table

        for batch in batches:
            groups = batch.column(0).to_numpy()
            for group in np.unique(groups).tolist():
                mine = batch.filter(pa.array(groups == group))
                is_text = pc.is_valid(mine.column(1))
                texts.setdefault(group, []).append(mine.filter(is_text).select([1, 2]))
                words = mine.filter(pc.invert(is_text))
                if not words.num_rows:
                    continue
                flat = words.column(5).flatten()
                vectors = np.ones((words.num_rows, dims + 1))
                vectors[:, :dims] = pc.fill_null(flat, 0.0).to_numpy(zero_copy_only=False).reshape(-1, dims)
                missing = pc.is_null(flat).to_numpy(zero_copy_only=False).reshape(-1, dims) if flat.null_count else None
                owner = np.repeat(np.arange(words.num_rows), pc.list_value_length(words.column(3)))
                at, uses = (words.column(i).flatten().to_numpy(zero_copy_only=False) for i in (3, 4))
                order = np.argsort(at, kind="stable")
                at, owner, uses = at[order], owner[order], uses[order]
                table = grown(sums, group, int(at[-1]) + 1)
                added(table, at, owner, uses, vectors)
                if missing is not None:
                    added(grown(gaps, group, len(table))[:, :dims], at, owner, uses, missing)
        for group, table in sums.items():
            for named in texts[group]:
                for low in range(0, named.num_rows, 10_000):
                    some = named.slice(low, 10_000)
                    at = some.column(0).to_numpy()
                    known = at < len(table)
                    known[known] = table[at[known], -1] > 0
                    at, names = at[known], some.column(1).filter(pa.array(known))
                    weight = table[at, -1:]
                    values = (table[at, :dims] / weight).ravel()
                    lost = (grown(gaps, group, len(table))[at, :dims] == weight).ravel() if group in gaps else None
                    offsets = pa.array(np.arange(len(at) + 1, dtype=np.int32) * dims)
                    vec = pa.ListArray.from_arrays(offsets, pa.array(values, mask=lost))
                    yield pa.RecordBatch.from_arrays([names, vec], names=[key, "vec"])

    return rows.mapInArrow(run, StructType([rows.schema[key], StructField("vec", ArrayType(DoubleType()))]))


# Blocks that the words are numbered in, and bits of an id that number the words of a block.
BLOCKS, PLACE_BITS = 1024, 32


def dictionary(vectors: DataFrame) -> DataFrame:
    """(word, id): whole numbers for words, from 0 in each of a fixed number of blocks.

    A word's block follows from its hash, so frequent words are dealt out evenly.
    """
    block = F.pmod(F.xxhash64("word"), F.lit(BLOCKS)).cast("long")
    place = F.row_number().over(Window.partitionBy("block").orderBy("word")) - 1
    return vectors.select("word", block.alias("block")).select(
        "word", (F.shiftleft("block", PLACE_BITS) + place).alias("id"))


def _changes(values: np.ndarray) -> np.ndarray:
    """Whether each value differs from the one before; the first does."""
    return np.append(True, values[1:] != values[:-1])


def _runs(values: np.ndarray) -> list[tuple[int, int]]:
    """(begin, end) of the runs of equal neighbours."""
    edges = [*np.flatnonzero(_changes(values)).tolist(), len(values)] if len(values) else []
    return list(zip(edges, edges[1:]))


def cell_means(
    events: DataFrame, vectors: DataFrame, dims: int, stage: Callable[[str, DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """(cell, vec): mean of the description means of a cell.

    Every event counts once, however long its description. Equal descriptions are
    one text with one mean, weighted in each cell by its events. Vectors should be
    stored; ``stage`` stores the texts, which are read more than once.
    """
    keyed = events.filter(F.col("description").isNotNull()).select(
        "cell", "description", F.unhex(F.md5("description")).alias("text_id")
    )
    texts = keyed.select("text_id", "description").distinct()
    if stage:
        texts = stage("texts", texts)
    uses = keyed.groupBy("cell", "text_id").agg(F.count(F.lit(1)).alias("uses"))
    means = text_means(texts, vectors, "text_id", "description", dims, stored=True)
    return weighted_mean(uses.join(means, "text_id"), "cell", dims)
