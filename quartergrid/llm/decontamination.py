"""Benchmark decontamination as a prefix-filtered containment join.

Only DataFrame functions are used. A window of an item counts when all of it
occurs, so of its shingles one, the rarest in the corpus, must be found: with a
containment of 1 the necessary prefix is a single token. Documents give the
places of all item shingles in one pass; the counts of these order the shingles.
Places of rarest shingles that leave room for the window before and after them
are verified against all words of the window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quartergrid.llm.common import of_checked_size, staged

WINDOW = 10
SHINGLE = 3

_SEPARATORS = "".join(chr(c) for c in [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words(text: Column) -> Column:
    """Lower-case words (A-Z only) between runs of ASCII that is no letter or digit."""
    plain = F.trim(F.translate(text, _UPPER + _SEPARATORS, _UPPER.lower() + " " * len(_SEPARATORS)))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " +"))


def _shingle(size: int, *parts: Column) -> Column:
    return F.xxhash64(F.lit(size), *parts[:size])


def _shingles(rows: DataFrame, sizes: list[int], *carried: str) -> DataFrame:
    """(carried, place, size, shingle) of every run of each of ``sizes`` words of the column ``words``."""
    shifted = [F.col("words").alias("w1")] + [
        F.slice("words", k, F.greatest(F.size("words"), F.lit(1))).alias(f"w{k}") for k in range(2, max(sizes) + 1)]
    each = rows.select(*carried, F.posexplode(F.arrays_zip(*shifted)).alias("place", "run"))
    runs = [
        F.when(F.col(f"run.w{size}").isNotNull(), F.struct(
            F.lit(size).alias("size"), _shingle(size, *(F.col(f"run.w{k}") for k in range(1, size + 1))).alias("shingle")))
        for size in sizes
    ]
    if len(runs) > 1:
        return each.select(*carried, "place", F.inline(F.array_compact(F.array(*runs))))
    return each.select(*carried, "place", runs[0].alias("r")).filter("r is not null").select(*carried, "place", "r.size", "r.shingle")


def item_windows(items: DataFrame, window: int) -> DataFrame:
    """(item_id, window_id, words): the windows of each item; a short item is one."""
    listed = items.filter("item_id is not null and text is not null").select(
        F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("all")).filter(F.size("all") > 0)
    size = F.least(F.size("all"), F.lit(window))
    starts = F.explode(F.sequence(F.lit(1), F.size("all") - size + 1))
    cut = listed.withColumn("size", size).withColumn("start", starts)
    return cut.select("item_id", F.slice("all", F.col("start"), F.col("size")).alias("words")).withColumn(
        "window_id", F.md5(F.array_join("words", " "))).distinct()


def _matches(texts: DataFrame, shingles: DataFrame) -> DataFrame | None:
    """(text_id, n, size, place, shingle): where item shingles stand in the texts.

    Equal texts give equal rows, which are one row after a sum in their tasks.
    """
    sizes = sorted(r[0] for r in shingles.select("size").distinct().collect())  # 1 to SHINGLE
    if not sizes:
        return None
    wanted = staged(shingles.select("size", "shingle").distinct(), "item_shingles")
    places = _shingles(texts, sizes, "text_id", "n").join(of_checked_size(wanted), ["size", "shingle"])
    return places.select("text_id", "n", "size", "place", "shingle").distinct()


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: (doc_id, n_words, n_hit, n_items, items_sha256, contaminated, item_ids).

    ``n_hit`` counts the words inside any occurrence of a window of an item,
    ``item_ids`` are the items with such windows, sorted as strings. Null and
    empty texts have no words. Items without words, text or id have no windows;
    repeated items are one. Equal texts are matched once; every row keeps a
    result, with its doc_id as it is. Other columns are ignored; empty documents
    give an empty table, empty items hit nothing.
    """
    spark = docs.sparkSession
    windows = staged(item_windows(items, window), "item_windows")
    distinct = windows.select("window_id", "words").distinct()
    parts = None
    for size in range(1, SHINGLE + 1):
        fits = F.size("words") >= size if size == SHINGLE else F.size("words") == size
        part = _shingles(distinct.filter(fits), [size], "window_id")
        parts = part if parts is None else parts.unionByName(part)
    shingles = staged(parts, "window_shingles")

    every = docs.select("doc_id", "text", F.md5("text").alias("text_id"))
    split = every.filter("text is not null").select("text_id", words(F.col("text")).alias("words")).withColumn(
        "n", F.size("words"))
    found = _matches(split, shingles)
    if found is None:  # no item has a word
        found = spark.createDataFrame([], "text_id string, n int, size int, place int, shingle long")
    found = staged(found, "matches")

    # Rare first: the shingle of each window with the fewest places in the corpus.
    counts = found.groupBy("size", "shingle").agg(F.count(F.lit(1)).alias("hits"))
    rarest = shingles.join(counts, ["size", "shingle"], "left").groupBy("window_id").agg(
        F.min(F.struct(F.coalesce("hits", F.lit(0)).alias("hits"), "size", "shingle", "place")).alias("p"))
    prefix = staged(rarest.filter("p.hits > 0").join(distinct, "window_id").select(
        F.col("p.size").alias("size"), F.col("p.shingle").alias("shingle"), F.col("p.place").alias("inside"),
        "window_id", F.size("words").alias("k")), "prefixes")
    start = F.col("place") - F.col("inside")
    near = found.join(prefix, ["size", "shingle"]).withColumn("start", start).filter(
        (F.col("start") >= 0) & (F.col("start") + F.col("k") <= F.col("n")))
    candidates = staged(near.groupBy("text_id").agg(
        F.collect_set(F.struct("start", "k", "window_id")).alias("tries")), "candidates")

    # Few texts have a candidate: only those leave their place. A window is known by
    # the hash of its words.
    few = of_checked_size(candidates.select("text_id"))
    tried = split.drop("n").join(few, "text_id", "left_semi").join(candidates, "text_id")
    here = lambda c: F.md5(F.array_join(F.slice("words", c["start"] + 1, c["k"]), " "))
    verified = tried.select("text_id", F.filter("tries", lambda c: here(c) == c["window_id"]).alias("hits")).filter(
        F.size("hits") > 0)
    covered = F.transform("hits", lambda c: F.sequence(c["start"], c["start"] + c["k"] - 1))
    hits = staged(verified.select(
        "text_id", F.size(F.array_distinct(F.flatten(covered))).alias("n_hit"),
        F.array_distinct(F.transform("hits", lambda c: c["window_id"])).alias("window_ids"),
    ).dropDuplicates(["text_id"]), "hits")
    named = hits.select("text_id", F.explode("window_ids").alias("window_id")).join(
        windows.select("window_id", "item_id"), "window_id").groupBy("text_id").agg(
        F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    results = staged(hits.select("text_id", "n_hit").join(named, "text_id"), "contaminated")

    counted = every.select("doc_id", "text_id", F.coalesce(F.size(words(F.col("text"))), F.lit(0)).alias("n_words"))
    none = F.array().cast("array<string>")
    out = counted.join(results, "text_id", "left").withColumn("item_ids", F.coalesce("item_ids", none))
    return out.select(
        "doc_id", F.greatest("n_words", F.lit(0)).cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"), "item_ids",
    )
