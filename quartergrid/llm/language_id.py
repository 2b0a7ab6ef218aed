"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased, everything that is no letter becomes one space, and the
n-grams of 1 to ``MAX_N`` characters are hashed into a fixed number of buckets.
Training sums n-grams per language and bucket over all labelled texts. The model
is a matrix of log probabilities, buckets by languages, broadcast to executors
that score whole batches of texts with sparse sums in numpy, in one pass for each
block of languages.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quartergrid.llm.common import staged

BUCKET_BITS = 16
MAX_N = 3
#: Languages whose part of the matrix, 2 ** BUCKET_BITS numbers each, is held at a time.
BLOCK_LANGUAGES = 256
#: Characters that are hashed together; a longer text is summed in parts.
BATCH_CHARS = 1 << 20
UNKNOWN = "und"
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def _overlap(text: str, at: int) -> int:
    """Where a part that goes on at ``at`` must begin to hold the n-grams that end after it.

    Runs of what is no letter count as one character.
    """
    need = MAX_N - 1
    while at > 0 and need:
        at -= 1
        need -= text[at].isalpha() or at == 0 or text[at - 1].isalpha()
    return at


def _parts(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(code points, number of the text of each, whether the part before had it) of texts with letters.

    Parts are of bounded size; those of a long text overlap, so that no n-gram is lost.
    """
    held: list[np.ndarray] = []
    owners: list[int] = []
    before: list[int] = []
    size = 0

    def part() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sizes = [len(h) for h in held]
        old = np.concatenate([np.arange(n) < b for n, b in zip(sizes, before)])
        return np.concatenate(held), np.repeat(owners, sizes), old

    for i, text in enumerate(texts):
        if not any(map(str.isalpha, text)):
            continue
        text = text.lower()
        for at in range(0, len(text), BATCH_CHARS):
            begin = _overlap(text, at)
            held.append(np.frombuffer(text[begin : at + BATCH_CHARS].encode("utf-32-le", "surrogatepass"), np.uint32))
            owners.append(i)
            before.append(at - begin)
            size += len(held[-1])
            if size >= BATCH_CHARS:
                yield part()
                held, owners, before, size = [], [], [], 0
    if held:
        yield part()


def ngrams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, number of the text) of n-grams, grouped by text within each part.

    Texts without a letter have none. N-grams that end in what a part has from the
    one before are counted there.
    """
    for points, owner, old in _parts(texts):
        letter = _letters()[points]
        x = np.where(letter, points, np.uint32(32))
        same = np.empty(len(owner), bool)
        same[0], same[1:] = False, owner[1:] == owner[:-1]
        space = ~letter
        keep = np.ones(len(x), bool)
        keep[1:] = ~(space[1:] & space[:-1] & same[1:])
        x, owner, old = x[keep], owner[keep], old[keep]
        h = np.zeros(len(x), np.uint32)
        for n in range(1, MAX_N + 1):
            if len(x) < n:
                break
            h = h[: len(x) - n + 1] + x[n - 1 :] * _FACTORS[n - 1]
            mixed = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D) + np.uint32(n)
            mixed = (mixed ^ (mixed >> np.uint32(12))) * np.uint32(0x297A2D39)
            inside = (owner[: len(h)] == owner[n - 1 :]) & ~old[n - 1 :]
            yield (mixed >> np.uint32(32 - BUCKET_BITS)).astype(np.int64)[inside], owner[: len(h)][inside]


class Model(NamedTuple):
    """Languages in order of name, log probabilities by language and bucket, log priors."""

    names: list[str]
    weights: np.ndarray
    priors: np.ndarray


def counts(labelled: DataFrame) -> DataFrame:
    """(lang, bucket, n): n-grams of all labelled texts; bucket -1 counts the texts.

    ``labelled`` has ``text`` and ``lang``; rows without either are left out. Counts
    are summed per task, then over all.
    """
    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        docs: Counter[str] = Counter()
        for batch in found:
            texts, langs = batch.column(0).to_pylist(), np.array(batch.column(1).to_pylist(), object)
            docs.update(langs.tolist())
            for bucket, owner in ngrams(texts):
                spoken = langs[owner]
                for name in set(langs[np.unique(owner)]):
                    own = np.bincount(bucket[spoken == name], minlength=1 << BUCKET_BITS)
                    counts[name] = counts.get(name, 0) + own
        for name, n in docs.items():
            some = counts.get(name, np.zeros(1, np.int64))
            what = np.flatnonzero(some)
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([name] * (len(what) + 1), pa.string()),
                "bucket": pa.array(np.append(what, -1), pa.int32()), "n": pa.array(np.append(some[what], n), pa.int64())})

    known = labelled.select("text", F.col("lang").cast("string")).filter("text is not null and lang is not null")
    return staged(known.mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(
        F.sum("n").alias("n")), "ngrams")


def models(counted: DataFrame, size: int = BLOCK_LANGUAGES) -> Iterator[Model]:
    """The model in blocks of ``size`` languages, smoothed by one; priors are over all languages.

    The driver holds one block at a time, beside the number of texts of each language.
    """
    texts = sorted((r["lang"], r["n"]) for r in counted.filter("bucket < 0").select("lang", "n").collect())
    total = sum(n for _, n in texts)
    for begin in range(0, len(texts), size):
        names = [name for name, _ in texts[begin : begin + size]]
        rows = counted.filter(F.col("lang").between(names[0], names[-1]) & (F.col("bucket") >= 0)).toArrow()
        number = pc.index_in(rows.column("lang"), pa.array(names, pa.string())).to_numpy()
        n = np.ones((len(names), 1 << BUCKET_BITS), np.float64)
        n[number, rows.column("bucket").to_numpy()] += rows.column("n").to_numpy()
        weights = np.log(n / n.sum(axis=1, keepdims=True))
        yield Model(names, weights.astype(np.float32), np.log([n / total for _, n in texts[begin : begin + size]]))


def train(labelled: DataFrame) -> Model:
    """All blocks of the model as one, for few languages."""
    parts = list(models(counts(labelled)))
    if not parts:
        return Model([], np.ones((0, 1 << BUCKET_BITS), np.float32), np.zeros(0))
    return Model(sum((p.names for p in parts), []), np.concatenate([p.weights for p in parts]),
                 np.concatenate([p.priors for p in parts]))


def scores(texts: list[str], weights: np.ndarray, priors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether a text has letters, log probabilities by text and language)."""
    total = np.tile(priors, (len(texts), 1))
    lettered = np.zeros(len(texts), bool)
    for bucket, owner in ngrams(texts):
        if not len(owner):
            continue
        starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        who = owner[starts]
        lettered[who] = True
        for i, row in enumerate(weights):
            total[who, i] += np.add.reduceat(row[bucket], starts, dtype=np.float64)
    return lettered, total


def _scored(rows: DataFrame, model: Model, carried: list[str], keep_text: bool) -> DataFrame:
    """(carried[, text], lang_pred, top, mass) after one more block of languages.

    ``top`` is the log probability of the best language yet, ``mass`` the sum of all
    relative to it. ``rows`` has these columns too, but before the first block.
    """
    known = rows.sparkSession.sparkContext.broadcast(model)
    later = "top" in rows.columns

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, weights, priors = known.value
        for batch in found:
            text = batch.column("text")
            lettered, total = scores([t or "" for t in text.to_pylist()], weights, priors)
            most = total.argmax(axis=1)
            top = total.max(axis=1)
            mass = np.exp(total - top[:, None]).sum(axis=1)
            best = [names[i] if yes else UNKNOWN for i, yes in zip(most, lettered)]
            if later:
                was, held = batch.column("top").to_numpy(), batch.column("mass").to_numpy()
                old = batch.column("lang_pred").to_pylist()
                high = np.maximum(was, top)
                mass = held * np.exp(was - high) + mass * np.exp(top - high)
                best = [new if b > a else one for a, b, one, new in zip(was, top, old, best)]
                top = high
            mass = np.where(lettered, mass, np.inf)
            columns = [batch.column(c) for c in carried] + [text] * keep_text
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(best, pa.string()), pa.array(top), pa.array(mass)],
                names=[*carried, *["text"] * keep_text, "lang_pred", "top", "mass"])

    taken = rows.select(*carried, "text", *(["lang_pred", "top", "mass"] if later else []))
    kinds = dict(taken.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in [*carried, *["text"] * keep_text])
    return taken.mapInArrow(run, f"{schema}, lang_pred string, top double, mass double")


def predict(docs: DataFrame, counted: DataFrame, *carried: str, size: int = BLOCK_LANGUAGES) -> DataFrame:
    """(carried, lang_pred, score) of the column ``text`` of every row.

    ``counted`` is from :func:`counts`. One pass over the texts for each ``size``
    languages; between passes the rows are stored, so a task holds one block.
    """
    n = counted.filter("bucket < 0").count()
    rows = docs.select(*carried, "text")
    if not n:
        return rows.select(*carried, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    for i, model in enumerate(models(counted, size)):
        last = (i + 1) * size >= n
        rows = _scored(rows, model, list(carried), keep_text=not last)
        if not last:
            rows = staged(rows, "scored")
    return rows.select(*carried, "lang_pred", (1 / F.col("mass")).alias("score"))


def identify_languages(docs: DataFrame, held_out: Column) -> DataFrame:
    """One row per document: (doc_id, held_out, lang_pred, score).

    Learns from ``text`` and ``lang`` of all rows that are not ``held_out`` and
    predicts from the text alone, each taken whole. ``lang_pred`` is a learned
    value, ties go to the first by name; ``score`` is its posterior probability.
    A text that is null or has no letter is ``und`` with score 0, and so is all
    when nothing could be learned. Repeated rows count and are scored each; a null
    doc_id stays; other columns are ignored; an empty table gives an empty table.
    """
    split = docs.select("doc_id", held_out.alias("held_out"), "text", "lang")
    counted = counts(split.filter(~F.coalesce("held_out", F.lit(False))))
    return predict(split, counted, "doc_id", "held_out")
