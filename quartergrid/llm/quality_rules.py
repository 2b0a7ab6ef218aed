"""Quality rules by tokeniser fertility, with bands per language and script.

Two public vocabularies measure each text: a byte-level one gives the characters
per token and the entropy of its tokens, and one of pieces tells which bytes it
would have to spell out. Texts of a language and script, and of a like number of
tokens, form a group. What lies far outside the quartiles of its group is
rejected; a group of few texts takes the quartiles of a wider one, so every text
is judged.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quartergrid.llm.common import arrow_map, of_checked_size, staged, text_bytes
from quartergrid.llm.hashing import Words, batches
from quartergrid.llm.tokens import BYTE_RANKS, PIECES, own_characters, token_ids

MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
REPEAT_WINDOW = 5
SYMBOLS = b"#*$%&|<>"
#: A band reaches so many quartile distances beyond the quartiles,
FENCE = 1.5
#: and from the median at least by ``sampling / sqrt(n_tokens)``, what chance alone
#: moves a text: a share of the median for characters per token, plain differences
#: for the other two. Above the median, where short formal texts lie, HIGH_SIDE times that.
SAMPLING = {"chars_per_token": 0.6, "token_entropy": 0.3, "byte_share": 0.5}
HIGH_SIDE = {"chars_per_token": 3.0, "token_entropy": 3.0, "byte_share": 1.0}
#: Quartiles of few members are unsure: their fence is longer by the factor 1 + FEW / members.
FEW = 4
#: The quartiles of a group weigh as much as those of the next wider group when it has so many different texts.
OWN_BAND = 50
#: First and last code point of letters, by script.
SCRIPTS = (
    ("Latin", 0xC0, 0x24F), ("Greek", 0x370, 0x3FF), ("Cyrillic", 0x400, 0x52F), ("Hebrew", 0x590, 0x5FF),
    ("Arabic", 0x600, 0x6FF), ("Devanagari", 0x900, 0x97F), ("Thai", 0xE00, 0xE7F), ("Hangul", 0x1100, 0x11FF),
    ("Latin", 0x1E00, 0x1EFF), ("Kana", 0x3040, 0x30FF), ("Han", 0x3400, 0x4DBF), ("Han", 0x4E00, 0x9FFF),
    ("Hangul", 0xAC00, 0xD7AF),
)
_STARTS = np.array([s[1] for s in SCRIPTS])
_ENDS = np.array([s[2] for s in SCRIPTS])
_NAMES = sorted({s[0] for s in SCRIPTS})
_CODE = np.array([_NAMES.index(s[0]) for s in SCRIPTS])
_FOREIGN = re.compile(r"[^\x00-\x7f]+")
_SPACES = np.frombuffer(b"\t\n\x0b\x0c\r ", np.uint8)
_LETTERS = np.array([*range(65, 91), *range(97, 123)])


def script_of(letters: int, foreign: np.ndarray) -> str:
    """Script of most letters: ``letters`` of A-Z and the code points beyond ASCII."""
    at = np.searchsorted(_STARTS, foreign, side="right") - 1
    inside = (at >= 0) & (foreign <= _ENDS[np.maximum(at, 0)])
    counts = np.bincount(_CODE[at[inside]], minlength=len(_NAMES))
    counts[_NAMES.index("Latin")] += letters
    return _NAMES[int(counts.argmax())] if counts.any() else "none"


def repeated_words(windows: np.ndarray, size: int) -> int:
    """Words that windows found twice or more cover; windows follow each other."""
    in_order = np.sort(windows)
    if not (in_order[1:] == in_order[:-1]).any():
        return 0
    _, group, times = np.unique(windows, return_inverse=True, return_counts=True)
    start = np.flatnonzero(times[group] > 1)
    change = np.zeros(len(windows) + size, np.int64)
    np.add.at(change, start, 1)
    np.add.at(change, start + size, -1)
    return int((np.cumsum(change) > 0).sum())


def _entropy(ids: np.ndarray) -> float:
    """Entropy of the tokens over the most that so many tokens can have, 0 to 1."""
    if len(ids) < 2:
        return 0.0
    counts = np.bincount(ids) if len(ids) > 20_000 else np.unique(ids, return_counts=True)[1]
    share = counts[counts > 0] / len(ids)
    return float(-(share * np.log2(share)).sum() / np.log2(len(ids)))


def measures(docs: DataFrame, vocabulary: str = BYTE_RANKS, pieces: str = PIECES) -> DataFrame:
    """doc_id, the base counts, and script, n_tokens and the three token measures."""
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens",
             "chars_per_token", "token_entropy", "byte_share", "script")

    def measure(text: bytes, windows: np.ndarray, n_words: int) -> tuple:
        seen = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
        string = text.decode()
        blank = int(seen[_SPACES].sum())
        lines = [line for line in text.split(b"\n") if line.strip()]
        ids = token_ids(vocabulary, string)
        foreign = np.frombuffer("".join(_FOREIGN.findall(string)).encode("utf-32-le"), np.uint32)
        lacking = foreign[~own_characters(pieces)[foreign]]
        spelt = int((2 + (lacking > 0x7FF) + (lacking > 0xFFFF)).sum())
        solid = len(text) - blank
        return (
            n_words, len(string) - blank, int(seen[np.frombuffer(SYMBOLS, np.uint8)].sum()),
            len(lines) - len(set(lines)), repeated_words(windows, REPEAT_WINDOW), len(ids),
            len(string) / len(ids) if len(ids) else 0.0, _entropy(ids),
            spelt / solid if solid else 0.0, script_of(int(seen[_LETTERS].sum()), foreign),
        )

    def each(batch: pa.RecordBatch) -> Iterator[dict]:
        rows = []
        for _, held in batches(text_bytes(batch.column(1))):
            words = Words(held)
            windows = words.windows(REPEAT_WINDOW)
            for i, text in enumerate(held):
                a, b = words.first[i], words.first[i + 1]
                rows.append(measure(text, windows[a : max(a, b - REPEAT_WINDOW + 1)], int(b - a)))
        columns = list(zip(*rows)) if rows else [[] for _ in names]
        yield {"doc_id": batch.column(0), "lang": batch.column(2)} | dict(zip(names, map(list, columns)))

    lang = F.col("lang") if "lang" in docs.columns else F.lit(None)
    whole = {n: pa.int64() for n in names[:6]}
    parts = {n: pa.float64() for n in names[6:9]}
    return arrow_map(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", lang.cast("string").alias("lang")), each,
        "doc_id long, lang string, " + ", ".join(f"{n} long" for n in whole) + ", "
        + ", ".join(f"{n} double" for n in parts) + ", script string",
        doc_id=pa.int64(), lang=pa.string(), **whole, **parts, script=pa.string(),
    )


def _group() -> list[Column]:
    """Language, script and size class (powers of two of the tokens) of a text."""
    size = F.floor(F.log2(F.greatest("n_tokens", F.lit(1)).cast("double"))).cast("int")
    return [F.coalesce("lang", F.lit("")).alias("g_lang"), F.col("script").alias("g_script"), size.alias("g_size")]


def _base_failed() -> Column:
    repeated = 100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    return (F.col("n_words") < MIN_WORDS) | repeated


def _octaves() -> Column:
    return F.log2(F.greatest("n_tokens", F.lit(1)).cast("double"))


def _quartiles(rows: DataFrame, keys: list[str], level: int, members: Column, weight: Column) -> DataFrame:
    """(keys, texts, band<level>) of each group that ``keys`` make."""
    marks = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(f"texts{level}"),
        F.struct(
            members.cast("double").alias("members"), F.percentile("n_tokens", F.lit(0.5), weight).alias("typical"),
            *(F.percentile(m, marks, weight).alias(f"q_{m}") for m in SAMPLING),
        ).alias(f"band{level}"),
    )


def bands(measured: DataFrame) -> DataFrame:
    """One row per group: its ``band``, and the ``slope`` of the entropy per octave of tokens.

    A band has the quartiles of each measure, the entropy without its slope, the
    typical number of tokens and how many members it stems from. Groups are language,
    script and size class; language and script; script; all texts. The values of a
    group of n texts count n / (n + OWN_BAND), those of the wider groups the rest, so
    no number of texts makes a band jump. In the last two a language and script is
    one member, or a part of one in the same way. Texts that fail the base rules
    found no band. Equal measurements count once, so copies of a text don't narrow
    a band. The quartiles are exact on values rounded to three places, which bounds
    what an aggregate holds.
    """
    rounded = [F.round(m, 3).alias(m) for m in SAMPLING]
    differing = staged(
        measured.filter(~_base_failed()).select(*_group(), "n_tokens", *rounded).distinct(), "differing")
    slope = staged(differing.agg(
        F.coalesce(F.regr_slope("token_entropy", _octaves()), F.lit(0.0)).alias("slope")), "slope")
    levelled = differing.crossJoin(F.broadcast(slope)).withColumn(
        "token_entropy", F.round(F.col("token_entropy") - F.col("slope") * _octaves(), 3))
    language = ["g_lang", "g_script"]
    # Weights in units of a millionth of a text.
    share = F.lit(float(OWN_BAND)) / (OWN_BAND + F.count(F.lit(1)))
    sizes = of_checked_size(staged(levelled.groupBy(*language).agg(
        F.greatest(F.lit(1), F.round(1e6 * share)).cast("long").alias("weight")), "weights"), 100_000)
    weighted = levelled.join(sizes, language)
    one, texts, languages = F.lit(1), F.count(F.lit(1)), F.sum("weight") / (1e6 * OWN_BAND)
    own = _quartiles(levelled, [*language, "g_size"], 0, texts, one)
    wider = _quartiles(levelled, language, 1, texts, one)
    script = _quartiles(weighted, ["g_script"], 2, languages, F.col("weight"))
    everything = _quartiles(weighted, [], 3, languages, F.col("weight"))

    def blended(field: Callable[[str], Column]) -> Column:
        value = field("band3")
        for i in (2, 1, 0):
            trust = F.col(f"texts{i}") / (F.col(f"texts{i}") + OWN_BAND)
            value = trust * field(f"band{i}") + (1 - trust) * value
        return value

    values = [blended(lambda band, m=m: F.col(band)[m]).alias(m) for m in ("members", "typical")]
    values += [F.array(*(blended(lambda band, m=m, i=i: F.col(band)[f"q_{m}"][i]) for i in range(3))).alias(f"q_{m}") for m in SAMPLING]
    return own.join(wider, language).join(script, "g_script").crossJoin(F.broadcast(everything)).crossJoin(
        F.broadcast(slope)).select(*language, "g_size", F.struct(*values).alias("band"), "slope")


def _within(m: str) -> Column:
    """Whether measure ``m`` of a row lies in the band of its group."""
    q1, mid, q3 = (F.col(f"band.q_{m}")[i] for i in range(3))
    n = F.greatest("n_tokens", F.lit(1)).cast("double")
    fence = FENCE * (1 + FEW / F.col("band.members")) * (q3 - q1)
    # Texts shorter than is typical vary more.
    short = F.sqrt(F.greatest(F.lit(1.0), F.col("band.typical") / n))
    least = SAMPLING[m] / F.sqrt(n) * (mid if m == "chars_per_token" else F.lit(1.0))
    low = mid - F.greatest((mid - q1 + fence) * short, least)
    high = mid + F.greatest((q3 - mid + fence) * short, HIGH_SIDE[m] * least)
    value = F.round(m, 3)
    if m == "token_entropy":
        value = F.round(value - F.col("slope") * _octaves(), 3)
    return value.between(low, high)


def judge(measured: DataFrame) -> DataFrame:
    """Add ``base_failed`` and ``kept`` to a stored table of measures."""
    failed = _base_failed()
    inside = F.lit(True)
    for m in SAMPLING:
        inside = inside & F.coalesce(_within(m), F.lit(False))
    keyed = measured.select("*", *_group())
    known = of_checked_size(staged(bands(measured), "bands"))
    return keyed.join(known, ["g_lang", "g_script", "g_size"], "left").select(
        *measured.columns, failed.alias("base_failed"), (~failed & inside).alias("kept"),
    )


def quality_verdicts(docs: DataFrame) -> DataFrame:
    """One row per document with its counts, token measures and verdicts.

    ``base_failed``: fewer than 10 words, or more than a fifth of the words in
    five-word windows that the text holds twice. ``kept``: passes that and lies
    within the bands of its group, or of the wider one that stands in for it. Null and empty texts have zero counts, the
    script ``none`` and fail. Repeated rows and null doc_ids get a row each; a
    null ``lang``, or a table without it, is a language of its own. Other columns
    are ignored; an empty table gives an empty table.
    """
    return judge(staged(measures(docs), "measures"))
