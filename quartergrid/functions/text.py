"""Tokens and vectors held in text."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: a spaced hyphen, or one separator character.
SEPARATORS = r" - |[ .\\/;,&!?()\[\]{}]"


def tokens(text: Column) -> Column:
    """Lower-case tokens of a text in order; none for null."""
    parts = F.transform(F.split(text, SEPARATORS), F.lower)
    return F.coalesce(
        F.filter(parts, lambda t: F.length(t) > 0), F.array().cast("array<string>")
    )


def token_rows(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, word): one row per token, repeats included, as :func:`tokens`."""
    parts = texts.select(key, F.explode(F.split(F.col(text), SEPARATORS)).alias("part"))
    return parts.select(key, F.lower("part").alias("word")).filter(F.length("word") > 0)


def lowered(text: Column) -> Column:
    """A text whose :func:`arrow_tokens` are the tokens of the text given.

    Only a capital sigma is lower-cased by what stands around it, beyond separators too.
    """
    return F.when(F.contains(text, F.lit("\u03a3")), F.array_join(tokens(text), ".")).otherwise(F.lower(text))


# Bytes with every one-character separator as a space.
_SPACED = np.arange(256, dtype=np.uint8)
_SPACED[np.frombuffer(rb".\/;,&!?()[]{}", np.uint8)] = ord(" ")


def arrow_tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(tokens of all texts, number of tokens of each) of :func:`lowered` texts; none for null."""
    if not len(texts):
        return texts, np.zeros(0, np.int64)
    plain = pc.replace_substring(pc.fill_null(texts, ""), " - ", " ")
    valid, offsets, data = plain.buffers()
    if data is not None:
        data = pa.py_buffer(_SPACED[np.frombuffer(data, np.uint8)])
    plain = pa.Array.from_buffers(plain.type, len(plain), [valid, offsets, data], offset=plain.offset)
    parts = pc.split_pattern(plain, " ")
    words = parts.flatten()
    full = pc.not_equal(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    ends = np.append(0, full.cumsum())
    bounds = parts.offsets.to_numpy() - parts.offsets[0].as_py()
    return words.filter(pa.array(full)), np.diff(ends[bounds])


def number_array(text: Column) -> Column:
    """Space-separated numbers as ``array<double>``."""
    return F.transform(F.split(text, " "), lambda t: t.try_cast("double"))
