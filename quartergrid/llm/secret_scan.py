"""Secrets in texts: fixed patterns, and strings that nothing around them explains.

The patterns find assignments, access keys and long hexadecimal runs. Other long
strings near a sensitive word are judged by novelty: the bytes they add to the
zstandard-compressed text around them, with a compressor primed by identifiers.
Names and paths add little; keys add nearly all their length. Later copies of a
string, and those that a pattern found, don't explain it; what is a secret in one
place is one in all places of the text.
"""

from __future__ import annotations

import builtins
import keyword
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed patterns, the least length and the group it applies to, in reporting order.
PATTERNS = {
    "assign": (re.compile(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 6, 2),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 20, 0),
    "hex": (re.compile(r"[0-9a-f]{24,}"), 24, 0),
}
NOVEL = "novel"
KINDS = (*PATTERNS, NOVEL)
ASSIGNED_WORDS = ("passw", "secret", "token", "api")
#: Words that make the text near them sensitive: after them within REACH
#: characters, before them within REACH_BACK.
SENSITIVE = re.compile(
    r"password|passwd|passphrase|pwd|secret|token|api[_ -]?key|access[_ -]?key|private[_ -]?key|signing[_ -]?key"
    r"|auth|bearer|credential", re.I | re.A)
SENSITIVE_WORDS = ("passw", "passphrase", "pwd", "secret", "token", "key", "auth", "bearer", "credential")
REACH = 48
REACH_BACK = 24
#: Text on either side that a candidate is compressed with.
AROUND = 512
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{8,}")
#: Words, names in camel case, numbers and dates: no measure of novelty tells an
#: unknown word from a key. Those with letters and digits are measured from so many characters on.
ORDINARY = re.compile(r"(?:[A-Z]?[a-z]{2,}|[A-Z]+|[0-9]+|[+/_=-])+")
ORDINARY_LENGTH = 16
#: Least added bytes, and least added bytes per character.
MIN_BYTES = 12
MIN_NOVELTY = 0.72


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    novelty: float | None


@lru_cache(maxsize=1)
def _compressor() -> zstandard.ZstdCompressor:
    """Primed with the names of the language at hand and usual settings."""
    names = [*keyword.kwlist, *dir(builtins), *dir(str), *dir(dict), "password", "secret", "token", "api_key",
             "access_key", "private_key", "authorization", "bearer", "credential", "https://", "localhost",
             "config", "settings", "client", "server", "username", "database", "connection", "abcdefghijklmnop",
             "ABCDEFGHIJKLMNOP", "0123456789", "example", "changeme", "placeholder"]
    known = zstandard.ZstdCompressionDict("\n".join(names).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(level=9, dict_data=known, write_content_size=False, write_dict_id=False)


class Known:
    """Spans in order of start, found by place."""

    def __init__(self, spans: list[tuple[int, int]] = ()) -> None:
        self.spans = sorted(spans)
        self.starts = [a for a, _ in self.spans]
        self.reach = list(accumulate((b for _, b in self.spans), max))  # the farthest end up to each span

    def between(self, begin: int, end: int) -> list[tuple[int, int]]:
        """The spans that may meet the text from ``begin`` to before ``end``."""
        return self.spans[bisect_right(self.reach, begin) : bisect_left(self.starts, end)]


def novelty(text: str, start: int, end: int, known: Known = Known()) -> tuple[int, float]:
    """(bytes that text[start:end] adds to what is around it, the same per character).

    Copies of it after ``end`` and in the spans of ``known`` are blanked out.
    """
    own = text[start:end]
    before = text[max(0, start - AROUND) : start]
    if known.spans and own in before:
        at, parts = max(0, start - AROUND), []
        for a, b in known.between(at, start):
            if at < b:
                a, b = max(a, at), min(b, start)
                parts += [text[at:a], text[a:b].replace(own, " ")]
                at = b
        before = "".join(parts) + text[at:start]
    after = text[end : end + AROUND + end - start].replace(own, " ")[:AROUND]
    around = before + "\n" + after
    compress = _compressor().compress
    added = len(compress((around + "\n" + own).encode())) - len(compress(around.encode()))
    return added, added / (end - start)


def find(text: str) -> list[Span]:
    """Spans of a text in order of start, then of kind; positions in code points."""
    out: list[Span] = []
    plain = text.lower()
    for kind, (pattern, least, group) in PATTERNS.items():
        if kind == "assign" and not any(w in plain for w in ASSIGNED_WORDS):
            continue
        for m in pattern.finditer(text):
            if len(m[group]) >= least:
                out.append(Span(kind, m.start(), m.end(), None))
    if any(w in plain for w in SENSITIVE_WORDS):
        known = Known([(s.start, s.end) for s in out])
        words = [m.span() for m in SENSITIVE.finditer(text)]
        if words:
            out += _novel(text, words, known)
    return sorted(out, key=lambda s: (s.start, KINDS.index(s.kind)))


def _novel(text: str, words: list[tuple[int, int]], known: Known) -> Iterator[Span]:
    near = after = 0
    places: dict[str, list[tuple[int, int]]] = {}
    secrets: dict[str, float] = {}
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        while near < len(words) and words[near][1] <= start:
            near += 1
        while after < len(known.spans) and known.spans[after][1] <= start:
            after += 1
        if after < len(known.spans) and known.spans[after][0] < end:
            continue  # found by a pattern
        string = m[0]
        if ORDINARY.fullmatch(string) and not (
            len(string) >= ORDINARY_LENGTH and any(c.isdigit() for c in string) and any(c.isalpha() for c in string)
        ):
            continue
        places.setdefault(string, []).append((start, end))
        if string in secrets:
            continue
        # The first word that starts at or after the end; words inside the string don't count.
        ahead = near
        while ahead < len(words) and words[ahead][0] < end:
            ahead += 1
        follows = near > 0 and start - words[near - 1][1] <= REACH
        precedes = ahead < len(words) and words[ahead][0] - end <= REACH_BACK
        if follows or precedes:
            added, share = novelty(text, start, end, known)
            if added >= MIN_BYTES and share >= MIN_NOVELTY:
                secrets[string] = round(share, 3)
    for string, share in secrets.items():
        for start, end in places[string]:
            yield Span(NOVEL, start, end, share)


def scan_secrets(docs: DataFrame) -> DataFrame:
    """One row per document: (doc_id, secrets), an array of (kind, start, end, novelty).

    Spans are in code points, the end exclusive, sorted by start and then by kind
    in the order assign, access, hex, novel. Texts are scanned whole; null and
    empty texts have no spans. Repeated rows and null doc_ids get a row each; other
    columns are ignored; an empty table gives an empty table.
    """
    kinds = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                ("novelty", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[s._asdict() for s in find(t or "")] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kinds)], names=["doc_id", "secrets"])

    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(
        run, f"doc_id {rows.dtypes[0][1]}, secrets array<struct<kind: string, start: long, end: long, novelty: double>>")


def span_text(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
