"""Main text of web pages by the container that the pages of a host agree on.

Pages are read twice. The first pass scores the containers of each page, by how
much text that is no link stands directly in them, and names the best one by its
generalised path: the tags and classes from the root down, without numbers. Spark
counts these votes per host. The second pass takes the text of the containers on
the winning path; a page without that path uses its own best one.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartergrid.llm.common import of_checked_size, staged

#: Fixed values of HTML.
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table "
    "tbody td tfoot th thead tr ul caption".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template".split())
IN_HEAD = frozenset("head html base link meta title style script noscript template".split())
#: A start tag ends open elements of its group, up to the nearest of the scope.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}),
          "th": ({"td", "th"}, {"table", "tr"}), "option": ({"option"}, {"select"})}
PARAGRAPH_SCOPE = frozenset("td th table button caption object body".split())

CONTAINERS = frozenset("article body div main section td".split())
#: Elements without main text, by tag or by a word of their class, id or role.
LEFT_OUT = frozenset(
    "aside button canvas datalist dialog footer form head header menu nav object select svg audio video".split()) | RAW
LEFT_OUT_WORDS = frozenset(
    "ad ads adsense advert adverts advertisement advertising banner breadcrumb breadcrumbs byline comment comments "
    "complementary consent contentinfo cookie cookies disclaimer disqus footer form gdpr header hidden login masthead "
    "menu modal nav navbar navigation newsletter notice notices notification overlay pager pagination popup promo "
    "promoted promotion recommended related replies reply respond search share sharing sidebar signup skip social "
    "sponsor sponsored subscribe toolbar widget widgets".split())

#: Words that make a class the state of an element and not its role: with-sidebar, no-comments.
STATE_WORDS = frozenset("no not with without has enabled disabled open closed off on show hide".split())
#: Elements that may hold the text although a word of theirs says otherwise, and what never does.
TEXT_TAGS = frozenset(("article", "main"))
TEXT_WORDS = frozenset("article body content entry main page post story text".split())
READER_WORDS = frozenset("comment comments disqus replies reply respond".split())
SHOWN, DOUBTFUL, HIDDEN = range(3)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?][^>]*+>", re.S)
_NAMED = re.compile(r"""(?:^|[\s"'/])(class|id|role)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_BLANK = re.compile(r"\s+")


@lru_cache(maxsize=4096)
def _label(tag: str, attributes: str) -> tuple[str, int]:
    """(tag with its classes, numbers generalised; SHOWN, DOUBTFUL or HIDDEN).

    An element is hidden by its tag, or by a word of its class, id or role unless
    that is a state. It is doubtful, to be shown if most text of the page is in it,
    if tag or words also call it the text.
    """
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _NAMED.finditer(attributes)} if attributes else {}
    classes = sorted(set(re.sub(r"\d+", "#", found.get("class", "")).split()))
    label = ".".join([tag, *classes])
    if tag in ("html", "body"):
        return label, SHOWN
    if tag in LEFT_OUT:
        return label, HIDDEN
    names = [{w.lower() for w in _WORD.findall(name)} for value in found.values() for name in value.split()]
    against = [words for words in names if words & LEFT_OUT_WORDS and not words & STATE_WORDS]
    if not against:
        return label, SHOWN
    called_text = tag in TEXT_TAGS or any(words & TEXT_WORDS for words in names)
    return label, DOUBTFUL if called_text and not any(words & READER_WORDS for words in against) else HIDDEN


class _Page:
    """The text blocks of a page and the tree of the containers around them.

    Containers and doubtful elements are numbered as they open; each knows the one
    around it, so a block is a text and one number, however deep it stands.
    """

    def __init__(self, html: str) -> None:
        self.html = html
        self.open: list[tuple[str, bool, bool]] = []  # tag, hidden, numbered
        self.paths: list[int] = [0]
        self.count: Counter[str] = Counter()
        self.hidden = 0
        self.text: list[str] = []
        self.linked = 0
        #: Of each numbered element: the one around it, its path if it is a container, whether it is in doubt.
        self.around: list[int] = [-1]
        self.path: list[int | None] = [None]
        self.doubtful: list[bool] = [False]
        self.here = [0]
        #: (text, characters in links, number of the innermost element)
        self.blocks: list[tuple[str, int, int]] = []
        self._read()
        self._drop_doubtful()

    def _flush(self) -> None:
        if self.text:
            text = _BLANK.sub(" ", unescape("".join(self.text))).strip()
            if text:
                self.blocks.append((text, min(self.linked, len(text)), self.here[-1]))
            self.text, self.linked = [], 0

    def _add(self, text: str) -> None:
        if text and not self.hidden:
            self.text.append(text)
            if self.count["a"]:
                self.linked += len(text)

    def _push(self, tag: str, attributes: str) -> None:
        label, state = _label(tag, attributes)
        self.count[tag] += 1
        self.hidden += state == HIDDEN
        self.paths.append(xxhash.xxh64_intdigest(label, seed=self.paths[-1]))
        numbered = tag in CONTAINERS or state == DOUBTFUL
        self.open.append((tag, state == HIDDEN, numbered))
        if numbered:
            self.around.append(self.here[-1])
            self.path.append(self.paths[-1] if tag in CONTAINERS else None)
            self.doubtful.append(state == DOUBTFUL)
            self.here.append(len(self.around) - 1)

    def _pop(self) -> None:
        tag, hidden, numbered = self.open.pop()
        self.paths.pop()
        self.count[tag] -= 1
        self.hidden -= hidden
        if numbered:
            self.here.pop()

    def _drop_doubtful(self) -> None:
        """Keep the blocks of doubtful elements only if most text that is no link is there."""
        if not any(self.doubtful):
            return
        plain = [0] * len(self.around)
        for text, linked, at in self.blocks:
            plain[at] += len(text) - linked
        for at in range(len(plain) - 1, 0, -1):  # elements come after what is around them
            plain[self.around[at]] += plain[at]
        shown = [True] * len(plain)
        for at in range(1, len(plain)):
            shown[at] = shown[self.around[at]] and (not self.doubtful[at] or 2 * plain[at] > plain[0])
        self.blocks = [b for b in self.blocks if shown[b[2]]]

    def _close(self, tags: set[str] | frozenset[str], scope: set[str] | frozenset[str] = frozenset()) -> None:
        """End the nearest open element of ``tags``, unless one of ``scope`` is nearer.

        Only block elements end a block of text, the named one or those in it.
        """
        if not any(self.count[t] for t in tags):
            return
        for i in range(len(self.open) - 1, -1, -1):
            tag = self.open[i][0]
            if tag in tags:
                if any(t in BLOCK for t, *_ in self.open[i:]):
                    self._flush()
                while len(self.open) > i:
                    self._pop()
                return
            if tag in scope:
                return

    def _start(self, tag: str, attributes: str) -> None:
        if self.count["head"] and tag not in IN_HEAD:
            self._close({"head"})
        if tag in BLOCK:
            self._flush()
            self._close({"p"}, PARAGRAPH_SCOPE)
        elif tag == "br":
            self._add(" ")
        if tag in CLOSES:
            self._close(*CLOSES[tag])
        if tag in VOID:
            return
        self._push(tag, attributes)

    def _read(self) -> None:
        html, at, end = self.html, 0, len(self.html)
        while at < end:
            found = _TOKEN.search(html, at)
            if found is None:
                self._add(html[at:])
                break
            self._add(html[at : found.start()])
            at = found.end()
            tag = (found[2] or found[5] or "").lower()
            if not tag:
                continue
            if found[1] or found[4]:
                if tag in BLOCK:
                    self._flush()
                self._close({tag})
                continue
            attributes = found[3] or found[6] or ""
            if tag in RAW and not attributes.endswith("/"):
                if self.count["head"] and tag not in IN_HEAD:
                    self._close({"head"})
                close = _raw_end(tag).search(html, at)
                at = close.end() if close else end
            else:
                self._start(tag, attributes)
        self._flush()

    def best(self) -> tuple[int, int] | None:
        """(score, path) of the best container; the one met first among equals."""
        scores: dict[int, int] = {}
        for text, linked, at in self.blocks:
            shares = iter((4, 2, 1))
            while at >= 0:
                if self.path[at] is not None:
                    share = next(shares, 0)
                    if not share:
                        break
                    scores[self.path[at]] = scores.get(self.path[at], 0) + share * (len(text) - 2 * linked)
                at = self.around[at]
        top = max(scores, key=scores.__getitem__, default=None)
        return None if top is None or scores[top] <= 0 else (scores[top], top)

    def _inside(self, path: int | None) -> list[str]:
        """The blocks in containers of a path."""
        inside = [False] * len(self.around)
        for at in range(1, len(inside)):
            inside[at] = inside[self.around[at]] or path is not None and self.path[at] == path
        return [text for text, _, at in self.blocks if inside[at]]

    def text_of(self, path: int | None) -> str:
        """Blocks in containers of ``path``, or of the page's best one."""
        inside = self._inside(path)
        if not inside and (own := self.best()):
            inside = self._inside(own[1])
        return "\n".join(inside)


@lru_cache(maxsize=32)
def _raw_end(tag: str) -> re.Pattern[str]:
    return re.compile(rf"</{tag}(?=[\s/>])[^>]*+>", re.I)


_TOP = 1 << 64


def _signed(path: int) -> int:
    return path - _TOP if path >= _TOP >> 1 else path


def votes(pages: DataFrame) -> DataFrame:
    """(host, path, score): the best container of each page that has one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths, scores = [], [], []
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if (best := _Page(html).best()) is not None:
                    hosts.append(host)
                    scores.append(best[0])
                    paths.append(_signed(best[1]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array(paths, pa.int64()), pa.array(scores, pa.int64())],
                names=["host", "path", "score"])

    known = pages.filter("host is not null and html is not null").select("host", "html")
    return known.mapInArrow(run, "host string, path long, score long")


def winning_paths(pages: DataFrame) -> DataFrame:
    """(host, path): the path most pages of the host vote for, then the best score."""
    counted = votes(pages).groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("pages"), F.sum("score").alias("score"))
    return counted.groupBy("host").agg(F.max(F.struct("pages", "score", "path")).alias("top")).select(
        "host", F.col("top.path").alias("path"))


def extract_main_text(pages: DataFrame) -> DataFrame:
    """One row per page: (page_id, url, text, n_chars).

    Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles
    and reader comments are left out. Character references are decoded, white
    space in a block becomes one space, that of Unicode too, blocks are trimmed and joined by
    ``\\n``. A null or empty html, or one without text, gives an empty text. Pages
    whose url is null or names no host decide for themselves. Unclosed tags end
    with what holds them. Repeated rows get a row each and vote each; other
    columns are ignored; an empty table gives an empty table.
    """
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    known = pages.select("page_id", "url", "html").withColumn("host", F.when(host != "", host))
    winners = of_checked_size(staged(winning_paths(known), "paths"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for html, path in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                texts.append(_Page(html or "").text_of(None if path is None else path % _TOP))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    rows = known.join(winners, "host", "left").select("page_id", "url", "html", "path")
    kinds = dict(rows.dtypes)
    return rows.mapInArrow(run, f"page_id {kinds['page_id']}, url string, text string, n_chars long")
