import random
import tracemalloc
from html.parser import HTMLParser

import pytest

from quartergrid.llm.html_text import _Page, extract_main_text


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, text string, path int")


def text(spark, html, url="http://a.b/"):
    return extract_main_text(pages(spark, [(1, url, html)])).first()["text"]


LEFT_OUT = [
    "<nav><ul><li>Menu entry with words</ul></nav>", "<header><h1>Site name</h1></header>", "<footer>&copy; somebody</footer>",
    "<aside>On the side</aside>", '<div class="side-bar sidebar-3">More on the side</div>', '<div id="cookieNotice">We use them</div>',
    '<div class="ad">Buy this</div>', "<form><p>Your name<input></form>", "<script>if (a < b) write('<p>no</p>')</script>",
    "<style>p{}</style>", '<section class="comments"><article><p>First! A reader speaks</p></article></section>',
    "<!-- <p>hidden</p> -->", '<div role="navigation">Up</div>', "<noscript><p>Switch it on</p></noscript>",
]


@pytest.mark.parametrize("container", ["article", "main", 'div class="post-12 body"', "section"])
def test_parts_around_and_inside_are_left_out(spark, container):
    tag = container.split()[0]
    inner = "".join(f"{x}<p>Paragraph {i} of the real text, long enough.</p>" for i, x in enumerate(LEFT_OUT))
    html = (f"<!DOCTYPE html><html><head><title>T</title></head><body>{''.join(LEFT_OUT)}"
            f"<{container}><h1>The title</h1>{inner}</{tag}>{''.join(LEFT_OUT)}</body></html>")
    want = "\n".join(["The title", *(f"Paragraph {i} of the real text, long enough." for i in range(len(LEFT_OUT)))])
    assert text(spark, html) == want


def test_blocks_white_space_and_references(spark):
    html = ("<article><h1> A \n title </h1><p>one<br>two &amp; <b>th</b>ree &lt;p&gt; &eacute;&#x263A;&nbsp;x<p>unclosed <i>italic"
            "<ul><li>first<li>second</ul>tail 1 < 2</article><footer>no")
    assert text(spark, html) == "A title\none two & three <p> é☺ x\nunclosed italic\nfirst\nsecond\ntail 1 < 2"


def test_pages_of_a_host_agree(spark):
    body = "<p>The text of this page goes on for a while, and then some more.</p>" * 3
    usual = [(i, "https://Host.example:80/x", f'<body><div class="c{i}">{body}</div><div class="extra">short</div></body>')
             for i in range(5)]
    odd = (9, "https://user@host.example/y", f'<body><div class="c7"><p>Few words.</p></div><div class="extra">{body}{body}</div></body>')
    other = (10, "https://else.example/", odd[2])
    got = {r["page_id"]: r["text"] for r in extract_main_text(pages(spark, [*usual, odd, other])).collect()}
    assert got[9] == "Few words." and got[10].startswith("The text")
    assert got[0].count("\n") == 2


def test_a_page_without_the_path_uses_its_own(spark):
    body = "<p>The text of this page goes on for a while, and then some more.</p>"
    rows = [(i, "http://h/", f"<body><article>{body}</article></body>") for i in range(3)]
    got = {r["page_id"]: r["text"] for r in extract_main_text(pages(spark, [*rows, (7, "http://h/", f"<main>{body}</main>")])).collect()}
    assert got[7] == got[0] != ""


@pytest.mark.parametrize("begin, end", [
    ('<div class="content with-sidebar">', "</div>"), ('<main class="post no-comments">', "</main>"),
    ('<article class="post share-enabled">', "</article>"), ('<div id="main" class="form-page">', "</div>"),
    ('<div class="header-fixed page">', "</div>"), ('<article role="main" class="promo">', "</article>"),
])
def test_an_article_whose_classes_name_other_parts(spark, begin, end):
    article = "<p>The article goes on about its subject for quite some time.</p>" * 6
    around = '<div class="sidebar">On the side</div><section class="comments"><article class="comment"><p>A reader</p></article></section>'
    assert text(spark, f"<body>{around}{begin}{article}{end}{around}</body>") == "\n".join(
        ["The article goes on about its subject for quite some time."] * 6)


def test_long_comments_stay_out(spark):
    html = ('<article class="post"><p>A short article of some words.</p></article><section class="comments">'
            + '<article class="comment"><p>A long answer of a reader, who goes on and on about it all.</p></article>' * 9 + "</section>")
    assert text(spark, html) == "A short article of some words."


class _Blocks(HTMLParser):
    """Blocks of a well-formed page with all tags around them, by the standard parser."""

    def __init__(self, html):
        super().__init__()
        self.open, self.blocks, self.now = [], [], []
        self.feed(html)
        self.end()

    def end(self):
        said = " ".join("".join(t for t, _ in self.now).split())
        if said:
            self.blocks.append((said, min(len(said), sum(len(t) for t, link in self.now if link)), list(self.open)))
        self.now = []

    def handle_starttag(self, tag, attributes):
        if tag not in ("a", "b"):
            self.end()
        self.open.append((tag, dict(attributes).get("class", "")))

    def handle_endtag(self, tag):
        if tag not in ("a", "b"):
            self.end()
        self.open.pop()

    def handle_data(self, data):
        if not any(tag == "nav" or c == "menu" for tag, c in self.open):
            self.now.append((data, any(tag == "a" for tag, _ in self.open)))


def by_brute_force(html):
    """The blocks in the containers of the best path, every path tried for every block."""
    found = []
    for said, linked, around in _Blocks(html).blocks:
        chain = [".".join([t, *sorted(set(c.split()))]) for t, c in around]
        paths = [">".join(chain[: i + 1]) for i, (t, _) in enumerate(around) if t in ("div", "section", "article", "body")]
        found.append((said, len(said) - 2 * linked, paths))
    scores = {}
    for _, own, paths in found:
        for share, path in zip((4, 2, 1), paths[::-1]):
            scores[path] = scores.get(path, 0) + share * own
    best = max(scores, key=scores.get, default=None)
    if best is None or scores[best] <= 0:
        return ""
    return "\n".join(said for said, _, paths in found if best in paths)


def random_page(rng, depth=0):
    out = []
    for _ in range(rng.randrange(1, 5)):
        kind = rng.random()
        if depth < 5 and kind < 0.5:
            tag = rng.choice(["div", "section", "article", "nav", "div"])
            name = rng.choice(["", "x", "y z", "x" if tag == "article" else "menu"])
            out.append(f'<{tag} class="{name}">{random_page(rng, depth + 1)}</{tag}>')
        elif kind < 0.85:
            words = " ".join(rng.choice(["alpha", "be&amp;ta", "<b>gamma</b>", "<a>delta link</a>", "\n"]) for _ in range(rng.randrange(12)))
            out.append(f"<p>{words}</p>")
        else:
            out.append(rng.choice(["loose text ", "<a>only a link</a> ", " "]))
    return "".join(out)


def test_pages_by_brute_force(spark):
    rng = random.Random(12)
    rows = [(i, None, f"<body>{random_page(rng)}</body>") for i in range(400)]
    got = {r["page_id"]: r["text"] for r in extract_main_text(pages(spark, rows)).collect()}
    for i, _, html in rows:
        assert got[i] == by_brute_force(html), html


def test_deep_nesting_takes_little_memory():
    html = "<body>" + "<div>x" * 20_000 + "</div>" * 20_000
    tracemalloc.start()
    page = _Page(html)
    assert tracemalloc.get_traced_memory()[1] < 50e6 and len(page.blocks) == 20_000
    tracemalloc.stop()
    assert page.text_of(None)


def test_awkward_rows(spark):
    deep = "<div>" * 20_000 + "deep text" + "</div>" * 20_000
    rows = [(1, "http://a/", None), (2, None, ""), (None, "x", "<p>loose"), (4, "http://a/", "plain text"),
            (4, "http://a/", "plain text"), (5, "http://d/", f"<body>{deep}</body>"), (6, "http://e/", "<article><p a='x>never"),
            (7, "http://e/", "<script>open"), (8, "http://f/", "<body><article>" + "<p>word " * 200_000)]
    got = {}
    for r in extract_main_text(pages(spark, rows)).collect():
        got.setdefault(r["page_id"], []).append((r["text"], r["n_chars"]))
    assert got[1] == got[2] == got[7] == [("", 0)]
    assert got[5] == [("deep text", 9)] and len(got[4]) == 2
    assert got[8][0][1] == 200_000 * 5 - 1
    assert extract_main_text(pages(spark, rows).filter("false")).count() == 0
