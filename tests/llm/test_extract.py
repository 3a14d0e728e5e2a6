import random
from html.parser import HTMLParser

import numpy as np
from pyspark.sql import types as T

from sievery.llm import extract as X

SCHEMA = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
                       T.StructField("html", T.StringType()), T.StructField("host", T.StringType()),
                       T.StructField("text", T.StringType())])


def frame(spark, rows):
    return spark.createDataFrame([(*r, "h", "t") for r in rows], SCHEMA).repartition(3)


def texts(spark, rows):
    return {r.page_id: r.text for r in X.extract(frame(spark, rows)).collect()}


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{x:1}</style><script>var a="</p>";</script></head>
<body><nav><ul><li><a href="/x">Menu</a></li></ul></nav><!-- c --><div class="ad">Buy</div>
<div id="cookie-notice">We use cookies</div><header>Site</header>
<article class="post"><header><h1>Head &amp; line</h1></header><p><b>One  two
three<br>four<p>Caf&eacute; &#x41;&#66; &unknown; 1 &lt; 2</p><ul><li>a<li>b</ul>
<aside>Side</aside><form><input value="x">Search</form><div class="comments"><p>Nice!</p></div>
<table><tr><td>c1<td>c2</table>tail <i>text</i></article>
<section class="related-posts">More</section><footer>&copy; Foot</footer></body></html>"""


def test_blocks_of_a_marked_article(spark):
    got = texts(spark, [(1, "http://h.org/a", PAGE)])
    assert got[1] == "Head & line\nOne two three four\nCafé AB &unknown; 1 < 2\na\nb\nc1\nc2\ntail text"


def test_an_articles_own_header_stays_and_nested_comments_go():
    page = ("<div class='site-header'>Site</div><article id='post-1'><div class='entry-header'><h1>Title</h1></div>"
            "<p>Body</p><article class='comment'><p>Reader</p></article><div class='share-bar'>Share</div></article>")
    assert [t for k, t in X.blocks(page) if k == "main"] == ["Title", "Body"]
    assert [t for k, t in X.blocks(page) if k == "chrome"] == ["Site", "Reader", "Share"]


def test_odd_pages(spark):
    rows = [(1, "http://h.org/1", None), (2, None, ""), (3, "odd", "plain text"), (4, "http://h.org/4", "<p>a"),
            (5, "http://h.org/5", "<article>cut off &am"), (6, "http://h.org/6", "<p"), (7, "http://h.org/7", "<!-- x"),
            (8, "http://h.org/8", "<script>x"), (9, "http://h.org/9", "<article><p>x</article></div></p>y"),
            (None, "http://h.org/n", "<main>no id</main>"), (10, "http://h.org/10", "a < b & c > d"),
            (11, "http://h.org/11", "<div>" * 3000 + "deep"), (12, "http://h.org/12", "<article>" + "w " * 50000)]
    got = texts(spark, rows)
    assert [got[i] for i in range(1, 12)] == ["", "", "plain text", "a", "cut off &am", "", "", "", "x",
                                              "a < b & c > d", "deep"]
    assert got[None] == "no id" and got[12] == ("w " * 50000).strip()
    assert X.extract(frame(spark, rows).limit(0)).count() == 0


def unmarked(i, host="big.org"):
    return (i, f"http://{host}/{i}", f"<body><div>Subscribe to our daily letter and never miss any new story "
            f"again</div><p>Unique words of page {i} that stand{i} nowhere{i} else{i} at{i} all{i}</p>"
            f"<div>All rights reserved by the owners of this fine site since 1999</div></body>")


def body(i):
    return f"Unique words of page {i} that stand{i} nowhere{i} else{i} at{i} all{i}"


def test_host_boilerplate_goes_and_unique_runs_stay(spark):
    rows = [unmarked(i) for i in range(12)] + [unmarked(50, "alone.org")]
    got = texts(spark, rows)
    assert all(got[i] == body(i) for i in range(12))
    assert body(50) in got[50] and "Subscribe" in got[50]          # one page repeats nothing


def test_parts_of_a_large_host_give_the_same(spark, monkeypatch):
    rows = [unmarked(i) for i in range(12)]
    whole = texts(spark, rows)
    monkeypatch.setattr(X, "PART_PAGES", 1)
    assert texts(spark, rows) == whole


def test_an_article_keeps_what_other_pages_repeat(spark):
    shared = "This very passage of more than eight words is in many articles of the host"
    rows = [(i, f"http://h.org/{i}", f"<article><p>{shared}</p><p>own {i}</p></article>") for i in range(5)]
    assert texts(spark, rows) == {i: f"{shared}\nown {i}" for i in range(5)}


def test_repeated_equals_brute_force():
    rng = np.random.default_rng(9)
    streams = [[str(x) for x in rng.integers(0, 3, n)] for n in (60, 80, 5, 0, 70, 40)]
    pages = [0, 1, 2, 3, 3, 0]
    got = X.repeated(streams, pages)
    holders = {}
    for s, p in zip(streams, pages, strict=True):
        for i in range(len(s) - X.RUN + 1):
            holders.setdefault(tuple(s[i:i + X.RUN]), set()).add(p)
    for s, flags in zip(streams, got, strict=True):
        hit = set()
        for i in range(len(s) - X.RUN + 1):
            if len(holders[tuple(s[i:i + X.RUN])]) > 1:
                hit |= set(range(i, i + X.RUN))
        assert set(np.flatnonzero(flags).tolist()) == hit


def test_what_other_parts_hold_is_found_on_any_of_their_pages(spark, monkeypatch):
    passage = "A passage that two pages of a part and one of another part have"
    notice = "This notice is in the menu of one page and in plain text of another"
    tail = "This tail is plain text beside a marked article and on a page without one"
    rows = [(i, f"http://big.org/{i}", f"<p>own{i} words{i}</p><div>{passage}</div>") for i in range(3)]
    rows += [(3, "http://big.org/3", f"<nav>{notice}</nav><p>third page</p>"),
             (4, "http://big.org/4", f"<p>fourth page</p><div>{notice}</div>"),
             (5, "http://big.org/5", f"<article>{'fifth ' * 20}</article><div>{tail}</div>"),
             (6, "http://big.org/6", f"<p>sixth page</p><div>{tail}</div>")]
    whole = texts(spark, rows)
    assert [whole[i] for i in (0, 1, 2, 4, 6)] == ["own0 words0", "own1 words1", "own2 words2", "fourth page",
                                                   "sixth page"]
    for pages in (3, 2, 1):                                # among them cuts of 2 + 1 and 1 + 1 pages
        monkeypatch.setattr(X, "PART_PAGES", pages)
        assert texts(spark, rows) == whole


def test_a_marked_comment_advert_or_teaser_is_not_the_article(spark):
    text = "The real body is in plain elements and is longer than the marked part"
    rows = [(1, "http://a.org/", f"<div><p>{text}</p></div><article class='comment even' id='comment-7'>Nice read</article>"),
            (2, "http://b.org/", f"<article class='ad'>{'Buy now ' * 20}</article><p>{text}</p>"),
            (3, "http://c.org/", f"<p>{text}</p><article class='card'>Next story</article>"),
            (4, "http://d.org/", f"<main class='has-sidebar no-comments'><p>{text}</p></main><p>plain</p>"),
            (5, "http://e.org/", f"<main id='content'><article class='related-card'>Other</article><p>{text}</p></main>")]
    assert texts(spark, rows) == {1: text, 2: text, 3: f"{text}\nNext story", 4: text, 5: text}


def test_an_articles_sections_are_no_chrome_by_parts_of_their_names():
    page = ("<article><h2 id='related-work'>Related work</h2><p>One</p><h2 id='notice-period' class='banner'>Notice</h2>"
            "<p class='share-price'>Two</p><section id='social-policy'><p>Three</p></section><p class='menu-engineering'>"
            "Four</p><div class='post-share-buttons'>Tweet</div><div class='entry-comments-list'>Hi</div>"
            "<div class='ad-slot-2'>Buy</div><ul class='related-posts'><li>More</ul><p class='lead'>Five</p></article>")
    got = X.blocks(page)
    assert [t for k, t in got if k == "main"] == ["Related work", "One", "Notice", "Two", "Three", "Four", "Five"]
    assert [t for k, t in got if k == "chrome"] == ["Tweet", "Hi", "Buy", "More"]


def test_chrome_in_inline_elements_leaves_its_block_whole():
    page = ("<article><p>Read <b>the</b> <button>More</button>text <a class='menu-item'>Home</a>to the "
            "<script>var x = '<p>';</script>end.</p><p>Next<span hidden>gone</span> one</p></article>"
            "<p>Open <button>Go</button>text</p>")
    assert X.blocks(page) == [("main", "Read the text to the end."), ("chrome", "MoreHome"),
                              ("main", "Next one"), ("chrome", "gone"), ("open", "Open text"), ("chrome", "Go")]


def test_copies_of_an_unmarked_article_keep_it(spark, monkeypatch):
    story = "<h1>A story</h1><p>" + " ".join(f"word{i}" for i in range(60)) + "</p>"
    rows = [(1, "http://h.org/a", f"<nav>Menu</nav>{story}"), (2, "http://h.org/b", f"<nav>Other</nav>{story}")]
    want = "A story\n" + " ".join(f"word{i}" for i in range(60))
    assert texts(spark, rows) == {1: want, 2: want}
    monkeypatch.setattr(X, "PART_PAGES", 1)
    assert texts(spark, rows) == {1: want, 2: want}
    more = [unmarked(i, "h.org") for i in range(10, 16)] + [unmarked(10, "h.org")]
    got = texts(spark, rows + more)
    assert got[1] == got[2] == want and all(got[i] == body(i) for i in range(10, 16))


class Independent(HTMLParser):
    """Main text by the standard parser: blocks of well-formed pages, judged by tags only."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.text, self.stack = [], "", []

    def flush(self):
        text = " ".join(self.text.split())
        if text:
            self.out.append(text)
        self.text = ""

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.text += " "
            return
        if tag in X.BLOCKS:
            self.flush()
        self.stack.append(tag)

    def handle_endtag(self, tag):
        if tag in X.BLOCKS:
            self.flush()
        self.stack.pop()

    def handle_data(self, data):
        inside = "article" in self.stack
        if inside and not set(self.stack) & (X.NO_TEXT | X.CHROME):
            self.text += data


def test_invented_pages_against_the_standard_parser():
    rng = random.Random(5)
    words = ["plain", "words", "&amp;", "caf&eacute;", "&#x41;", "x&lt;y", "\n", "  ", "\u00a0", "tail"]

    def text():
        return " ".join(rng.choices(words, k=rng.randint(0, 6)))

    def element(depth):
        if depth == 0 or rng.random() < 0.3:
            return text()
        tag = rng.choice(["div", "section", "ul", "b", "i", "span", "a", "aside", "form", "nav", "button", "script",
                          "blockquote", "table", "br"])
        if tag == "br":
            return "<br>"
        if tag == "script":
            return "<script>var a = 1;</script>"
        return f"<{tag}>" + "".join(element(depth - 1) for _ in range(rng.randint(0, 4))) + f"</{tag}>"
    for _ in range(400):
        page = f"<body><nav>{text()}</nav><article>" + "".join(element(4) for _ in range(5)) + "</article></body>"
        p = Independent()
        p.feed(page)
        p.close()
        p.flush()
        assert [t for k, t in X.blocks(page) if k == "main"] == p.out, page
