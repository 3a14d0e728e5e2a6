"""Main text of web pages with a suffix array per host (operator 5).

1. A page is parsed into blocks.  Scripts, styles and the like have no text;
   blocks inside menus, headers, footers, sidebars, notices, adverts, forms and
   reader comments (by tag, role, class or id) are *chrome*; blocks of a marked
   article (``article``, ``main``) are *main*; all others are *open*.  An article that
   is named a comment, an advert, a teaser or the like is chrome; a page whose main
   blocks have less text than its open ones has no marked article, and both are open.
2. A host's chrome and open blocks are concatenated page by page as token
   streams.  A suffix array, sorted by prefix doubling down to ``RUN`` tokens,
   brings equal substrings of that length together; those that distinct pages
   share are boilerplate, and overlapping ones join to longer runs.
3. A page with a marked article gives its main blocks, whole: an article's own
   words stay even where other pages repeat them.  A page without one gives its
   open blocks less the covered tokens: the unique runs (a block is cut only where
   at least ``RUN`` of its tokens in a row are covered, or goes as a whole).

A host with many pages is dealt into parts by page, each of at most about
``PART_BYTES``.  A part's suffix array settles its own pages, and gives every distinct
window of its streams once, as a hash with the smallest and the largest page that
hold it.  A shuffle of these finds the windows of distinct pages of the whole host,
which are then covered on the pages without a marked article, as in one part.

Character references are decoded, white space inside a block becomes one space,
empty blocks vanish, blocks are joined by one line feed.

Pages of a host with equal open text, and rows that share an id, count as one page
in step 2, so that copies of an article keep it.

Defined results: null or empty html gives the empty text; a null or odd url makes
the host the empty string; rows without an id are extracted like others; other columns are never read; an empty table
gives an empty one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievery.llm.common import bounded_batches, materialize, spark_of, text_or_empty

RUN = 8                       # tokens of a substring that counts as repeated
PART_PAGES, PART_BYTES = 2000, 8 << 20
BROADCAST_HOSTS = 200_000     # of hosts with several parts: at most about 60 MB of names

# Element kinds.
NO_TEXT = frozenset("script style noscript template head title iframe object svg math canvas "
                    "audio video textarea select".split())
CHROME = frozenset("nav header footer aside form menu dialog button fieldset".split())
MAIN = frozenset(("article", "main"))
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre "
    "section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset(("script", "style", "textarea", "title"))
# An end tag or a sibling closes these where authors leave the end tag out.
CLOSED_BY = {"p": BLOCKS, "li": frozenset(("li",)), "dt": frozenset(("dt", "dd")),
             "dd": frozenset(("dt", "dd")), "tr": frozenset(("tr",)),
             "td": frozenset(("td", "th", "tr")), "th": frozenset(("td", "th", "tr")),
             "option": frozenset(("option",))}
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog "
                         "menu menubar toolbar".split())
CHROME_NAME = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner\w*|cookie\w*|consent|gdpr|notice\w*|"
    r"notification\w*|popup|modal|menu\w*|nav|navbar|navigation|breadcrumb\w*|sidebar\w*|side-bar|"
    r"widget\w*|footer\w*|header\w*|masthead|comments?|commentlist|disqus\w*|respond|replies|reply|"
    r"share|sharing|social\w*|related|recommend\w*|newsletter\w*|subscribe|signup|login|toolbar|"
    r"pagination|pager|skip-link)(?:$|[\s_-])", re.IGNORECASE)
# An article or main element of one of these classes is no main text; "has-sidebar" and the like say nothing.
CHROME_ARTICLE = re.compile(
    r"(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookie\w*|notice|popup|modal|sidebar|widget|"
    r"comments?|reply|replies|related|recommend\w*|newsletter|teaser)"
    r"(?:[_-]+(?:ads?|articles?|body|box|cards?|content|entry|items?|list|posts?|stor(?:y|ies)|teasers?|unit|\d+))*",
    re.IGNORECASE)
# Inside an article whole class names count, so that a section on "share-price" or "related-work" is text:
# a name of chrome, alone or with names of places and of parts of a page around it.
_PLACE = (r"article|bottom|entry|float\w*|fixed|global|inline|left|main|mobile|page|post|primary|right|secondary|"
          r"site|sticky|top")
_NAME = (r"ads?|advert\w*|sponsor\w*|promo\w*|banners?|cookies?|consent|gdpr|notices?|notifications?|popup|modal|menu|"
         r"navbar|nav|navigation|breadcrumbs?|sidebar|side-bar|widgets?|footer|masthead|comments?|commentlist|disqus|"
         r"respond|replies|reply|share|sharing|socials?|related|recommend\w*|newsletter|subscribe|subscription|signup|"
         r"login|toolbar|pagination|pager|skip-link")
_PART = (r"area|articles?|bar|block|body|box|buttons?|btns?|cards?|container|content|count|form|icons?|inner|items?|"
         r"link|links|list|module|overlay|panel|posts?|row|section|slot|stor(?:y|ies)|teasers?|text|title|thread|unit|"
         r"wrap|wrapper|\d+")
CHROME_INSIDE = re.compile(
    rf"(?:(?:{_PLACE})[_-]+)*(?:{_NAME})(?:[_-]+(?:{_PART}|{_NAME}))*", re.IGNORECASE)
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
ARTICLE_HEAD = frozenset(("header",))     # a header inside an article belongs to it

TAG = re.compile(r"<(?:!--.*?(?:--!?>|$)|!\[CDATA\[.*?(?:\]\]>|$)|[!?][^>]*(?:>|$)|"
                 r"(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|$)|'[^']*(?:'|$))*)(?:>|$))", re.DOTALL)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""",
                       re.IGNORECASE)
SPACE = re.compile(r"\s+")


# ------------------------------------------------------------------ pages to blocks

def chrome_element(tag: str, attributes: str, inside_main: bool) -> bool:
    if tag in CHROME:
        return not (inside_main and tag in ARTICLE_HEAD)
    if not attributes or tag in ("html", "body"):
        return False
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True
        if name == "role" and value.strip().lower() in CHROME_ROLES:
            return True
        if name in ("class", "id") and tag in MAIN and not inside_main:
            if any(CHROME_ARTICLE.fullmatch(v) for v in value.split()):
                return True
        elif inside_main:                     # an id there is an anchor of the text
            if name == "class" and tag not in HEADINGS and any(CHROME_INSIDE.fullmatch(v) for v in value.split()):
                return True
        elif name in ("class", "id") and CHROME_NAME.search(value):
            return True
    return False


def blocks(html: str) -> list[tuple[str, str]]:
    """(kind, text) of the page's blocks in order; kind: main, open or chrome.

    Chrome in an inline element (a button, a menu's link) leaves its block whole."""
    out: list[tuple[str, str]] = []
    parts: list[tuple[str, str]] = []         # kind and text since the last border of blocks
    stack: list[tuple[str, str]] = []         # open elements: tag, what they make of their text
    kind = "open"

    def flush() -> None:
        for own in dict.fromkeys(k for k, _ in parts):
            text = SPACE.sub(" ", unescape("".join(t for k, t in parts if k == own))).strip()
            if text:
                out.append((own, text))
        parts.clear()

    def close(depth: int) -> None:
        nonlocal kind
        del stack[depth:]
        kind = stack[-1][1] if stack else "open"

    at = 0
    for m in TAG.finditer(html):
        if m.start() < at:
            continue
        if kind != "none":
            parts.append((kind, html[at:m.start()]))
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if tag in VOID:
            if tag == "br" or tag == "hr":
                parts.append((kind, " "))
            continue
        if m[1]:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if tag in BLOCKS:
                flush()
            if depth is not None:
                if any(t in BLOCKS for t, _ in stack[depth:]) and tag not in BLOCKS:
                    continue                  # an inline end tag does not close a block
                if any(t in BLOCKS for t, _ in stack[depth:]):
                    flush()
                close(depth)
            continue
        if tag in BLOCKS:
            flush()
            if stack and tag in CLOSED_BY.get(stack[-1][0], ()):
                close(len(stack) - 1)
            else:
                own = next((i for i in range(len(stack) - 1, -1, -1)
                            if stack[i][0] in CLOSED_BY and tag in CLOSED_BY[stack[i][0]]
                            and all(t not in BLOCKS for t, _ in stack[i + 1:])), None)
                if own is not None:
                    close(own)
        if m[0].endswith("/>") and tag not in BLOCKS:
            continue
        if kind in ("none", "chrome") and tag not in NO_TEXT:
            new = kind
        elif tag in NO_TEXT:
            new = "none"
        elif chrome_element(tag, m[3] or "", kind == "main"):
            new = "chrome"
        else:
            new = "main" if tag in MAIN else kind
        stack.append((tag, new))
        kind = new
        if tag in RAW:
            end = re.compile(f"</{tag}\\s*>", re.IGNORECASE).search(html, at)
            if tag == "textarea" or tag == "title" or end:
                at = end.end() if end else len(html)
            else:
                at = len(html)
            close(len(stack) - 1)
    if kind != "none":
        parts.append((kind, html[at:]))
    flush()
    return out


def host_of(url: str | None) -> str:
    m = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return m[1].lower() if m else ""


# ------------------------------------------------------------------ suffix array

def ranks(tokens: np.ndarray, depth: int) -> np.ndarray:
    """Rank of every suffix by its first ``depth`` tokens (prefix doubling).

    ``tokens`` are positive; places beyond the end count as unlike any token.
    """
    _, rank = np.unique(tokens, return_inverse=True)
    rank = rank.astype(np.int64) + 1
    length = 1
    while length < depth:
        step = min(length, depth - length)
        ahead = np.zeros_like(rank)
        ahead[:-step] = rank[step:] if step < len(rank) else 0
        _, rank = np.unique(rank * (int(rank.max()) + 2) + ahead, return_inverse=True)
        rank = rank.astype(np.int64) + 1
        length += step
    return rank


def repeated(streams: list[list[str]], pages: list[int]) -> list[np.ndarray]:
    """For every stream, which tokens lie in a substring of ``RUN`` tokens that two distinct
    pages share.  Streams of equal page numbers are one page."""
    return covers_and_windows(streams, pages)[0]


def covers_and_windows(streams: list[list[str]], pages: list[int]) -> tuple[
        list[np.ndarray], list[str], np.ndarray, np.ndarray]:
    """The covered tokens as of ``repeated``; the distinct windows of ``RUN`` tokens, and the
    smallest and the largest page that hold each."""
    sizes = [len(s) for s in streams]
    out = [np.zeros(n, bool) for n in sizes]
    if not any(n >= RUN for n in sizes):
        return out, [], np.zeros(0, np.int64), np.zeros(0, np.int64)
    words: dict[str, int] = {}
    flat, owner = [], []
    for s, page in zip(streams, pages, strict=True):
        flat += [words.setdefault(w, len(words) + 1) for w in s] + [0]
        owner += [page] * (len(s) + 1)
    token, owner = np.array(flat, np.int64), np.array(owner, np.int64)
    ends = np.flatnonzero(token == 0)
    token[ends] = len(words) + 1 + np.arange(len(ends))       # every stream's end is unique
    rank = ranks(token, RUN)
    order = np.argsort(rank, kind="stable")                   # the suffix array to depth RUN
    r, o = rank[order], owner[order]
    first = np.ones(len(r), bool)
    first[1:] = r[1:] != r[:-1]
    group = np.cumsum(first) - 1
    low = np.full(group[-1] + 1, np.iinfo(np.int64).max)
    high = np.full(group[-1] + 1, np.iinfo(np.int64).min)
    np.minimum.at(low, group, o)
    np.maximum.at(high, group, o)
    hit = np.zeros(len(token) + RUN, np.int64)
    starts = order[(low < high)[group]]
    np.add.at(hit, starts, 1)
    np.add.at(hit, starts + RUN, -1)
    covered = np.cumsum(hit)[:len(token)] > 0
    at = 0
    for i, n in enumerate(sizes):
        out[i] = covered[at:at + n]
        at += n + 1
    one = order[first]                                        # a place of every distinct window
    whole = np.flatnonzero(ends[np.searchsorted(ends, one)] - one >= RUN)
    texts = list(words)
    windows = [" ".join([texts[w - 1] for w in token[i:i + RUN].tolist()]) for i in one[whole].tolist()]
    return out, windows, low[whole], high[whole]


def unique_runs(texts: list[str], covered: list[bool]) -> str:
    """Blocks without their covered tokens, empty ones left out.

    A run of covered tokens that ends inside a block and has fewer than ``RUN`` of
    its tokens belongs to a neighbouring block's repetition, and stays.
    """
    out, at = [], 0
    for text in texts:
        tokens = text.split(" ")
        own = covered[at:at + len(tokens)]
        at += len(tokens)
        if all(own):
            continue
        left: list[str] = []
        run: list[str] = []
        for t, c in zip(tokens, own, strict=True):
            if c:
                run.append(t)
                continue
            if len(run) < RUN:
                left += run
            run = []
            left.append(t)
        if len(run) < RUN:
            left += run
        out.append(" ".join(left))
    return "\n".join(out)


# ------------------------------------------------------------------ steps

PARSED = "host string, main string, marked boolean, open array<string>, chrome array<string>"


def _parse():
    def parse(url: pa.Array, html: pa.Array) -> pa.Array:
        hosts, mains, marked, opens, chromes = [], [], [], [], []
        for u, h in zip(url.to_pylist(), html.to_pylist(), strict=True):
            found = blocks(h)
            main = [t for k, t in found if k == "main"]
            own = [t for k, t in found if k == "open"]
            body = bool(main) and sum(map(len, main)) >= sum(map(len, own))
            hosts.append(host_of(u))
            mains.append("\n".join(main) if body else "")
            marked.append(body)
            opens.append(own if body else [t for k, t in found if k != "chrome"])
            chromes.append([t for k, t in found if k == "chrome"])
        strings = pa.list_(pa.string())
        return pa.StructArray.from_arrays(
            [pa.array(hosts, pa.string()), pa.array(mains, pa.string()), pa.array(marked, pa.bool_()),
             pa.array(opens, strings), pa.array(chromes, strings)],
            ["host", "main", "marked", "open", "chrome"])
    return parse


STATE = ("page_id long, url string, host string, open array<string>, covered array<boolean>, "
         "windows array<struct<h: long, a: long, b: long>>")


def _hash(text: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def _cover(key, table):
    """A part of a host: open blocks and covers of its pages without a marked article; of a
    host with several parts also the distinct windows of all its pages, in rows without blocks."""
    rows = table.select(["page_id", "url", "host", "marked", "open", "chrome", "parts"]).to_pylist()
    streams, pages, numbers = [], [], {}
    for i, r in enumerate(rows):
        own = [t for b in r["open"] for t in b.split(" ")]
        # copies of one text are one page, which repeats nothing
        page = _hash("text " + " ".join(own).lower() if own else
                     f"row {key[1].as_py()} {i}" if r["page_id"] is None else f"id {r['page_id']}")
        if r["page_id"] is not None:
            page = numbers.setdefault(r["page_id"], page)
        streams += [own, [t for b in r["chrome"] for t in b.split(" ")]]
        pages += [page, page]
    covers, windows, low, high = covers_and_windows(streams, pages)
    out = [{"page_id": r["page_id"], "url": r["url"], "host": r["host"], "open": r["open"],
            "covered": covers[2 * i].tolist()} for i, r in enumerate(rows) if not r["marked"]]
    if rows[0]["parts"]:
        found = [{"h": _hash(w), "a": a, "b": b} for w, a, b in zip(
            windows, low.tolist(), high.tolist(), strict=True)]
        out += [{"host": rows[0]["host"], "windows": found[at:at + 10_000]}
                for at in range(0, len(found), 10_000)]
    return pa.Table.from_pylist(out, pa.schema([
        ("page_id", pa.int64()), ("url", pa.string()), ("host", pa.string()),
        ("open", pa.list_(pa.string())), ("covered", pa.list_(pa.bool_())),
        ("windows", pa.list_(pa.struct([("h", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])))]))


def _windows():
    def windows(texts: pa.Array, covered: pa.Array) -> pa.Array:
        out = []
        for blocks_, cover in zip(texts.to_pylist(), covered.to_pylist(), strict=True):
            tokens = [t for b in blocks_ for t in b.split(" ")]
            out.append([_hash(" ".join(tokens[i:i + RUN]))
                        for i in range(len(tokens) - RUN + 1) if not all(cover[i:i + RUN])])
        return pa.array(out, pa.list_(pa.int64()))
    return windows


def _finish():
    def finish(texts: pa.Array, covered: pa.Array, shared: pa.Array) -> pa.Array:
        out = []
        for blocks_, cover, more in zip(texts.to_pylist(), covered.to_pylist(), shared.to_pylist(),
                                        strict=True):
            if more:
                more, cover = set(more), list(cover)
                tokens = [t for b in blocks_ for t in b.split(" ")]
                for i in range(len(tokens) - RUN + 1):
                    if _hash(" ".join(tokens[i:i + RUN])) in more:
                        cover[i:i + RUN] = [True] * RUN
            out.append(unique_runs(blocks_, cover))
        return pa.array(out, pa.string())
    return finish


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url",
            html: str = "html") -> DataFrame:
    """page_id, url and text (empty if none) of every row."""
    spark = spark_of(pages)
    bounded_batches(spark)
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"),
                        text_or_empty(html).alias("html"))
    parse = F.arrow_udf(_parse(), PARSED)
    parsed = rows.withColumn("p", parse("url", "html")).select("page_id", "url", "p.*")

    # parts of the large hosts; the others, by default, are one part
    host = F.regexp_extract(F.coalesce("url", F.lit("")),
                            r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    large = materialize(
        rows.groupBy(F.lower(host).alias("host")).agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("html").cast("long")).alias("size"))
        .select("host", F.greatest(F.ceil(F.col("n") / PART_PAGES), F.ceil(F.col("size") / PART_BYTES)
                                   ).cast("int").alias("parts")).filter("parts > 1"), "hosts")
    if large.count() <= BROADCAST_HOSTS:              # checked
        large = F.broadcast(large)
    # an article's own words go straight to the result; the host's parts get the rest of a page
    marked = parsed.filter("marked").select("page_id", "url", F.col("main").alias("text"))
    dealt = parsed.drop("main").join(large, "host", "left").withColumn("part", F.expr(
        "cast(pmod(xxhash64(page_id, url), coalesce(parts, 1)) as int)"))
    covered = materialize(dealt.groupBy("host", "part").applyInArrow(_cover, STATE), "pages")
    rest = covered.filter("open is not null").drop("windows")
    # windows that are unique in their part but occur in another part of the host, on any page
    row = F.xxhash64("host", "page_id", "url", F.array_join("open", "\n"))
    loose = (rest.join(large, "host", "left_semi")
             .select("host", "page_id", row.alias("row"),
                     F.explode(F.arrow_udf(_windows(), "array<long>")("open", "covered")).alias("h"))
             .distinct())
    seen = (covered.filter("open is null").join(loose.select("host").distinct(), "host", "left_semi")
            .select("host", F.inline("windows")))
    shared = seen.groupBy("host", "h").agg(F.min("a").alias("a"), F.max("b").alias("b")).filter(
        "a < b").select("host", "h")
    more = loose.join(shared, ["host", "h"]).groupBy("row").agg(F.collect_set("h").alias("more"))
    finished = (rest.withColumn("row", row).join(more, "row", "left")
                .select("page_id", "url", F.arrow_udf(_finish(), "string")(
                    "open", "covered", F.coalesce("more", F.array().cast("array<long>"))).alias("text")))
    return marked.union(finished)
