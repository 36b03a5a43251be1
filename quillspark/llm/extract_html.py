"""Main text of web pages by equivalence-class template deduction.

A page is a sequence of tokens: its structural tags with their path, and its
text blocks with theirs, inside an article as outside.  Over the pages of one
host, and over those of one layout (the same set of tag paths) on a host, tokens
with the same occurrence vector (how often on which page) form an equivalence
class; classes that are large and frequent, and ordered on a page, are the
template of that host or layout.  Template tags nest the slots of a page;
template text is boilerplate.  Text in the remaining slots is the page's
content, without those slots whose enclosing tags say they are menus, adverts,
forms and the like; among slots that are left, an article's come first.
Method: Arasu and Garcia-Molina, "Extracting Structured Data from Web Pages",
SIGMOD 2003.

Occurrence vectors are compared by a commutative digest, summed per (host,
layout, token) with a partial sum before the shuffle, over all pages: a host
with a third of the pages costs no single task.  What is left per host and
layout is its template, a few tokens, joined back to the pages.
"""

from __future__ import annotations

import html as entities
import re
import sys
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.common import bounded_batches, checked_broadcast, free_name, staged

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: A class is large with so many tokens, frequent on so many pages and this share of the host's.
CLASS_SIZE, CLASS_PAGES, CLASS_SHARE = 2, 3, 0.5
#: Share of the pages that a template text inside an article must be on.
EVERYWHERE = 0.9
#: Tokens that a task hands over at a time, about.
TOKEN_ROWS = 1 << 16

#: An attribute list ends before the next tag, so markup that never closes costs linear time.
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/<>]*+)((?:\"[^\"]*\"|'[^']*'|[^'\"<>])*+)>", re.S)
ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
LETTERS = re.compile("[a-z]+")
CAMEL = re.compile("(?<=[a-z])(?=[A-Z])")
PARTS = re.compile("[-_:]+")

RAW = frozenset(("script", "style", "title", "textarea", "iframe", "noembed", "noframes", "xmp"))
#: Elements whose nesting matters; others open and close without a place on the path.
STRUCTURE = frozenset(("html", "head", "body", "main", "article", "section", "div", "nav", "header", "footer", "aside", "form", "ul",
                       "ol", "dl", "table", "figure", "details", "dialog", "menu", "noscript", "template", "svg", "math", "button",
                       "select", "label", "fieldset", "object", "canvas", "video", "audio", "address"))
INLINE = frozenset(("a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img",
                    "ins", "kbd", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup",
                    "time", "tt", "u", "var", "wbr"))
#: Elements and words in class, id or role that mark boilerplate.
BOILERPLATE_TAGS = frozenset(("head", "nav", "footer", "aside", "form", "dialog", "menu", "noscript", "template", "svg", "math", "button",
                              "select", "object", "canvas", "video", "audio"))
BOILERPLATE_WORDS = frozenset((
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "alert", "banner", "breadcrumb", "breadcrumbs", "comment", "comments",
    "consent", "contentinfo", "cookie", "cookies", "copyright", "disclaimer", "disqus", "footer", "header", "login", "masthead", "menu",
    "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notification", "pager", "pagination", "popup", "promo", "promoted",
    "recommended", "related", "replies", "respond", "search", "share", "sharing", "sidebar", "signup", "skip", "social", "sponsor",
    "sponsored", "subscribe", "toolbar", "widget",
    "adbox", "adsense", "adslot", "adunit", "commentlist", "commentslist", "cookiebanner", "cookiebar", "loginform", "searchbar", "searchbox",
    "searchform", "sharebar", "sidenav", "subnav", "topnav"))
#: What may stand beside such a word in a compound without changing what the element is;
#: "with-sidebar", "has-comments", "menu-open" or "search-results" name no boilerplate.
NEUTRAL_PARTS = frozenset((
    "site", "page", "global", "main", "primary", "secondary", "top", "bottom", "left", "right", "post", "article", "entry", "blog", "google",
    "list", "area", "box", "bar", "button", "buttons", "link", "links", "block", "section", "wrapper", "wrap", "container", "slot", "unit",
    "form", "icons", "item", "items", "text", "message", "policy", "posts", "articles", "user", "users", "reader", "readers", "visitor",
    "visitors", "guest", "thread", "threads", "body", "author", "breaking", "important", "legal", "service", "info", "inline"))
#: Elements without an end tag, and those that the start of another one ends.
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "input", "link", "meta", "param", "source", "track"))
ENDED_BY_LIKE = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th", "tr"), "th": ("td", "th", "tr"),
                 "option": ("option",)}
MAIN = ("article", "main")
MAIN_MARKS = frozenset(("main", "main-content", "maincontent"))
#: Marks of a block: shown, inside an article or main element that a word alone marks (or that stands in such
#: an element), boilerplate.
SHOWN, DOUBTED, DROPPED = 0, 1, 2


def _marks(attributes: str) -> list[str]:
    return LETTERS.findall(" ".join(a or b or c for _, a, b, c in ATTRIBUTE.findall(attributes)).lower())


def _names(attributes: str) -> list[str]:
    """Whole class names, ids and roles in lower case, camel case parted by hyphens."""
    raw = " ".join(a or b or c for _, a, b, c in ATTRIBUTE.findall(attributes))
    return CAMEL.sub("-", raw).lower().split()


def _is_boilerplate(name: str, words: frozenset[str]) -> bool:
    """A listed word, alone or in a compound of listed words, neutral parts and numbers."""
    if name in words:
        return True
    parts = [x for x in PARTS.split(name) if x and not x.isdigit()]
    return not words.isdisjoint(parts) and all(x in BOILERPLATE_WORDS or x in NEUTRAL_PARTS for x in parts)


def blocks(page: str) -> Iterator[tuple[str, str, str, int, bool]]:
    """``(kind, path, text, mark, nested)`` of a page in order.

    ``kind`` is ``tag`` (a structural element opens; no text) or the element
    that holds the text: ``article``, ``main`` or ``body``.  ``mark`` is
    ``DROPPED`` if an enclosing element is boilerplate, by its name or by a word
    in its class, id or role, and ``DOUBTED`` if only words say so and they
    stand at the holding article or main element or above it.  Class, id and role
    count on every element but inline ones.  Text of a block has its character
    references decoded and white space made single spaces.  Hidden text (``hidden``,
    ``display:none``) is text like any other.  ``path`` is a digest of the open
    elements, so markup that nests without end stays small.  ``nested`` says that
    the block stands in an element of its own below the article or main element.
    """
    # Name, path, boilerplate by name, holder of the last element that a word marks, holder, path of the holder.
    stack: list[tuple[str, str, bool, str, str, str]] = []
    bottom = ("", "", False, "", "body", "")
    opened: Counter[str] = Counter()
    at, held = 0, []

    def flush():
        text = " ".join(entities.unescape("".join(held)).split())
        held.clear()
        if text:
            _, path, dropped, worded, holder, held_by = stack[-1] if stack else bottom
            yield holder, path, text, mark(dropped, worded, holder), path != held_by

    def mark(dropped, worded, holder):
        return DROPPED if dropped or worded == holder else DOUBTED if worded else SHOWN

    def close(name):
        while opened[name]:
            last = stack.pop()[0]
            opened[last] -= 1
            if last == name:
                break

    while at < len(page):
        m = TAG.search(page, at)
        held.append(page[at:m.start() if m else len(page)])
        if not m:
            break
        at = m.end()
        if m.group(2) is None:
            continue
        closing, name = m.group(1), m.group(2).lower()
        if name in INLINE:
            continue
        yield from flush()
        if closing:
            close(name)
            continue
        # Only marked elements of these names are on the stack; what ends them ends their mark.
        if stack and (stack[-1][0] == "p" and (name not in VOID or name == "hr") or name in ENDED_BY_LIKE.get(stack[-1][0], ())):
            close(stack[-1][0])
        if name in RAW:
            end = re.compile(f"</{name}\\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if name not in VOID and not m.group(3).endswith("/"):
            _, path, dropped, worded, outer, held_by = stack[-1] if stack else bottom
            marks, names = (_marks(m.group(3)), _names(m.group(3))) if "=" in m.group(3) else ([], [])
            # The header of an article holds its title.
            words = BOILERPLATE_WORDS if outer == "body" else BOILERPLATE_WORDS - {"header"}
            if name not in STRUCTURE:
                if any(_is_boilerplate(x, words) for x in names):
                    stack.append((name, path, dropped, outer, outer, held_by))
                    opened[name] += 1
                continue
            holder = name if name in MAIN else "main" if outer == "body" and not MAIN_MARKS.isdisjoint(names) else outer
            path = f"{_digest(path, name, *marks):x}"
            held_by = path if holder != outer or name in MAIN else held_by
            if name == "body" or name == "html":
                dropped, worded = False, ""
            elif name in BOILERPLATE_TAGS:
                dropped = True
            elif name in words or any(_is_boilerplate(x, words) for x in names):
                worded = outer
            stack.append((name, path, dropped, worded, holder, held_by))
            opened[name] += 1
            yield "tag", path, "", mark(dropped, worded, holder), False
    yield from flush()


def _digest(*parts: str) -> int:
    from xxhash import xxh64_intdigest
    n = xxh64_intdigest("\x1f".join(parts).encode("utf-8", "surrogatepass"), 7)
    return n - (1 << 64) if n >> 63 else n


def tokens(page: str | None) -> tuple[int, dict[int, tuple[int, int]]]:
    """Layout of a page (a digest of its set of tag paths), and token -> (occurrences, first place);
    ``MAIN_PAGE`` is among the tokens of a page with text in an article or main element."""
    out: dict[int, tuple[int, int]] = {}
    paths = set()
    for i, (kind, path, text, *_) in enumerate(blocks(page or "")):
        if kind == "tag":
            paths.add(path)
        t = _digest(kind, path, text)
        n, first = out.get(t, (0, i))
        out[t] = n + 1, first
        if kind in MAIN:
            out[MAIN_PAGE] = 1, 0
    return _digest(*sorted(paths)), out


def _in_order(orders: list[tuple[int, int]]) -> set[int]:
    """Places of a longest run of ``(place, order)`` whose orders never fall."""
    tails: list[int] = []
    ends: list[int] = []
    before = []
    for i, (_, order) in enumerate(orders):
        at = bisect_right(tails, order)
        before.append(ends[at - 1] if at else -1)
        tails[at:at + 1], ends[at:at + 1] = [order], [i]
    out, i = set(), ends[-1] if ends else -1
    while i >= 0:
        out.add(orders[i][0])
        i = before[i]
    return out


def main_text(page: str | None, of_host: dict[int, int] | None = None, of_layout: dict[int, int] | None = None) -> str:
    """Content of a page, given its host's and its layout's template (token -> order).

    Content is the text that is neither marked as boilerplate nor template text;
    a template text counts as such only where the page keeps the template's
    order.  Inside an article or main element it counts only with structural
    evidence: it is on nearly all (``EVERYWHERE``) of the host's pages with such an element, in an element of its own
    below the article, and that element holds nothing but such text.  So equal
    paragraphs of near copies, series or quotations are content.  Of what is left an article's text comes first, then the main
    element's, then the body's; where neither is left, words alone drop no
    article or main element.  An article whose blocks and letters are mostly
    template text is one that the host repeats, and stays whole, unless all of
    it is repeated and more text is left elsewhere.  A page without any other
    text than the template's is a copy and keeps it.
    """
    seen = list(blocks(page or ""))
    fixed: set[int] = set()
    for template in (of_host, of_layout):
        if template:
            ids = ((i, template.get(_digest(kind, path, text))) for i, (kind, path, text, *_) in enumerate(seen))
            ids = [(i, order) for i, order in ids if order is not None]
            fixed |= _in_order([(i, abs(order)) for i, order in ids if seen[i][0] not in MAIN
                                or template is of_host and order < 0 and seen[i][4]])
    own = {path for i, (kind, path, *_) in enumerate(seen) if kind in MAIN and i not in fixed}
    fixed = {i for i in fixed if seen[i][0] not in MAIN or seen[i][1] not in own}
    slots: dict[str, list[str]] = {}
    whole: dict[str, list[str]] = {}
    shown = {mark for kind, _, _, mark, _ in seen if kind in MAIN}
    most = DOUBTED if SHOWN not in shown else SHOWN
    for i, (kind, _, text, mark, _) in enumerate(seen):
        if kind != "tag" and mark <= most:
            whole.setdefault(kind, []).append(text)
            if i not in fixed:
                slots.setdefault(kind, []).append(text)
    letters = lambda texts: sum(map(len, texts))
    for holder in MAIN:
        left, every = slots.get(holder, []), whole.get(holder, [])
        if left and (2 * len(left) >= len(every) or 2 * letters(left) >= letters(every)):
            return " ".join(left)
        if left:
            return " ".join(every)
    rest = slots.get("body", [])
    repeated = next((whole[h] for h in MAIN if h in whole), [])
    if not rest:
        return " ".join(repeated or whole.get("body", []))
    return " ".join(repeated if letters(repeated) >= letters(rest) else rest)


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]+)", 1), F.lit("")))


#: Stand for the page itself among its tokens: their rows count a layout's pages, and those with an article.
PAGE, MAIN_PAGE = 0, 1


def _deduced(by_token: DataFrame, group: list[str], size: int, least: int, share: float) -> DataFrame:
    """``group`` and ``template``: the ordered tokens of each group's large and frequent classes.

    The order of a token that is on nearly all pages with an article is negative.
    """
    tokens_of = by_token.where(~F.col("token").isin(PAGE, MAIN_PAGE)).groupBy(*group, "token").agg(
        F.sum("pages").alias("pages"), F.bit_xor("vector").alias("vector"), (F.sum("places") / F.sum("pages")).alias("place"))
    pages_of = by_token.where(F.col("token").isin(PAGE, MAIN_PAGE)).groupBy(*group).agg(
        F.sum(F.when(F.col("token") == PAGE, F.col("pages"))).alias("of"), F.sum(F.when(F.col("token") == MAIN_PAGE, F.col("pages"))).alias("mains"))
    frequent = tokens_of.where(F.col("pages") >= least).join(pages_of, group).where(F.col("pages") >= share * F.col("of"))
    classes = frequent.groupBy(*group, "pages", "vector").agg(F.count(F.lit(1)).alias("members")).where(F.col("members") >= size)
    sign = F.when(F.col("pages") >= EVERYWHERE * F.coalesce("mains", "of"), -1).otherwise(1)
    kept = frequent.join(classes, [*group, "pages", "vector"], "left_semi").withColumn("sign", sign)
    # A template is short: each of its tokens is on at least `share` of the pages.
    order = Window.partitionBy(*group).orderBy("place", "token")
    return (kept.select(*group, "token", (F.col("sign") * F.row_number().over(order)).alias("at")).groupBy(*group)
            .agg(F.map_from_entries(F.collect_list(F.struct("token", "at"))).alias("template")))


def templates(pages: DataFrame, url: str = "url", page: str = "html", size: int = CLASS_SIZE, least: int = CLASS_PAGES,
              share: float = CLASS_SHARE) -> tuple[DataFrame, DataFrame]:
    """``(host, template)`` and ``(host, layout, template)``: the ordered tokens of the large and frequent classes.

    The occurrence digest of a token is a sum of hashes of (page, occurrences);
    pages of equal markup get different hashes by their row.
    """
    names = ["host", "layout", "token", "vector", "first"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows: list[tuple] = []
            for h, k, p in zip(frame["host"], frame["k"], frame["page"]):
                layout, found = tokens(p)
                rows.append((h, layout, PAGE, 0, 0))
                rows += [(h, layout, t, _digest(str(k), str(n)), first) for t, (n, first) in found.items()]
                if len(rows) >= TOKEN_ROWS:
                    yield pd.DataFrame(rows, columns=names)
                    rows = []
            if rows:
                yield pd.DataFrame(rows, columns=names)
    bounded_batches(pages.sparkSession)
    html = F.col(f"`{page}`")
    rows = pages.select(host_of(F.col(f"`{url}`")).alias("host"), html.alias("page"),
                        F.xxhash64(F.col(f"`{url}`"), html, F.monotonically_increasing_id()).alias("k")).where("page is not null")
    seen = rows.mapInPandas(run, "host string, layout long, token long, vector long, first long")
    by_token = staged(seen.groupBy("host", "layout", "token").agg(
        F.count(F.lit(1)).alias("pages"), F.bit_xor("vector").alias("vector"), F.sum("first").alias("places")), "page-tokens")
    return tuple(_deduced(by_token, group, size, least, share) for group in (["host"], ["host", "layout"]))


def extract(pages: DataFrame, url: str = "url", page: str = "html", out: str = "text", size: int = CLASS_SIZE,
            least: int = CLASS_PAGES, share: float = CLASS_SHARE) -> DataFrame:
    """``pages`` with ``out``: the main text of each page, empty if there is none.

    A null or empty page has an empty text; a null url is one host; hosts of
    few pages have no template and go by their markup alone.
    """
    of_host, of_layout = templates(pages, url, page, size, least, share)
    of_host, of_layout = staged(of_host, "host-templates"), staged(of_layout, "layout-templates")

    @F.pandas_udf("long")
    def layout_of(html: pd.Series) -> pd.Series:
        return pd.Series([tokens(h)[0] for h in html], dtype="int64")

    @F.pandas_udf("string")
    def text(html: pd.Series, first: pd.Series, second: pd.Series) -> pd.Series:
        return pd.Series([main_text(h, *(None if t is None else dict(t) for t in both)) for h, *both in zip(html, first, second)])
    bounded_batches(pages.sparkSession)
    host, layout, t, u = (free_name(pages, n) for n in ("_host", "_layout", "_template", "_layout_template"))
    of_host = of_host.select(F.col("host").alias(host), F.col("template").alias(t))
    of_layout = of_layout.select(F.col("host").alias(host), F.col("layout").alias(layout), F.col("template").alias(u))
    rows = pages.withColumn(host, host_of(F.col(f"`{url}`"))).withColumn(layout, layout_of(F.col(f"`{page}`")))
    rows = rows.join(checked_broadcast(of_host), host, "left").join(checked_broadcast(of_layout), [host, layout], "left")
    return rows.select(*[F.col(f"`{c}`") for c in pages.columns if c != out],
                       text(F.col(f"`{page}`"), F.col(t), F.col(u)).alias(out))
