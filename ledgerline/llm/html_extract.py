"""Main text of web pages, with site templates removed.

A page is parsed once into elements and text items (lenient: unclosed and stray tags, comments, raw-text elements and
a cut-off end are all defined below). Every element has a hash of its subtree: tag, class, id and all text and elements within.
In Spark the subtrees of all elements that hold text are counted per host, once for each distinct main content, so that copies of
one page don't make its article a template. A subtree that recurs on many pages of distinct content is its host's template, and is deleted
from each of its pages: within main content on PAGES_INSIDE pages and SHARE_INSIDE of the host's (a block of an article that
recurs less may be its own), elsewhere on PAGES_OUTSIDE and SHARE_OUTSIDE. So a host has at most the
elements of a page divided by SHARE_OUTSIDE of them, and its templates are a bounded array.

Kept is the text of `article` and `main` elements (role=main too), or of the whole body where there are none. What a template
can't show, as it differs from page to page (adverts, comments, notices), goes by a second rule: block elements whose tag, role, class or id
says so. Inline elements are never dropped for a name. Block elements part the text; `br` and inline elements don't. White space
inside a block becomes one space, character references are decoded, empty blocks vanish, blocks are joined by a line feed.

Defined cases: null or empty html gives an empty text; null urls have the host ""; null ids stay null; repeated rows each give a
row and count once; a comment or raw-text element without an end lasts to the end of the page, as does a tag that is cut off or an
attribute whose quotation mark is never closed; nesting may be of any depth, and the work is linear in a page's length; an empty
table gives an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import discard, settle, shared_folder, sub_batches, tune

#: Pages of distinct content on which a template recurs at least, and their share of the host's: in main content, and elsewhere.
PAGES_INSIDE, SHARE_INSIDE = 8, 0.6
PAGES_OUTSIDE, SHARE_OUTSIDE = 3, 0.01
#: Tags by what they do. Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead title tr ul".split())
DROPPED = frozenset("head nav header footer aside form menu dialog button select fieldset".split()) | RAW
#: Words of class and id names, and roles, of what is not main text.
ODD_WORDS = frozenset("ad ads advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promotion banner banners nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars aside rail footer header masthead topbar comment comments commentlist respond disqus reply replies cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended widget widgets pagination pager toolbar".split())
ODD_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog".split())
#: An end that a start tag implies: it closes an open element of the second set, up to one of the third.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
ENDS_P = BLOCK - {"td", "th", "tr", "li", "option", "body", "html"} | {"li"}

#: A tag from its "<": possessive, so one pass; a value's mark that is never closed lasts to the end of the page.
TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:=\s*+\"[^\"]*+(?:\"|\Z)|=\s*+'[^']*+(?:'|\Z)|[^>])*+)(?:>|\Z)")
ATTRIBUTE = re.compile(r"([^\s=\"'/]++)\s*+=\s*+(?:\"([^\"]*+)\"?|'([^']*+)'?|([^\s\"']++))")
NAME_WORD = re.compile(r"[a-z]+")


class Page:
    """Elements (tag, parent, dropped, main, subtree hash) and text items in page order."""

    def __init__(self, source: str) -> None:
        self.parent, self.drop, self.main, self.hash = [-1], [False], [False], [0]
        self.items: list[tuple[int, str | None]] = []  # (element, text), or None where a block ends
        self.tags, self.inner, self.full = [""], [[""]], [False]
        self.stack = [0]
        self.open: dict[str, list[int]] = {}  # the places of open elements in the stack, by tag
        at, n = 0, len(source)
        while at < n:
            here = source.find("<", at)
            if here < 0 or here + 1 == n:
                break
            if source.startswith("<!--", here):
                after = source.find("-->", here + 4)
                stop = n if after < 0 else after + 3
            elif source[here + 1] in "!?":
                after = source.find(">", here)
                stop = n if after < 0 else after + 1
            elif m := TAG.match(source, here):
                if here > at:
                    self.text(source[at:here])
                at = self.tag(m, source)
                continue
            else:  # a plain "<"
                self.text(source[at : here + 1])
                at = here + 1
                continue
            if here > at:
                self.text(source[at:here])
            at = stop
        if at < n:
            self.text(source[at:])
        while self.stack:
            self.pop()

    def tag(self, m: re.Match[str], source: str) -> int:
        """Take a tag; returns where the page goes on."""
        name, raw = m[2].lower(), m[3]
        if m[1]:
            self.end(name)
            return m.end()
        self.start(name, raw)
        if name not in RAW or raw.rstrip().endswith("/"):
            return m.end()
        close = raw_end(name).search(source, m.end())
        self.end(name)
        return close.end() if close else len(source)

    def text(self, raw: str) -> None:
        here = self.stack[-1]
        self.items.append((here, html.unescape(raw) if "&" in raw else raw))
        self.inner[here].append(raw)
        if not raw.isspace():
            self.full[here] = True

    def start(self, tag: str, raw: str) -> None:
        if tag in ENDS_P:
            self.close({"p"}, {"article", "section", "div", "td", "th", "button", "body", "main"})
        if tag in CLOSES:
            self.close(*CLOSES[tag])
        if tag in BLOCK:
            self.items.append((self.stack[-1], None))
        elif tag == "br":
            self.items.append((self.stack[-1], " "))
        if tag in VOID:
            return
        names, role = "", ""
        if "=" in raw:
            for k, a, b, c in ATTRIBUTE.findall(raw):
                if (k := k.lower()) in ("class", "id"):
                    names += " " + (a or b or c).lower()
                elif k == "role":
                    role = (a or b or c).lower()
        self.parent.append(self.stack[-1])
        self.main.append(tag in ("article", "main") or role == "main")
        named = tag in BLOCK and tag not in ("body", "html", "article", "main") and bool(names) and not ODD_WORDS.isdisjoint(NAME_WORD.findall(names))
        self.drop.append(tag in DROPPED or role in ODD_ROLES or named or tag == "article" and "comment" in names)
        self.hash.append(0)
        self.tags.append(tag)
        self.inner.append([tag, names])
        self.full.append(False)
        self.open.setdefault(tag, []).append(len(self.stack))
        self.stack.append(len(self.parent) - 1)

    def pop(self) -> None:
        e = self.stack.pop()
        self.hash[e] = xxhash.xxh3_64_intdigest("\x00".join(self.inner[e]).encode("utf-8", "surrogatepass")) - (1 << 63)
        self.inner[e] = []
        if self.stack:
            self.open[self.tags[e]].pop()
            self.inner[self.stack[-1]].append(str(self.hash[e]))
            self.full[self.stack[-1]] |= self.full[e]
        if self.tags[e] in BLOCK:
            self.items.append((e, None))

    def nearest(self, tags: set[str]) -> int:
        """The place in the stack of the innermost open element of these tags, or 0."""
        return max((self.open[t][-1] for t in tags if self.open.get(t)), default=0)

    def close(self, tags: set[str], limits: set[str]) -> None:
        """Pop up to the nearest open element of `tags`, unless one of `limits` is nearer."""
        k = self.nearest(tags)
        if k > self.nearest(limits):
            while len(self.stack) > k:
                self.pop()

    def end(self, tag: str) -> None:
        if k := self.nearest({tag}):
            while len(self.stack) > k:
                self.pop()
        elif tag in BLOCK:
            self.items.append((self.stack[-1], None))

    def inside(self, lists: bool) -> list[bool]:
        """Which elements are main content: within article or main, or all where there are none."""
        any_main = any(m and not (d and lists) for m, d in zip(self.main, self.drop, strict=True))
        out = [not any_main]
        for e in range(1, len(self.parent)):
            out.append(out[self.parent[e]] or self.main[e])
        return out

    def kept(self, templates: frozenset[int] | set[int], lists: bool = True) -> list[bool]:
        """Which elements' own text is main text. Templates are hashes, those of main content with the lowest bit set.

        Without `lists`, templates alone decide, over the whole page but for raw-text elements and the head.
        """
        inside, gone, out = self.inside(lists), [False], []
        for e in range(1, len(self.parent)):
            odd = self.drop[e] if lists else self.tags[e] in RAW or self.tags[e] == "head"
            gone.append(gone[self.parent[e]] or odd or key_of(self.hash[e], inside[e]) in templates and not self.main[e])
        for e, g in enumerate(gone):
            out.append(not g and (inside[e] or not lists))
        return out

    def extract(self, templates: frozenset[int] | set[int] = frozenset(), lists: bool = True) -> str:
        kept, blocks, now = self.kept(templates, lists), [], []
        for e, text in self.items:
            if text is None:
                if now:
                    blocks.append(" ".join("".join(now).split()))
                    now = []
            elif kept[e]:
                now.append(text)
        if now:
            blocks.append(" ".join("".join(now).split()))
        return "\n".join(b for b in blocks if b)

    def subtrees(self) -> tuple[int, list[int]]:
        """A hash of the main content, and the distinct keys of all elements with text, html, body and the main ones aside."""
        inside = self.inside(True)
        content = xxhash.xxh3_64_intdigest(self.extract().encode("utf-8", "surrogatepass")) - (1 << 63)
        own = {key_of(self.hash[e], inside[e]) for e in range(1, len(inside)) if self.full[e] and not self.main[e] and self.tags[e] not in ("html", "body")}
        return content, sorted(own - {0})


def key_of(tree: int, inside: bool) -> int:
    """A subtree's hash with its place: the lowest bit says whether it is in main content."""
    return tree & ~1 | int(inside)


@cache
def raw_end(name: str) -> re.Pattern[str]:
    return re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*+>", re.I)


def with_host(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    url = F.col(url_col).cast("string")
    host = F.coalesce(F.lower(F.regexp_extract(url, "://([^/?#]*)", 1)), F.lit(""))
    return pages.select(F.col(id_col).alias("id"), url.alias("url"), F.col(html_col).cast("string").alias("html"), F.xxhash64(host).alias("host"))


def site_templates(source: DataFrame, work: str) -> DataFrame:
    """(host, templates): the keys of the recurring subtrees of each host that has any; (host, html) is parsed once."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(it, "html"):
            out: list[tuple[int, int, int]] = []
            for host, text in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                if text:
                    content, trees = Page(text).subtrees()
                    out += [(host, content, 0), *((host, content, t) for t in trees)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], ["host", "content", "tree"])

    seen = source.select("host", "html").mapInArrow(run, "host bigint, content bigint, tree bigint").distinct()
    counts = settle(seen.groupBy("host", "tree").agg(F.count("*").alias("n")).where(F.col("n") >= PAGES_OUTSIDE), "counts", work)
    pages = counts.where("tree = 0").select("host", F.col("n").alias("pages"))  # tree 0 stands for the page itself
    often = counts.where("tree <> 0").join(pages, "host").where(f"n >= case when tree & 1 = 1 then greatest({PAGES_INSIDE}, {SHARE_INSIDE} * pages) else {SHARE_OUTSIDE} * pages end")
    return often.groupBy("host").agg(F.collect_set("tree").alias("templates"))  # at most the elements of a page / SHARE_OUTSIDE


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", lists: bool = True) -> DataFrame:
    """`id_col`, url, text, n_chars of every row. Without `lists`, only site templates, scripts, styles and the head are removed."""
    tune(pages.sparkSession)
    source = with_host(pages, id_col, url_col, html_col)
    id_type = source.schema["id"].dataType.simpleString()
    work = shared_folder(pages.sparkSession)
    templates = settle(site_templates(source, work), "templates")  # so that the join's sides come from scans, and Spark can split a hot host
    discard(pages.sparkSession, work)
    joined = source.join(templates, "host", "left").select("id", "url", "html", "templates")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(it, "html"):
            texts = [Page(h).extract(set(t or ()), lists) if h else "" for h, t in zip(batch.column("html").to_pylist(), batch.column("templates").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["id", "url", "text", "n_chars"])

    return joined.mapInArrow(run, f"id {id_type}, url string, text string, n_chars bigint").withColumnRenamed("id", id_col)
