"""Main text of web pages, with site templates removed.

Every element's subtree is hashed bottom-up. Spark counts, for each host, in how
many different articles' pages a subtree occurs (exact copies of a page count
once). Subtrees that recur across many pages of their host are deleted, inside
articles too. Prose inside an article (paragraphs, headings, list items) needs
more: it must be on most pages of a host with many, as copies of an article
repeat its prose. What is left is read by the fallback: an article or main
element if there is one, and no element that is boilerplate by tag, role, class
or id (such as adverts and comments, which don't recur).

Text: character references decoded; white space inside a block becomes one
blank; blocks are trimmed and joined in page order by one blank. Of several
articles all are kept, in page order, but for teasers (half of whose text or more
is in links) and comments; if all are teasers, the longest is.

Defined results: null and empty html give an empty text; a null url counts as
the host ``""``; repeated rows give equal results and count once; unclosed and
truncated markup is read as browsers do, as far as text is concerned. Parsing
takes time in proportion to the page, however deep its elements lie.
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free, map_rows, stored, text_function

#: A subtree is a template when it occurs in this many different pages of a host, and in this share of them.
MIN_PAGES, MIN_SHARE = 6, 0.01
#: The same for prose inside an article.
PROSE_PAGES, PROSE_SHARE = 20, 0.75
#: Templates up to this number are broadcast as an array of 64-bit keys (8 MB); more are joined to the pages.
BROADCAST_KEYS = 1_000_000

TOKEN = re.compile(r"""<!--(?:-?>|.*?--!?>|.*\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*)>|</?[a-zA-Z][^>]*\Z""", re.S)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")

# Element kinds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
CLOSERS = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>?", re.I) for t in RAW}
BLOCK = frozenset(
    "#root html body head address article aside blockquote br center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li listing main menu nav ol optgroup option p plaintext pre section summary table caption colgroup tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - frozenset("#root html body head br caption colgroup legend optgroup option tbody td tfoot th thead tr".split())
SIBLINGS = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "option": (("option",), ("select",))}
P_FENCES = ("td", "th", "caption", "table", "button", "object", "html")
DROP = frozenset("script style noscript template nav footer aside form button select textarea iframe svg math canvas object audio video map head title dialog menu datalist".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre article main figcaption li dd dt td th tr br hr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice popup modal overlay newsletter subscribe subscription paywall sidebar aside menu nav navbar navigation breadcrumb breadcrumbs footer masthead comment comments respond replies disqus share sharing social related recommended widget toolbar pagination pager login signup search skip".split()
)

PROSE_MARK = 0x5DEECE66D


class Node:
    __slots__ = ("tag", "kind", "label", "children", "hash")

    def __init__(self, tag: str, kind: int, label: str):
        self.tag, self.kind, self.label = tag, kind, label  # kind: 0 text counts, 1 header, 2 dropped
        self.children: list[Node | str] = []
        self.hash = 0


def _kind(tag: str, raw: str) -> tuple[int, str]:
    if tag in DROP:
        return 2, ""
    if not raw.strip():
        return (1 if tag == "header" else 0), ""
    found = {m[1].lower(): next((g for g in m.groups()[1:] if g is not None), "") for m in ATTRIBUTE.finditer(raw)}
    label = f"{found.get('class', '')} {found.get('id', '')}".lower()
    if tag in ("html", "body", "main") or (tag == "article" and "comment" not in label):
        return 0, label
    if "hidden" in found or found.get("aria-hidden") == "true" or found.get("role", "").lower() in ROLES or "display:none" in found.get("style", "").replace(" ", "").lower():
        return 2, label
    words = set(re.split(r"[^a-z]+", label)) if label.strip() else set()
    return (2 if words & NAMES else 1 if tag == "header" or "header" in words else 0), label


class Open:
    """The open elements, with the depths of each tag, so that the innermost one of a tag is found at once."""

    def __init__(self, root: Node):
        self.stack, self.depths, self.closed = [root], {}, []

    def push(self, node: Node) -> None:
        self.depths.setdefault(node.tag, []).append(len(self.stack))
        self.stack.append(node)

    def last(self, tags: tuple[str, ...]) -> int:
        """Depth of the innermost open element of ``tags``, 0 if there is none."""
        return max([d[-1] for t in tags if (d := self.depths.get(t))], default=0)

    def close_to(self, depth: int) -> None:
        """Close the elements at ``depth`` and deeper, hashing each."""
        while len(self.stack) > depth:
            node = self.stack.pop()
            if self.stack:
                self.depths[node.tag].pop()
            h = xxhash.xxh64(f"{node.tag} {node.label}")
            for c in node.children:
                h.update(" ".join(c.split()) if isinstance(c, str) else c.hash.to_bytes(8, "little"))
            node.hash = h.intdigest()
            if node.tag in BLOCK and node.children:
                self.closed.append(node)

    def close_within(self, tags: tuple[str, ...], fences: tuple[str, ...]) -> None:
        """Close the innermost element of ``tags``, unless a fence lies inside it."""
        depth = self.last(tags)
        if depth and depth > self.last(fences):
            self.close_to(depth)


def parse(html: str) -> tuple[Node, list[Node]]:
    """The tree, and all closed block elements."""
    root = Node("#root", 0, "")
    open_, at, end = Open(root), 0, len(html)
    stack = open_.stack
    while at < end:
        m = TOKEN.search(html, at)
        if m is None:
            stack[-1].children.append(unescape(html[at:]))
            break
        if m.start() > at:
            stack[-1].children.append(unescape(html[at : m.start()]))
        at = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        tag, raw = name.lower(), m[3] or m[6] or ""
        if m[1] or m[4]:
            if depth := open_.last((tag,)):
                open_.close_to(depth)
            continue
        if tag in CLOSES_P:
            open_.close_within(("p",), P_FENCES)
        if tag in SIBLINGS:
            open_.close_within(*SIBLINGS[tag])
        node = Node(tag, *_kind(tag, raw))
        stack[-1].children.append(node)
        if tag in VOID:
            continue
        if tag in RAW:
            close = CLOSERS[tag].search(html, at)
            node.hash = xxhash.xxh64_intdigest(html[at : close.start() if close else end])
            at = close.end() if close else end
            continue
        if not raw.rstrip().endswith("/") or tag in BLOCK:
            open_.push(node)
    open_.close_to(0)
    return root, open_.closed


def host_of(url: str | None) -> str:
    return re.split(r"[/?#]", (url or "").partition("//")[2] or (url or ""), maxsplit=1)[0].rpartition("@")[2].lower()


def key_of(host: str, subtree: int, prose: bool = False) -> int:
    """Key of a subtree of a host; as prose inside an article it has another."""
    k = xxhash.xxh64_intdigest(host, subtree ^ PROSE_MARK if prose else subtree)
    return k - (1 << 64) if k >> 63 else k


class Templates:
    """Sorted 64-bit keys of a host's recurring subtrees; those of prose carry the key of ``PROSE_MARK`` more."""

    def __init__(self, keys: Iterable[int] = ()):
        self.keys = array("q", sorted(keys))

    def __contains__(self, key: int) -> bool:
        at = bisect_left(self.keys, key)
        return at < len(self.keys) and self.keys[at] == key

    def __bool__(self) -> bool:
        return len(self.keys) > 0


def text_of(top: Node, host: str, templates: Templates, marked: bool) -> str:
    """Text of the subtree without templates and dropped elements; ``marked``: it is an article."""
    out: list[str] = []
    todo: list[tuple[Node | str, bool, bool]] = [(top, False, marked)]
    while todo:
        node, head, inside = todo.pop()
        if isinstance(node, str):
            if not head:
                out.append(node)
            continue
        if node is not top:
            if templates and node.tag in BLOCK and node.children and key_of(host, node.hash, inside and node.tag in PROSE) in templates:
                out.append(" ")
                continue
            if node.kind == 2 or (node.kind == 1 and not inside):
                out.append(" " * (node.tag in BLOCK))
                continue
        # of a header inside the article only the headings are kept
        head = node.tag not in HEADINGS and (head or node.kind == 1)
        inside = inside or node.tag in ("article", "main")
        if node.tag in BLOCK:
            todo.append((" ", False, inside))
            out.append(" ")
        todo.extend((c, head, inside) for c in reversed(node.children))
    return " ".join("".join(out).split())


def main_text(html: str | None, host: str = "", templates: Templates | None = None) -> str:
    if not html:
        return ""
    return _main(parse(html)[0], host, templates or Templates())


def _main(root: Node, host: str, templates: Templates) -> str:
    """Text of the articles in page order, but for teasers; else of the main elements; else of the page."""
    for tag in ("article", "main"):
        tops = _outermost(root, tag)
        if len(tops) == 1:
            return text_of(tops[0], host, templates, True)
        if tops:
            texts = [text_of(t, host, templates, True) for t in tops]
            own = [x for x, t in zip(texts, tops, strict=True) if x and not teaser(t, len(x))]
            return " ".join(own or [max(texts, key=len)])
    return text_of(root, host, templates, False)


def teaser(top: Node, chars: int) -> bool:
    """Whether at least half of an article's ``chars`` characters are in its links: it points to an article elsewhere."""
    linked, todo = 0, [(top, False)]
    while todo:
        node, within = todo.pop()
        if isinstance(node, str):
            linked += len(" ".join(node.split())) * within
        elif node.kind != 2:
            todo.extend((c, within or node.tag == "a") for c in node.children)
    return 2 * linked >= chars


def _outermost(root: Node, tag: str) -> list[Node]:
    found, todo = [], [root]
    while todo:
        n = todo.pop()
        if isinstance(n, str) or n.kind == 2:
            continue
        if n.tag == tag:
            found.append(n)
        else:
            todo.extend(reversed(n.children))
    return found


def find_templates(pages: DataFrame, url: str = "url", html: str = "html", min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE, prose_pages: int = PROSE_PAGES, prose_share: float = PROSE_SHARE) -> DataFrame:
    """Keys (``key``) of host and subtree that recur across the host's pages, as such or as prose inside an article."""

    def subtrees(rows: Iterator[tuple]) -> Iterator[tuple]:
        for u, h in rows:
            if h:
                host = host_of(u)
                root, closed = parse(h)
                article = xxhash.xxh64_intdigest(_main(root, host, Templates())) >> 1
                site = key_of(host, 0)
                yield site, site, article, False
                own = {n.hash: n.tag in PROSE for n in closed if n.tag not in ("#root", "html", "body")}
                for subtree, prose in own.items():
                    yield site, key_of(host, subtree), article, False
                    if prose:
                        yield site, key_of(host, subtree, True), article, True

    kinds = pa.schema([("site", pa.int64()), ("key", pa.int64()), ("article", pa.int64()), ("prose", pa.bool_())])
    seen = map_rows(pages, kinds, "site long, key long, article long, prose boolean", subtrees, [url, html], out_rows=1 << 14).distinct()
    counts = stored(seen.groupBy("site", "key", "prose").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages), "html-subtrees")
    sites = counts.where("site = key").select("site", F.col("n").alias("pages"))
    often = F.when(F.col("prose"), (F.col("n") >= prose_pages) & (F.col("n") >= F.col("pages") * prose_share)).otherwise(F.col("n") >= F.col("pages") * min_share)
    return counts.where("site <> key").join(sites, "site").where(often).select("key").distinct()


def extract(pages: DataFrame, url: str = "url", html: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with the main text in ``out``."""
    spark = pages.sparkSession
    templates = stored(find_templates(pages, url, html), "html-templates")
    if templates.count() <= BROADCAST_KEYS:
        shared = spark.sparkContext.broadcast(Templates(templates.toArrow()["key"].to_pylist()))

        def read(rows: Iterator[tuple]) -> Iterator[str]:
            for u, h in rows:
                yield main_text(h, host_of(u), shared.value)

        return pages.withColumn(out, text_function(read, "string")(F.col(url), F.col(html)))

    def subtrees(rows: Iterator[tuple]) -> Iterator[tuple]:
        for p, u, h in rows:
            host = host_of(u)
            for key in {key_of(host, n.hash, as_prose) for n in parse(h or "")[1] for as_prose in (False, True)}:
                yield p, key

    def read_with(rows: Iterator[tuple]) -> Iterator[str]:
        for u, h, own in rows:
            yield main_text(h, host_of(u), Templates(own or ()))

    page, keys = free([*pages.columns, out], "_page"), free([*pages.columns, out], "_keys")
    address = F.xxhash64(F.coalesce(F.col(url), F.lit("")), F.coalesce(F.col(html), F.lit("")))
    rows = map_rows(pages.select(address.alias("p"), F.col(url).alias("u"), F.col(html).alias("h")), pa.schema([("p", pa.int64()), ("key", pa.int64())]), "p long, key long", subtrees, ["p", "u", "h"]).distinct()
    own = rows.join(templates, "key", "left_semi").groupBy(F.col("p").alias(page)).agg(F.collect_set("key").alias(keys))
    joined = pages.withColumn(page, address).join(own, page, "left")
    return joined.withColumn(out, text_function(read_with, "string")(F.col(url), F.col(html), F.col(keys))).drop(page, keys)


def query(spark, sf_dir: str) -> DataFrame:
    """op4: main text of every page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return extract(pages.select("page_id", "url", "html")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
