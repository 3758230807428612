"""Main text of web pages by site template removal.

Every page is parsed into its element tree and every subtree, also inside ``article`` and ``main``,
gets a hash of its tags, attributes and text. Spark counts per host on how many different pages a
subtree occurs; those on at least ``MIN_PAGES`` pages and a share ``SHARE`` of the host's
different pages, or on at least ``MANY_PAGES``, are the site's template and are deleted from its
pages. Pages are different if their content keys are: equal pages count once, and near-equal ones
mostly, so that a group of copies is not taken for the template of its host. Inside an article, headings, list items, table
cells and inline elements recur with the larger blocks they are part of, not by themselves, and
where the recurring blocks make more than half of its text, it is a copied article and keeps them. So are the elements whose tag, role, class or id
says that they are no article text (menus, forms, adverts, comments and so on), which is all
that is known of hosts with few pages. Inside an article the words of class and id count only for
boxes of mostly links or with form controls, or as whole classes that have no other sense
(``SURE``); headings and paragraphs stay. Articles and what holds them are judged by role and whole
words (comments and related articles are no article), unless nothing of the page would be left. What is left of ``article`` (else ``main``, else the page)
gives the text: one block per block element, character references decoded, white space inside a
block one space, blocks joined by an empty line.

The counts are partially aggregated per (host, hash, key), then per (host, hash), so a hot host is
no hot task; a host has at most (subtrees per page / SHARE) template hashes by its share. They are broadcast while they number at most
``MAX_BROADCAST`` in all, else joined by host, which Spark can split on a hot host.

Defined results: NULL and empty html and pages of template only give the empty text; pages without
a host have no site template; tags that are not closed end where HTML ends them; repeated rows
are separate rows (and count once as pages); an empty table gives no rows; other columns are kept.
"""

from __future__ import annotations

import html as html_lib
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import cut, use_package

MIN_PAGES = 3
SHARE = 0.2
#: So many different pages make a block template whatever their share, if they are at least DIVERSE of the rows that hold it.
MANY_PAGES = 100
DIVERSE = 0.25
#: Pages of fewer words are different if any word differs, longer ones if the sketch of their word pairs does.
SKETCH_WORDS = 40
#: Template hashes (8 bytes each) that are broadcast at most.
MAX_BROADCAST = 500_000

#: Element names of HTML by role. Fixed values.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img br".split())
NO_TEXT = frozenset("head script style noscript template iframe object embed svg canvas audio video map nav aside footer form fieldset button select option datalist input textarea dialog menu title xmp noembed noframes".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split())
#: Opening the first closes an open one of the second, up to a container of the third kind.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
#: Words of a class or id, and roles, that mark elements which are no article text.
MARKED = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer header"
    " login menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted related replies search share sharing"
    " sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
#: Of these, words that as a whole class name a box inside an article, and elements that are boxes.
SURE = frozenset(
    "ad ads advert adverts advertisement advertising breadcrumb breadcrumbs comment comments consent cookies disqus newsletter pager pagination"
    " promo promoted replies sidebar signup sponsored subscribe".split()
)
BOXES = frozenset("article div dl ol section table ul".split())
#: Text elements, which no word of a class or id drops inside an article.
PLAIN = frozenset("h1 h2 h3 h4 h5 h6 hgroup p pre blockquote main".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())

#: Inside an article these are parts of a list, table or section, and no template by themselves.
PARTS = frozenset("h1 h2 h3 h4 h5 h6 hgroup li dt dd tr td th thead tbody tfoot caption figcaption summary legend".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|</?[a-zA-Z][^\s/>]*+(?>\"[^\"]*+\"|'[^']*+'|[^'\">])*+>", re.S)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_ATTR = re.compile(r"([^\s=/\"'<>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
#: Articles beside the article.
_SECOND = re.compile(r"(?:^|\s)(?:comment|reply|related|promo|promoted|sponsored|ad|advert)[-_]")
_PARTS = re.compile(r"[^\W_]+")
_HIDDEN = re.compile(r"\shidden(?=[\s=/>])|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)


_CONTROLS = frozenset("form input select textarea button".split())
_SIGN = re.compile(r"\s(?:class|role)\s*=", re.I)


class Node:
    """An element; ``letters`` are those of its text, ``linked`` those in links, ``control`` says whether it holds form controls."""

    __slots__ = ("tag", "raw", "items", "hash", "holds_main", "letters", "linked", "control")

    def __init__(self, tag: str, raw: str = ""):
        self.tag, self.raw, self.items, self.hash, self.holds_main = tag, raw, [], 0, tag in ("article", "main")
        self.letters = self.linked = 0
        self.control = False

    def finish(self) -> None:
        """Hash and counts of the whole subtree, from those of the children."""
        h = xxhash.xxh64(self.raw.encode("utf-8", "replace"))
        for x in self.items:
            if isinstance(x, str):
                words = " ".join(x.split())
                self.letters += len(words) - words.count(" ")
                h.update(b"\0" + words.encode("utf-8", "replace"))
            else:
                self.letters += x.letters
                self.linked += x.linked
                self.control |= x.control or x.tag in _CONTROLS
                h.update(x.hash.to_bytes(8, "little"))
        if self.tag == "a":
            self.linked = self.letters
        self.hash = h.intdigest()


def parse(html: str) -> Node:
    """The element tree; ``items`` are texts and nodes in page order. Every node carries the hash of its subtree."""
    root = Node("#page")
    stack, opened = [root], Counter()

    def close(depth: int) -> None:
        while len(stack) > depth:
            node = stack.pop()
            opened[node.tag] -= 1
            node.finish()
            stack[-1].items.append(node)
            stack[-1].holds_main |= node.holds_main

    def depth_of(tags, until=()) -> int:
        if not any(opened[t] for t in tags):
            return 0
        for d in range(len(stack) - 1, 0, -1):
            if stack[d].tag in tags:
                return d
            if stack[d].tag in until:
                break
        return 0

    # behind the last ">" there is no tag, so no "<" is tried there again and again
    at, last = 0, html.rfind(">") + 1
    while (m := _TOKEN.search(html, at, last)) is not None:
        if m.start() > at:
            stack[-1].items.append(html[at : m.start()])
        at, raw = m.end(), m.group()
        if raw[1] in "!?":
            if raw.startswith("<!--") and not raw.endswith("-->"):
                at = len(html)  # a comment that never ends
                break
            continue
        name = _NAME.match(raw).group(1).lower()
        if raw[1] == "/":
            if name in INLINE:
                # an inline end tag never closes a block
                d = opened[name] and next((d for d in range(len(stack) - 1, 0, -1) if stack[d].tag == name or stack[d].tag not in INLINE), 0)
                if d and stack[d].tag == name:
                    close(d)
            elif name not in ("body", "html") and (d := depth_of((name,), () if name in ("table", "article", "main") else ("table",))):
                close(d)
            continue
        if name in CLOSES_P and (d := depth_of(("p",), ("table", "td", "th", "button", "object"))):
            close(d)
        if name in SIBLINGS:
            again, until = SIBLINGS[name]
            while d := depth_of(again, until):
                close(d)
        node = Node(name, raw)
        if name in VOID or raw.endswith("/>") and name not in RAW and name not in CLOSES_P:
            node.finish()
            stack[-1].items.append(node)
        elif name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(html, at)
            node.items.append(html[at : end.start()] if end else html[at:])
            at = end.end() if end else len(html)
            node.finish()
            stack[-1].items.append(node)
        else:
            stack.append(node)
            opened[name] += 1
    rest = html[at:]
    if (comment := rest.find("<!--")) >= 0:
        rest = rest[:comment]
    if rest:
        stack[-1].items.append(rest)
    close(1)
    return root


def content_key(text: str) -> int:
    """Equal for equal texts, and mostly for near-equal ones: the least hash of the word pairs (of short texts the hash)."""
    words = text.split()
    if len(words) < SKETCH_WORDS:
        return xxhash.xxh64_intdigest(" ".join(words).encode("utf-8", "replace"))
    h = np.fromiter((zlib.crc32(w.encode("utf-8", "replace")) for w in words), np.uint64, len(words))
    pairs = (h[:-1] << np.uint64(32) | h[1:]) * np.uint64(0x9E3779B97F4A7C15)
    pairs ^= pairs >> np.uint64(32)
    return int((pairs * np.uint64(0xD6E8FEB86659FD93)).min())


def page_hashes(html: str) -> tuple[int, set[int]]:
    """The content key of a page's text and the hashes of its subtrees that may be template."""
    root = parse(html)
    return content_key(_text(root, frozenset())), subtree_hashes(root)


def may_recur(node: Node, inside: bool) -> bool:
    """Whether an element can be template: none that holds ``article`` or ``main``; inside these a box
    with a sign of its own (class, role, links or form controls), never a bare block of text."""
    if node.holds_main or node.tag in ("#page", "html", "body", "br", "hr", "wbr", "meta", "link"):
        return False
    if not inside:
        return True
    if node.tag in INLINE or node.tag in PARTS or node.tag in PLAIN:
        return False
    return node.control or node.linked > 0 or _SIGN.search(node.raw) is not None


def subtree_hashes(root: Node) -> set[int]:
    """Hashes of the subtrees that may be template."""
    out, todo = set(), [(root, False)]
    while todo:
        node, inside = todo.pop()
        inside = inside or node.tag in ("article", "main")
        if may_recur(node, inside):
            out.add(node.hash)
        todo += [(x, inside) for x in node.items if not isinstance(x, str)]
    return out


def is_marked(node: Node, inside: bool, strict: bool = True) -> bool:
    """Whether tag, role, class or id say that an element is no article text.

    ``strict`` judges also articles, ``main`` and what holds them, outside of an article."""
    if node.tag in NO_TEXT or node.tag == "header" and not inside:
        return True
    if node.tag in ("html", "body") or " " not in node.raw:
        return False
    if node.holds_main and not inside:
        return strict and _is_marked_holder(node)
    if _HIDDEN.search(node.raw):
        return True
    for key, *values in _ATTR.findall(node.raw):
        key, value = key.lower(), "".join(values).lower()
        if key == "role" and value in ROLES:
            return True
        if key not in ("class", "id") or not (marks := MARKED.intersection(_PARTS.findall(value))):
            continue
        if not inside:
            return True
        # inside an article such words also name its sections and anchors
        if marks == {"header"} or node.tag in PLAIN or key == "id" and node.tag in ("section", "a", "span"):
            continue
        if key == "class" and node.tag in BOXES and SURE.intersection(value.split()) or _is_heavy(node):
            return True
    return False


def _is_marked_holder(node: Node) -> bool:
    """The same of an article, ``main`` or a holder of these: only by whole words of its class, or id and role."""
    for key, *values in _ATTR.findall(node.raw):
        key, value = key.lower(), "".join(values).lower()
        if key == "role" and value in ROLES or key in ("class", "id") and (MARKED - {"header"}).intersection(value.split()):
            return True
        if key in ("class", "id") and node.tag == "article" and _SECOND.search(value):
            return True
    return False


def _is_heavy(node: Node) -> bool:
    """Whether an element holds form controls, or at least half of its letters in links."""
    return node.control or node.letters > 0 and 2 * node.linked >= node.letters


def _scopes(root: Node, template, strict: bool = True) -> list[Node]:
    """The outermost articles that are not dropped; else the ``main`` elements; else the page."""
    for wanted in ("article", "main"):
        found, todo = [], [root]
        while todo:
            node = todo.pop()
            if node is not root and (node.hash in template and not node.holds_main or is_marked(node, False, strict)):
                continue
            if node.tag == wanted:
                found.append(node)
            else:
                todo += [x for x in reversed(node.items) if not isinstance(x, str)]
        if found:
            return found
    return [root]


def main_text(html: str | None, template=frozenset()) -> str:
    """The text of a page without the subtrees whose hashes are in ``template``."""
    return _text(parse(html or ""), template)


def _text(root: Node, template) -> str:
    # where the words of classes drop all of a page, its articles are taken whatever holds them
    return _scopes_text(root, template, True) or (_scopes_text(root, template, False) if root.holds_main else "")


def _scopes_text(root: Node, template, strict: bool) -> str:
    out = []
    for scope in _scopes(root, template, strict):
        inside = scope is not root
        blocks, recurring = _blocks(scope, inside, template)
        # what recurs inside an article and is its greater part is a copied article, no template
        if inside and recurring > sum(map(len, blocks)):
            blocks, _ = _blocks(scope, inside, frozenset())
        out += blocks
    return "\n\n".join(out)


def _blocks(scope: Node, inside: bool, template) -> tuple[list[str], int]:
    """The blocks of text of a scope, and the number of letters of what ``template`` deleted."""
    blocks, words, recurring = [], [], 0

    def flush() -> None:
        if text := " ".join("".join(words).split()):
            blocks.append(text)
        words.clear()

    todo: list = [scope]
    while todo:
        x = todo.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            words.append(html_lib.unescape(x) if "&" in x else x)
        elif x is not scope and ((marked := is_marked(x, inside)) or x.hash in template and may_recur(x, inside)):
            if not marked and inside:
                recurring += sum(map(len, _blocks(x, inside, frozenset())[0]))
            if x.tag not in INLINE:
                flush()
        elif x.tag == "br":
            words.append(" ")
        elif x.tag in INLINE:
            todo += reversed(x.items)
        else:
            flush()
            todo += [None, *reversed(x.items)]
    flush()
    return blocks, recurring


def host_of(url: Column) -> Column:
    found = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(found != "", found)


def site_templates(
    pages: DataFrame, url_col: str = "url", html_col: str = "html", min_pages: int = MIN_PAGES, share: float = SHARE, many_pages: int = MANY_PAGES
) -> DataFrame:
    """``(t_host, template)``: per host the sorted hashes of its template's subtrees."""

    @F.pandas_udf("struct<key: long, hashes: array<long>>")
    def hashes(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for html in batches:
            keys, found = zip(*(page_hashes(h or "") for h in html)) if len(html) else ((), ())
            yield pd.DataFrame({"key": np.array(keys, np.uint64).astype(np.int64), "hashes": [np.array(sorted(f), np.uint64).astype(np.int64) for f in found]})

    rows = pages.select(host_of(F.col(url_col)).alias("t_host"), F.col(html_col).alias("html")).filter("t_host is not null")
    # NULL stands for the page itself
    each = rows.select("t_host", hashes("html").alias("h")).select("t_host", "h.key", F.explode(F.array_append("h.hashes", F.lit(None).cast("long"))).alias("hash"))
    counts = each.groupBy("t_host", "hash", "key").agg(F.count("*").alias("rows")).groupBy("t_host", "hash").agg(F.count("*").alias("n"), F.sum("rows").alias("rows"))
    counts = cut(counts.filter((F.col("n") >= min_pages) | F.col("hash").isNull()), "site-counts")
    sizes = counts.filter("hash is null").select("t_host", F.col("n").alias("pages"))
    many = (F.col("n") >= many_pages) & (F.col("n") >= DIVERSE * F.col("rows"))
    often = counts.filter(F.col("hash").isNotNull() & (F.col("n") >= min_pages)).join(sizes, "t_host").filter((F.col("n") >= share * F.col("pages")) | many)
    return often.groupBy("t_host").agg(F.array_sort(F.collect_list("hash")).alias("template"))


def extract_main_text(pages: DataFrame, url_col: str = "url", html_col: str = "html", max_broadcast: int = MAX_BROADCAST, **template_options) -> DataFrame:
    """``(page, text)``: the columns of ``pages`` without the html as the struct ``page``, and the main text."""
    use_package(pages.sparkSession)
    templates = cut(site_templates(pages, url_col, html_col, **template_options), "site-templates")
    n = templates.agg(F.coalesce(F.sum(F.size("template")), F.lit(0))).first()[0]

    @F.pandas_udf("string")
    def text_of(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for html, template in batches:
            yield pd.Series([main_text(h, frozenset() if t is None else frozenset(np.asarray(t, np.int64).astype(np.uint64).tolist())) for h, t in zip(html, template)])

    rest = [F.col(f"`{c}`") for c in pages.columns if c.lower() != html_col.lower()]
    rows = pages.select(F.struct(*rest).alias("page"), host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))
    both = rows.join(F.broadcast(templates) if n <= max_broadcast else templates, F.col("host") == F.col("t_host"), "left")
    return both.select("page", text_of("html", "template").alias("text"))
