"""Main text of web pages by wrappers inferred per host.

A page is a stream of tags and texts, balanced into nested terms. A wrapper is a union-free regular expression over
such terms: elements, optional terms, repeated groups, and texts that are either constant or a slot. A page's own
repetitions (list items, paragraphs, pairs of a term and its text) are folded into repeated groups first; then wrappers
are aligned two by two: terms with the same tag and class match and are merged inside, texts that differ become slots,
terms of only one side become optional. Each element of a wrapper counts the pages and the characters, linked or not,
that it was seen with. A wrapper also keeps the blocks that have the same text at the same path on all its pages; if
the host has ENOUGH different pages these, and texts that never differ, are constants and all other text is slot text.
From the host's wrapper the place of the article is chosen - a tag or class that says so, or else the element that
holds most of the unlinked slot text - and each page is read at that place, without the constant blocks. A constant
block of fewer than LABEL words that are not all linked stays: it may be a label within the articles. So does all text
of a page that would have none without its constants.

Scale: a task folds its pages into one wrapper per host and emits only those; wrappers of a host meet in two rounds
(salted, then whole), so a host with a third of all pages is as cheap as any. Pages are then joined to their host's
wrapper; adaptive execution splits a hot host, and the wrapper table is small beside the pages.

Defined results: null or empty html gives empty text; a null or hostless url belongs to the host ``''``; repeated pages
are read one by one and change no decision but the counts; elements nested deeper than 100 levels are read as siblings;
an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgersync.llm.common import stage, table

# Names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
DROPPED = frozenset(
    "head script style noscript template iframe object svg canvas audio video nav aside footer form button select textarea input "
    "label dialog menu noembed noframes title option".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
#: Words of class and id names, without digits.
NOT_ARTICLE = re.compile(
    r"(ads?|adverts?|advertising|advertisements?|adbox|adsense|banner|breadcrumbs?|comments?|commentlist|respond|reply|replies|disqus|cookies?|consent|gdpr|"
    r"sidebar|aside|menu|menus|navigation|navbar|nav|topbar|toolbar|share|sharing|social|related|recommended|recommendations|promo|promotion|promoted|"
    r"sponsor|sponsored|newsletter|subscribe|subscription|signup|login|notice|notices|notification|popup|modal|overlay|footer|masthead|widget|widgets|"
    r"pagination|pager|pagenav|disclaimer|alert|hidden|skip|copyright|footnav|sitenav|sidenav)"
)
ARTICLE = re.compile(r"(articlebody|article|story|storybody|entrycontent|postcontent|postbody|post|entry|maintext|articletext|bodytext)")
#: First and last words that say how an element looks or what it goes with, not what it is.
MODIFIERS = frozenset("has have no not with without is js overflow".split())
STATES = frozenset("open opened closed visible enabled disabled on off active inactive true false".split())
ALONE = frozenset("hidden skip".split())  # say something only as a whole name
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",), "thead": ("tr", "td", "th"), "tbody": ("tr", "td", "th", "thead", "tbody"), "tfoot": ("tr", "td", "th", "tbody"),
}
SCOPE = frozenset("table ul ol dl select div article section main body aside nav header footer form blockquote td th".split())

DEEPEST = 100
WIDEST = 64  # terms side by side in a wrapper before same tags are taken together
SALTS = 64
ENOUGH = 3  # different pages of a host before what they share is no article
LABEL = 5
_TAG = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTR = re.compile(r"([^\s=/\"'>]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)|([^\s=/\"'>]+)")


class Node:
    """An element of a page; children are nodes and texts in page order."""

    __slots__ = ("tag", "attrs", "children", "_key", "holds")

    def __init__(self, tag: str, attrs: str = "") -> None:
        self.tag, self.attrs, self.children = tag, attrs, []
        self._key = None
        self.holds = 0  # 2 with the article's place inside, 1 with most of the page's text, else 0

    def values(self) -> dict[str, str]:
        if not self.attrs.strip(" /"):
            return {}
        return {(m[1] or m[3]).lower(): html.unescape((m[2] or "").strip("\"'")) for m in _ATTR.finditer(self.attrs)}

    @property
    def key(self) -> str:
        """Tag, first class or id without digits, and role: what alignment compares."""
        if self._key is None:
            v = self.values()
            name = (v.get("class", "").split() or v.get("id", "").split() or [""])[0]
            role = v.get("role") or v.get("itemprop") or ""
            self._key = "|".join([self.tag, re.sub(r"\d+", "#", name), role]).rstrip("|")
        return self._key


def parse(text: str) -> Node:
    """The page as nested elements: missing end tags are supplied, stray ones ignored."""
    root = Node("html")
    stack, at, n = [root], 0, len(text)
    while at < n:
        m = _TAG.search(text, at)
        if not m:
            stack[-1].children.append(text[at:])
            break
        if m.start() > at:
            stack[-1].children.append(text[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
                if stack[k].tag in SCOPE and tag not in SCOPE and tag not in BLOCK:
                    break  # an inline end tag closes nothing outside its block
            continue
        if tag == "html":
            continue
        if tag in BLOCK and tag != "br":
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    del stack[k:]
                    break
                if stack[k].tag in SCOPE:
                    break
        if tag in CLOSES:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in CLOSES[tag]:
                    del stack[k:]
                    break
                if stack[k].tag in SCOPE and stack[k].tag not in CLOSES[tag]:
                    break
        node = Node(tag, m[3])
        stack[-1].children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(text, at)
            at = end.end() if end else n
        elif tag not in VOID and not m[3].rstrip().endswith("/") and len(stack) < DEEPEST:
            stack.append(node)
    _weigh(root)
    return root


def _weigh(root: Node) -> None:
    """Find the elements that hold the page's main or article element or most of its unlinked text."""
    sizes: list[tuple[Node, int, bool, int]] = []

    def visit(node: Node) -> tuple[int, bool, int]:
        size, main, article = 0, node.tag == "main" or "articlebody" in node.attrs.lower(), 0
        for child in node.children:
            if isinstance(child, str):
                size += len(child.strip())
            elif child.tag not in DROPPED:
                n, m, a = visit(child)
                size, main, article = size + (n if child.tag != "a" else 0), main or m, max(article, a)
        article = max(article, size) if node.tag == "article" else article
        sizes.append((node, size, main, article))
        return size, main, article

    total = visit(root)[0]
    for node, size, main, article in sizes:
        node.holds = 2 if main or 2 * article > total else int(2 * size > total)


def named_unwanted(name: str) -> int:
    """2 if a class or id name is one of NOT_ARTICLE, 1 if its first or last word is, else 0."""
    parts = re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower())
    if not parts:
        return 0
    if NOT_ARTICLE.fullmatch("".join(parts)):
        return 2
    if parts[0] in MODIFIERS or parts[-1] in STATES:
        return 0
    return int(any(NOT_ARTICLE.fullmatch(x) and x not in ALONE for x in (parts[0], parts[-1])))


def unwanted(node: Node, inside: bool) -> bool:
    """Whether an element is no part of an article; ``inside``: within the article's place.

    A name counts as a whole or by its first or last word. By a whole name an element with the page's article place is
    never unwanted, by a word of one also none with most of the page's text.
    """
    if node.tag in DROPPED or (node.tag == "header" and not inside):
        return True
    if not node.attrs:
        return False
    v = node.values()
    if "hidden" in v or v.get("aria-hidden") == "true" or v.get("role", "").lower() in ROLES or "display:none" in v.get("style", "").replace(" ", ""):
        return True
    names = f"{v.get('class', '')} {v.get('id', '')}".split()
    if node.tag not in ("body", "main") and max(map(named_unwanted, names), default=0) > node.holds:
        return True
    return not inside and not node.holds and any(re.fullmatch(r"(site|page|main|global|top)?header", re.sub(r"[^a-z]", "", x.lower())) for x in names)


def says_article(key: str) -> int:
    """2 for an article, 1 for a main element or an article-like name, else 0."""
    tag, name, role = (key + "||").split("|")[:3]
    if tag == "article" or role.lower() == "articlebody":
        return 2
    return int(tag == "main" or role == "main" or bool(ARTICLE.fullmatch(re.sub(r"[^a-z]", "", name.lower()))))


# Terms: ["t", constant or None, optional] or ["e", key, optional, repeated, pages, chars, linked, children]
# or ["g", optional, repeated, terms], a group of several terms.


def _name(term: list) -> str:
    return "#" if term[0] == "t" else term[1] if term[0] == "e" else "(" + ",".join(map(_name, term[3])) + ")"


def _optional(term: list) -> list:
    term[{"t": 2, "e": 2, "g": 1}[term[0]]] = True
    return term


def _merge_terms(a: list, b: list) -> list:
    if a[0] == "t":
        return ["t", a[1] if a[1] == b[1] else None, a[2] or b[2]]
    if a[0] == "e":
        return ["e", a[1], a[2] or b[2], a[3] or b[3], a[4] + b[4], a[5] + b[5], a[6] + b[6], merge(a[7], b[7])]
    return ["g", a[1] or b[1], a[2] or b[2], merge(a[3], b[3])]


def fold(terms: list[list]) -> list[list]:
    """Tandem repeats of one to three terms become repeated groups."""
    for width in (1, 2, 3):
        out, i = [], 0
        while i < len(terms):
            names = [_name(t) for t in terms[i : i + width]]
            j = i + width
            group = terms[i:j]
            if len(group) == width and (width == 1 or len(set(names)) > 1) and names != ["#"]:
                while j + width <= len(terms) and [_name(t) for t in terms[j : j + width]] == names:
                    group = [_merge_terms(x, y) for x, y in zip(group, terms[j : j + width], strict=True)]
                    j += width
            if j > i + width:
                out.append(_repeated(group[0]) if width == 1 else ["g", False, True, group])
                i = j
            else:
                out.append(terms[i])
                i += 1
        terms = out
    return terms


def _repeated(term: list) -> list:
    term[{"e": 3, "g": 2}[term[0]]] = True
    return term


def merge(a: list[list], b: list[list]) -> list[list]:
    """Align two term streams: equal terms are merged, the others become optional."""
    x, y = [_name(t) for t in a], [_name(t) for t in b]
    if x == y:
        out = [_merge_terms(s, t) for s, t in zip(a, b, strict=True)]
    else:
        best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
        for i in range(len(x) - 1, -1, -1):
            for j in range(len(y) - 1, -1, -1):
                best[i][j] = best[i + 1][j + 1] + 1 if x[i] == y[j] else max(best[i + 1][j], best[i][j + 1])
        out, i, j = [], 0, 0
        while i < len(x) or j < len(y):
            if i < len(x) and j < len(y) and x[i] == y[j]:
                out.append(_merge_terms(a[i], b[j]))
                i, j = i + 1, j + 1
            elif j == len(y) or (i < len(x) and best[i + 1][j] >= best[i][j + 1]):
                out.append(_optional(a[i]))
                i += 1
            else:
                out.append(_optional(b[j]))
                j += 1
        out = fold(out)
    if len(out) > WIDEST:  # too unlike: same names stand for one optional repeated term
        kept: dict[str, list] = {}
        for t in out:
            if t[0] != "t":
                n = _name(t)
                kept[n] = _repeated(_optional(_merge_terms(kept[n], t) if n in kept else t))
            else:
                kept["#"] = ["t", None, True]
        out = list(kept.values())
    return out


def _digest(*parts: str) -> str:
    return hashlib.blake2b("\x1f".join(parts).encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()


def page_terms(node: Node, inside: bool = False) -> tuple[list[list], int, int]:
    """A node's children as folded terms, with their characters and how many of them are linked."""
    terms, chars, linked = [], 0, 0
    for child in node.children:
        if isinstance(child, str):
            text = " ".join(child.split())
            if text:
                if not terms or terms[-1][0] != "t":
                    # a long text as its beginning, a digest of all of it and its length
                    terms.append(["t", text if len(text) <= 80 else text[:64] + _digest(text) + str(len(text)), False])
                else:
                    terms[-1][1] = None
                chars += len(text)
        elif child.tag not in DROPPED and not unwanted(child, inside):
            inner, c, n = page_terms(child, inside or says_article(child.key) > 0)
            if child.tag == "a":
                n = c
            terms.append(["e", child.key, False, False, 1, c, n, inner])
            chars, linked = chars + c, linked + n
    return fold(terms), chars, linked


def blocks(root: Node) -> dict[str, tuple[Node, list[str], int, str]]:
    """The blocks of a page that can be constant, by path and text: (element, path, unlinked characters, block around)."""
    found: dict[str, tuple[Node, list[str], int, str]] = {}

    def visit(node: Node, path: list[str], inside: bool, counted: bool) -> tuple[list[str], list[str], int, int, int]:
        parts, within, words, chars, linked = [], [], 0, 0, 0
        for child in node.children:
            if isinstance(child, str):
                if text := " ".join(child.split()):
                    parts.append(text)
                    words, chars = words + text.count(" ") + 1, chars + len(text)
            elif not unwanted(child, True):
                here = [*path, child.key]
                known = counted and not unwanted(child, inside)  # a site's header is no part of the wrapper
                inner, below, w, c, n = visit(child, here, inside or says_article(child.key) > 0, known)
                n = c if child.tag == "a" else n
                if c:
                    text = _digest(*inner)
                    parts.append(text)
                    if child.tag in BLOCK and (w >= LABEL or n == c):
                        name = _digest(text, *here)
                        for b in below:
                            found[b] = (*found[b][:3], name)
                        found[name] = (child, here, c - n if known else 0, "")
                        within.append(name)
                    else:
                        within += below
                words, chars, linked = words + w, chars + c, linked + n
        return parts, within, words, chars, linked

    visit(root, [], False, True)
    return found


# The wrapper of a host's pages: their number, the least ENOUGH digests of different ones, unlinked characters, shared
# blocks (path, unlinked characters, block around), terms.


def page_wrapper(page: str) -> dict:
    root = parse(page)
    terms, chars, linked = page_terms(root)
    same = {name: [path, plain, around] for name, (_, path, plain, around) in blocks(root).items()}
    return {"n": 1, "pages": [_digest(page)], "plain": chars - linked, "same": same, "terms": terms}


def merge_wrappers(a: dict, b: dict) -> dict:
    return {
        "n": a["n"] + b["n"],
        "pages": sorted({*a["pages"], *b["pages"]})[:ENOUGH],
        "plain": a["plain"] + b["plain"],
        "same": {name: v for name, v in a["same"].items() if name in b["same"]},
        "terms": merge(a["terms"], b["terms"]),
    }


def constants(wrapper: dict) -> list[str]:
    return sorted(wrapper["same"]) if len(wrapper["pages"]) >= ENOUGH else []


def article_path(wrapper: dict) -> list[str] | None:
    """The names from the root to the place of the article; None if the whole page is the place."""
    n, known = wrapper["n"], set(constants(wrapper))
    fixed: dict[tuple[str, ...], int] = {}  # characters of constant blocks in each element, a page
    for path, plain, around in (wrapper["same"][name] for name in sorted(known)):
        for k in range(len(path) + 1) if around not in known else ():
            fixed[tuple(path[:k])] = fixed.get(tuple(path[:k]), 0) + plain

    def slots(t: list, path: list[str]) -> int:
        return max(0, t[5] - t[6] - n * fixed.get(tuple(path), 0))

    named: list[tuple[int, int, int, list[str]]] = []

    def visit(items: list[list], path: list[str]) -> None:
        for t in items:
            if t[0] == "g":
                visit(t[3], path)
            elif t[0] == "e":
                here = [*path, t[1]]
                if level := says_article(t[1]):
                    named.append((level, slots(t, here), -len(here), here))
                visit(t[7], here)

    visit(wrapper["terms"], [])
    if named:
        return max(named)[3]
    path: list[str] = []
    terms, total = wrapper["terms"], max(0, wrapper["plain"] - n * fixed.get((), 0))
    while True:
        flat = [u for t in terms for u in (t[3] if t[0] == "g" else [t]) if u[0] == "e"]
        if len(wrapper["pages"]) >= ENOUGH:  # texts that all pages share
            same = [t[1] for t in terms if t[0] == "t" and t[1] is not None and not t[2]]
            total = max(0, total - n * sum(len(x) if len(x) <= 80 else int(x[80:]) for x in same))
        top = max(flat, key=lambda t: (slots(t, [*path, t[1]]), t[1]), default=None)
        most = slots(top, [*path, top[1]]) if top else 0
        # one paragraph or item is no place
        if not most or most <= 0.5 * total or top[3] or top[1].split("|")[0] not in ("body", "div", "section", "main", "table", "tbody", "tr", "td", "center"):
            return path or None
        path.append(top[1])
        terms, total = top[7], most


def places(root: Node, path: list[str]) -> list[Node]:
    found = [root]
    for name in path:
        found = [c for n in found for c in n.children if isinstance(c, Node) and c.key == name and not unwanted(c, True)]
    return found


def block_text(nodes: list[Node], without: frozenset[int] = frozenset(), inside: bool = True) -> str:
    """The texts of the nodes' blocks, in page order, without the elements of these Python ids.

    Site headers are left out if the nodes aren't ``inside`` an article's place, up to an article-like element.
    """
    blocks: list[list[str]] = [[]]

    def visit(node: Node, inside: bool) -> None:
        for child in node.children:
            if isinstance(child, str):
                blocks[-1].append(child)
                continue
            within = inside or says_article(child.key) > 0
            if child.tag in BLOCK:
                blocks.append([])
                if id(child) not in without and not unwanted(child, inside):
                    visit(child, within)
                blocks.append([])
            elif not unwanted(child, inside):
                visit(child, within)

    for n in nodes:
        blocks.append([])
        visit(n, inside)
    made = (" ".join(html.unescape("".join(b)).split()) for b in blocks)
    return " ".join(b for b in made if b)


def article_text(page: str | None, path: list[str] | None, same: list[str] | None = None) -> str:
    """The main text of a page whose host keeps articles at ``path`` and has the ``same`` blocks on all pages."""
    if not page:
        return ""
    root = parse(page)
    found = places(root, path) if path else []
    if not found:  # a page unlike its host's others is its own wrapper
        path = article_path(page_wrapper(page))
        found = places(root, path) if path else []
    found = found or [root]
    # a place that says so, or with text beside it, is narrower than the page
    inside = any(map(says_article, path or [])) or sum(map(_size, found)) < _size(root)
    if same:
        known = blocks(root)
        if text := block_text(found, frozenset(id(known[name][0]) for name in same if name in known), inside):
            return text
    return block_text(found, inside=inside) or block_text(found)


def _size(node: Node) -> int:
    """The characters of an element, of its unwanted parts too."""
    return sum(len(c.strip()) if isinstance(c, str) else _size(c) for c in node.children if isinstance(c, str) or c.tag not in RAW | {"head"})


def _fold_pages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    by_host: dict[str, dict] = {}
    salt = TaskContext.get().partitionId() % SALTS

    def rows() -> pd.DataFrame:
        return pd.DataFrame({"host": list(by_host), "salt": salt, "wrapper": [json.dumps(t) for t in by_host.values()]})

    for batch in batches:
        for host, page in zip(batch["host"], batch["html"], strict=True):
            if page:
                made = page_wrapper(page)
                by_host[host] = merge_wrappers(by_host[host], made) if host in by_host else made
        if len(by_host) > 2_000:
            yield rows()
            by_host.clear()
    if by_host:
        yield rows()


def _merge_wrappers(parts: pd.DataFrame) -> str:
    texts = sorted(parts["wrapper"])
    made = json.loads(texts[0])
    for t in texts[1:]:
        made = merge_wrappers(made, json.loads(t))
    return json.dumps(made)


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper, path, same): the wrapper of each host of ``pages`` (host, html), the article's place and the constant blocks in it."""

    def some(parts: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"host": [parts["host"].iloc[0]], "wrapper": [_merge_wrappers(parts)]})

    def whole(parts: pd.DataFrame) -> pd.DataFrame:
        wrapper = _merge_wrappers(parts)
        made = json.loads(wrapper)
        return pd.DataFrame({"host": [parts["host"].iloc[0]], "wrapper": [wrapper], "path": [article_path(made)], "same": [constants(made)]})

    local = pages.select("host", "html").mapInPandas(_fold_pages, "host string, salt int, wrapper string")
    met = local.groupBy("host", "salt").applyInPandas(some, "host string, wrapper string")
    return met.groupBy("host").applyInPandas(whole, "host string, wrapper string, path array<string>, same array<string>")


def _read_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            part = batch.slice(lo, 256)
            text = [article_text(page, path, same) for page, path, same in zip(*(part.column(c).to_pylist() for c in ("html", "path", "same")), strict=True)]
            made = [pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())]
            yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), *made], ["page_id", "url", "text", "n_chars"])


def extract_articles(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages`` (page_id, url, html)."""
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    read = pages.select("page_id", "url", "html", host.alias("host"))
    wrappers = stage(infer_wrappers(read), "wrappers")
    joined = read.join(wrappers.select("host", "path", "same"), "host", "left").select("page_id", "url", "html", "path", "same")
    typed = joined.withColumn("page_id", F.col("page_id").cast("long"))
    return typed.mapInArrow(_read_pages, "page_id long, url string, text string, n_chars long")


def op3_page_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_articles(table(spark, sf_dir, "pages"))


QUERIES = {"op3_page_articles": op3_page_articles}
SQL: dict[str, str] = {}
