"""Main text of web pages with site template removal.

1. Each page is parsed into elements (unclosed, implied and stray tags are allowed). Every block element has
   a hash of its subtree: tag, class, text and children. Headings and parts of lists and tables inside an
   article have none of their own.
2. Spark counts, per host, on how many different pages a subtree hash from outside the articles occurs, and in
   how many different article texts one from inside. Hashes on at least SHARE of a host's pages or in at least
   ARTICLE_SHARE of its article texts, and in MIN_PAGES of them, are that host's template; so a host has at most
   (elements of a page) / SHARE.
3. From each page the template's subtrees are deleted, and those that are by their name no text of the
   article: menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles, reader comments.
   Outside an article any word of a class or id counts; inside one only whole classes and ids that are sure do,
   and what bears a doubtful one goes if the template has it. html, body, article and main stay whatever their name.
   What is left - of the article or main element, if there is one with text - is given in blocks.

Inside a block white space becomes one space; blocks are joined by an empty line. Null or empty html gives an
empty text; a null url is a host of its own. Rows that share an id are pages of their own. Copies of an article
count once, so they make no template. An article that the template would leave without text, or take more than
half of in more than NOTICES places (a near copy of a host's other articles), keeps all of it.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsframe.llm.common import small_batches

SHARE = 0.05
ARTICLE_SHARE = 0.5
MIN_PAGES = 4
NOTICES = 4
SALTS = 64

# Element names and attribute words
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption xmp".split())
NO_TEXT = frozenset(
    "script style textarea title head nav aside footer form noscript template svg math iframe noembed noframes object button "
    "select option input label menu dialog canvas audio video map xmp annotation annotation-xml".split())
NO_TEXT_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner banners sponsor sponsored promo promotion menu navbar nav navigation breadcrumb "
    "breadcrumbs sidebar aside footer cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe "
    "subscription signup login share sharing social related recommended comment comments commentlist reply replies disqus discussion widget "
    "toolbar pagination pager skip masthead copyright legal disclaimer form search".split())
# inside an article: whole classes and ids that are sure, and elements and roles that are doubtful
SURE_CLASSES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsored navbar breadcrumb breadcrumbs pagination comments commentlist comment-list "
    "comments-area cookie-notice cookie-banner cookie-consent share-buttons sharing-buttons social-share related-posts related-articles "
    "newsletter-signup newsletter-form".split())
SURE_IDS = frozenset("comments disqus_thread".split())
DOUBTFUL = frozenset("math xmp".split())
DOUBTFUL_ROLES = frozenset("alert banner complementary form".split())
NO_TEXT_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar toolbar".split())
ENDS = {  # an open element that a new one closes, up to an element that holds it
    "li": (frozenset(("li",)), frozenset(("ul", "ol", "menu", "dir"))),
    "dt": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "dd": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "tr": (frozenset(("tr", "td", "th")), frozenset(("table",))),
    "td": (frozenset(("td", "th")), frozenset(("tr", "table"))),
    "th": (frozenset(("td", "th")), frozenset(("tr", "table"))),
    "option": (frozenset(("option",)), frozenset(("select",))),
}
# what recurs inside articles without being template
PARTS = frozenset("article main h1 h2 h3 h4 h5 h6 hgroup hr li dt dd caption tbody td tfoot th thead tr figcaption summary".split())
CLOSES_P = BLOCK - frozenset("html body td th tr tbody thead tfoot caption dd dt li figcaption summary".split())

MARK = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|</[^a-zA-Z>][^>]*>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
HIDDEN = re.compile(r"""(?<![\w-])(?:hidden(?![\w-])|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none)""", re.I)
WORD = re.compile(r"[a-z]+")
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


class Element:
    __slots__ = ("tag", "words", "classes", "name", "role", "hidden", "children", "parent")

    def __init__(self, tag: str, attributes: str, parent: Element | None):
        self.tag, self.parent, self.children = tag, parent, []
        self.words: frozenset = frozenset()
        self.classes: tuple | list = ()
        self.name, self.role, self.hidden = "", "", False
        if attributes:
            names = []
            for k, v in ATTRIBUTE.findall(attributes):
                v = v.strip("\"'").lower()
                if k.lower() == "role":
                    self.role = v
                    continue
                if k.lower() == "class":
                    self.classes = v.split()
                else:
                    self.name = v.strip()
                names += WORD.findall(v)
            self.words = frozenset(names)
            self.hidden = HIDDEN.search(attributes) is not None


def parse(source: str) -> Element:
    """The page as a tree; children are elements and strings (texts still with character references)."""
    root = at = Element("", "", None)
    pos, end = 0, len(source)
    while pos < end:
        m = MARK.search(source, pos)
        if m is None:
            at.children.append(source[pos:])
            break
        if m.start() > pos:
            at.children.append(source[pos : m.start()])
        pos = m.end()
        slash, tag, attributes = m.group(1, 2, 3) if m[2] else m.group(4, 5, 6)
        if not tag:
            continue
        tag = tag.lower()
        if slash:
            up = at
            while up is not None and up.tag != tag:
                # an inline end tag doesn't close blocks around it
                up = None if up.tag in BLOCK and tag not in BLOCK else up.parent
            if up is not None and up.parent is not None:
                at = up.parent
            elif tag == "br":
                at.children.append(" ")
            continue
        if tag in ENDS:
            closed, holders = ENDS[tag]
            up, last = at, None
            while up is not None and up.tag not in holders:
                if up.tag in closed:
                    last = up
                up = up.parent
            at = last.parent if last is not None else at
        if tag in CLOSES_P:
            up = at
            while up is not None and up.tag != "p" and (up.tag not in BLOCK):
                up = up.parent
            if up is not None and up.tag == "p":
                at = up.parent
        e = Element(tag, attributes, at)
        at.children.append(e)
        if tag in VOID:
            continue
        if tag in RAW:
            close = re.compile(f"</{re.escape(tag)}(?=[\\s/>])[^>]*>", re.I).search(source, pos)
            if tag == "xmp":  # shown as it stands
                e.children.append(entities.escape(source[pos : close.start() if close else end], False))
            pos = close.end() if close else end
            continue
        if not attributes.endswith("/") or tag in BLOCK:
            at = e
    return root


def no_text(e: Element, inside: bool) -> bool:
    """Whether an element is by name no part of an article; a header inside one may hold its title."""
    if e.tag in ("html", "body", "article", "main"):
        return False
    if e.hidden:
        return True
    if inside:
        return (e.tag in NO_TEXT and e.tag not in DOUBTFUL or e.role in NO_TEXT_ROLES and e.role not in DOUBTFUL_ROLES
                or e.name in SURE_IDS or not SURE_CLASSES.isdisjoint(e.classes))
    return e.tag in NO_TEXT or e.tag == "header" or e.role in NO_TEXT_ROLES or not e.words.isdisjoint(NO_TEXT_WORDS)


def doubtful(e: Element) -> bool:
    """Whether an element inside an article bears a name that, outside, would be no text's."""
    return e.tag in DOUBTFUL or e.role in DOUBTFUL_ROLES or not e.words.isdisjoint(NO_TEXT_WORDS)


def articles(root: Element) -> list[Element]:
    """Outermost article elements, else main elements, else none; those that stand inside an element of a doubtful
    name (<div class="has-sidebar">) count if there are no others."""
    for sure in (False, True):
        for name in ("article", "main"):
            found, todo = [], [root]
            while todo:
                e = todo.pop()
                if e.tag == name or name == "main" and e.role == "main" and not no_text(e, sure):
                    found.append(e)
                    continue
                if not no_text(e, sure):
                    todo.extend(c for c in reversed(e.children) if isinstance(c, Element))
            if any(blocks(e, frozenset(), {}) for e in found):
                return found
    return []


def subtree_hashes(root: Element, skip: list[Element]) -> dict[int, int]:
    """By id() of each block element outside skip, the hash of its subtree (even). Bottom up, without recursion."""
    out: dict[int, int] = {}
    order, todo, without = [], [root], {id(e) for e in skip}
    while todo:
        e = todo.pop()
        if id(e) not in without:
            order.append(e)
            todo.extend(c for c in e.children if isinstance(c, Element))
    known: dict[int, str] = {}
    holds = {id(root)}
    for e in skip:  # what holds an article is no candidate
        while e is not None:
            holds.add(id(e))
            e = e.parent
    for e in reversed(order):
        parts = [f"<{e.tag} {' '.join(sorted(e.words))}>"]
        for c in e.children:
            parts.append(known.get(id(c), "") if isinstance(c, Element) else " ".join(c.split()))
        h = xxhash.xxh3_64_hexdigest("\x00".join(parts).encode("utf-8", "surrogatepass"))
        known[id(e)] = h
        if e.tag in BLOCK and id(e) not in holds and e.tag not in ("html", "body", "head"):
            out[id(e)] = (int(h, 16) - (1 << 63)) & ~1
    return out


def article_hashes(tops: list[Element]) -> dict[int, int]:
    """By id() of each block or doubtful element with text inside the articles, the hash of its subtree (odd)."""
    out: dict[int, int] = {}
    known: dict[int, str] = {}
    order: list[Element] = []
    for top in tops:
        todo = [top]
        while todo:
            e = todo.pop()
            order.append(e)
            todo.extend(c for c in e.children if isinstance(c, Element) and not no_text(c, inside(top)))
    over = {id(e) for e in tops}
    for e in reversed(order):
        parts = [known.get(id(c), "") if isinstance(c, Element) else " ".join(c.split()) for c in e.children]
        if not any(parts):
            continue
        h = known[id(e)] = xxhash.xxh3_64_hexdigest("\x00".join([f"<{e.tag} {' '.join(sorted(e.words))}>", *parts]).encode("utf-8", "surrogatepass"))
        if id(e) not in over and (e.tag in BLOCK and e.tag not in PARTS or doubtful(e)):
            out[id(e)] = (int(h, 16) - (1 << 63)) | 1
    return out


def inside(top: Element) -> bool:
    return top.tag in ("article", "main") or top.role == "main"


def blocks(top: Element, template: frozenset, hashes: dict[int, int], cut: list | None = None) -> list[str]:
    """Texts of the blocks under an element, in page order, without template and named non-text; to cut, if
    given, the template's elements are added."""
    done: list[str] = []
    run: list[str] = []

    def flush() -> None:
        text = " ".join(entities.unescape("".join(run)).split())
        run.clear()
        if text:
            done.append(text)

    within = inside(top)
    todo: list = [top]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            run.append(x)
        elif x is None:
            flush()
        elif x is not top and (no_text(x, within) or hashes.get(id(x)) in template):
            if cut is not None and not no_text(x, within):
                cut.append(x)
            if x.tag in BLOCK:
                flush()
        elif x.tag == "br":
            run.append(" ")
        else:
            if x.tag in BLOCK:
                flush()
                todo.append(None)
            todo.extend(reversed(x.children))
    flush()
    return done


def main_text(source: str | None, template: frozenset) -> str:
    if not source:
        return ""
    root = parse(source)
    tops = articles(root)
    if not tops:
        return "\n\n".join(blocks(root, template, subtree_hashes(root, tops)))
    hashes = article_hashes(tops) if template else {}
    out = []
    for top in tops:
        cut: list[Element] = []
        text = blocks(top, template, hashes, cut)
        if cut and (not text or len(cut) > NOTICES):
            whole = blocks(top, frozenset(), hashes)
            if not text or 2 * sum(map(len, text)) < sum(map(len, whole)):
                text = whole
        out += text
    return "\n\n".join(out)


def page_templates(pages: DataFrame, share: float = SHARE, min_pages: int = MIN_PAGES, article_share: float = ARTICLE_SHARE) -> DataFrame:
    """pages: host, html. host, template: the hashes of subtrees that recur on many different pages of it, or in
    many different article texts."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            out: list[list] = [[], [], []]
            for host, source in zip(b.column("host").to_pylist(), b.column("html").to_pylist()):
                if not source:
                    continue
                root = parse(source)
                tops = articles(root)
                found = [(source, {0, *subtree_hashes(root, tops).values()})]  # 0 counts the pages, 1 the article texts
                if tops:
                    text = "\n\n".join(b for top in tops for b in blocks(top, frozenset(), {}))
                    found.append((text, {1, *article_hashes(tops).values()}))
                for text, hashes in found:
                    page = xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)
                    for h in hashes:
                        for column, v in zip(out, (host, page, h)):
                            column.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64())], ["host", "page", "hash"])

    # equal pages, and equal article texts, count once: first per (host, subtree, page), then per (host, subtree)
    seen = pages.mapInArrow(hashed, "host string, page long, hash long").groupBy("host", "hash", "page").agg(F.lit(1).alias("one"))
    counts = seen.groupBy("host", "hash").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_pages)
    counts = counts.withColumn("part", F.pmod("hash", F.lit(2)))
    total = counts.where("hash in (0, 1)").select("host", "part", F.col("n").alias("total"))
    least = F.when(F.col("part") == 0, F.lit(share)).otherwise(F.lit(article_share))
    return (counts.where("hash not in (0, 1)").join(total, ["host", "part"]).where(F.col("n") >= least * F.col("total"))
            .groupBy("host").agg(F.collect_list("hash").alias("template")))


def extract(pages: DataFrame, share: float = SHARE, min_pages: int = MIN_PAGES) -> DataFrame:
    """page_id, url, text of every page."""
    named = pages.select("page_id", "url", "html", F.lower(F.coalesce(F.regexp_extract("url", HOST, 1), F.lit(""))).alias("host"))
    template = page_templates(named.select("host", "html"), share, min_pages)

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple = (None, frozenset())
        for b in small_batches(batches):
            texts = []
            for host, source, hashes in zip(b.column("host").to_pylist(), b.column("html").to_pylist(), b.column("template").to_pylist()):
                if held[0] != host:
                    held = (host, frozenset(hashes or ()))
                texts.append(main_text(source, held[1]))
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    kind = dict(pages.dtypes)["page_id"]
    # a host's pages are dealt over SALTS joins, each with its own copy of the host's bounded template
    salted = named.withColumn("salt", F.pmod(F.xxhash64("page_id", "url", "html"), F.lit(SALTS)).cast("int"))
    copies = template.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies, ["host", "salt"], "left").select("page_id", "url", "html", "host", "template").mapInArrow(extracted, f"page_id {kind}, url string, text string")


def extract_digest(pages: DataFrame) -> DataFrame:
    return extract(pages).withColumn("n_chars", F.length("text").cast("long"))
