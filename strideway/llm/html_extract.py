"""Main text of web pages: equivalence classes of tokens make a host's template, and what its slots hold is extracted.

A page's tokens are its containers, each known by its path (tags with the words of class and id, from the body down), and its
texts, each known by its container and its characters. A token's occurrence vector is how often it stands on each of the host's
different pages; tokens with equal vectors are a class. A class is valid if it stands on two pages at least and hangs on
one token of the class around it, so that valid classes nest: they are the host's template. Vectors are hashed and added up by
aggregations that are combined before they are shuffled, however large a host is, and before anything is left out.

The template tells its slots apart. A container whose texts are all in its own class is the same wherever it stands, which is
boilerplate. One whose text is links for the larger part is a menu. One that holds a repeated class of varying number, beside a larger
slot of the same container that doesn't, is a list of comments or teasers. What stands inside the slot where most of the text varies is
no such thing. What HTML's own tags and roles name as navigation, footer,
aside, form and so on is outside anyway. Names of class and id break ties: they leave out a container only if it is a
slot of the template. ``main`` and ``article`` are believed: where a page has one, its slots are the main text, and only
named slots are left out of it. All blocks of the slots that are left are the text.
"""

from __future__ import annotations

import hashlib
import html as html_module
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strideway.llm import text_kernel as K
from strideway.plans.lineage import cut

#: Tokens of templates that may be broadcast; more are joined by shuffling.
BROADCAST_TOKENS = 500_000
#: A container is a slot of the template if its class stands on so many pages, and on one of so many of the host's.
SLOT_PAGES, SLOT_ONE_IN = 2, 10
#: Boilerplate holds the same texts on so many pages, and on one of two of the host's.
SAME_PAGES, SAME_ONE_IN = 3, 2
#: A list's repeated containers hold this share of its text.
LIST_SHARE = 0.8
#: What the template says of a token.
IS_SLOT, IS_OUTSIDE, IS_CONTENT, IS_MAIN = 1, 2, 4, 8

# Kinds of elements.
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_RAW = set("script style noscript template iframe svg math object canvas textarea select title".split())
_BLOCK = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
_CONTAINER = set("body main article section div td nav aside header footer form ul ol menu dialog".split())
_CONTENT = {"main", "article"}
#: What never holds main text, and what doesn't outside of the article.
_OUTSIDE_TAGS = set("nav footer aside form dialog".split())
_OUTSIDE_ARTICLE = set("header button menu label".split())
_OUTSIDE_ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form".split())
_OUTSIDE_NAMES = set(
    "ad ads adv advert adverts advertisement advertisements adsense adbox adslot sponsor sponsored promo promotion nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar sidebars aside rail widget widgets "
    "footer foot masthead topbar toolbar cookie cookies consent gdpr notice notices notification notifications alert popup modal overlay newsletter subscribe subscription signup login signin share sharing social "
    "related recommended recommendations comment comments commentlist disqus reply replies respond discussion pagination pager skip search searchform form hidden copyright disclaimer "
    "discussion thread feedback talkback responses crumbs announcement announcements popover tooltip paywall donate poll topnav subnav sitemap advertising commercial".split()
)
_HEADER_NAMES = {"header", "banner", "head"}
#: Names that say what a container lies beside, such as ``content-with-sidebar``; then its names don't tell what it is.
_BESIDE_NAMES = {"with", "has", "no", "without"}
#: Names that say that a container is the article's own, whatever else they say.
_OWN_NAMES = {"story", "article", "main", "body", "content", "post", "text"}
#: Elements that a new element of the same kind ends, up to the elements that hold them.
_CLOSED_BY_ITSELF = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}

_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
_CUT_TAG = re.compile(r"</?[a-zA-Z][^<>]*\Z")
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME = re.compile(r"[^A-Za-z]+|(?<=[a-z])(?=[A-Z])")
_SPACE = re.compile(r"\s+")


class Node:
    """A container on a page; its token says where it stands."""

    __slots__ = ("token", "parent", "tag", "outside", "named", "content", "top", "holds", "size", "linked", "own", "own_size", "away", "dropped")

    def __init__(self, name: str, tag: str, parent: Node | None, outside: bool, named: bool):
        self.token = _hash(f"{parent.token if parent else 0}>{name}")
        self.parent, self.tag, self.outside, self.named = parent, tag, outside, named
        is_content = tag in _CONTENT
        self.top = is_content and not (parent and parent.content)  # main or article, in no other
        self.content = is_content or bool(parent and parent.content)
        self.holds = False  # main or article
        self.size = self.linked = self.own = self.own_size = 0
        self.away = outside or named or bool(parent and parent.away)
        self.dropped = False


class Block(NamedTuple):
    text: str
    node: Node
    linked: int  # characters inside links


class _Open(NamedTuple):
    tag: str
    node: Node | None


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _words_of(attributes: dict[str, str]) -> set[str]:
    return {x for key in ("class", "id") for x in map(str.lower, _NAME.split(attributes.get(key, ""))) if x}


def _outside(tag: str, attributes: dict[str, str], in_content: bool) -> bool:
    """Do tag, role or style say that the element holds no main text?"""
    if tag in _OUTSIDE_TAGS or not in_content and tag in _OUTSIDE_ARTICLE or attributes.get("role", "").lower() in _OUTSIDE_ROLES:
        return True
    if "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return True
    return bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attributes.get("style", ""), re.I))


def _named(tag: str, names: set[str], in_content: bool) -> bool:
    if tag in ("body", "html", "main", "article") or names & (_BESIDE_NAMES | _OWN_NAMES):
        return False
    return bool(names & _OUTSIDE_NAMES) or not in_content and bool(names & _HEADER_NAMES)


class Page:
    """A page's containers, in the order in which they open, and its blocks of text."""

    def __init__(self, page: str):
        self.root = Node("", "html", None, False, False)
        self.nodes, self.blocks = [self.root], []
        self._opened: list[_Open] = []
        self._at_block: list[int] = []  # places of block elements among the opened ones
        self._count: dict[str, int] = {}
        self._node, self._held, self._linked = self.root, [], 0
        self._read(page)
        self._close()
        for node in reversed(self.nodes):
            if node.parent:
                node.parent.size += node.size
                node.parent.linked += node.linked
                node.parent.holds |= node.holds or node.top

    def _close(self) -> None:
        if self._held:
            text = _SPACE.sub(" ", "".join(self._held)).strip()
            if text:
                linked = min(self._linked, len(text))
                self.blocks.append(Block(text, self._node, linked))
                self._node.size += len(text)
                self._node.linked += linked
                self._node.own += 1
                self._node.own_size += len(text)
            self._held.clear()
        self._linked = 0

    def _pop(self) -> None:
        one = self._opened.pop()
        self._count[one.tag] -= 1
        if self._at_block and self._at_block[-1] == len(self._opened):
            self._at_block.pop()
        if one.node:
            self._close()  # text of a container is its own
            self._node = one.node.parent

    def _read(self, page: str) -> None:
        """Each step goes on from where the last one ended; what isn't found once is not looked for again."""
        at, lacking = 0, set()
        while at < len(page):
            less = page.find("<", at)
            if less < 0:
                less = len(page)
            self._text(page[at:less])
            if less == len(page):
                return
            if page.startswith("<!--", less):
                end = page.find("-->", less + 4)
                if end < 0:
                    return
                at = end + 3
                continue
            if page.startswith(("<!", "<?"), less) and ">" not in lacking:
                end = page.find(">", less)
                if end >= 0:
                    at = end + 1
                    continue
                lacking.add(">")
            m = _TAG.match(page, less) if ">" not in lacking else None
            if not m:
                after = page.find("<", less + 1)
                if after < 0 and _CUT_TAG.match(page, less):
                    return  # a tag that the page's end cuts
                self._text("<")
                at = less + 1
                continue
            at, tag = m.end(), m.group(2).lower()
            if m.group(1):
                self._end(tag)
            elif tag in _RAW and not m.group(3).endswith("/") and tag not in lacking:
                end = re.compile(f"</{tag}\\b[^>]*+>?", re.I).search(page, at)
                if end:
                    at = end.end()
                elif tag in ("script", "style"):
                    return
                else:
                    lacking.add(tag)
            elif tag not in _RAW:
                self._start(tag, m.group(3))

    def _text(self, text: str) -> None:
        if text:
            # A character reference can't open a tag, so it is decoded in text alone.
            text = html_module.unescape(text) if "&" in text else text
            self._held.append(text)
            if self._count.get("a"):
                self._linked += len(text)

    def _end(self, tag: str) -> None:
        if tag in _BLOCK:
            self._close()
        if self._count.get(tag):
            while self._opened[-1].tag != tag:
                self._pop()
            self._pop()

    def _start(self, tag: str, given: str) -> None:
        if tag == "br":
            self._held.append(" ")
            return
        if tag in _BLOCK:
            self._close()
            # A paragraph ends with the block that follows, and so do inline elements that were left open in it.
            if self._at_block and self._opened[self._at_block[-1]].tag == "p":
                keep = self._at_block[-1]
                while len(self._opened) > keep:
                    self._pop()
        stop = _CLOSED_BY_ITSELF.get(tag)
        if stop and self._count.get(tag):
            for k in range(len(self._opened) - 1, -1, -1):
                if self._opened[k].tag in stop:
                    break
                if self._opened[k].tag == tag:
                    while len(self._opened) > k:
                        self._pop()
                    break
        if tag in _VOID or given.endswith("/"):
            return
        attributes = {k.lower(): html_module.unescape(a or b or c or "") for k, a, b, c in _ATTRIBUTE.findall(given)} if given.strip() else {}
        words, inside = _words_of(attributes), self._node.content
        outside, named = _outside(tag, attributes, inside), _named(tag, words, inside)
        node = None
        if tag in _CONTAINER or outside or named:
            self._close()
            node = self._node = Node(".".join([tag, *sorted(words)]), tag, self._node, outside, named)
            self.nodes.append(node)
        if tag in _BLOCK:
            self._at_block.append(len(self._opened))
        self._count[tag] = self._count.get(tag, 0) + 1
        self._opened.append(_Open(tag, node))


def tokens_of(page: str) -> list[tuple]:
    """The page's tokens, as ``_TOKEN`` has them from ``token`` on."""
    read = Page(page)
    if not read.blocks:
        return []
    found: dict[int, list] = {}
    for x in read.nodes:
        one = found.setdefault(x.token, [x.token, x.parent.token if x.parent else 0, False, 0, 0, 0, 0, 0, False, False, False])
        for k, more in enumerate((1, x.size, x.linked, x.own, x.own_size), 3):
            one[k] += more
        one[8] |= x.named
        one[9] |= x.away
        one[10] |= x.content or x.holds
    for b in read.blocks:
        token = _hash(f"{b.node.token}:{b.text}")
        one = found.setdefault(token, [token, b.node.token, True, 0, 0, 0, 0, 0, False, b.node.away, b.node.content])
        one[3] += 1
        one[4] += len(b.text)
    return [tuple(x) for x in found.values()]


def extract(page: str, template: dict[int, tuple[int, int]], several: bool = False) -> str:
    """The page's main text; ``template``: what its host's template says of tokens (flags, characters); ``several``: the host has other pages."""
    read = Page(page)
    for evidence in (IS_OUTSIDE, 0):  # copies of one page repeat all of it
        own: set[int] = set()  # nodes in the slot where most of the text varies
        for x in read.nodes:
            flags = template.get(x.token, (0, 0))[0]
            above = x.parent
            if flags & IS_MAIN or above and id(above) in own:
                own.add(id(x))
            in_article = bool(above and above.content)
            by_name = x.named and (bool(flags & IS_SLOT) or not several and not in_article)
            by_class = bool(flags & evidence) and not x.holds and not x.content and id(x) not in own
            x.dropped = bool(above and above.dropped) or x.outside or by_name or by_class
        left = [b for b in read.blocks if not b.node.dropped]
        if left:
            break
    tops = {x.token: x for x in read.nodes if x.top and not x.dropped and x.size}
    if tops and any(b.node.content for b in left):
        size = {t: template.get(t, (0, 0))[1] or x.size for t, x in tops.items()}
        best = min(tops, key=lambda t: (tops[t].tag != "main", -size[t], t))
        left = [b for b in left if b.node.content and _top(b.node).token == best]
    return "\n\n".join(b.text for b in left)


def _top(node: Node) -> Node:
    """The main or article that holds a node, and is in no other."""
    while not node.top:
        node = node.parent
    return node


#: Per page: a token and its container's; how often it stands there; characters, those in links, texts and characters that no container inside holds;
#: whether it has a telling name, lies in something that has or is outside, lies in or around an article.
_TOKEN = "host string, page long, token long, parent long, is_text boolean, n long, size long, linked long, own long, own_size long, named boolean, away boolean, article boolean"


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names, kinds = zip(*((x.split(" ")[0], {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}[x.split(" ")[1]]) for x in _TOKEN.split(", ")), strict=True)
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part, rows = batch.slice(at, 500), []
            for host, page in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                text = page.as_py() or ""
                key = _hash(text)
                rows += [(host, key, *x) for x in tokens_of(text)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=list(names))


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            texts = []
            for page, several, template in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), part.column(4).to_pylist(), strict=True):
                texts.append(extract(page or "", {x["token"]: (x["flags"], x["size"]) for x in template or []}, bool(several)))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], names=["page_id", "url", "text", "n_chars"])


def host_of(url: Column) -> Column:
    """The host of a URL, lower-cased; the empty string if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def occurrences(pages: DataFrame) -> DataFrame:
    """(host, token, ...): every token that stands on two of a host's different pages, with the hash of its occurrence vector, and the hosts' roots."""
    slim = pages.select(host_of(F.col("url").cast("string")).alias("host"), F.col("html").cast("string").alias("html"))
    found = slim.mapInArrow(K.tidy(_tokens), _TOKEN)
    # A page that repeats counts once; the rows of one page tell it apart, so nothing gathers under a host or a token.
    each = found.groupBy("host", "token", "page").agg(*(F.first(c).alias(c) for c in ("parent", "is_text", "n", "size", "linked", "own", "own_size", "named", "away", "article")))
    total = [F.sum(c).alias(c) for c in ("n", "size", "linked", "own", "own_size")]
    same = [F.first(c).alias(c) for c in ("parent", "is_text")]
    stats = each.groupBy("host", "token").agg(
        *total, *same, F.count(F.lit(1)).alias("pages"), F.max("n").alias("most"), F.min("n").alias("least"), F.max("named").alias("named"), F.max("away").alias("away"), F.max("article").alias("article"), F.expr("bit_xor(xxhash64(page, n))").alias("vector"),
    )
    return stats.where("pages > 1 or parent = 0")


def classes(tokens: DataFrame) -> DataFrame:
    """(host, vector): the valid classes. All tokens of one that hang on no other of its tokens hang on the same token."""
    up = tokens.select("host", F.col("token").alias("parent"), F.col("vector").alias("around"))
    hung = tokens.where("pages > 1").join(up, ["host", "parent"], "left").where("around is null or around <> vector")
    return hung.groupBy("host", "vector").agg(F.min("parent").alias("lo"), F.max("parent").alias("hi"), F.min("pages").alias("support")).where(f"lo = hi and support >= {SLOT_PAGES}").select("host", "vector")


def templates(pages: DataFrame) -> DataFrame:
    """(host, several, template): of each host whether it has different pages, and what its template says of tokens: flags and characters."""
    tokens = cut(occurrences(pages), "html-tokens")
    hosts = tokens.where("parent = 0").select("host", F.col("pages").alias("total"))
    valid = cut(tokens.join(classes(tokens), ["host", "vector"], "left_semi"), "html-classes")
    containers = valid.where("not is_text")
    # Texts in their container's class; repeated containers in a container.
    texts = valid.where("is_text").select("host", F.col("parent").alias("token"), "vector", "n", "size").groupBy("host", "token", "vector").agg(F.sum("n").alias("fixed"), F.sum("size").alias("fixed_size"))
    repeated = tokens.where("not is_text and most > 1").select("host", F.col("parent").alias("token"), "size", (F.col("most") > F.col("least")).alias("varies"))
    lists = repeated.groupBy("host", "token").agg(F.sum("size").alias("listed"), F.max("varies").alias("varies"))
    slots = containers.join(texts, ["host", "token", "vector"], "left").join(lists, ["host", "token"], "left").join(hosts, "host")
    is_list = (F.col("most") == 1) & F.coalesce(F.col("varies") & (F.col("listed") >= LIST_SHARE * F.col("size")), F.lit(False))
    slots = cut(slots.withColumn("is_list", is_list), "html-slots")
    beside = slots.where("most = 1 and not is_list").groupBy("host", "parent").agg(F.max("size").alias("largest"))
    slots = slots.join(beside, ["host", "parent"], "left")
    # Where most of the text stands that varies; what repeats inside it is the article's.
    varies = F.when(~F.col("away") & ~F.col("article"), F.struct(F.col("own_size") - F.coalesce("fixed_size", F.lit(0)), "token"))
    main = slots.groupBy("host").agg(F.max(varies)["token"].alias("main"))
    slots = slots.join(main, "host", "left")
    same = (F.col("own") > 0) & F.col("fixed").eqNullSafe(F.col("own")) & (F.col("pages") >= SAME_PAGES) & (F.col("pages") * SAME_ONE_IN >= F.col("total"))
    menu = (F.col("linked") * 2 > F.col("size")) & (F.col("size") > 0)
    listing = F.col("is_list") & F.coalesce(F.col("largest") > F.col("size"), F.lit(False))
    often = F.col("pages") * SLOT_ONE_IN >= F.col("total")
    outside = often & ~F.col("article") & (F.col("parent") != 0) & (same | menu | listing)
    flags = F.when(often & F.col("named"), IS_SLOT).otherwise(0) + F.when(outside, IS_OUTSIDE).otherwise(0) + F.when(F.col("article"), IS_CONTENT).otherwise(0) + F.when(F.col("token") == F.col("main"), IS_MAIN).otherwise(0)
    told = slots.withColumn("flags", flags).where("flags > 0").groupBy("host").agg(F.collect_list(F.struct("token", "flags", "size")).alias("template"))
    return hosts.join(told, "host", "left").select("host", (F.col("total") > 1).alias("several"), "template")


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars: one row per page.

    text is the article's blocks in page order, joined by two line breaks, without menus, headers, footers,
    sidebars, notices, adverts, forms, scripts, styles, markup and comments; character references are
    decoded, and white space inside a block is one space. n_chars counts its code points.

    Null or empty html: an empty text. Pages without a URL, or with one that names no host, share one
    template. Repeated pages and pages without page_id are each extracted. Broken markup (open or
    unmatched tags, a cut end) is read as far as it goes. An empty table gives no rows. Other columns are ignored.
    """
    slim = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"), host_of(F.col("url").cast("string")).alias("host"))
    known = cut(templates(pages), "html-templates")
    size = known.agg(F.sum(F.lit(1) + F.greatest(F.lit(0), F.size(F.coalesce("template", F.array())))).alias("n")).first()["n"] or 0
    # Both are tables, so that beyond the bound adaptive execution can split a host that very many pages have.
    joined = slim.join(F.broadcast(known) if size <= BROADCAST_TOKENS else known, "host", "left").select("page_id", "url", "html", "several", "template")
    page_type = dict(pages.dtypes)["page_id"]
    return joined.mapInArrow(K.tidy(_extracted), f"page_id {page_type}, url string, text string, n_chars long")
