"""Main text of web pages by equivalence-class template deduction.

Pages of a host come from few templates. The tokens of a page are its elements, told apart
by their path, and its blocks of text, told apart by path and content. Tokens that occur
equally often in every page of the host have the same *occurrence vector* and form an
equivalence class. A class is valid if it has enough members and pages. Its elements are
template structure, its texts template text, and they nest by their paths: a class whose
elements lie below an element of another class fills a slot of it. What remains between
template tokens is slot content: the slot of a block of text is the innermost template
element around it that is on the page once, and is no text block itself. Elements that
repeat on a page, of a nested class or of none, belong to the slot around them.

Copies say nothing about a template: pages of a host whose texts are equal but for tags,
scripts, styles and comments count as one page of it.

Vectors are never gathered: each page adds to a token's fingerprint a 64-bit hash of
(page, count) by exclusive or, so equal vectors give equal fingerprints whatever the number
of pages, and a host with a third of all pages is a map-side aggregate like any other.

The text of a page is what its content slots hold but for template text. Articles (or main
elements) only pick among the slots: those with text of theirs are content, and of a slot as
wide as the page what the articles hold; on pages without one, every slot is content. Menus,
headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments are
left out by element, role and class name wherever they are. A page (or its article) whose
text is all template text keeps it. A name or a form around an article (or main element) with
most of the page's text is layout, unless it names reader comments; ids of headings are
anchors and tell nothing. Inside an article (or main element) only elements, roles, the
template and a few whole names of containers (``FOREIGN_NAMES``) tell; words of names
do not. Outside articles blocks that are
links are menus if the container around them holds little else on the host's pages.

Character references are decoded, white space within a block becomes one space, blocks are
joined by an empty line. Null or empty html gives the empty text. Rows are independent but
for the template: repeated pages give repeated results. A null url is a host of its own.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripdemand.llm.stored import on_workers, stored, written
from tripdemand.llm.text_arrays import U64, chunks, mix, strings

#: A class needs this many pages, and half of its host's, and this many tokens.
LEAST_PAGES, LEAST_TOKENS = 3, 3
#: Hosts (some menus and template tokens each), and texts with copies, that may be broadcast; beyond it they are joined by shuffling.
BROADCAST_HOSTS = 100_000
CHUNK_BYTES = 4 << 20

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?>[^>"']+|"[^"]*"|'[^']*')*)>"""
    r"""|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)>""", re.DOTALL)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe xmp template".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
#: Containers that tell nothing of a text's part in the page.
PAGE_WIDE = frozenset(("html", "body"))
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
PARAGRAPH = frozenset(("p",))
SCOPES = frozenset("ul ol dl table article main section div body".split())
#: Blocks that hold running text or its parts; all other blocks are containers, which may be slots.
TEXT_BLOCKS = frozenset(
    "address blockquote dd dl dt figcaption figure h1 h2 h3 h4 h5 h6 hr li ol p pre summary table tbody td tfoot th thead tr ul".split())

# what is never main text, by element, role, and word of a class or id
SIDE_ELEMENTS = frozenset("aside audio button canvas dialog footer form head iframe menu nav noscript object script select style svg template textarea title video".split())
SIDE_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search tablist toolbar".split())
SIDE_WORDS = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright disclaimer discussion disqus footer gdpr "
    "login masthead menu modal nav navbar navigation newsletter notice notification pager pagination paywall popup promo promoted promotion recommended related replies "
    "reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription tags toolbar topbar widget".split())
#: Of these, what is never a name of the layout around main text; and the ids of such threads.
THREAD_WORDS = frozenset("comment comments discussion disqus related recommended replies reply respond".split())
THREAD_IDS = frozenset("comments comment-list disqus_thread replies respond".split())
#: Whole names of containers that are no part of the article they stand in.
CONTAINERS = frozenset("div ins ol section ul".split())
FOREIGN_NAMES = THREAD_IDS | frozenset(
    "ad ads adsbygoogle advert advertisement adverts breadcrumb breadcrumbs cookie-banner cookie-notice cookies navbar navigation newsletter newsletter-signup notice pagination promo "
    "reader-comments related related-articles related-posts share share-buttons sharing sidebar signup social social-share sponsored sponsored-content subscribe toolbar widget".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
NO_SIDE, LAYOUT, SIDE = 0, 1, 2
HEADER_WORDS = frozenset(("header", "head"))
NEGATING = frozenset(("has", "no", "with", "without"))
MAIN_ROLES = frozenset(("main", "article"))
CONTENT_WORDS = (frozenset(("article", "post", "entry", "story", "main", "page")), frozenset(("body", "content", "text")))


class Block:
    """A stretch of text: its path, the paths of the containers around it, whether it is beside the main text, in a main element within a name of the layout, the main elements it is in, and its text."""

    __slots__ = ("path", "around", "side", "wrapped", "mains", "text", "linked")

    def __init__(self, path: tuple[str, ...], around: tuple[tuple[str, ...], ...], side: bool, wrapped: bool, mains: tuple[int, ...], text: str, linked: int) -> None:
        self.path, self.around, self.side, self.wrapped, self.mains, self.text, self.linked = path, around, side, wrapped, mains, text, linked


def _words(value: str) -> list[str]:
    return [w.lower() for w in WORD.findall(value)]


def _side(name: str, attrs: dict[str, str], in_main: bool) -> int:
    """Whether an element is beside the main text: SIDE, LAYOUT if only unless it is around main text, or NO_SIDE."""
    if name in ("html", "body", "main"):
        return NO_SIDE
    role = attrs.get("role", "").lower()
    if name in SIDE_ELEMENTS and name != "form" or name == "header" and not in_main:
        return SIDE
    if role in SIDE_ROLES and role != "form" or "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true":
        return SIDE
    if re.search(r"display\s*:\s*none", attrs.get("style", ""), re.IGNORECASE):
        return SIDE
    side = LAYOUT if name == "form" or role == "form" else NO_SIDE
    classes, ids = attrs.get("class", "").split(), attrs.get("id", "").split()
    if in_main:  # words of names say too little there; only a container's whole name
        return SIDE if name in CONTAINERS and FOREIGN_NAMES.intersection(x.lower() for x in (*classes, *ids)) else side
    if name in HEADINGS:  # anchors
        ids = [x for x in ids if x.lower() in THREAD_IDS]
    for label in (*classes, *ids):
        words = _words(label)
        if NEGATING.intersection(words):
            continue
        if THREAD_WORDS.intersection(words):
            return SIDE
        if SIDE_WORDS.intersection(words) or HEADER_WORDS.intersection(words):
            side = LAYOUT
    return side


def _main_kind(name: str, attrs: dict[str, str]) -> str | None:
    """``article``, ``main`` or ``content`` for an element that announces main text."""
    if name in MAIN_ROLES:
        return name
    if attrs.get("role", "").lower() in MAIN_ROLES:
        return attrs["role"].lower()
    if attrs.get("itemprop", "").lower() == "articlebody":
        return "content"
    for label in f"{attrs.get('class', '')} {attrs.get('id', '')}".split():
        words = _words(label)
        if all(some.intersection(words) for some in CONTENT_WORDS) or words in (["article"], ["content"]):
            return "content"
    return None


#: What copies of a text may differ in (Java's syntax).
UNSEEN = r"(?is)<!--.*?-->|<(script|style)\b.*?</\1|<[^>]*>"
#: Attributes that say something about an element's part in the page.
TELLING = re.compile(r"class|id|role|hidden|style|itemprop", re.IGNORECASE)


@lru_cache(1 << 14)
def described(name: str, raw: str, in_main: bool) -> tuple[str, int, str | None]:
    """An element's label in paths, whether it is beside the main text, and its kind of main element."""
    attrs = {k.lower(): html.unescape(v.strip("\"'")) for k, v in ATTRIBUTE.findall(raw)} if raw else {}
    label = name + "".join(f".{w}" for w in sorted(attrs.get("class", "").split()))
    side = _side(name, attrs, in_main)
    return label, side, None if side else _main_kind(name, attrs)


class Open:
    """An open element: its paths (of all elements, of blocks), those of the containers up to it, whether it is beside the main text, in a main element within a name of the layout, its main elements."""

    __slots__ = ("name", "path", "blocks", "around", "side", "wrapped", "mains")

    def __init__(self, name: str, path: tuple[str, ...], blocks: tuple[str, ...], around: tuple[tuple[str, ...], ...], side: int, wrapped: bool, mains: tuple[int, ...]) -> None:
        self.name, self.path, self.blocks, self.around, self.side, self.wrapped, self.mains = name, path, blocks, around, side, wrapped, mains


OUTSIDE = Open("", (), (), (), NO_SIDE, False, ())


def parse(page: str) -> tuple[list[tuple[str, ...]], list[Block], list[str]]:
    """The paths of all elements, all blocks of text, and the kind of each main element."""
    stack: list[Open] = []
    elements: list[tuple[str, ...]] = []
    blocks: list[Block] = []
    mains: list[str] = []
    parts: list[str] = []
    linked = links = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            top = stack[-1] if stack else OUTSIDE
            blocks.append(Block(top.blocks, top.around, top.side > NO_SIDE, top.wrapped, top.mains, text, linked))
        parts.clear()
        linked = 0

    def close(names: frozenset[str] | set[str], scopes: frozenset[str] = frozenset()) -> None:
        """Close the innermost element of these names, unless a scope lies around it first."""
        nonlocal links
        for k in range(len(stack) - 1, -1, -1):
            if stack[k].name in names:
                gone = stack[k:]
                if parts and any(s.name in BLOCK for s in gone):
                    flush()
                links -= sum(s.name == "a" for s in gone)
                del stack[k:]
                return
            if stack[k].name in scopes:
                return

    at, size = 0, len(page)
    while at < size:
        start = page.find("<", at)
        if start < 0:
            start = size
        if start > at:
            text = page[at:start]
            if "&" in text:
                text = html.unescape(text)
            parts.append(text)
            if links > 0:
                linked += len("".join(text.split()))
        if start == size:
            break
        m = TOKEN.match(page, start)
        if m is None:
            parts.append("<")
            at = start + 1
            continue
        at = m.end()
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            if m[0].startswith("<![CDATA["):
                parts.append(m[0][9:].removesuffix("]]>"))
            continue
        if m["end"] or m["end2"]:
            close({name})
            continue
        if name in BLOCK:
            close(PARAGRAPH, SCOPES)  # a paragraph ends where another block begins
        if name in CLOSES:
            close(CLOSES[name], SCOPES)
        if name in BLOCK and parts:
            flush()
        if name == "br":
            parts.append(" ")
        if name in VOID:
            continue
        raw = m["attrs"] if m["name"] else m["attrs2"]
        top = stack[-1] if stack else OUTSIDE
        label, side, kind = described(name, raw if raw and TELLING.search(raw) else "", bool(top.mains))
        side = max(side, top.side)
        inside = top.mains
        wrapped = top.wrapped
        if side == LAYOUT and kind in MAIN_ROLES:  # which names around it are layout is known at the end of the page
            side, wrapped = NO_SIDE, True
        if kind and not side:
            inside = (*inside, len(mains))
            mains.append(kind)
        path = (*top.path, label)
        around = (*top.around, path) if name in BLOCK and name not in TEXT_BLOCKS and name not in PAGE_WIDE else top.around
        stack.append(Open(name, path, (*top.blocks, label) if name in BLOCK else top.blocks, around, side, wrapped, inside))
        elements.append(path)
        links += name == "a"
        if name in RAW:  # no markup inside
            end = re.compile(f"</{re.escape(name)}", re.IGNORECASE).search(page, at)
            at = end.start() if end else size
    flush()
    settle(blocks)
    return elements, blocks, mains


def settle(blocks: list[Block]) -> None:
    """Main elements within layout or side names: they are main if no other is and they hold most of the text, else beside it."""
    wrapped = [b for b in blocks if b.wrapped and not b.side]
    if wrapped:
        free = [b for b in blocks if not b.wrapped and not b.side]
        if any(b.mains for b in free) or sum(len(b.text) - b.linked for b in wrapped) <= sum(len(b.text) - b.linked for b in free):
            for b in wrapped:
                b.side = True


@lru_cache(1 << 14)
def path_number(path: tuple[str, ...], kind: str = "element") -> int:
    """A 64-bit number for a path."""
    return int.from_bytes(blake2b(repr((kind, path)).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def text_number(path: tuple[str, ...], text: str) -> int:
    """A 64-bit number for a text at a path."""
    key = path_number(path).to_bytes(8, "little", signed=True)
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8, key=key).digest(), "little", signed=True) | 1


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#]*@)?([^/?#@]*)", 1))


def is_link_list(block: Block) -> bool:
    return block.linked > 0.8 * len(block.text.replace(" ", ""))


def container_of(block: Block) -> int:
    """The number of the innermost container around a block."""
    return path_number(block.around[-1] if block.around else (), "container")


def page_tokens(page: str) -> tuple[Counter, Counter]:
    """How often each token occurs (elements even, texts odd numbers), and for each container
    ten times the characters of its links over 0.8 of all its characters."""
    elements, blocks, _ = parse(page)
    tokens = Counter(path_number(e) & ~1 for e in elements)
    tokens.update(text_number(b.path, b.text) for b in blocks)
    links: Counter = Counter()
    for b in blocks:
        if not b.side:
            links[container_of(b)] += 10 * b.linked - 8 * len(b.text.replace(" ", ""))
    return tokens, links


def slot_of(block: Block, once: set[int], template: frozenset[int]) -> int | None:
    """The innermost template element around a block that is on its page once; None if the page is its slot."""
    for path in reversed(block.around):
        number = path_number(path) & ~1
        if number in once and number in template:
            return number
    return None


def main_blocks(page: str, menus: frozenset[int] | None, template: frozenset[int]) -> list[str]:
    """The blocks of the main text, given the host's containers of links and its template's elements and texts."""
    elements, blocks, mains = parse(page)
    kept = [b for b in blocks if not b.side]
    chosen = main_elements(kept, mains)
    inside = [bool(chosen.intersection(b.mains)) for b in kept]
    own = [text_number(b.path, b.text) not in template for b in kept]
    in_menu = [is_link_list(b) and (not b.around or container_of(b) in (menus or ())) for b in kept]
    if chosen:
        if not any(i and o for i, o in zip(inside, own, strict=True)):  # the template is not all of an article
            return [b.text for b, i in zip(kept, inside, strict=True) if i]
        once = {n for n, c in Counter(path_number(e) & ~1 for e in elements).items() if c == 1} if template else set()
        slots = [slot_of(b, once, template) for b in kept]
        picked = {s for s, i, o in zip(slots, inside, own, strict=True) if i and o and s is not None}
        return [b.text for b, s, i, o, m in zip(kept, slots, inside, own, in_menu, strict=True) if o and (i or s in picked and not m)]
    content = [(b, o) for b, o, m in zip(kept, own, in_menu, strict=True) if not m]
    some = any(o for _, o in content)  # else the template is all of the page
    return [b.text for b, o in content if o or not some]


def main_elements(kept: list[Block], mains: list[str]) -> set[int]:
    """The main elements that pick the content slots: the articles, or the main elements if these hold over twice their text."""
    size: Counter = Counter()
    held: dict[str, set[int]] = {}
    for b in kept:
        for m in b.mains:
            held.setdefault(mains[m], set()).add(m)
        for kind in {mains[m] for m in b.mains}:
            size[kind] += len(b.text)
    if "main" in held and size["article"] < 0.5 * size["main"]:
        return held["main"]
    return held.get("article") or held.get("content") or set()


def distinct_contents(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """(host, page, html): each text of a host once, with a number; of copies the smallest html."""
    page = F.coalesce(F.col(html_col), F.lit(""))
    text = F.regexp_replace(F.regexp_replace(page, UNSEEN, " "), r"[\s<>]+", " ")
    source = pages.select(host_of(F.col(url_col)).alias("host"), F.unhex(F.md5(text.cast("binary"))).alias("digest"), page.alias("html"))
    source = written(source, "contents")  # the patterns run once; what follows reads the columns it needs
    key = ["host", "digest"]
    copied = stored(source.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*key))
    some = copied.limit(BROADCAST_HOSTS + 1).count()
    if some <= BROADCAST_HOSTS:  # then pages without a copy are not shuffled
        copied = F.broadcast(copied)
    number = F.xxhash64("host", "html").alias("page")
    if not some:
        return source.select("host", number, "html")
    copies = source.join(copied, key, "left_semi").groupBy(*key).agg(F.min("html").alias("html"))
    return source.join(copied, key, "left_anti").select("host", number, "html").unionAll(copies.select("host", number, "html"))


def deduce_templates(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """(host, menus, template): the containers of links of each host, and the numbers of its template's elements and texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "html", CHUNK_BYTES):
            marks = mix(batch.column("page").to_numpy().view(U64))
            seen: dict[tuple[str, int, int], list[int]] = {}
            for host, page, mark in zip(strings(batch.column("host")), strings(batch.column("html")), marks, strict=True):
                tokens, links = page_tokens(page or "")
                prints = mix(mark + np.fromiter(tokens.values(), U64, len(tokens))).view(np.int64).tolist()
                rows = [(0, t, p, 0) for t, p in zip(tokens, prints, strict=True)] + [(1, t, 0, n) for t, n in links.items()] + [(2, 0, 0, 0)]
                for kind, token, p, n in rows:
                    row = seen.setdefault((host, kind, token), [0, 0, 0])
                    row[0] += 1
                    row[1] ^= p
                    row[2] += n
            keys = list(seen)
            cols = [pa.array([k[i] for k in keys], t) for i, t in enumerate((pa.string(), pa.int32(), pa.int64()))]
            cols += [pa.array([seen[k][i] for k in keys], pa.int64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays(cols, ["host", "kind", "token", "pages", "vector", "links"])

    found = distinct_contents(pages, url_col, html_col).mapInArrow(run, "host string, kind int, token long, pages long, vector long, links long")
    tokens = found.groupBy("host", "kind", "token").agg(F.sum("pages").alias("pages"), F.bit_xor("vector").alias("vector"), F.sum("links").alias("links"))
    tokens = written(tokens, "tokens")  # read for several things; parsed once
    host = tokens.where("kind = 2").select("host", F.col("pages").alias("n_pages"))
    # valid classes: the same vector, in half of the pages, with some structure
    own = tokens.where("kind = 0").join(host, "host").where((F.col("pages") >= LEAST_PAGES) & (F.col("pages") * 2 >= F.col("n_pages")))
    is_text = F.col("token").bitwiseAND(F.lit(1)) == 1
    classes = own.groupBy("host", "vector").agg(F.count(F.lit(1)).alias("members"), F.count(F.when(~is_text, 1)).alias("elements"))
    valid = classes.where((F.col("members") >= LEAST_TOKENS) & (F.col("elements") > 0)).select("host", "vector")
    members = own.join(valid, ["host", "vector"], "left_semi").groupBy("host").agg(F.collect_list("token").alias("template"))
    menus = tokens.where("kind = 1 and links > 0").groupBy("host").agg(F.collect_list("token").alias("menus"))
    return host.select("host").join(menus, "host", "left").join(members, "host", "left")


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page row: the id and url columns, text, n_chars (code points) and n_blocks."""
    on_workers(pages.sparkSession)
    templates = stored(deduce_templates(pages, url_col, html_col))
    if templates.limit(BROADCAST_HOSTS + 1).count() <= BROADCAST_HOSTS:
        templates = F.broadcast(templates)
    source = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")).withColumn("host", host_of(F.col("url"))).join(templates, "host", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "html", CHUNK_BYTES):
            out = [main_blocks(p or "", frozenset(m or ()), frozenset(t or ())) for p, m, t in zip(strings(batch.column("html")), batch.column("menus").to_pylist(), batch.column("template").to_pylist(), strict=True)]
            texts = ["\n\n".join(b) for b in out]
            cols = [batch.column("id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array([len(b) for b in out], pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, ["id", "url", "text", "n_chars", "n_blocks"])

    id_type, url_type = (source.schema[c].dataType.simpleString() for c in ("id", "url"))
    out = source.select("id", "url", "html", "menus", "template").mapInArrow(run, f"id {id_type}, url {url_type}, text string, n_chars long, n_blocks long")
    return out.withColumnsRenamed({"id": id_col, "url": url_col})
