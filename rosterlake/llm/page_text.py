"""Main text of web pages by template deduction over the pages of a host.

Tokens of a page are its elements, told apart by the path of open elements, and its text blocks
with the path they stand in. Tokens of a host that occur equally often on every page share an
occurrence vector and form a class. Vectors are compared by a sum of page hashes weighted with
the counts, which is added up over the pages in any order, so a host may have any number of
pages. Classes that occur on nearly all pages are valid; the one whose tokens occur once per page
is the template's skeleton, others are nested in it. Text blocks in valid classes belong to the
template. The skeleton's elements part a page into slots; the main text is what remains in the
slots that are not made of links and do not stand in an element for navigation and the like.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlake.session import small_side

from .tables import written
from .words import slices

PAGES = 2  # distinct pages that a host needs for a template
SURE = 8  # from so many pages on a valid class may miss some, and may hold long texts and those of articles
SHARE = 0.9  # of a sure host's distinct pages on which a valid class occurs; of others it is on all
SHORT = 200  # characters of a text that the template of a host with few pages may hold
LONG = 500  # characters from which on an element is kept although its name has a doubtful word
LINKED = 0.5  # share of a slot's characters in links beyond which it is navigation

# Element names and attribute words of HTML pages.
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math", "select", "object", "canvas"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td "
    "tfoot th thead tr ul".split()
)
OUTSIDE = set("nav footer aside form head menu dialog button input label fieldset audio video".split())
OUTSIDE_WORDS = set(
    "ad ads advert adverts advertisement advertising adv banner sponsor sponsored promo promotion menu nav navbar "
    "navigation breadcrumb breadcrumbs sidebar aside footer header masthead cookie cookies consent notice notices gdpr "
    "alert popup modal overlay newsletter subscribe subscription signup login comment comments discussion disqus replies "
    "reply respond share sharing social related recommended recommendations teaser widget toolbar pagination pager search "
    "complementary contentinfo dialog form".split()
)
# words that say where or how a part of a page is shown, beside a word that says what it is
BESIDE = set(
    "list lists link links bar box block blocks area section container wrapper wrap inner outer content top bottom left "
    "right main site page global primary secondary first last item items title text icon icons button buttons btn fixed "
    "sticky mobile desktop js region column col row unit slot post posts article entry small large open close group holder".split()
)
ARTICLE_OUTSIDE = set("comment comments reply ad ads advert sponsored promo related recommended teaser".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}}

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Element(NamedTuple):
    name: str
    path: int
    outside: bool
    inside: bool
    link: bool
    doubt: int = -1  # number of the doubtful element that it is or stands in


class Block(NamedTuple):
    """A text block: hash of its place and text, the paths it stands in, and what it is part of."""

    token: int
    chain: list[int]
    text: str
    linked: int
    outside: bool
    inside: bool
    doubt: int = -1


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _outside(name: str, attributes: str, inside: bool) -> float:
    """How surely an element is not part of an article, from its name and attribute words.

    1 for elements and names that say so; 0.5 for a name in which such a word stands beside words
    that mean something else (``social-science``); 0 else.
    """
    if name in OUTSIDE or name == "header" and not inside:
        return 1.0
    if not attributes or name in ("html", "body", "main"):
        return 0.0
    words, most = OUTSIDE_WORDS if name != "article" else ARTICLE_OUTSIDE, 0.0
    for key, *values in _ATTRIBUTE.findall(attributes):
        value = "".join(values)
        key = key.lower()
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return 1.0
        if key == "style" and "display:none" in value.replace(" ", "").lower():
            return 1.0
        if key in ("class", "id", "role"):
            for one in value.split():
                found = _WORD.findall(_CAMEL.sub(" ", one).lower())
                telling = [w in words and b not in ("with", "has", "no", "without") for b, w in zip(["", *found], found)]
                if any(telling):
                    known = all(t or w in BESIDE or w[0].isdigit() for t, w in zip(telling, found, strict=True))
                    most = max(most, 1.0 if known else 0.5)
    return most


def parse_page(page: str) -> tuple[list[int], list[Block]]:
    """The paths of all elements and the text blocks of a page, in page order."""
    root = Element("", 0, False, False, False)
    stack = [root]
    paths: list[int] = []
    blocks: list[Block] = []
    parts: list[str] = []
    doubtful: list[list[int]] = []  # per doubtful element its characters, and those in links
    linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text:
            text = html.unescape(text) if "&" in text else text
            parts.append(text)
            if any(e.link for e in stack):
                linked += len(text)

    def close_block() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                holder = next(e for e in reversed(stack) if e.name in BLOCK or e is root)
                chain = [_signed(e.path) for e in stack if e.name in BLOCK]
                token = _signed(xxhash.xxh3_64_intdigest(text, holder.path))
                top = stack[-1]
                in_links = min(linked, len(text))
                if top.doubt >= 0:
                    doubtful[top.doubt][0] += len(text)
                    doubtful[top.doubt][1] += in_links
                blocks.append(Block(token, chain, text, in_links, top.outside, top.inside, top.doubt))
            parts.clear()
        linked = 0

    def open_element(name: str, attributes: str) -> None:
        top = stack[-1]
        words = " ".join(sorted("".join(v) for k, *v in _ATTRIBUTE.findall(attributes) if k.lower() in ("class", "id")))
        path = xxhash.xxh3_64_intdigest(f"{name} {words}", top.path)
        surely, doubt = _outside(name, attributes, top.inside), top.doubt
        if surely == 0.5 and doubt < 0:
            doubt = len(doubtful)
            doubtful.append([0, 0])
        inside = top.inside or name in ("article", "main") or 'role="main"' in attributes
        stack.append(Element(name, path, top.outside or surely == 1, inside, name == "a", doubt))
        paths.append(_signed(path))

    def close_element(index: int) -> None:
        if any(e.name in BLOCK for e in stack[index:]):
            close_block()
        del stack[index:]

    at = 0
    while True:
        match = _TAG.search(page, at)
        if match is None:
            add(page[at:])
            break
        add(page[at : match.start()])
        at = match.end()
        name = (match[2] or match[5] or "").lower()
        if not name:  # a comment or declaration
            continue
        attributes = match[3] if match[2] else match[6]
        if match[1] or match[4]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name == name:
                    close_element(i)
                    break
            continue
        if name == "br" or name == "wbr":
            parts.append(" " if name == "br" else "")
            continue
        if name in RAW:
            if not attributes.endswith("/"):
                end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if name in BLOCK:
            for i in range(len(stack) - 1, 0, -1):  # a block ends a paragraph that is still open
                if stack[i].name == "p":
                    close_element(i)
                    break
                if stack[i].name in BLOCK:
                    break
            if name in CLOSED_BY:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].name in CLOSED_BY[name]:
                        close_element(i)
                        break
                    if stack[i].name in SCOPE.get(name, ()):
                        break
            close_block()
        if name not in VOID and not attributes.endswith("/"):
            open_element(name, attributes)
    close_block()
    # a doubtful element is an article if it has much text of its own
    gone = {i for i, (chars, in_links) in enumerate(doubtful) if chars < LONG or in_links > LINKED * chars}
    return paths, [b._replace(outside=True) if b.doubt in gone else b for b in blocks]


def page_tokens(paths: list[int], blocks: list[Block]) -> tuple[list[int], list[int], list[int], list[int]]:
    """Tokens of a page, elements first: how often each occurs, and for elements the characters in
    them and those in links. Text that is outside of articles anyway is not counted as a token."""
    times, chars, linked = Counter(paths), Counter(), Counter()
    for block in blocks:
        for path in set(block.chain):
            chars[path] += len(block.text)
            linked[path] += block.linked
    elements = list(times)
    texts = Counter(b.token for b in blocks if not b.outside)
    counts = [*times.values(), *texts.values()]
    return [*elements, *texts], counts, [chars[p] for p in elements], [linked[p] for p in elements]


_BLOCK_TYPE = pa.struct(
    [("token", pa.int64()), ("chain", pa.list_(pa.int64())), ("text", pa.string()), ("inside", pa.bool_())]
)
_PARSED = (
    "tokens array<bigint>, times array<bigint>, chars array<bigint>, linked array<bigint>, "
    "blocks array<struct<token:bigint,chain:array<bigint>,text:string,inside:boolean>>"
)


def parsed_pages(pages: DataFrame, key: str, url: str, page: str) -> DataFrame:
    """key, url, host, page_hash, tokens with their figures, and blocks that are not outside, written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "page"):
            figures, blocks = [], []
            for value in batch.column(4).to_pylist():
                paths, found = parse_page(value)
                figures.append(page_tokens(paths, found))
                own = [b for b in found if not b.outside]
                blocks.append([{"token": b.token, "chain": b.chain, "text": b.text, "inside": b.inside} for b in own])
            columns = [pa.array(c, pa.list_(pa.int64())) for c in zip(*figures, strict=True)]
            names = ["key", "url", "host", "page_hash", "tokens", "times", "chars", "linked", "blocks"]
            columns = [*(batch.column(i) for i in range(4)), *columns, pa.array(blocks, pa.list_(_BLOCK_TYPE))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    host = F.lower(F.regexp_extract(F.coalesce(F.col(url).cast("string"), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))
    text = F.coalesce(F.col(page).cast("string"), F.lit(""))
    rows = pages.select(
        F.col(key).alias("key"), F.col(url).alias("url"), host.alias("host"), F.xxhash64(text).alias("page_hash"), text.alias("page")
    )
    kinds = {n: pages.schema[c].dataType.simpleString() for n, c in (("key", key), ("url", url))}
    schema = f"key {kinds['key']}, url {kinds['url']}, host string, page_hash bigint, {_PARSED}"
    return written(rows.mapInArrow(run, schema), "pages")


def templates(parsed: DataFrame) -> DataFrame:
    """Per site (hash of the host): skeleton (elements once on nearly every page), menus (those of them that hold
    mostly links), fixed (text blocks in valid classes), and sure (``SURE`` pages or more).

    Copies of a page count once; a host of one page has no template. On a host with few pages a class
    is valid if it is on all of them. A host keeps only tokens of valid classes, which are no
    more than a page has; tokens of fewer than ``PAGES`` pages go before anything is joined.
    """
    figures = ["tokens", "times", "chars", "linked"]
    site = F.xxhash64("host").alias("site")
    once = parsed.filter("host <> ''").select(site, "page_hash", *figures).dropDuplicates(["site", "page_hash"])
    sizes = once.groupBy("site").agg(F.count("*").alias("all_pages")).filter(F.col("all_pages") >= PAGES)
    each = once.select("site", "page_hash", F.explode(F.arrays_zip(*figures)).alias("t")).select("site", "page_hash", "t.*")
    counted = each.groupBy("site", F.col("tokens").alias("token")).agg(
        F.count("*").alias("pages"),
        F.sum("times").alias("times"),
        F.sum("chars").alias("chars"),
        F.sum("linked").alias("linked"),
        # the occurrence vector: one hash per page, as often as the token occurs there
        F.sum(F.col("times") * F.shiftright(F.xxhash64("page_hash"), 24)).alias("vector"),
    )
    least = F.when(F.col("all_pages") >= SURE, SHARE * F.col("all_pages")).otherwise(F.col("all_pages"))
    frequent = counted.filter(F.col("pages") >= PAGES).join(small_side(sizes), "site").filter(F.col("pages") >= least)
    classes = frequent.groupBy("site", "all_pages", "vector", "pages", "times").agg(
        F.collect_list(F.struct("token", "chars", "linked")).alias("members")
    )
    valid = classes.filter(F.size("members") > 1)  # tokens of a template come in company
    token = F.transform("members", lambda m: m["token"])
    menus = F.transform(
        F.filter("members", lambda m: m["linked"] > LINKED * m["chars"]), lambda m: m["token"]
    )
    once_each = F.col("times") == F.col("pages")
    return valid.groupBy("site").agg(
        (F.max("all_pages") >= SURE).alias("sure"),
        F.flatten(F.collect_list(F.when(once_each, token))).alias("skeleton"),
        F.flatten(F.collect_list(F.when(once_each, menus))).alias("menus"),
        F.flatten(F.collect_list(token)).alias("fixed"),
    )


def main_text(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """key, url, text, n_chars: the main text of every page, its blocks joined by an empty line.

    Kept are blocks outside of elements for navigation, forms, adverts, notices, comments and the
    like, outside of slots that are mostly links, and not part of the host's template. A name in
    which a telling word stands beside others only counts against elements of little text or
    mostly links. The template of a host with two to seven distinct pages holds only what is on
    all of them, and of texts only short ones outside of articles. If any block
    that is kept stands in an article or main element, only such blocks are. Character references are
    decoded, white space within a block is one space. NULL or empty pages, and those without
    such a block, have the text ''; a NULL url or one without host has no template. Repeated rows
    give repeated rows, columns other than the three are ignored, an empty table gives no rows. The
    parsed pages are written to shared storage while the plan is built.
    """
    parsed = parsed_pages(pages, key, url, page)
    rows = parsed.select("key", "url", "blocks", F.when(F.col("host") != "", F.xxhash64("host")).alias("site"))
    joined = rows.join(small_side(templates(parsed)), "site", "left")
    empty = F.array().cast("array<bigint>")
    for name in ("skeleton", "menus", "fixed"):
        joined = joined.withColumn(name, F.coalesce(name, empty))

    def kept(block: Column) -> Column:
        slot = F.try_element_at(F.filter(block["chain"], lambda p: F.array_contains("skeleton", p)), F.lit(-1))
        menu = ~block["inside"] & slot.isNotNull() & F.array_contains("menus", slot)
        holds = F.col("sure") | (~block["inside"] & (F.length(block["text"]) < SHORT))
        fixed = F.array_contains("fixed", block["token"]) & F.coalesce(holds, F.lit(False))
        return ~fixed & ~F.coalesce(menu, F.lit(False))

    blocks = joined.withColumn("blocks", F.filter("blocks", kept))
    inside = F.exists("blocks", lambda b: b["inside"])
    blocks = blocks.withColumn("blocks", F.when(inside, F.filter("blocks", lambda b: b["inside"])).otherwise(F.col("blocks")))
    text = F.array_join(F.transform("blocks", lambda b: b["text"]), "\n\n")
    found = blocks.select(F.col("key").alias(key), F.col("url").alias(url), text.alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("bigint"))
