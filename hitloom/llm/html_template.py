"""Main text of web pages by equivalence-class template deduction.

Tokens are start tags, told apart by their path of elements and classes, and whole
text nodes with their path. The occurrence vector of a token is its count on every
page of the host; tokens with the same vector form an equivalence class. Vectors are
never gathered: a token's vector is represented by an order-free hash of (page, count)
that Spark combines before the shuffle, so a host with a third of all pages is an
ordinary aggregate. Equal pages of a host count once.

Classes that cover most pages of a host and have several tokens are its template. On
each page a class is valid if its tokens follow each other in the same order round
after round; the class of tokens occurring once is the root, and the gaps between its
tokens are the slots in which further classes nest. What remains in the slots is the
data. Of it the main text is taken: all slots but those of template text or of links
only. Article and main elements are a hint: if the data within them has at least as many
characters outside links as the data elsewhere, only theirs is taken. Menus, headers,
footers, asides, forms, adverts, notices and reader comments are told by their
elements, classes and roles.
"""

from __future__ import annotations

import html
import re
import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitloom.llm import common

common.ship(sys.modules[__name__])

#: Share of a host's pages that template tokens stand on, and the fewest pages to tell.
SUPPORT = 0.6
MIN_PAGES = 3
MIN_CLASS = 2

# Element names by their role in HTML, and names in classes and ids.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table "
    "tbody tfoot thead tr ul".split()
)
CELLS = frozenset("td th br".split())
DROPPED = frozenset(
    "aside audio button canvas datalist dialog footer form head iframe input label menu nav noscript object search select "
    "script style svg template textarea title video".split()
)
REGIONS = frozenset("article main".split())
#: What a class says of these concerns the page, not their text.
KEPT = frozenset("html body article main".split())
DROPPED_NAMES = frozenset(
    "ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments cookie cookies consent "
    "disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices notification pager "
    "pagination popup promo related replies respond share sharing sidebar signup skip social sponsor sponsored subscribe "
    "toolbar widget widgets".split()
)
#: Words that a class or id may add to one of these and still name the same thing.
NEUTRAL_NAMES = frozenset(
    "area bar block bottom box container content global group header inner item items left links list main outer page "
    "primary right secondary section site slot text top wrap wrapper".split()
)
DROPPED_ROLES = frozenset("banner navigation contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Elements that an open one of the first name may not stay open under.
SCOPE = frozenset("html body article section main div table td th ul ol dl blockquote aside nav header footer form button".split())
CLOSED_BY_SAME = {"li": ("ul", "ol", "menu"), "dd": ("dl",), "dt": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select", "datalist")}

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>", re.S)
_ATTRIBUTE = re.compile(r"(?:^|[\s\"'/])(class|id|role|hidden|aria-hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?(?=[\s/]|$)", re.I)
_NAME = re.compile(r"[a-z0-9]+")


@dataclass
class Node:
    """A text node: its place among the tokens, its block, and where it stands."""

    at: int
    block: int
    text: str
    dropped: bool
    region: bool
    link: bool


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): (m[2] or "").strip("\"'").lower() for m in _ATTRIBUTE.finditer(text)} if text.strip(" /") else {}


def _is_dropped(name: str, attributes: dict[str, str], in_region: bool) -> bool:
    if name in DROPPED or (name == "header" and not in_region):
        return True
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or attributes.get("role") in DROPPED_ROLES:
        return True
    if name in KEPT or attributes.get("role") == "main":
        return False
    names = f"{attributes.get('class', '')} {attributes.get('id', '')}".split()
    return any(_names_dropped(set(_NAME.findall(one))) for one in names)


def _names_dropped(words: set[str]) -> bool:
    """Whether a class names something to drop: ``cookie-notice`` and ``site-footer`` do, ``no-sidebar`` and ``share-price`` don't."""
    return bool(words & DROPPED_NAMES) and words <= DROPPED_NAMES | NEUTRAL_NAMES


def parse(page: str) -> tuple[list[int], list[Node]]:
    """Template tokens in page order and the text nodes among them."""
    tokens: list[int] = []
    nodes: list[Node] = []
    # name, path, dropped by kind of element, dropped by name, in a region, in a link
    stack = [("", 0, False, False, False, False)]
    block, at, raw_until = 0, 0, 0

    def add_text(text: str) -> None:
        text = html.unescape(text)
        if text.isspace() or not text:
            if text and nodes and nodes[-1].block == block:
                nodes[-1].text += " "
            return
        _, path, kind, named, region, link = stack[-1]
        tokens.append(_signed(xxhash.xxh64_intdigest(" ".join(text.split()), path)))
        nodes.append(Node(len(tokens) - 1, block, text, kind or named, region, link))

    def close(depth: int) -> None:
        nonlocal block
        if any(frame[0] in BLOCK for frame in stack[depth:]):
            block += 1
        del stack[depth:]

    for tag in _TAG.finditer(page):
        if tag.start() < raw_until:
            continue
        if tag.start() > at:
            add_text(page[at : tag.start()])
        at = tag.end()
        if tag[2] is None:
            continue
        name = tag[2].lower()
        if tag[1]:
            depth = next((k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == name), 0)
            if depth:
                close(depth)
            elif name in BLOCK:
                block += 1
            continue
        if name in BLOCK:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == "p":
                    close(k)
                    break
                if stack[k][0] in SCOPE:
                    break
            block += 1
        elif name in CELLS and nodes:
            nodes[-1].text += " "
        if name in CLOSED_BY_SAME:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == name or (name in ("dd", "dt") and stack[k][0] in ("dd", "dt")):
                    close(k)
                    break
                if stack[k][0] in CLOSED_BY_SAME[name]:
                    break
        _, path, kind, named, region, link = stack[-1]
        attributes = _attributes(tag[3])
        own = _is_dropped(name, attributes, region)
        path = xxhash.xxh64_intdigest(f"{name}.{attributes.get('class', '')}", path)
        tokens.append(_signed(path))
        if name in VOID:
            continue
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])", re.I).search(page, at)
            at = raw_until = end.start() if end else len(page)
        is_region = name in REGIONS or attributes.get("role") == "main"
        # A region inside something dropped only by its class is taken for unclosed markup.
        named = own if is_region else named or own
        stack.append((name, path, kind or (name in DROPPED), named, (region or is_region), link or name == "a"))
    if at < len(page):
        add_text(page[at:])
    return tokens, nodes


def _slots(tokens: list[int], template: dict[int, int]) -> tuple[list[int], set[int]]:
    """The slot of every token, and the places of template tokens.

    Slots are the gaps between tokens of the root: the largest valid class that occurs
    once. Classes valid on this page whose rounds each lie in one slot nest there.
    """
    by_class: dict[int, list[int]] = {}
    for place, token in enumerate(tokens):
        if token in template:
            by_class.setdefault(template[token], []).append(place)
    valid = {}
    for name, places in by_class.items():
        round_ = list(dict.fromkeys(tokens[p] for p in places))
        if len(places) % len(round_) == 0 and all(tokens[p] == round_[k % len(round_)] for k, p in enumerate(places)):
            valid[name] = (places, len(round_))
    roots = [name for name, (places, size) in valid.items() if len(places) == size]
    root = max(roots, key=lambda name: (valid[name][1], -valid[name][0][0]), default=None)
    marks = set(valid[root][0]) if root is not None else set()
    slots, slot = [], 0
    for place in range(len(tokens)):
        slot += place in marks
        slots.append(slot)
    used = set(marks)
    for places, size in valid.values():
        rounds = (places[k : k + size] for k in range(0, len(places), size))
        if all(len({slots[p] for p in one}) == 1 for one in rounds) or len(places) == size:
            used.update(places)
    return slots, used


def main_text(page: str | None, template: dict[int, int]) -> str:
    """Blocks of main text joined by empty lines, given the host's template (token to class)."""
    tokens, nodes = parse(page or "")
    slots, used = _slots(tokens, template)
    kept = [n for n in nodes if not n.dropped and n.at not in used]
    worded = {slots[n.at] for n in kept if not n.link}
    kept = [n for n in kept if slots[n.at] in worded]
    inside = sum(len(n.text.strip()) for n in kept if n.region and not n.link)
    outside = sum(len(n.text.strip()) for n in kept if not n.region and not n.link)
    if inside and inside >= outside:
        kept = [n for n in kept if n.region]
    blocks: dict[int, list[str]] = {}
    for node in kept:
        blocks.setdefault(node.block, []).append(node.text)
    texts = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n\n".join(t for t in texts if t)


def host(url: Column) -> Column:
    """Host of a URL in lower case, empty if it has none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


def _token_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["host", "page", "token", "n"]
    for batch in batches:
        columns: list[list] = [[], [], [], []]
        for host_, page in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = page.as_py() or ""
            key = _signed(xxhash.xxh64_intdigest(text))
            for token, n in Counter(parse(text)[0]).items():
                for column, value in zip(columns, (host_, key, token, n)):
                    column.append(value)
            if len(columns[0]) > 1 << 18:
                yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), *(pa.array(c, pa.int64()) for c in columns[1:])], names=names)
                columns = [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), *(pa.array(c, pa.int64()) for c in columns[1:])], names=names)


def templates(pages: DataFrame) -> DataFrame:
    """Per ``host`` the tokens of its template with their classes (``template``).

    ``pages`` has ``host`` and ``html``. Hosts of fewer than ``MIN_PAGES`` different
    pages have none.
    """
    found = pages.select("host", "html").mapInArrow(_token_batches, "host string, page long, token long, n long").distinct()
    vectors = found.groupBy("host", "token").agg(F.count("*").alias("support"), F.bit_xor(F.xxhash64("page", "n")).alias("vector"))
    # The first token of a page, its outermost element, stands once for each page; so do all pages of a host.
    sizes = pages.select("host", F.xxhash64("html").alias("page")).distinct().groupBy("host").agg(F.count("*").alias("pages"))
    frequent = vectors.join(sizes, "host").where((F.col("pages") >= MIN_PAGES) & (F.col("support") >= F.col("pages") * SUPPORT))
    frequent = common.store(frequent.select("host", "token", "vector"), "template-tokens")
    classes = frequent.groupBy("host", "vector").agg(F.count("*").alias("size")).where(F.col("size") >= MIN_CLASS)
    valid = frequent.join(classes, ["host", "vector"])
    # At most the tokens of a few pages: each stands on most pages of the host.
    return valid.groupBy("host").agg(F.collect_list(F.struct("token", "vector")).alias("template"))


def _extract_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        known: tuple[object, dict[int, int]] = (None, {})
        for page, template in zip(batch.column("html"), batch.column("template")):
            listed = template.as_py() or []
            pairs = known[1] if listed == known[0] else {t["token"]: t["vector"] for t in listed}
            known = (listed, pairs)
            texts.append(main_text(page.as_py(), pairs))
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` of every row.

    A null or empty html gives an empty text; pages without host share one template;
    repeated rows and ids give a row each; other columns are ignored.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host(F.col("url")).alias("host"))
    learned = common.store(templates(rows), "templates")
    joined = rows.join(learned, "host", "left").select("page_id", "url", "html", "template")
    schema = joined.select("page_id", "url", F.lit("").alias("text"), F.lit(0).cast("long").alias("n_chars")).schema
    return joined.mapInArrow(_extract_batches, schema)
