"""Main text of web pages, with wrappers inferred from the pages of a host as union-free regular expressions.

A page is read as a stream of block tags and text. Pages of one host are aligned one by one with the wrapper found so
far: block tags of the same kind match in order; a run of flowing blocks (paragraphs, headings, lists, text) becomes one
repeated group; what only some pages have becomes optional; text that differs becomes a slot, text that never differs
stays as template text. Wrappers align with each other in the same way, so every task folds its own pages first and
only one wrapper per task and host is shuffled.

The wrapper then says which slots hold the main text: not in menus, headers, footers, sidebars, notices, adverts, forms
or comments (by element, role, class or id), not template text and not lists of links. Template text is the same on half
of a host's different pages; copies of a page count once. Each page is aligned once more and gives its blocks in those
slots: only those in its own article and main elements if these hold most of them, else all, so that no layout of a host
is read by the region of another. A page that has no such block gives all that is not set apart.
"""

from __future__ import annotations

import functools
import html
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import MOST_BROADCAST, sized_broadcast, text_or_empty, written

# Fixed values of the HTML language.
RAW = "script style noscript template iframe textarea title svg math select option button object canvas audio video head".split()
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
CONTAINERS = set("html body article main section div nav header footer aside form fieldset dialog menu search center table tbody thead tfoot tr td th".split())
FLOW = set("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre figure figcaption address hr details summary caption hgroup".split())
CLOSED_BY = {"p": CONTAINERS | FLOW, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr", "tbody"}, "th": {"td", "th", "tr", "tbody"}, "h1": FLOW, "h2": FLOW, "h3": FLOW, "h4": FLOW, "h5": FLOW, "h6": FLOW}
# Fixed words that name what is no main text.
APART = set("nav header footer aside form fieldset dialog menu search".split())
APART_WORDS = set(
    "nav navbar navigation menu header masthead topbar footer sidebar aside rail widget notice notices alert cookie cookies consent gdpr banner popup modal overlay "
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion form search login signup subscribe newsletter "
    "comment comments reply replies respond disqus share sharing social related recommended breadcrumb breadcrumbs pagination pager toolbar copyright "
    "complementary contentinfo".split()
)

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<raw>" + "|".join(RAW) + r")(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*>"
    r"|<(?P<close>/?)(?P<tag>[a-z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.IGNORECASE | re.DOTALL,
)
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
PIECES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
DEPTH = 96  # elements nested deeper give their text to the one at this depth, those set apart stay elements


class Node:
    """An element of a page: kind (tag and names) and children; text children are (text, characters in links)."""

    __slots__ = ("tag", "kind", "children")

    def __init__(self, tag: str, kind: str):
        self.tag, self.kind, self.children = tag, kind, []


def _kind(tag: str, attrs: str) -> str:
    words = sorted({w.lower() for m in NAMES.finditer(attrs) for w in PIECES.findall(m[1] or m[2] or m[3] or "")}) if attrs else []
    return " ".join([tag, *words])


def parse(page: str) -> Node:
    """The tree of block elements; inline markup is dropped, unclosed elements end with their parent.

    The tree is at most DEPTH + 1 elements deep: `homes` says which one takes the text of each open element.
    """
    root = Node("html", "html")
    stack, homes, words, linked, in_link, at = [root], [root], [], 0, 0, 0

    def flush() -> None:
        nonlocal words, linked
        if words:
            text = " ".join(html.unescape("".join(words)).split())
            if text:
                homes[-1].children.append((text, min(linked, len(text))))
        words, linked = [], 0

    while True:
        m = TOKEN.search(page, at)
        if m is None or m.start() > at:
            words.append(page[at : m.start() if m else len(page)])
            linked += len(words[-1]) if in_link else 0
        if m is None:
            break
        at = m.end()
        if m["raw"]:
            end = re.compile(rf"</{m['raw']}\s*>", re.IGNORECASE).search(page, at)
            if m["raw"].lower() != "head":
                if m[0].endswith("/>"):
                    continue
                if end is None and m["raw"].lower() in ("svg", "math", "button", "select", "option", "object", "audio", "video", "canvas"):
                    continue
                at = end.end() if end else len(page)
            elif end is not None:
                at = end.end()
            flush()
            continue
        tag = (m["tag"] or "").lower()
        if tag in ("br", "wbr"):
            words.append(" " if tag == "br" else "")
        elif tag == "a":
            in_link = 0 if m["close"] else 1
        elif tag in CONTAINERS or tag in FLOW:
            flush()
            in_link = 0
            if m["close"]:
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth].tag == tag:
                        del stack[depth:], homes[depth:]
                        break
                    if stack[depth].tag in CONTAINERS and tag in FLOW:
                        break
            elif tag == "html" or tag == "body" and any(x.tag == "body" for x in stack):
                continue
            else:
                while len(stack) > 1 and tag in CLOSED_BY.get(stack[-1].tag, ()):
                    stack.pop()
                    homes.pop()
                node, home = Node(tag, _kind(tag, m["attrs"] or "")), homes[-1]
                if len(stack) <= DEPTH or len(stack) > DEPTH and home is homes[DEPTH] and _apart(node.kind):
                    home.children.append(node)
                    home = node
                if tag not in VOID:
                    stack.append(node)
                    homes.append(home)
    flush()
    return root


# A wrapper is a list [kind, pages, children]; children are wrappers or groups ["+", pages, {kind: wrapper}].
# Text is a member "#" of a group: ["#", pages, checksum of its text or None for a slot, characters, characters in links,
# marks of its pages]. The wrapper of a whole page has the marks of its pages as a fourth item. A mark is a checksum of a
# page's text; of many, the least are kept, so that those of a slot are a fair sample of those of the host.

MARKS = 16


def _folded(node: Node) -> list[tuple[str, list]]:
    """Children in order: containers one by one, runs of flowing blocks and text as one group."""
    out: list[tuple[str, list]] = []
    for child in node.children:
        flows = isinstance(child, tuple) or child.tag in FLOW
        if flows and out and out[-1][0] == "+":
            out[-1][1].append(child)
        else:
            out.append(("+", [child]) if flows else (child.kind, [child]))
    return out


def _all_text(node: Node) -> list[str]:
    """Text blocks of a page that are not set apart."""
    out: list[str] = []
    for c in node.children:
        if isinstance(c, tuple):
            out.append(c[0])
        elif not _apart(c.kind):
            out += _all_text(c)
    return out


def wrapper_of(node: Node, page: int | None = None) -> list:
    """The wrapper of a page, or of an element of the page with the mark `page`."""
    whole = page is None
    mark = zlib.crc32("\n".join(_all_text(node)).encode("utf-8", "replace")) if page is None else page
    children = []
    for kind, nodes in _folded(node):
        if kind != "+":
            children.append(wrapper_of(nodes[0], mark))
            continue
        members: dict = {}
        for child in nodes:
            if isinstance(child, tuple):
                new = ["#", 1, zlib.crc32(child[0].encode("utf-8", "replace")), len(child[0]), child[1], [mark]]
                key = "#"
            else:
                new, key = wrapper_of(child, mark), child.kind
            members[key] = _merged(members[key], new, False) if key in members else new
        children.append(["+", 1, members])
    return [node.kind, 1, children, [mark]] if whole else [node.kind, 1, children]


def _lengths(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Lengths of the longest common subsequences of `a` with each beginning of `b`."""
    row = np.zeros(len(b) + 1, np.int32)
    for x in a:
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], row[:-1] + (b == x)))
    return row


def _common(a: np.ndarray, b: np.ndarray, at: int, to: int) -> list[tuple[int, int]]:
    """Pairs of a longest common subsequence, `at` and `to` being the places of the first ones.

    Halves of `a` are matched with the parts of `b` that suit them best, so memory stays in proportion to the lengths.
    """
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    pairs = [(at + k, to + k) for k in range(head)]
    x, y = a[head : len(a) - tail], b[head : len(b) - tail]
    if len(x) == 1:
        pairs += [(at + head, to + head + int(k)) for k in np.flatnonzero(y == x[0])[:1]]
    elif len(x) and len(y):
        half = len(x) // 2
        cut = int(np.argmax(_lengths(x[:half], y) + _lengths(x[half:][::-1], y[::-1])[::-1]))
        pairs += _common(x[:half], y[:cut], at + head, to + head) + _common(x[half:], y[cut:], at + head + half, to + head + cut)
    return pairs + [(at + len(a) - tail + k, to + len(b) - tail + k) for k in range(tail)]


def _aligned(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Pairs of a longest common subsequence; -1 for what only one side has, in order."""
    numbers: dict[str, int] = {}
    one, two = (np.array([numbers.setdefault(k, len(numbers)) for k in x], np.int32) for x in (a, b))
    out, i, j = [], 0, 0
    for x, y in [*_common(one, two, 0, 0), (len(a), len(b))]:
        out += [(k, -1) for k in range(i, x)] + [(-1, k) for k in range(j, y)] + [(x, y)]
        i, j = x + 1, y + 1
    return out[:-1]


def _marks(a: list[int], b: list[int]) -> list[int]:
    return sorted({*a, *b})[:MARKS]


def _merged(a: list, b: list, pages: bool = True) -> list:
    """The wrapper that matches all that either matches. `pages`: they come from different pages."""
    n = a[1] + b[1] if pages else max(a[1], b[1])
    if a[0] == "#":
        same = a[2] is not None and a[2] == b[2]
        return ["#", n, a[2] if same else None, a[3] + b[3], a[4] + b[4], _marks(a[5], b[5]) if same else []]
    if a[0] == "+":
        both = dict(a[2])
        for kind, x in b[2].items():
            both[kind] = _merged(both[kind], x, pages) if kind in both else x
        return ["+", n, both]
    marks = [_marks(a[3], b[3])] if len(a) > 3 else []
    if [c[0] for c in a[2]] == [c[0] for c in b[2]]:
        return [a[0], n, [_merged(x, y, pages) for x, y in zip(a[2], b[2], strict=True)], *marks]
    pairs = _aligned([c[0] for c in a[2]], [c[0] for c in b[2]])
    return [a[0], n, [_merged(a[2][i], b[2][j], pages) if i >= 0 and j >= 0 else a[2][i] if i >= 0 else b[2][j] for i, j in pairs], *marks]


def _apart(kind: str) -> bool:
    tag, *names = kind.split(" ")
    if tag in ("html", "body", "article", "main"):
        return False
    return tag in APART or not APART_WORDS.isdisjoint(names)


def main_slots(wrapper: list) -> list:
    """The wrapper as nested decisions: [not set apart, children] with groups {kind: decision}."""
    marks = set(wrapper[3])
    varies = False

    def template(slot: list) -> bool:
        return slot[2] is not None and len(slot[5]) >= 3 and 2 * len(marks.intersection(slot[5])) >= len(marks)

    def look(w: list) -> None:
        nonlocal varies
        if w[0] == "#":
            varies = varies or (w[2] is None and w[3] > w[4])
        elif not _apart(w[0]):
            for c in w[2].values() if w[0] == "+" else w[2]:
                look(c)

    if len(marks) >= 3:
        look(wrapper)

    def decide(w: list, apart: bool) -> object:
        apart = apart or w[0] not in "#+" and _apart(w[0])
        if w[0] == "#":
            return not apart and not (varies and template(w)) and (w[3] == 0 or w[4] < 0.8 * w[3])
        if w[0] == "+":
            return {kind: decide(c, apart) for kind, c in w[2].items()}
        return [w[0], not apart, [decide(c, apart) for c in w[2]]]

    return decide(wrapper, False)


def blocks(node: Node, decision) -> list[str]:
    """Text blocks of a page in the main slots, in page order."""
    out: list[tuple[str, bool]] = []  # and whether an article or main element holds it

    def everything(x, inside: bool) -> None:
        if isinstance(x, tuple):
            out.append((x[0], inside))
        elif not _apart(x.kind):
            for c in x.children:
                everything(c, inside or x.tag in ("article", "main"))

    def walk(x: Node, d: list, inside: bool) -> None:
        inside = inside or x.tag in ("article", "main")
        folded = _folded(x)
        for i, j in _aligned([k for k, _ in folded], ["+" if isinstance(c, dict) else c[0] for c in d[2]]):
            if i < 0:
                continue
            kind, nodes = folded[i]
            if j < 0:
                if d[1]:
                    for c in nodes:
                        everything(c, inside)
            elif kind != "+":
                walk(nodes[0], d[2][j], inside)
            else:
                for c in nodes:
                    own = d[2][j].get("#" if isinstance(c, tuple) else c.kind, d[1])
                    if isinstance(own, list):
                        walk(c, own, inside)
                    elif own:
                        everything(c, inside)

    walk(node, decision, False)
    inner = [text for text, inside in out if inside]
    if inner and sum(map(len, inner)) >= 0.6 * sum(len(text) for text, _ in out):
        return inner
    return [text for text, _ in out] or _all_text(node)


@functools.lru_cache(maxsize=512)
def _decision(wrapper: str):
    return main_slots(json.loads(wrapper))


def _dump(wrapper: list) -> str:
    return json.dumps(wrapper, separators=(",", ":"), ensure_ascii=False)


def _infer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, html) -> one wrapper for each host of this task."""
    found: dict[str, list] = {}
    for batch in batches:
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            new = wrapper_of(parse(page))
            found[host] = _merged(found[host], new) if host in found else new
    yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array([_dump(w) for w in found.values()], pa.string())], names=["host", "wrapper"])


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, wrapper) sorted by host -> one wrapper for each host; holds one wrapper at a time."""
    host, held, done = None, None, []
    for batch in batches:
        for name, wrapper in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if held is not None and name == host:
                held = _merged(held, json.loads(wrapper))
            else:
                if held is not None:
                    done.append((host, _dump(held)))
                host, held = name, json.loads(wrapper)
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.string())], names=["host", "wrapper"])
        done = []
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array([host], pa.string()), pa.array([_dump(held)], pa.string())], names=["host", "wrapper"])


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1))


def wrappers(pages: DataFrame, *, url_column: str = "url", html_column: str = "html") -> DataFrame:
    """host, wrapper (JSON) over all pages of each host."""
    hosted = pages.select(host_of(F.col(url_column).cast("string")).alias("host"), text_or_empty(html_column).alias("html"))
    own = hosted.mapInArrow(_infer, "host string, wrapper string").withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(32)))
    some = own.repartition("host", "salt").sortWithinPartitions("host", "wrapper").select("host", "wrapper").mapInArrow(_fold, "host string, wrapper string")
    return some.repartition("host").sortWithinPartitions("host", "wrapper").mapInArrow(_fold, "host string, wrapper string")


def extract(pages: DataFrame, *, max_broadcast: int = MOST_BROADCAST, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every row of `pages`.

    Blocks are joined by a line feed; white space in a block is one space. Null and empty pages, and pages without main
    text, give an empty text; pages without a host share one wrapper; null ids and repeated rows are kept; other columns
    are ignored; an empty table gives no rows. The wrappers are broadcast only if their measured bytes stay within
    `max_broadcast`. Nesting deeper than DEPTH elements is read as DEPTH.
    """
    known = written(wrappers(pages, url_column=url_column, html_column=html_column), "wrappers")
    known = sized_broadcast(known, max_broadcast)
    rows = pages.select(F.col(id_column).cast("long").alias("page_id"), F.col(url_column).cast("string").alias("url"), host_of(F.col(url_column).cast("string")).alias("host"), text_or_empty(html_column).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = ["\n".join(blocks(parse(page), _decision(wrapper))) for page, wrapper in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return rows.join(known, "host").select("page_id", "url", "html", "wrapper").mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op2_html_extraction(spark, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
