"""Main text of web pages by wrapper induction.

The pages of a host are aligned with one of them, the reference, by simple tree matching of their DOM trees. A node
whose text is the same on nearly all pages of the host is template; nodes whose text varies are slots that content
fills. Counts are over groups of near-equal main texts, so that copies of one article, edited or not, don't make it a
template; pages of which a frame without telling names is nearly all the text look like copies too, and keep it. What
is content is then read from the page's own tree: the article or main element if there is one, else the body, without template
nodes, without elements that hold menus, headers, footers, sidebars, notices, adverts, forms, scripts or comments.

Blocks are the runs of text between block elements and line breaks; white space inside a block becomes one space,
empty blocks are left out, and blocks are joined by line feeds.

Defined cases: null or empty html gives the empty text; a null url belongs to the empty host; a host with fewer than
``LEAST`` groups of texts has no template; pages cut off anywhere are read as far as they go; of very long lists of
child elements (over ``CELLS`` pairs) that differ, the best matching is the same, found by whole rows of cells of which few
are kept; elements may be nested as deep as they are; repeated rows give equal texts; an empty table gives no rows.
"""

from __future__ import annotations

import html as entities
import re
import sys
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from math import isqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.llm import words
from hourloom.llm.components import components
from hourloom.llm.storage import bounded_batches, stored
from hourloom.llm.url_filters import host_of

#: Groups of near-equal texts of a host that must share a node's text, and their least share.
LEAST, SHARE = 3, 0.8
#: Estimated Jaccard similarity of the word pairs of near-equal texts, by minima of so many bands of so many hashes.
ALIKE, BANDS, BAND = 0.8, 12, 5
_SEEDS = words.scrambled(BANDS * BAND, 71)
CELLS = 250_000

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*+)>?", re.S
)
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noscript template xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body br dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3"
    " h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th"
    " thead title tr ul".split()
)
#: Opening one of these ends an open paragraph.
ENDS_P = BLOCK - {"br", "body", "head", "html", "option", "title", "legend", "td", "th", "tr", "tbody", "thead", "tfoot"}
#: Unless one of these but itself stands between.
KEEPS_P = {t: {"table", "td", "th", "button", "body", "div", "li", "section", "article"} - {t} for t in ENDS_P}
#: Opening the key ends an open one of the first group, unless one of the second stands between.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dd": ({"dd", "dt"}, {"dl"}),
    "dt": ({"dd", "dt"}, {"dl"}),
    "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
}
RAW_END = {t: re.compile(rf"</{t}\b[^>]*>?", re.I) for t in RAW}
ASIDE = RAW | frozenset("head nav footer aside form button select svg canvas object dialog menu audio video math".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
NAMES = re.compile(
    r"(?:^|[-_\s])(?:ads?|advert\w*|adbox|banner|sponsor\w*|promo\w*|sidebar|side|widget|menu|nav|navbar|navigation|"
    r"breadcrumbs?|header|masthead|footer|cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|newsletter|subscribe|"
    r"signup|login|share|sharing|social|related|recommended|comments?|replies|respond|disqus|pagination|pager|toolbar|"
    r"skip|tags|toc|form|search)(?:$|[-_\s])",
    re.I,
)


@dataclass
class Page:
    """The tree of a page, node 0 being its root, and its texts in order; None marks a block's end."""

    labels: list[str] = field(default_factory=lambda: ["#"])
    parents: list[int] = field(default_factory=lambda: [-1])
    children: list[list[int]] = field(default_factory=lambda: [[]])
    names: list[str] = field(default_factory=lambda: [""])
    texts: list[tuple[int, str] | None] = field(default_factory=list)


def parse(source: str) -> Page:
    page = Page()
    stack: list[tuple[str, int]] = [("#", 0)]
    places: dict[str, list[int]] = {}  # where a tag is open on the stack
    at = 0

    def text(chunk: str) -> None:
        if chunk and not chunk.isspace():
            page.texts.append((stack[-1][1], entities.unescape(chunk)))
        elif chunk:
            page.texts.append((stack[-1][1], " "))

    def top(tags) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=0)

    def close(wanted, barrier=frozenset()) -> None:
        i = top(wanted)
        if not i or top(barrier) > i:
            return
        if any(tag in BLOCK for tag, _ in stack[i:]):
            page.texts.append(None)
        for tag, _ in stack[i:]:
            places[tag].pop()
        del stack[i:]

    while True:
        m = TOKEN.search(source, at)
        text(source[at : m.start()] if m else source[at:])
        if not m:
            return page
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if stack[-1][0] == tag:
                if tag in BLOCK:
                    page.texts.append(None)
                places[tag].pop()
                stack.pop()
            else:
                close({tag})
            continue
        if tag in ENDS_P and places.get("p"):
            close({"p"}, KEEPS_P[tag])
        if tag in ENDS:
            wanted, barrier = ENDS[tag]
            while stack[-1][0] != "#" and top(wanted):
                depth = len(stack)
                close(wanted, barrier)
                if len(stack) == depth:
                    break
        if tag in BLOCK:
            page.texts.append(None)
        if tag in VOID:
            continue
        node = len(page.labels)
        named = " ".join(a[2] or a[3] or a[4] or "" for a in ATTRIBUTE.finditer(" " + m[3])) if m[3] else ""
        page.labels.append(tag)
        page.parents.append(stack[-1][1])
        page.children.append([])
        page.names.append(named)
        page.children[stack[-1][1]].append(node)
        if tag in RAW:
            end = RAW_END[tag].search(source, at)
            at = end.end() if end else len(source)
        elif not m[3].endswith("/"):
            places.setdefault(tag, []).append(len(stack))
            stack.append((tag, node))


class Matcher:
    """Simple tree matching. Trees of one shape are one number, and weights of pairs of shapes are remembered."""

    def __init__(self):
        sys.setrecursionlimit(max(sys.getrecursionlimit(), 1_000_000))  # a level of a tree is a call or two
        self.shapes: dict[tuple, int] = {}
        self.parts: list[tuple[str, tuple[int, ...]]] = []
        self.weights: dict[tuple[int, int], int] = {}

    def shaped(self, page: Page) -> list[int]:
        """The shape of every node's tree."""
        out = [0] * len(page.labels)
        for node in range(len(page.labels) - 1, -1, -1):
            key = (page.labels[node], tuple(out[c] for c in page.children[node]))
            shape = self.shapes.get(key)
            if shape is None:
                shape = self.shapes[key] = len(self.parts)
                self.parts.append(key)
            out[node] = shape
        return out

    def weight(self, a: int, b: int) -> int:
        """How many nodes of the two trees match at most, in order and level by level."""
        key = (a, b)
        found = self.weights.get(key)
        if found is None:
            (label, left), (other, right) = self.parts[a], self.parts[b]
            found = int(label == other)
            if found and left and right:
                for i, j in self.pairs(left, right):
                    found += self.weight(left[i], right[j])
            if len(self.weights) > 2_000_000:
                self.weights.clear()
            self.weights[key] = found
        return found

    def pairs(self, left: tuple[int, ...], right: tuple[int, ...]) -> list[tuple[int, int]]:
        """The best matching of two lists of trees, as places in both."""
        lo, m, n = 0, len(left), len(right)
        while lo < m and lo < n and left[lo] == right[lo]:
            lo += 1
        tail = 0
        while tail < m - lo and tail < n - lo and left[m - 1 - tail] == right[n - 1 - tail]:
            tail += 1
        out = [(i, i) for i in range(lo)] + [(m - 1 - i, n - 1 - i) for i in range(tail - 1, -1, -1)]
        a, b = left[lo : m - tail], right[lo : n - tail]
        if not a or not b:
            return out
        if len(a) * len(b) > CELLS:
            return out + [(lo + i, lo + j) for i, j in self.long_pairs(a, b)]
        best = [[0] * (len(b) + 1)]
        for x in a:
            above, row = best[-1], [0]
            for j, y in enumerate(b):
                row.append(max(row[j], above[j + 1], above[j] + self.weight(x, y)))
            best.append(row)
        i, j = len(a), len(b)
        while i and j:
            if best[i][j] == best[i - 1][j]:
                i -= 1
            elif best[i][j] == best[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                out.append((lo + i, lo + j))
        return out

    def best_rows(self, a: tuple[int, ...], b: np.ndarray, row: np.ndarray) -> Iterator[np.ndarray]:
        """The rows of the table of best weights that follow the given one, a whole row at a time."""
        distinct, places = np.unique(b, return_inverse=True)
        kinds = {}
        for k, shape in enumerate(distinct.tolist()):
            label, children = self.parts[shape]
            same, nested = kinds.setdefault(label, ([], []))
            same.append(k)
            if children:
                nested.append((k, shape))
        last, weights = None, None
        for x in a:
            if x != last:
                label, children = self.parts[x]
                same, nested = kinds.get(label, ((), ()))
                found = np.zeros(len(distinct), np.int64)
                found[list(same)] = 1
                if children:
                    for k, shape in nested:
                        found[k] = self.weight(x, shape)
                last, weights = x, found[places]
            below = np.zeros_like(row)
            np.maximum.accumulate(np.maximum(row[1:], row[:-1] + weights), out=below[1:])
            row = below
            yield row

    def long_pairs(self, a: tuple[int, ...], b: tuple[int, ...]) -> list[tuple[int, int]]:
        """The same matching of two long lists. Of n rows the square root of n are kept, and those between are made again
        on the way back."""
        wide, step = np.asarray(b), isqrt(len(a)) + 1
        row = np.zeros(len(b) + 1, np.int64)
        kept = [row]
        for i, row in enumerate(self.best_rows(a, wide, row), 1):
            if i % step == 0:
                kept.append(row)
        out, i, j = [], len(a), len(b)
        while i and j:
            start = (i - 1) // step * step
            first = kept[start // step][: j + 1]
            best = [first, *self.best_rows(a[start:i], wide[:j], first)]
            while i > start and j:
                here, above = best[i - start], best[i - start - 1]
                if here[j] == above[j]:
                    i -= 1
                elif here[j] == here[j - 1]:
                    j -= 1
                else:
                    i, j = i - 1, j - 1
                    out.append((i, j))
        return out

    def align(self, page: Page, shapes: list[int], other: Page, other_shapes: list[int]) -> dict[int, int]:
        """Nodes of the page to nodes of the other."""
        out, open_pairs = {}, [(0, 0)]
        while open_pairs:
            a, b = open_pairs.pop()
            out[a] = b
            left, right = page.children[a], other.children[b]
            if left and right:
                for i, j in self.pairs(tuple(shapes[c] for c in left), tuple(other_shapes[c] for c in right)):
                    if page.labels[left[i]] == other.labels[right[j]]:
                        open_pairs.append((left[i], right[j]))
        return out


def digest(text: str) -> int:
    return int.from_bytes(xxhash.xxh64_digest(text.encode("utf-8", "replace")), "big", signed=True)


def own_texts(page: Page) -> dict[int, str]:
    out: dict[int, list[str]] = {}
    for item in page.texts:
        if item:
            out.setdefault(item[0], []).append(item[1])
    return {node: joined for node, parts in out.items() if (joined := " ".join("".join(parts).split()))}


def left_out(page: Page, node: int, inside: bool) -> bool:
    """Whether the element holds something other than main text; ``inside``: below an article or main element."""
    label, names = page.labels[node], page.names[node]
    if label in ASIDE or label == "header" and not inside:
        return True
    return bool(names) and label not in ("html", "body", "article", "main", "p") and (
        names.lower() in ROLES or NAMES.search(names) is not None
    )


def main_text(page: Page, template: set[int]) -> str:
    """The text of the content, without the own texts of the nodes of ``template``."""
    n = len(page.labels)
    inside, out, gone = [False] * n, [False] * n, [False] * n
    for node in range(1, n):
        up = page.parents[node]
        inside[node] = inside[up] or page.labels[node] in ("article", "main")
        out[node] = out[up] or left_out(page, node, inside[up])
        gone[node] = out[node] or node in template  # the nodes below a template node vary for themselves
    framed = any(inside[item[0]] and not gone[item[0]] for item in page.texts if item and not item[1].isspace())
    blocks, parts = [], []
    for item in [*page.texts, None]:
        if item is None:
            block = " ".join("".join(parts).split())
            if block:
                blocks.append(block)
            parts = []
        elif not gone[item[0]] and (inside[item[0]] or not framed):
            parts.append(item[1])
    return "\n".join(blocks)


class Host:
    """Pages against the references they are given; a worker keeps the last few."""

    def __init__(self):
        self.matcher, self.known = Matcher(), {}

    def aligned(self, source: str | None, reference: str | None) -> tuple[Page, dict[int, int]]:
        if len(self.matcher.parts) > 200_000 or len(self.matcher.weights) > 400_000:
            self.matcher, self.known = Matcher(), {}
        if reference not in self.known:
            if len(self.known) > 50:
                self.known.clear()
            other = parse(reference or "")
            self.known[reference] = other, self.matcher.shaped(other)
        page = parse(source or "")
        return page, self.matcher.align(page, self.matcher.shaped(page), *self.known[reference])


def signatures(texts: list[str]) -> list[list[int] | None]:
    """The least hashes of each text's word pairs; None without words."""
    out: list[list[int] | None] = []
    for block in words.blocks(pa.array(texts, pa.large_string()), words.LETTERS, lower=True):
        for _, own in block.rows():
            hashes, low = block.hashes[own], None
            pairs = words.grams(hashes, tuple(range(min(2, len(hashes))))) if len(hashes) else hashes
            for i in range(0, len(pairs), 512):
                part = words.mix(pairs[i : i + 512, None] ^ _SEEDS).min(axis=0)
                low = part if low is None else np.minimum(low, part)
            out.append(None if low is None else (low & np.uint64(0x7FFFFFFF)).astype(np.int32).tolist())
    return out


def slot_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, slot, text, variant) of every aligned node with text; the variant is the page's main text, and its
    signature comes in a row without a slot."""
    hosts = Host()
    for batch in batches:
        out: dict[str, list] = {k: [] for k in ("host", "slot", "text", "variant")}
        mains: dict[tuple, str] = {}
        for host, source, reference in zip(*(batch.column(c).to_pylist() for c in ("host", "html", "reference"))):
            page, to = hosts.aligned(source, reference)
            main = main_text(page, set())
            variant = digest(main)
            rows = [(host, to[n], digest(t), variant) for n, t in own_texts(page).items() if n in to]
            if rows:
                mains[host, variant] = main
            for row in rows:
                for k, v in zip(out, row):
                    out[k].append(v)
        signed = [(*key, low) for key, low in zip(mains, signatures(list(mains.values()))) if low]
        filler = [None] * len(signed)
        columns = [out["host"] + [r[0] for r in signed], out["slot"] + filler, out["text"] + filler]
        columns += [out["variant"] + [r[1] for r in signed], [None] * len(out["host"]) + [r[2] for r in signed]]
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()))
        names = ["host", "slot", "text", "variant", "signature"]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, kinds)], names=names)


def text_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hosts = Host()
    for batch in batches:
        texts = []
        for source, reference, template in zip(*(batch.column(c).to_pylist() for c in ("html", "reference", "template"))):
            if not source:
                texts.append("")
            elif not template:
                texts.append(main_text(parse(source), set()))
            else:
                page, to = hosts.aligned(source, reference)
                fixed = {(t["slot"], t["text"]) for t in template}
                own = own_texts(page)
                texts.append(main_text(page, {n for n, r in to.items() if n in own and (r, digest(own[n])) in fixed}))
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
        )


def near_equal(texts: DataFrame) -> DataFrame:
    """(id, component) for texts (id, host, signature) that have near-equal ones on their host.

    Texts with an equal band are compared with one of them, so a large group of copies gives one pair a text.
    """
    hashes = [F.xxhash64("host", F.lit(b), F.slice("signature", BAND * b + 1, BAND)) for b in range(BANDS)]
    members = texts.select("id", F.explode(F.array(*hashes)).alias("band"))
    first = F.min_by("id", F.xxhash64("id", "band"))
    leaders = members.groupBy("band").agg(first.alias("lead"), F.count("*").alias("n")).where("n > 1").select("band", "lead")
    pairs = members.join(leaders, "band").where("id <> lead").select("id", "lead").distinct()
    pairs = pairs.join(texts.select("id", F.col("signature").alias("a")), "id")
    pairs = pairs.join(texts.select(F.col("id").alias("lead"), F.col("signature").alias("b")), "lead")
    same = F.size(F.filter(F.zip_with("a", "b", lambda x, y: x == y), lambda x: x))
    return components(pairs.where(same >= ALIKE * BANDS * BAND).select(F.col("id").alias("a"), F.col("lead").alias("b")))


def templates(pages: DataFrame) -> DataFrame:
    """(host, template): the slots of the host's reference whose text is the same in nearly all groups of pages."""
    schema = "host string, slot long, text long, variant long, signature array<int>"
    rows = pages.select("host", "html", "reference").mapInArrow(slot_rows, schema)
    rows = stored(rows.distinct().withColumn("id", F.xxhash64("host", "variant")), "slots")
    groups = near_equal(rows.where("slot is null").select("id", "host", "signature"))
    rows = rows.where("slot is not null").join(groups, "id", "left").withColumn("vote", F.coalesce("component", "id"))
    total = rows.select("host", "vote").distinct().groupBy("host").agg(F.count("*").alias("total"))
    shared = rows.select("host", "slot", "text", "vote").distinct()
    shared = shared.groupBy("host", "slot", "text").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST)
    shared = shared.join(total, "host").where(F.col("n") >= SHARE * F.col("total"))
    # at most 1 / SHARE texts for a slot, and the slots are the nodes of one page
    return shared.groupBy("host").agg(F.collect_list(F.struct("slot", "text")).alias("template"))


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text for every row of (page_id, url, html)."""
    bounded_batches(pages.sparkSession)
    pages = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    kind = dict(pages.dtypes)["page_id"]
    pages = pages.withColumn("host", host_of("url"))
    first = F.min_by("html", F.struct(F.xxhash64("html"), F.length("html")))
    references = stored(pages.where("html <> ''").groupBy("host").agg(first.alias("reference")), "references")
    fixed = stored(templates(pages.join(references, "host")), "templates")
    known = stored(references.join(fixed, "host"), "known")  # its true size lets Spark send it to the pages if it is small
    return pages.join(known, "host", "left").mapInArrow(text_rows, f"page_id {kind}, url string, text string")
