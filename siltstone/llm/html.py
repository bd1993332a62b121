"""Operator 3: main text of web pages by site style trees.

The pages of a host are merged into one tree whose nodes are style paths (block tags with their class and id words, from
the root). Over the pages that have a node, its importance is the entropy of its presentations (the sequences of its
children) for inner nodes and one less the mean entropy of its contents for texts: a text that all pages repeat has
importance 0, one that differs on each page 1. A node's composite importance adds its children's, damped by level. A
branch is removed where it and all below it stay under ``threshold``, if at least ``min_pages`` pages have it, inside the
page's article too. An article or main element is a weight, not a verdict: of what the tree leaves, its text alone is
taken unless more text stands outside than in the largest of them (cards of other pages), and a page of which the tree
leaves nothing keeps its article. What markup itself declares to be no content (scripts, forms,
navigation, adverts, comments, by tag, role, class or id) is removed on every page, so that hosts with few pages are
handled too.

The tree is never gathered as DOMs: pages send (host, node, presentation or content hash) counts, combined map-side;
only each host's node sums, without contents, meet in one task, and the removed paths are joined back to the pages.

Nulls: a null html gives an empty text; a null url forms a host of its own. Broken markup is read as far as tags can be
told. Repeated rows count as pages and get the same text. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import re
from html import unescape
from math import log

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, materialize, small_parts, tidy
from .urls import split_url

# Tags of HTML by what they do to text.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
_GONE = frozenset("script style textarea title noscript template iframe xmp noembed noframes head nav footer aside form button select option dialog menu svg canvas object audio video map".split())
_BLOCK = frozenset(
    "html body head address article aside blockquote center details dialog dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table caption thead tbody tfoot tr ul select option button".split()
)
_SPACE = frozenset("br td th img input wbr".split())
_CLOSES_P = _BLOCK - {"html", "body", "head", "button", "select", "option"}
_SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "option": {"option"}}
# Words of class, id and role that mark what is no content.
_NOISE = frozenset(
    """ad ads adv advert adverts advertisement advertising adsense adbox banner sponsor sponsored promo promotion nav navbar navigation
    menu breadcrumb breadcrumbs sidebar aside widget widgets footer colophon cookie cookies consent gdpr notice notices notification
    alert popup modal overlay newsletter subscribe subscription signup login register comment comments commentlist reply replies
    disqus respond social share sharing sharebar related recommended recommendations teaser pagination pager toolbar skip copyright
    contentinfo complementary search searchbox tags""".split()
)
_HEADER = frozenset("header masthead topbar site".split())
_TAG = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>", re.S)
_ATTR = re.compile(r"(?<![\w-])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_WORD = re.compile(r"[a-z]+")


class Node:
    __slots__ = ("tag", "sig", "gone", "main", "children", "texts", "parent")

    def __init__(self, tag, sig, gone, main, parent):
        self.tag, self.sig, self.gone, self.main, self.parent = tag, sig, gone, main, parent
        self.children: list[int] = []
        self.texts: list[str] = []


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


_SIGS: dict[tuple[int, str], int] = {}


def _sig(parent: int, name: str) -> int:
    found = _SIGS.get((parent, name))
    if found is None:
        if len(_SIGS) > 200_000:
            _SIGS.clear()
        found = _SIGS[parent, name] = signed(xxhash.xxh3_64_intdigest(f"{parent}/{name}".encode()))
    return found


def parse(html: str) -> tuple[list[Node], list[tuple[Node, str]]]:
    """All block nodes and the blocks of text in page order, each with the node it stands in."""
    root = Node("", 0, False, False, None)
    stack, nodes, blocks, run = [root], [root], [], []

    def flush():
        text = " ".join(unescape("".join(run)).split())
        run.clear()
        if text:
            blocks.append((stack[-1], text))
            stack[-1].texts.append(text)

    at, end = 0, len(html)
    while at < end:
        m = _TAG.search(html, at)
        if m is None:
            run.append(html[at:])
            break
        if m.start() > at:
            run.append(html[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag in _BLOCK or tag in ("section", "svg", "object", "canvas", "audio", "video", "map"):
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == tag:
                        flush()
                        del stack[i:]
                        break
                else:
                    if tag == "p":
                        flush()
            elif tag in _SPACE:
                run.append(" ")
            continue
        if tag in _SPACE:
            run.append(" ")
            continue
        if tag in _RAW:
            close = re.compile(rf"</{re.escape(tag)}\s*/?>", re.I).search(html, at)
            at = close.end() if close else end
            continue
        if tag in _VOID or not (tag in _BLOCK or tag in ("svg", "object", "canvas", "audio", "video", "map")):
            if tag == "hr":
                flush()
            elif tag not in _VOID and m[3] and ("class" in m[3] or "id" in m[3] or "hidden" in m[3]) and not m[3].rstrip().endswith("/"):
                # an inline element may hide its text too
                words, hidden = _marks(m[3])
                if hidden or words & _NOISE:
                    at = _skip(html, at, tag)
            continue
        flush()
        if tag in _CLOSES_P and stack[-1].tag == "p":
            stack.pop()
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in _SIBLINGS.get(tag, ()):
                del stack[i:]
                break
            if stack[i].tag in ("ul", "ol", "dl", "table", "select", "div", "section", "article", "body"):
                break
        top = stack[-1]
        words, hidden = _marks(m[3]) if m[3].strip() else (frozenset(), False)
        main = top.main or tag in ("article", "main")
        gone = top.gone or hidden or tag in _GONE or bool(words & _NOISE) or (tag == "header" or bool(words & _HEADER) and "header" in words or "masthead" in words) and not top.main
        node = Node(tag, _sig(top.sig, f"{tag}.{'.'.join(sorted(words))}"), gone, main and not gone, top)
        top.children.append(node.sig)
        nodes.append(node)
        if not m[3].rstrip().endswith("/") or tag in _BLOCK:
            stack.append(node)

    flush()
    return nodes, blocks


def _marks(attributes: str) -> tuple[frozenset[str], bool]:
    words, hidden = set(), False
    for name, a, b, c in _ATTR.findall(attributes):
        value, name = (a or b or c).lower(), name.lower()
        if name == "hidden":
            hidden = True
        elif name == "aria-hidden":
            hidden |= value == "true"
        elif name == "style":
            hidden |= "display:none" in value.replace(" ", "")
        else:
            words |= set(_WORD.findall(value))
    return frozenset(words), hidden


def _skip(html: str, at: int, tag: str) -> int:
    """Past the end tag that closes an inline element opened just before ``at``."""
    depth = 1
    for m in re.compile(rf"<(/?){re.escape(tag)}(?=[\s/>])[^>]*>", re.I).finditer(html, at):
        depth += -1 if m[1] else 1
        if not depth:
            return m.end()
    return at


def main_text(html: str, noise: frozenset[int] | set[int]) -> str:
    """Blocks that no removed branch holds, joined by newlines: those of the article if it outweighs what is outside it."""
    blocks = [(node, text) for node, text in parse(html)[1] if not node.gone]
    left, inside, outside = [], {}, 0
    for node, text in blocks:
        up = node
        while up is not None and up.sig not in noise:
            up = up.parent
        if up is None:
            left.append((node, text))
            top = _article(node)
            if top is None:
                outside += len(text)
            else:
                inside[top] = inside.get(top, 0) + len(text)
    if not left:
        left = [(node, text) for node, text in blocks if node.main]
    elif inside and max(inside.values()) >= outside:
        left = [(node, text) for node, text in left if node.main]
    return "\n".join(text for _, text in left)


def _article(node: Node) -> Node | None:
    """The outermost article or main element that holds a node."""
    top = None
    while node is not None and node.main:
        node, top = node.parent, node
    return top


def composite(rows: list[tuple[int, int, int, float]], damping: float) -> dict[int, float]:
    """Composite importance of each node from (node, parent, pages, own importance)."""
    below: dict[int, list[int]] = {}
    own = {}
    for node, parent, _, value in rows:
        own[node] = value
        below.setdefault(parent, []).append(node)
    out: dict[int, float] = {}
    order, i = [n for n, p, _, _ in rows if p not in own], 0
    depth = dict.fromkeys(order, 1)
    while i < len(order):
        for child in below.get(order[i], ()):
            if child not in depth:
                depth[child] = depth[order[i]] + 1
                order.append(child)
        i += 1
    for node in reversed(order):
        inner = [out[c] for c in below.get(node, ()) if c in out]
        share = damping ** depth[node]
        out[node] = (1 - share) * own[node] + share * sum(inner) / len(inner) if inner else own[node]
    return out


def style_tree(pages: DataFrame, threshold: float = 0.5, min_pages: int = 5, damping: float = 0.9) -> DataFrame:
    """host and ``noise``: the style paths of its branches to remove."""

    def scan(batches):
        names = ["host", "node", "parent", "inner", "feature", "pages"]
        for batch in small_parts(batches):
            counts: dict[tuple, int] = {}
            for url, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                host, seen = split_url(url)[0], set()
                nodes = [n for n in parse(html or "")[0][1:] if not n.gone and n.tag not in ("html", "body")]
                for node in nodes:
                    if node.children:
                        seen.add((host, node.sig, node.parent.sig, True, signed(xxhash.xxh3_64_intdigest(repr(node.children).encode()))))
                    for text in node.texts or ([] if node.children else [""]):
                        seen.add((host, node.sig, node.parent.sig, False, signed(xxhash.xxh3_64_intdigest(text.encode("utf-8", "replace")))))
                for x in seen:
                    counts[x] = counts.get(x, 0) + 1
            rows = [(*k, v) for k, v in counts.items()]
            columns = list(zip(*rows, strict=True)) if rows else [()] * 6
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    slim = pages.select(F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    parts = slim.mapInArrow(scan, "host string, node long, parent long, inner boolean, feature long, pages long")
    counts = parts.groupBy("host", "node", "parent", "inner", "feature").agg(F.sum("pages").alias("c"))
    # sums of c ln c give the entropies: of presentations over their shares, of a content over the pages that have it
    nodes = counts.groupBy("host", "node", "parent", "inner").agg(F.sum("c").alias("m"), F.sum(F.col("c") * F.log("c")).alias("s")).where(F.col("m") >= min_pages)

    def judge(key: tuple[pa.Scalar], t: pa.Table) -> pa.Table:
        own: dict[int, list] = {}
        for node, parent, inner, m, s in zip(*(t.column(c).to_pylist() for c in ("node", "parent", "inner", "m", "s")), strict=True):
            spread = s / m / log(m)
            value = 1 - spread
            row = own.setdefault(node, [node, parent, m, 0.0])
            row[2], row[3] = max(row[2], m), max(row[3], value) if not inner or row[3] else value
        total = composite([tuple(r) for r in own.values()], damping)
        children: dict[int, list[int]] = {}
        for node, parent, _, _ in own.values():
            children.setdefault(parent, []).append(node)
        high: set[int] = set()
        for node, value in total.items():
            while value >= threshold and node in own and node not in high:
                high.add(node)
                node = own[node][1]
        return pa.table({"host": pa.array([key[0].as_py()], pa.string()), "noise": pa.array([[n for n in total if n not in high]], pa.list_(pa.int64()))})

    return nodes.groupBy("host").applyInArrow(judge, "host string, noise array<long>")


@tidy
def extract_main_text(pages: DataFrame, threshold: float = 0.5, min_pages: int = 5) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    trees = materialize(style_tree(pages, threshold, min_pages).where(F.size("noise") > 0), "style-tree")
    url = F.coalesce("url", F.lit(""))
    rest = F.when(F.locate("://", url) > 0, F.expr("substring(coalesce(url, ''), locate('://', coalesce(url, '')) + 3)")).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    joined = slim.withColumn("host", host).join(broadcast_if_small(trees), "host", "left").select("page_id", "url", "html", "noise")

    def run(batches):
        for batch in small_parts(batches):
            texts = [main_text(h or "", frozenset(n or ())) for h, n in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return joined.mapInArrow(run, "page_id long, url string, text string, n_chars long")
