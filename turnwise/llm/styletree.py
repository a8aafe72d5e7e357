"""HTML extraction with a site style tree.

The pages of a host are merged into one tree: a node is a path of tags and classes. For every
node the tree knows on how many distinct pages it stands, how its children are made up there
(presentation) and what it says there (content). The entropy of both over these pages is its
importance: menus and notices repeat, articles do not. Copies of a page count once, so that
they are not taken for menus. Branches of low importance are cut from each page; what semantic
tags and class names say goes before what is measured.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache, reduce
from hashlib import blake2b

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnwise.session import store

# A branch below this importance is cut, if it stands on at least so many pages.
IMPORTANCE = 0.3
PAGES = 5
# Share of the presentation in the importance of a branch.
PRESENTATION = 0.1

# HTML elements by what they mean here.
_RAW = "script|style|noscript|template|textarea|title|iframe|svg|canvas|object|math"
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary "
    "table tbody td tfoot th thead tr ul".split()
)
_NOISE_TAGS = frozenset("nav footer aside form header menu button select dialog head label".split())
_MAIN_TAGS = frozenset(("article", "main"))
_CLOSES_P = _BLOCK - {"body", "html"}
_NOT_P = _BLOCK - {"p"}
_SIBLINGS = frozenset("li td th tr dt dd option".split())
_LISTS = frozenset("ul ol table dl select tbody thead".split())
# Names of what is not the article, as whole words of a class, id or role. Behind a hyphen
# they name a kind of it (site-footer); before one, some do (sidebar-left) and some do not
# (social-science). A page that merely has or lacks such a part is not it (has-sidebar).
_PARTS = (
    r"ads?|adverts?|advertisement|banner|sponsor(?:ed)?|promo|nav|navbar|navigation|menu|breadcrumbs?|sidebar|side-bar|"
    r"widget|footer|cookies?|consent|gdpr|notice|newsletter|subscribe|signup|popup|modal|comments?|respond|replies|"
    r"related|share|sharing|social|pagination|pager|toolbar|masthead|skip-link"
)
_HEADS = r"adverts?|nav|menu|breadcrumbs?|sidebar|footer|cookies?|consent|newsletter|comments?|pagination"
_NOISE_NAMES = re.compile(
    rf"(?!(?:has|no|not|with|without|is|hide|show)[-_])(?:[a-z0-9]+[-_]+)*(?:{_PARTS})[0-9]*|(?:{_HEADS})[-_][a-z0-9_-]+|"
    r"(?:share|sharing|social|related)[-_](?:links?|buttons?|icons?|bar|posts?|articles?|stories)"
)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{_RAW})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|</?[a-z][^>]*>"
    r"|<[!?][^>]*>",
    re.S | re.I,
)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)


def _number(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


@lru_cache(maxsize=1 << 16)
def _child(parent: int, label: str) -> int:
    """The number of a branch: a hash of its parent's number and its own name."""
    return _number(f"{parent}/{label}")


def _branch(path: tuple[str, ...]) -> int:
    return reduce(_child, path, 0)


class Node:
    """An element that is a block: its branch and its name, and what stands in it in order,
    blocks of text and further nodes. ``told`` counts the blocks below that say something."""

    __slots__ = ("parent", "branch", "label", "items", "told", "hashes")

    def __init__(self, parent: Node | None, label: str):
        self.parent, self.label, self.items, self.told, self.hashes = parent, label, [], 0, (0, 0)
        self.branch = _child(parent.branch if parent else 0, label) if label else 0


class Block:
    """A run of text in one block, the node it stands in, and what its tags say of it: inside
    an article, inside a noise element, inside something noisy by name, and the last of these
    counted from the outermost article on."""

    __slots__ = ("node", "main", "noise", "named", "named_inside", "parts", "said")

    def __init__(self, node: Node, flags: tuple[bool, bool, bool, bool]):
        self.node, self.parts, self.said = node, [], None
        self.main, self.noise, self.named, self.named_inside = flags

    def text(self) -> str:
        if self.said is None:
            self.said = " ".join("".join(self.parts).split())
        return self.said


def blocks(page: str) -> tuple[list[Block], list[Node]]:
    """The text blocks of a page in order, and its nodes, parents first. Tags may be left open
    or closed twice; markup that never ends is dropped with its content, as browsers do. The
    work is in proportion to the page, however deep it is."""
    root = Node(None, "")
    nodes, out = [root], []
    # Of each open element: tag, node, flags as in Block, its own and those above it.
    stack: list[tuple[str, Node, tuple[bool, bool, bool, bool]]] = [("", root, (False, False, False, False))]
    open_: Counter[str] = Counter()
    fresh, at = True, 0

    def text(piece: str) -> None:
        nonlocal fresh
        if not piece:
            return
        if fresh:
            if not piece.strip():
                return
            _, node, flags = stack[-1]
            out.append(Block(node, flags))
            node.items.append(out[-1])
            fresh = False
        out[-1].parts.append(entities.unescape(piece))

    def close(tag: str, stop: tuple[str, ...] | frozenset = ()) -> None:
        """Closes the last open element of a tag and what is open in it, unless one of
        ``stop`` is met first."""
        nonlocal fresh
        if not open_[tag]:
            return
        i = len(stack) - 1
        while stack[i][0] != tag:
            if stack[i][0] in stop:
                return
            i -= 1
        fresh = fresh or any(s[0] in _BLOCK for s in stack[i:])
        open_.subtract(s[0] for s in stack[i:])
        del stack[i:]

    for m in _TOKEN.finditer(page):
        text(page[at : m.start()])
        at = m.end()
        tag = m["tag"]
        if not tag:
            continue
        tag = tag.lower()
        if m["end"]:
            if open_[tag]:
                close(tag)
            else:
                fresh = fresh or tag in _BLOCK
            continue
        if tag == "br":
            text(" ")
            continue
        if tag in _CLOSES_P:
            close("p", _NOT_P)
            fresh = True
        if tag in _VOID:
            continue
        if tag in _SIBLINGS:
            # A sibling left open ends here.
            close(tag, _LISTS)
        names = " ".join(v.strip("\"'") for _, v in _NAMES.findall(m["attrs"])).lower() if "=" in m["attrs"] else ""
        _, node, (main, noise, named, named_inside) = stack[-1]
        own = tag not in ("html", "body")
        by_name = own and any(map(_NOISE_NAMES.fullmatch, names.split()))
        # The header of an article is part of it.
        noise = noise or own and tag in _NOISE_TAGS and not (tag == "header" and main)
        main_now = main or tag in _MAIN_TAGS
        flags = main_now, noise, named or by_name, named_inside or main_now and by_name
        if tag in _BLOCK:
            # Numbers in names tell pages apart, not branches.
            node = Node(node, f"{tag}.{re.sub('[0-9]+', '0', names)}" if names else tag)
            nodes.append(node)
            node.parent.items.append(node)
        stack.append((tag, node, flags))
        open_[tag] += 1
    text(page[at:])
    return out, nodes


def _told(found: list[Block]) -> list[Block]:
    """The blocks that say something and are not noise by tag or name."""
    return [b for b in found if not b.noise and not b.named and b.text()]


def branches(told: list[Block], nodes: list[Node]) -> dict[int, tuple[int, int]]:
    """Every branch of a page: its number -> hashes of its children's names and of its text,
    rolled up from the children, once for each node."""
    said = set(map(id, told))
    found: dict[int, list[tuple[int, int]]] = {}
    for node in reversed(nodes):
        shape, content = [], []
        for item in node.items:
            if isinstance(item, Node):
                if item.told:
                    shape.append(item.label)
                    content.append(str(item.hashes[1]))
                    node.told += item.told
            elif id(item) in said:
                shape.append("#")
                content.append(item.text())
                node.told += 1
        node.hashes = _number("/".join(shape)), _number("\n".join(content))
        if node.told and node.parent:
            found.setdefault(node.branch, []).append(node.hashes)
    joined = lambda parts: parts[0] if len(parts) == 1 else _number("/".join(map(str, parts)))
    return {k: (joined([s for s, _ in v]), joined([c for _, c in v])) for k, v in found.items()}


def main_text(page: str | None, low: set[int]) -> str:
    """The blocks that stay, one per line. A branch of low importance goes, as does one that
    is noise by name; where a page marks text as its article nothing beside it is the article,
    whatever the names of what stands around it. A branch above all text that could stay is
    never cut, and all of that stays where the measure would leave none."""
    found, nodes = blocks(page or "")
    told = _told(found)
    chosen = [b for b in told if b.main] or [
        b for b in found if b.main and not b.noise and not b.named_inside and b.text()
    ] or told
    stays = chosen
    if low and chosen:
        for b in chosen:
            b.node.told += 1
        count: Counter[int] = Counter()
        for node in reversed(nodes[1:]):
            node.parent.told += node.told
            count[node.branch] += node.told
        gone = {nodes[0]: False}
        for node in nodes[1:]:
            gone[node] = gone[node.parent] or node.branch in low and count[node.branch] < len(chosen)
        stays = [b for b in chosen if not gone[b.node]]
    return "\n".join(b.text() for b in stays or chosen)


def _host() -> F.Column:
    return F.lower(F.regexp_extract(F.col("url"), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def style_pages(pages: DataFrame) -> DataFrame:
    """Rows (host, page, nodes) for every page that says something: page is a hash of its whole
    text without what is noise by name, nodes (path, shape, content) are hashes of its branches."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            rows, nodes, ends = [], [], [0]
            for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                found, tree = blocks(page or "")
                if told := _told(found):
                    rows.append((host, _number("\n".join(b.text() for b in told))))
                    nodes += [(p, *hashes) for p, hashes in branches(told, tree).items()]
                    ends.append(len(nodes))
            hosts, keys = zip(*rows) if rows else ((), ())
            parts = zip(*nodes) if nodes else ((), (), ())
            each = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in parts], ["path", "shape", "content"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array(keys, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), each)],
                ["host", "page", "nodes"],
            )

    known = pages.select(_host().alias("host"), "html").where("host <> ''")
    return known.mapInArrow(run, "host string, page bigint, nodes array<struct<path: bigint, shape: bigint, content: bigint>>")


def low_branches(pages: DataFrame) -> DataFrame:
    """One row per host with branches of low importance: host, low (their numbers).

    The importance of a branch on m distinct pages is the entropy of its contents (and, for a
    small part, of its children) to the base m: 1 if all pages differ, 0 if all are alike.
    Copies of a page say nothing of its branches and count once; a page alone says nothing
    about its host, so branches on few pages are left in. Copies go, and counts per distinct
    content are summed, before any shuffle, so a host with a third of all pages is no larger
    task than others.
    """
    once = style_pages(pages).groupBy("host", "page").agg(F.min("nodes").alias("nodes"))
    nodes = once.select("host", F.inline("nodes"))
    kinds = F.explode(F.array(*[
        F.struct(F.lit(k).alias("kind"), F.col(k).alias("value")) for k in ("shape", "content")
    ])).alias("k")
    counted = (
        nodes.select("host", "path", kinds).groupBy("host", "path", "k.kind", "k.value").agg(F.count("*").alias("c"))
    )
    entropy = counted.groupBy("host", "path", "kind").agg(
        F.sum("c").alias("m"), F.sum(F.col("c") * F.log("c")).alias("s")
    ).withColumn("e", F.when(F.col("m") > 1, 1 - F.col("s") / (F.col("m") * F.log("m"))).otherwise(1.0))
    each = entropy.groupBy("host", "path").agg(
        F.max("m").alias("m"),
        F.sum(F.when(F.col("kind") == "shape", F.col("e") * PRESENTATION).otherwise(F.col("e") * (1 - PRESENTATION))).alias("importance"),
    )
    cut = each.where((F.col("importance") < IMPORTANCE) & (F.col("m") >= PAGES))
    return cut.groupBy("host").agg(F.collect_set("path").alias("low"))


def extract_text(pages: DataFrame, name: str = "text") -> DataFrame:
    """Adds the main text of every page; '' for null, empty or all-noise pages. Other columns
    stay; a column of that name is replaced. Nothing but noise is left out."""
    kept = [c for c in pages.columns if c != name]
    # Written, so that the planner knows its size: it is broadcast if small, and else joined
    # by a shuffle whose large hosts AQE splits.
    low = store(low_branches(pages), "branches")
    joined = pages.select(*kept, _host().alias("_tw_host")).join(
        low.withColumnRenamed("host", "_tw_of").withColumnRenamed("low", "_tw_low"), F.col("_tw_host") == F.col("_tw_of"), "left"
    )
    schema = pages.select(*kept).schema.add(name, "string")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            lows, cache = batch.column("_tw_low").to_pylist(), {}
            texts = [
                main_text(page, cache.setdefault(host, set(low or ())))
                for page, host, low in zip(batch.column("html").to_pylist(), batch.column("_tw_host").to_pylist(), lows)
            ]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(texts, pa.string())], [*kept, name])

    return joined.select(*kept, *([] if "html" in kept else ["html"]), "_tw_host", "_tw_low").mapInArrow(run, schema)
