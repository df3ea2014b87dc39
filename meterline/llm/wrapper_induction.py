"""Main text of web pages by wrapper induction.

The pages of a host are aligned with each other by simple tree matching: nodes match if their labels (tag and class) are
equal and their parents match, in page order: equal contents that stand once on either side first, then the largest sum of
matched nodes, in which equal contents count double; of equally good alignments that with the earlier pairs.  The aligned tree is the host's wrapper.  A node that
most pages have with the same content is template; the others are slots.  A page is then aligned with its host's wrapper,
template nodes are taken out, and the blocks of its article (``markup``) are its text.

Wrappers are learned from all pages: chunks of about ``CHUNK`` pages give one tree each, and trees are merged in chunks again
until a host has one, so that no task sees more than a chunk however many pages a host has.  What is shuffled for that are
labels and hashes, not pages.

Rows: NULL html counts as empty and gives an empty text; a page whose url is NULL or names no host has no template;
repeated rows are extracted each; a table without pages gives none.
"""

import json
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import small, written
from meterline.llm.markup import BLOCK, DROPPED, Node, article_blocks, parse

CHUNK = 64
#: A host with fewer pages has no template.
LEAST_PAGES = 5
#: Inside an article, what fewer pages share may be a passage that they quote.
LEAST_PAGES_INSIDE = 20
#: A template node is on this share of the host's pages, and this share of them agree on its content.
LEAST_SUPPORT = 0.5
LEAST_AGREEMENT = 0.9
#: Contents remembered for each node: any that more than one in ``CONTENTS + 1`` pages have is among them.
CONTENTS = 4
#: Nodes on fewer pages than this share are forgotten when trees are merged.
FORGOTTEN = 0.05
DEEPEST = 60


class Tree:
    """A node with a label, the number of pages that have it, and how many of them have which content."""

    __slots__ = ("children", "content", "contents", "label", "node", "support")

    def __init__(self, label: str, support: int, contents: dict[int, int], children: list["Tree"], node: Node | None = None):
        self.label, self.support, self.contents, self.children, self.node = label, support, contents, children, node
        #: The most frequent content.
        self.content = next(iter(contents)) if len(contents) == 1 else max(contents, key=contents.get)


def tree_of(node: Node, depth: int = 0) -> Tree:
    """Elements that can hold text, with a hash of their whole content.  Text is content of its element."""
    children, parts = [], []
    for child in node.children:
        if isinstance(child, str):
            parts.append(" ".join(child.split()))
        elif child.tag in DROPPED and child.tag not in ("nav", "footer", "aside", "form"):
            continue
        elif depth < DEEPEST:
            below = tree_of(child, depth + 1)
            parts.append(f"{below.label}{below.content}")
            if child.tag in BLOCK or below.children:
                children.append(below)
        else:
            parts.append(_text(child))
    style = node.named().get("class", "") if node.attributes else ""
    label = f"{node.tag}.{style}" if style else node.tag
    return Tree(label, 1, {crc32("\x00".join(filter(None, parts)).encode("utf-8", "surrogatepass")): 1}, children, node)


def _text(top: Node) -> str:
    parts, todo = [], [top]
    while todo:
        item = todo.pop()
        if isinstance(item, str):
            parts.append(item)
        else:
            todo += reversed(item.children)
    return " ".join(" ".join(parts).split())


def _weight(left: Tree, right: Tree) -> int:
    """Matched nodes below and including two nodes of one label; equal contents count double."""
    if left.label != right.label:
        return 0
    same = 1 if left.content == right.content else 0
    if not left.children or not right.children:
        return 1 + same
    return 1 + same + sum(_weight(a, b) for a, b in match(left.children, right.children))


def match(left: list[Tree], right: list[Tree]) -> list[tuple[Tree, Tree]]:
    """Pairs of children in order: equal ones at both ends, those whose content is on either side once, and between them the
    pairs with the largest weight."""
    labels = [tree.label for tree in left]
    if len(set(labels)) == len(labels) and labels == [tree.label for tree in right]:
        return list(zip(left, right, strict=True))
    pairs: list[tuple[Tree, Tree]] = []
    start = 0
    least = min(len(left), len(right))

    def equal(a: Tree, b: Tree) -> bool:
        """Pairing two such, first or last in their lists, cannot be beaten."""
        return a.label == b.label and a.content == b.content

    while start < least and equal(left[start], right[start]):
        pairs.append((left[start], right[start]))
        start += 1
    end = 0
    while end < least - start and equal(left[-1 - end], right[-1 - end]):
        end += 1
    tail = list(zip(left[len(left) - end :], right[len(right) - end :], strict=True))
    left, right = left[start : len(left) - end], right[start : len(right) - end]
    i = j = 0
    for a, b in [*_anchors(left, right), (len(left), len(right))]:
        if i < a and j < b:
            pairs += _aligned(left[i:a], right[j:b])
        if a < len(left):
            pairs.append((left[a], right[b]))
        i, j = a + 1, b + 1
    return pairs + tail


def _once(trees: list[Tree]) -> dict[tuple[str, int], int]:
    """Places of contents that occur once."""
    found: dict[tuple[str, int], int] = {}
    for at, tree in enumerate(trees):
        key = (tree.label, tree.content)
        found[key] = -1 if key in found else at
    return {key: at for key, at in found.items() if at >= 0}


def _anchors(left: list[Tree], right: list[Tree]) -> list[tuple[int, int]]:
    """Places of contents that both sides have once, as many as stand in the same order (the longest rising sequence)."""
    there = _once(right)
    shared = [(at, there[key]) for key, at in _once(left).items() if key in there]
    ends: list[int] = []  # smallest last place on the right of a sequence of each length
    last: list[int] = []
    before = []
    for n, (_, place) in enumerate(shared):
        k = bisect_left(ends, place)
        before.append(last[k - 1] if k else -1)
        ends[k : k + 1], last[k : k + 1] = [place], [n]
    found, n = [], last[-1] if last else -1
    while n >= 0:
        found.append(shared[n])
        n = before[n]
    return found[::-1]


def _aligned(left: list[Tree], right: list[Tree]) -> list[tuple[Tree, Tree]]:
    """The pairs in order with the largest weight, by the full table, a row at a time."""
    kinds: dict[str, int] = {}
    labels, contents = (
        [np.array([own(tree) for tree in trees], np.int64) for trees in (left, right)]
        for own in (lambda tree: kinds.setdefault(tree.label, len(kinds)), lambda tree: tree.content)
    )
    same = labels[0][:, None] == labels[1]
    weights = np.where(same, 1 + (contents[0][:, None] == contents[1]), 0)
    for i, j in zip(*np.nonzero(same), strict=True):
        if left[i].children and right[j].children:
            weights[i, j] = _weight(left[i], right[j])
    best = np.zeros((len(left) + 1, len(right) + 1), np.int64)
    for i in range(len(left) - 1, -1, -1):
        here = np.maximum(np.where(weights[i] > 0, weights[i] + best[i + 1, 1:], 0), best[i + 1, :-1])
        best[i, :-1] = np.maximum.accumulate(here[::-1])[::-1]
    pairs, i, j = [], 0, 0
    while i < len(left) and j < len(right):
        if weights[i, j] and best[i, j] == weights[i, j] + best[i + 1, j + 1]:
            pairs.append((left[i], right[j]))
            i, j = i + 1, j + 1
        elif best[i, j] == best[i + 1, j]:
            i += 1
        else:
            j += 1
    return pairs


def merged(left: Tree, right: Tree) -> Tree:
    """Both trees as one; nodes of only one of them stay, in order."""
    contents = dict(left.contents)
    for content, n in right.contents.items():
        contents[content] = contents.get(content, 0) + n
    if len(contents) > 4 * CONTENTS:
        # As many as the first content left out has are taken from each, as in the summary of Misra and Gries.
        ranked = sorted(contents.items(), key=lambda item: (-item[1], item[0]))
        contents = {c: n - ranked[CONTENTS][1] for c, n in ranked[:CONTENTS] if n > ranked[CONTENTS][1]} or dict(ranked[:1])
    children, i, j = [], 0, 0
    for a, b in match(left.children, right.children):
        while left.children[i] is not a:
            children.append(left.children[i])
            i += 1
        while right.children[j] is not b:
            children.append(right.children[j])
            j += 1
        children.append(merged(a, b))
        i, j = i + 1, j + 1
    children += left.children[i:] + right.children[j:]
    return Tree(left.label, left.support + right.support, contents, children)


def _kept(tree: Tree, least: float) -> list:
    children = [_kept(child, least) for child in tree.children if child.support >= least]
    return [tree.label, tree.support, [[c, n] for c, n in tree.contents.items()], children]


def written_form(tree: Tree) -> str:
    return json.dumps(_kept(tree, FORGOTTEN * tree.support), separators=(",", ":"))


def read_form(text: str, times: int = 1) -> Tree:
    """The written tree, or what as many copies of it give when they are merged."""

    def build(entry: list) -> Tree:
        label, support, contents, children = entry
        return Tree(label, support * times, {c: n * times for c, n in contents}, [build(child) for child in children])

    return build(json.loads(text))


def has_template(wrapper: Tree) -> bool:
    """Whether any node of the wrapper can be template; without one, no page needs to be aligned."""
    todo = [wrapper]
    while todo:
        node = todo.pop()
        enough = node.support >= max(LEAST_PAGES, LEAST_SUPPORT * wrapper.support)
        if enough and node.contents[node.content] >= LEAST_AGREEMENT * node.support:
            return True
        todo += node.children
    return False


def template_of(page: Tree, wrapper: Tree) -> set[int]:
    """Ids of the page's nodes that the wrapper has as template, those inside an article only with enough support."""
    found: set[int] = set()
    pages = wrapper.support
    if pages < LEAST_PAGES:
        return found
    todo = [(page, wrapper, False)]
    while todo:
        own, common, inside = todo.pop()
        inside = inside or own.node.tag in ("article", "main")
        enough = common.support >= max(LEAST_PAGES_INSIDE if inside else LEAST_PAGES, LEAST_SUPPORT * pages)
        if enough and own.content in common.contents and common.contents[own.content] >= LEAST_AGREEMENT * common.support:
            found.add(id(own.node))
        else:
            todo += [(a, b, inside) for a, b in match(own.children, common.children)]
    return found


def host_of(url: Column) -> Column:
    """The host in lower case without port; NULL if there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


_TREES = "host string, chunk bigint, tree string"


def _merge_chunk(trees: Iterable[tuple[str, int]]) -> str:
    wrapper = None
    for text, times in trees:
        tree = read_form(text, times)
        wrapper = tree if wrapper is None else merged(wrapper, tree)
    return written_form(wrapper)


def _summaries(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        trees = [written_form(tree_of(parse(source))) for source in batch["html"]]
        yield pd.DataFrame({"host": batch["host"], "chunk": batch["chunk"], "tree": trees})


def _merged_chunks(trees: DataFrame) -> DataFrame:
    """One tree for each chunk.  Equal trees are counted before the exchange, so that copies of a page are one row."""

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        tree = _merge_chunk(sorted(zip(group["tree"].tolist(), group["n"].tolist(), strict=True)))
        return pd.DataFrame({"host": [group["host"].iloc[0]], "chunk": [group["chunk"].iloc[0]], "tree": [tree]})

    counted = trees.groupBy("host", "chunk", "tree").agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy("host", "chunk").applyInPandas(merge, _TREES)


def host_wrappers(pages: DataFrame, url: str, source: str) -> DataFrame:
    """(host, tree): one wrapper for each host with at least ``LEAST_PAGES`` pages."""
    rows = pages.select(host_of(F.col(url)).alias("host"), F.col(url).alias("url"), F.coalesce(F.col(source), F.lit("")).alias("html"))
    rows = rows.where("host IS NOT NULL")
    sizes = rows.groupBy("host").agg(F.count(F.lit(1)).alias("pages")).where(F.col("pages") >= LEAST_PAGES)
    sizes = written(sizes, "host-sizes")
    most = sizes.agg(F.max("pages")).first()[0] or 0
    chunk = F.pmod(F.xxhash64("url", "html"), F.ceil(F.col("pages") / CHUNK)).alias("chunk")
    trees = rows.join(small(sizes), "host").select("host", chunk, "html").mapInPandas(_summaries, _TREES)

    trees = written(_merged_chunks(trees), "wrappers")
    chunks = -(-most // CHUNK)
    while chunks > 1:
        chunks = -(-chunks // CHUNK)
        fewer = trees.withColumn("chunk", F.pmod(F.xxhash64("chunk"), F.lit(chunks)))
        trees = written(_merged_chunks(fewer), "wrappers")
    return trees.select("host", "tree")


def extract_text(pages: DataFrame, key: str, url: str, source: str) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    wrappers = host_wrappers(pages, url, source)
    rows = pages.select(
        F.col(key).cast("bigint").alias("page_id"),
        F.col(url).alias("url"),
        host_of(F.col(url)).alias("host"),
        F.coalesce(F.col(source), F.lit("")).alias("html"),
    )
    joined = rows.join(small(wrappers), "host", "left").select("page_id", "url", "tree", "html")

    def extract(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        read: dict[str, Tree | None] = {}
        for batch in batches:
            texts = []
            for form, markup in zip(batch["tree"], batch["html"], strict=True):
                root = parse(markup)
                template: set[int] = set()
                if isinstance(form, str):
                    if form not in read:
                        if len(read) > 200:
                            read.clear()
                        wrapper = read_form(form)
                        read[form] = wrapper if has_template(wrapper) else None
                    if read[form] is not None:
                        template = template_of(tree_of(root), read[form])
                texts.append("\n\n".join(article_blocks(root, template)))
            yield pd.DataFrame(
                {"page_id": batch["page_id"].astype("Int64"), "url": batch["url"], "text": texts, "n_chars": [len(t) for t in texts]}
            )

    return joined.mapInPandas(extract, "page_id bigint, url string, text string, n_chars bigint")
