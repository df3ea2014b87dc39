"""Merkle manifest of a dataset: every document a leaf, a subroot for each source, one root.

Of the trees only every ``STORED_EVERY``-th level is stored.  A proof is made from the top down: the nodes of a stored level
that hang from one node of the next stored level (an aligned subtree of at most ``RUN ** STORED_EVERY`` nodes) are put
together in one row, the missing interior nodes are hashed again from them, the siblings on the way up are read off, and
the regenerated nodes are dropped.  Subtrees are all of one size, whatever the size of a source.

Rows: NULL in any column is the text ``-``; an empty text has the length 0 and is no NULL.  Rows without ``doc_id`` come
first in their source, rows without source form a source of their own that comes first.  Rows that share source and
``doc_id`` are leaves each, ordered by their digests; equal rows have equal leaves and stand beside each other, each with its
own proof.  A single leaf is its own subroot, a single source's subroot the root, and the proof without siblings is the
digest of nothing.  Texts of any length are hashed whole; a table without rows has no root and no proofs; columns beyond
the five are not read.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import let, numbered, written

#: Nodes that are hashed to one, and the distance of stored levels.
RUN = 16
STORED_EVERY = 2
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PATH = "array<struct<left:string,right:string>>"


def digest(value: Column) -> Column:
    return F.sha2(value.cast("binary"), 256)


def leaf(row: dict[str, Column]) -> Column:
    """The digest of a row's fields, each with its length in bytes, so that no two rows give the same input."""

    def field(name: str) -> Column:
        value = row[name].cast("string")
        return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))

    return digest(F.concat(*[field(name) for name in FIELDS]))


@dataclass(frozen=True)
class Tree:
    """Trees of one kind: (tree, pos, n, digest) of every stored level, the leaves first; of each tree the last one has its top."""

    levels: list[DataFrame]
    every: int


@dataclass(frozen=True)
class Manifest:
    documents: Tree
    sources: Tree
    root: str | None


def _hashed_runs(nodes: str) -> Column:
    """The next higher level of an array of nodes."""
    starts = F.sequence(F.lit(1), F.size(nodes), F.lit(RUN))
    return F.transform(starts, lambda start: digest(F.array_join(F.slice(nodes, start, RUN), "")))


def _blocks(level: DataFrame, every: int, *carried: str) -> DataFrame:
    """(tree, block, n, nodes0, nodes1, ...): an aligned subtree a row, with all its nodes by height, ``height`` of them hashed.

    ``items`` are the lowest nodes as structs in their order, with the ``carried`` columns.
    """
    block = F.expr(f"pos DIV {RUN**every}")
    grouped = level.groupBy("tree", block.alias("block")).agg(
        F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("pos", "digest", *carried))).alias("items")
    )
    grouped = grouped.withColumn("nodes0", F.col("items.digest"))
    height = F.lit(0)
    for k in range(every):
        grouped = grouped.withColumn(f"nodes{k + 1}", _hashed_runs(f"nodes{k}"))
        height = F.when(F.col("n") > RUN**k, k + 1).otherwise(height)
    return grouped.withColumn("height", height)


def _top(every: int) -> Column:
    """The node that a subtree hangs from; in a tree that ends below, its top."""
    return F.element_at(F.array(*[F.col(f"nodes{k}")[0] for k in range(every + 1)]), F.col("height") + 1)


def _siblings(index: Column, every: int) -> Column:
    """The siblings left and right on the way from the lowest node at ``index`` (from 0) to the top of its subtree."""

    def step(k: int) -> Column:
        own = F.floor(index / F.lit(RUN**k)).cast("int")
        place = F.pmod(own, F.lit(RUN))
        first = own - place + 1
        return F.struct(
            F.array_join(F.slice(f"nodes{k}", first, place), "").alias("left"),
            F.array_join(F.slice(f"nodes{k}", first + place + 1, F.lit(RUN - 1) - place), "").alias("right"),
        )

    return F.slice(F.array(*[step(k) for k in range(every)]).cast(PATH), F.lit(1), F.col("height"))


def grow(leaves: DataFrame, every: int = STORED_EVERY) -> Tree:
    """All trees over leaves (tree, pos, n, digest, ...), a written table; higher levels are written as they are made."""
    levels = [leaves]
    while (levels[-1].agg(F.max("n")).first()[0] or 0) > 1:
        above = _blocks(levels[-1], every).select(
            "tree",
            F.col("block").alias("pos"),
            F.expr(f"(n - 1) DIV {RUN**every} + 1").alias("n"),
            _top(every).alias("digest"),
        )
        levels.append(written(above, "merkle-level"))
    return Tree(levels, every)


def _joined(tree: Tree, k: int, above: DataFrame, *carried: str) -> DataFrame:
    """The subtrees of level ``k`` with ``path`` and further columns of the nodes they hang from."""
    blocks = _blocks(tree.levels[k], tree.every, *carried)
    return blocks.join(above.withColumnRenamed("pos", "block"), ["tree", "block"])


def descend(tree: Tree, tops: DataFrame) -> DataFrame:
    """(tree, pos, path, ...) of the lowest stored nodes but the leaves, from those of the tops.

    ``tops``: tree, pos = 0, the path from there on, and columns that each node of the tree takes along.
    """
    along = [F.col(name) for name in tops.columns if name not in ("tree", "pos", "path")]
    above = tops
    for k in reversed(range(1, len(tree.levels) - 1)):
        joined = _joined(tree, k, above)
        way = F.transform("items", lambda item, i: F.struct(item["pos"], F.concat(_siblings(i, tree.every), F.col("path")).alias("path")))
        above = written(joined.select("tree", *along, F.inline(way)), "merkle-paths")
    return above


def document_leaves(docs: DataFrame) -> DataFrame:
    """(tree, id, source, digest, tampered): ``tampered`` is the digest of the row with a text in lower case, for a fifth of the ids."""
    row = {name: F.col(name) for name in FIELDS}
    chosen = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0
    lowered = row | {"text": F.translate("text", UPPER, LOWER)}
    return docs.select(
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("tree"),
        F.col("doc_id").alias("id"),
        leaf(row).alias("digest"),
        F.when(chosen, leaf(lowered)).alias("tampered"),
    )


def build(docs: DataFrame, every: int = STORED_EVERY) -> Manifest:
    """The manifest of documents with the columns ``FIELDS``; every stored level is a table in the shared folder."""
    leaves = written(document_leaves(docs), "merkle-leaves")
    ordered = numbered(leaves, "tree", F.col("id").asc_nulls_first(), F.col("digest"))
    documents = grow(written(ordered, "merkle-level"), every)
    subroots = documents.levels[-1].select(F.lit("").alias("tree"), F.col("tree").alias("id"), "digest")
    sources = grow(written(numbered(written(subroots, "subroots"), "tree", F.col("id")), "merkle-level"), every)
    top = sources.levels[-1].first()
    return Manifest(documents, sources, top["digest"] if top else None)


def _folded(path: Column, start: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, start, lambda node, step: digest(F.concat(step["left"], node, step["right"])))


def _proof(path: Column) -> Column:
    return digest(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""))


def _leaf_rows(tree: Tree, above: DataFrame, carried: tuple[str, ...], body, *along: Column) -> DataFrame:
    """``body`` of the item and its path up to the last top, for each leaf; paths do not outlive the expression."""
    if len(tree.levels) == 1:  # every tree is a single leaf, and what is above are the leaves themselves
        alone = tree.levels[0].join(above.drop("pos"), "tree")
        return alone.select(*along, F.inline(F.array(body(F.struct("digest", *carried), F.col("path")))))
    joined = _joined(tree, 0, above, *carried)

    def row(item: Column, i: Column) -> Column:
        return let(F.concat(_siblings(i, tree.every), F.col("path")), lambda path: body(item, path))

    return joined.select(*along, F.inline(F.transform("items", row)))


def prove(manifest: Manifest) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: a row for each document.

    ``proof_sha256`` is the digest of all siblings from the leaf to the root.  ``folded_root`` starts at the tampered leaf
    where there is one, and ``verified`` tells whether it is the root.
    """
    empty = F.array().cast(PATH).alias("path")
    last = manifest.sources.levels[-1].select("tree", "pos", empty)
    paths = _leaf_rows(
        manifest.sources,
        descend(manifest.sources, last),
        ("id",),
        lambda item, path: F.struct(item["id"].alias("tree"), item["digest"].alias("subroot"), path.alias("path")),
    )
    tops = written(paths.select("tree", F.lit(0).cast("bigint").alias("pos"), "subroot", "path"), "merkle-paths")
    found = _leaf_rows(
        manifest.documents,
        descend(manifest.documents, tops),
        ("id", "tampered"),
        lambda item, path: F.struct(
            item["id"].alias("doc_id"),
            item["digest"].alias("leaf"),
            _proof(path).alias("proof_sha256"),
            _folded(path, F.coalesce(item["tampered"], item["digest"])).alias("folded_root"),
        ),
        F.col("subroot"),
    )
    root = F.lit(manifest.root).cast("string")
    return found.select(
        "doc_id", "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == root).alias("verified")
    )
