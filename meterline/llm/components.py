"""Connected components of a table of links."""

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import written


def _forest(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per batch, each node's smallest reachable node: the same components with fewer links."""
    for batch in batches:
        parent: dict = {}

        def root(node, parent=parent):
            top = node
            while parent.setdefault(top, top) != top:
                top = parent[top]
            while parent[node] != top:
                parent[node], node = top, parent[node]
            return top

        for left, right in zip(batch["node"].tolist(), batch["other"].tolist(), strict=True):
            a, b = root(left), root(right)
            if a != b:
                parent[max(a, b)] = min(a, b)
        nodes = [node for node in parent if root(node) != node]
        yield pd.DataFrame({"node": nodes, "other": [root(node) for node in nodes]}).astype(batch.dtypes.to_dict())


def _signature(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("node", "other").cast("decimal(38,0)"))).first()
    return tuple(row)


def _starred(links: DataFrame) -> DataFrame:
    """One round: larger neighbours of each node move to its smallest neighbour, then smaller ones do."""
    both = links.unionByName(links.select(F.col("other").alias("node"), F.col("node").alias("other")))
    smallest = both.groupBy("node").agg(F.min("other").alias("least"))
    smallest = smallest.select("node", F.least("node", "least").alias("least"))
    larger = both.join(smallest, "node").where("other > node")
    links = written(larger.select(F.col("other").alias("node"), F.col("least").alias("other")).distinct(), "large-star")
    smallest = links.groupBy("node").agg(F.min("other").alias("least"))
    moved = links.join(smallest, "node")
    return written(
        moved.where("other <> least")
        .select(F.col("other").alias("node"), F.col("least").alias("other"))
        .unionByName(smallest.select("node", F.col("least").alias("other")))
        .distinct(),
        "small-star",
    )


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, root) for every node with a link; ``root`` is the smallest node of its component.

    Links may repeat, point either way or to the node itself; rows with a NULL end are no links.  Links are first thinned
    to a forest inside each batch.  Then the alternating star rounds halve the longest path each time; they end when a
    round changes nothing.  Nodes of any type with an order.  No links give no rows.
    """
    kind = dict(links.dtypes)[left]
    ends = links.select(F.col(left).alias("node"), F.col(right).alias("other")).where("node <> other")
    ends = ends.mapInPandas(_forest, f"node {kind}, other {kind}").where("node > other")
    current = written(ends.distinct(), "links")
    before = _signature(current)
    while before[0]:
        current = _starred(current)
        after = _signature(current)
        if after == before:
            break
        before = after
    named = current.groupBy("node").agg(F.min("other").alias("root"))
    return named.unionByName(current.select(F.col("other").alias("node"), F.col("other").alias("root")).distinct())
