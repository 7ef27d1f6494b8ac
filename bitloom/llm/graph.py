"""Connected components by union-find: local forests, merged hierarchically.

Every task turns its edges into a spanning forest (node -> smallest node of its local tree), which
is never larger than its number of nodes. While the forests are too large for one task, rounds of
large-star and small-star (joins and aggregates only) flatten them; then groups of FAN_IN forests
are merged until one is left.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bitloom.plans.materialize import checkpointed
from bitloom.plans.skew import lookup

#: Edges of a forest that a single task may hold.
MERGE_BOUND = 1_000_000
FAN_IN = 8
#: Edges after which a task writes out its forest and begins another.
LOCAL_BOUND = 2_000_000


def _local_forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    parent: dict[str, str] = {}

    def find(x: str) -> str:
        root = x
        while (up := parent.get(root, root)) != root:
            root = up
        while x != root:
            x_up = parent.get(x, x)
            parent[x] = root
            x = x_up
        return root

    def flat() -> pd.DataFrame:
        pairs = [(x, find(x)) for x in list(parent)]
        return pd.DataFrame([p for p in pairs if p[0] != p[1]], columns=["u", "v"])

    for batch in batches:
        for a, b in zip(batch["u"], batch["v"], strict=True):
            a, b = find(a), find(b)
            if a != b:
                # code points order like the UTF-8 bytes that Spark compares
                parent[max(a, b)] = min(a, b)
        if len(parent) >= LOCAL_BOUND:
            yield flat()
            parent.clear()
    if parent:
        yield flat()


def _forests(edges: DataFrame) -> DataFrame:
    return edges.mapInPandas(_local_forest, "u string, v string")


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step: every node points its larger neighbours (large) or its smaller ones (small) to
    the smallest of itself and its neighbours. The node set of each component is kept."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("__m"), F.count(F.lit(1)).alias("__n")).withColumn("__m", F.least("__m", "u"))
    seen = lookup(both, least, ["u"], "__n", F.col("v"))
    if large:
        out = seen.where("v > u").select(F.col("v").alias("u"), F.col("__m").alias("v"))
    else:
        out = seen.select(F.col("v").alias("u"), F.col("__m").alias("v")).unionByName(least.select("u", F.col("__m").alias("v")))
    return out.where("u <> v").distinct()


def _sum_of(edges: DataFrame) -> tuple[int, int]:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, merge_bound: int = MERGE_BOUND) -> DataFrame:
    """(node, root) for every node that isn't the smallest of its component.

    ``edges``: columns u, v, strings; repeated edges, loops and nulls are allowed (an edge with a
    null end is ignored). No edges give no rows.
    """
    edges = edges.select("u", "v").where("u <> v")
    forest = checkpointed(_forests(edges).distinct())
    count, total = _sum_of(forest)
    while count > merge_bound:
        forest = checkpointed(_star(checkpointed(_star(forest, large=True)), large=False))
        before, (count, total) = (count, total), _sum_of(forest)
        if before == (count, total):  # all trees are stars
            return forest.select(F.col("u").alias("node"), F.col("v").alias("root"))
    parts = max(1, min(forest.rdd.getNumPartitions(), -(-count // max(merge_bound // FAN_IN, 1))))
    while parts > 1:
        parts = -(-parts // FAN_IN)
        forest = _forests(forest.repartition(parts) if parts > 1 else forest.coalesce(1))
    else:
        forest = forest if count == 0 else _forests(forest.coalesce(1))
    return forest.select(F.col("u").alias("node"), F.col("v").alias("root"))
