"""Clusters from merge edges, with a guard against weak chains."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.operators.components import components
from rollcall.storage import materialise

# A cluster may outgrow this size only by edges of this score or more.
MAX_SIZE, SURE = 12, 0.92


def greedy(edges: list[tuple[int, int, float]], max_size: int = MAX_SIZE, sure: float = SURE) -> tuple[dict[int, int], int]:
    """The smallest member of each node's cluster, and the number of edges refused. Edges are taken by score, the highest first, then by ends."""
    parent: dict[int, int] = {}
    size: dict[int, int] = {}

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    refused = 0
    for a, b, score in sorted(edges, key=lambda e: (-e[2], e[0], e[1])):
        for x in (a, b):
            parent.setdefault(x, x)
            size.setdefault(x, 1)
        a, b = find(a), find(b)
        together = size[a] if a == b else size[a] + size[b]
        if together > max_size and score < sure:
            refused += 1
        elif a != b:
            a, b = min(a, b), max(a, b)
            parent[b], size[a] = a, size[a] + size[b]
    return {x: find(x) for x in parent}, refused


def clusters(edges: DataFrame, ids: DataFrame, max_size: int = MAX_SIZE, sure: float = SURE) -> tuple[DataFrame, DataFrame]:
    """(id, cluster_id) for every id, cluster_id the smallest member; and (component, refused) of components where edges were refused.

    edges: a, b, score. A component of max_size nodes or fewer cannot trip the guard, nor can one whose edges
    are all sure, so it is a cluster as it stands; only the others are re-run edge by edge, each by itself.
    """
    edges = materialise(edges.select("a", "b", "score"))
    roots = components(edges.select(F.col("a").alias("u"), F.col("b").alias("v")))
    labelled = materialise(ids.select("id").join(roots, F.col("id") == F.col("node"), "left").select("id", F.coalesce("root", "id").alias("root")))
    of_edges = edges.join(labelled, F.col("a") == F.col("id")).select("a", "b", "score", "root")
    risky = of_edges.groupBy("root").agg(F.min("score").alias("least")).where(F.col("least") < sure).join(labelled.groupBy("root").count().where(F.col("count") > max_size), "root").select("root")
    risky = materialise(risky)

    def rerun(pdf: pd.DataFrame) -> pd.DataFrame:
        label, refused = greedy(list(zip(pdf.a.tolist(), pdf.b.tolist(), pdf.score.tolist())), max_size, sure)
        return pd.DataFrame({"root": pdf.root.iloc[0], "node": list(label), "label": list(label.values()), "refused": refused}, columns=["root", "node", "label", "refused"])

    again = materialise(of_edges.join(risky, "root").groupBy("root").applyInPandas(rerun, "root long, node long, label long, refused long"))
    found = labelled.join(again.select(F.col("node").alias("id"), "label"), "id", "left").select("id", F.coalesce("label", "root").alias("cluster_id"))
    return found, again.groupBy(F.col("root").alias("component")).agg(F.max("refused").alias("refused"))


def profile(found: DataFrame, top: int = 5) -> DataFrame:
    """Number of clusters, and the sizes of the largest ones."""
    sizes = found.groupBy("cluster_id").count()
    largest = sizes.orderBy(F.desc("count"), "cluster_id").limit(top).agg(F.sort_array(F.collect_list("count"), False).alias("largest"))
    return sizes.agg(F.count("*").alias("clusters")).join(F.broadcast(largest))
