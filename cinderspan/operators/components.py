"""Connected components by minimum hooking, pointer jumping and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinderspan.session import cut


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Label each node of an undirected graph with the smallest node it reaches.

    Input: one row per link, ends of any one orderable type; nulls, loops and repeated
    links are ignored (a loop still names its node). Output: ``node, component``, one row
    per node that occurs. An empty input gives an empty output.

    Each round hooks every component to its smallest neighbour, resolves the chains by
    pointer jumping and contracts the links, so components at least halve per round. Tables
    between rounds are written to the shared folder. Minima use map-side partial
    aggregation; the relabelling joins are plain equi-joins that adaptive execution splits
    when one node holds many links.
    """
    both = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a is not null and b is not null")
    links = cut(both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc-links")
    labels = links.select(F.col("a").alias("node")).union(links.select("b")).distinct().select("node", F.col("node").alias("component"))
    live = links.where("a <> b")
    while not live.isEmpty():
        parent = cut(
            live.select(F.col("b").alias("node"), F.col("a").alias("to")).groupBy("node").agg(F.min("to").alias("parent")),
            "cc-parent",
        )
        while True:
            up = parent.select(F.col("node").alias("parent"), F.col("parent").alias("upper"))
            jumped = cut(
                parent.join(up, "parent", "left").select(
                    "node", F.coalesce("upper", "parent").alias("parent"), F.col("upper").isNotNull().alias("moved")
                ),
                "cc-jump",
            )
            parent = jumped.select("node", "parent")
            if jumped.where("moved").isEmpty():
                break
        labels = cut(
            labels.join(parent.select(F.col("node").alias("component"), "parent"), "component", "left").select(
                "node", F.coalesce("parent", "component").alias("component")
            ),
            "cc-labels",
        )
        a, b = (parent.select(F.col("node").alias(x), F.col("parent").alias(f"{x}_up")) for x in "ab")
        live = (
            live.join(a, "a", "left")
            .join(b, "b", "left")
            .select(F.coalesce("a_up", "a").alias("a"), F.coalesce("b_up", "b").alias("b"))
            .where("a <> b")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            .distinct()
        )
        live = cut(live, "cc-live")
    return labels.select("node", "component")
