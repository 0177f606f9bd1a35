"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from goldweave.session import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(lowest, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them; edges point from larger to smaller."""
    lowest = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(lowest, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct()


def _observed(edges: DataFrame, scratch: Scratch, table: str) -> tuple[DataFrame, tuple]:
    """Written edges, and a sum over them that two sets of edges share only if they are the same; one job makes both."""
    seen = Observation()
    digest = F.xxhash64("u", "v").cast("decimal(38,0)")
    written = scratch.save(edges.observe(seen, F.count(F.lit(1)).alias("edges"), F.sum(digest).alias("digest")), table)
    return written, (seen.get["edges"], seen.get["digest"])


def connected_components(edges: DataFrame, scratch: Scratch, name: str = "components") -> DataFrame:
    """(node, component) of every node with an edge; a component is named by its smallest node.

    ``edges`` has two id columns. Each round is one job, which writes its
    result to the shared folder and observes it; the loop ends with the round
    that changes nothing, when only stars are left.
    """
    a, b = edges.columns[:2]
    table = f"{name}-0"
    pairs = edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    current, seen = _observed(pairs, scratch, table)
    before, rounds = None, 0
    while seen != before and seen[0]:
        rounds += 1
        previous, table, before = table, f"{name}-{rounds}", seen
        current, seen = _observed(_small_star(_large_star(current)), scratch, table)
        scratch.drop(previous)
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def extended_components(known: DataFrame, edges: DataFrame, scratch: Scratch, name: str = "extended") -> DataFrame:
    """(node, component) of the nodes whose component new edges change: new nodes, and nodes of joined components.

    ``known`` (node, component) is the result for the edges so far. New edges
    become edges between its components, so the rounds run over as many nodes
    as the new edges touch, whatever the size of what is known.
    """
    a, b = edges.columns[:2]
    ends = scratch.save(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).distinct(), f"{name}-edges")
    touched = ends.select(F.col("u").alias("node")).union(ends.select("v")).distinct()
    labels = scratch.save(touched.join(known.select("node", "component"), "node", "left").select(
        "node", F.coalesce("component", "node").alias("label"), F.col("component").isNull().alias("new")), f"{name}-labels")
    end = lambda side: labels.select(F.col("node").alias(side), F.col("label").alias(f"{side}_label"))
    lifted = ends.join(end("u"), "u").join(end("v"), "v").select("u_label", "v_label")
    joined = scratch.save(connected_components(lifted, scratch, f"{name}-rounds").select(
        F.col("node").alias("label"), F.col("component").alias("root")), f"{name}-roots")
    new = labels.filter("new").join(joined, "label", "left").select("node", F.coalesce("root", "label").alias("component"))
    moved = known.join(joined.filter("label <> root").withColumnRenamed("label", "component"), "component").select("node", F.col("root").alias("component"))
    return moved.unionByName(new)
