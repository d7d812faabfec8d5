"""Connected components of a link table, by hooking and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blobs import Tables, written


def components(links: DataFrame) -> DataFrame:
    """(node, component), for every node of links (a, b); component is one node of its component.

    Each round hooks every node to the neighbour of the least hash, if that is
    less than its own, jumps once along the hooks, and renames the links' ends;
    links within one node go, so a round hands a fraction of its links on. The
    order by hash keeps the hooks short, whatever the order of the nodes.
    """
    tables, rounds = Tables(), []
    same = lambda a, b: links_.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a != b").distinct()
    links_ = links
    edges = tables.write(same("a", "b"))
    while edges.limit(1).count():
        ends = edges.select(F.col("a").alias("node"), F.col("b").alias("near")).union(edges.select("b", "a"))
        least = ends.groupBy("node").agg(F.min_by("near", F.xxhash64("near")).alias("near"))
        hook = least.select("node", F.when(F.xxhash64("near") < F.xxhash64("node"), F.col("near")).otherwise(F.col("node")).alias("up"))
        jumped = tables.write(hook.join(hook.select(F.col("node").alias("up"), F.col("up").alias("component")), "up").select("node", "component"))
        rounds.append(jumped)
        links_ = edges
        for x in ("a", "b"):
            links_ = links_.join(jumped.select(F.col("node").alias(x), F.col("component").alias(f"{x}_")), x)
        edges = tables.write(same("a_", "b_"))
    if not rounds:
        return written(edges.select(F.col("a").alias("node"), F.col("b").alias("component")))
    found = rounds.pop()
    while rounds:
        far = found.select(F.col("node").alias("component"), F.col("component").alias("far"))
        found = rounds.pop().join(far, "component", "left").select("node", F.coalesce("far", "component").alias("component"))
    found = written(found)
    tables.drop()
    return found
