"""Iterative DataFrame jobs on graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumenframe.functions.scale import cut, measured


def provenance_leaves(edges: DataFrame, roots: DataFrame, *, max_depth: int | None = None, max_files: int | None = None) -> DataFrame:
    """Files without further provenance reached from each root, in depth-first order.

    ``edges`` is ``(parent, child, ord)``. Each level is one join of the frontier with the
    edge table; a path of ordinals keeps the order. A file counts once per root, at its first
    place: a later path to it is followed only if it comes before the one known, so shared parts
    are not walked twice and a cycle ends. The walk goes on until no path is left; ``max_depth``
    and ``max_files`` are optional limits of a product.
    """
    step = edges.select(F.col("parent").alias("node"), "child", F.col("ord").cast("bigint").alias("ord"))
    front = roots.select("root", F.col("root").alias("node"), F.array().cast("array<bigint>").alias("path"), F.lit(0).alias("depth")).distinct()
    front = cut(front)
    best, depth = front, 0
    while max_depth is None or depth < max_depth:
        depth += 1
        new = front.join(step, "node").select("root", F.col("child").alias("node"), F.array_append("path", F.col("ord")).alias("path"))
        new = new.groupBy("root", "node").agg(F.min("path").alias("path"))
        known = best.select("root", "node", F.col("path").alias("was"))
        new = new.join(known, ["root", "node"], "left").where("was IS NULL OR path < was").drop("was")
        front = cut(new.withColumn("depth", F.lit(depth)))
        if front.isEmpty():
            break
        both = best.unionByName(front).groupBy("root", "node").agg(F.min(F.struct("path", "depth")).alias("m"))
        best = cut(both.select("root", "node", "m.path", "m.depth"))
    first = best.join(step.select("node").distinct(), "node", "left_anti")
    rank = F.row_number().over(Window.partitionBy("root").orderBy("path"))
    out = first.withColumn("position", rank)
    if max_files is not None:
        out = out.where(F.col("position") <= max_files)
    return out.select("root", "node", "depth", "position")


def components(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Connected components: ``(id, comp)`` with the smallest id as the component's number.

    Every round hooks each component to its smallest neighbour component and follows the
    hooks to their roots, on the contracted graph only. The number of components that still
    have edges at least halves, so rounds grow with the logarithm of the graph, also for one
    huge component. Rounds are cut by reliable checkpoints; only counts reach the driver.
    """
    labels = cut(vertices.select("id", F.col("id").alias("comp")))
    live = cut(
        edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
        .unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        .where("u <> v")
        .distinct()
    )
    while not live.isEmpty():
        # Contracted vertices and the smaller neighbour each one hooks to.
        hook = cut(live.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("p")))
        while True:
            up = hook.select(F.col("u").alias("p"), F.col("p").alias("pp"))
            jumped = cut(hook.join(up, "p", "left").select("u", F.coalesce("pp", "p").alias("p"), (F.coalesce("pp", "p") != F.col("p")).alias("moved")))
            hook = jumped.select("u", "p")
            if jumped.where("moved").isEmpty():
                break
        to = measured(hook.where("u <> p"))
        labels = cut(labels.join(to.select(F.col("u").alias("comp"), "p"), "comp", "left").select("id", F.coalesce("p", "comp").alias("comp")))
        live = (
            live.join(to.select("u", F.col("p").alias("pu")), "u", "left")
            .select(F.coalesce("pu", "u").alias("u"), "v")
            .join(to.select(F.col("u").alias("v"), F.col("p").alias("pv")), "v", "left")
            .select("u", F.coalesce("pv", "v").alias("v"))
        )
        live = cut(live.where("u <> v").distinct())
        to.unpersist()
    return labels
