"""Connected components over billions of pairs, two ways.

``seed_tree_components`` prunes vertices round by round: each vertex points its
neighbourhood at the neighbourhood's minimum; vertices that are nobody's minimum drop out
as leaves of a propagation forest; seeds (the minima left over) then flow down the
forest, youngest round first. ``star_components`` alternates large-star and
small-star until the edges are stars around each component's minimum.

Both work on edge tables in the shared folder (lineage is cut each round, earlier
rounds are deleted), aggregate neighbourhoods with map-side partial minima (never
as lists), and join hot vertices where their edges lie, so a vertex with a third of all edges
is no bottleneck. Vertices that are no numbers are numbered once, in their order, so rounds exchange numbers only. A round is three writes
(seed tree) or two (stars); what it counts is counted while it is written, and nothing but counters reaches the driver.

Defined cases: null ends and self-pairs are ignored, repeated and turned pairs count once,
an empty table gives an empty result; vertex columns of any orderable type. A graph that needs more than ``MAX_ROUNDS`` rounds
raises an error; no unfinished result is returned.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..operators.skew import attach
from ..session import Scratch

MAX_ROUNDS = 60


def _both_ways(edges: DataFrame) -> DataFrame:
    turned = F.explode(F.array(F.struct(F.col("u"), F.col("v")), F.struct(F.col("v").alias("u"), F.col("u").alias("v"))))
    return edges.select(turned.alias("e")).select("e.u", "e.v")


def _counted(scratch: Scratch, df: DataFrame, tag: str, keep: Column | None = None, **counts: Column) -> tuple[DataFrame, dict[str, int]]:
    """Write a table and count while writing; rows that ``keep`` drops are counted but not written."""
    seen = Observation()
    observed = df.observe(seen, *(F.count(F.when(c, 1)).alias(name) for name, c in counts.items()))
    table = scratch.put(observed if keep is None else observed.filter(keep), tag)
    return table, seen.get


def _numbered(pairs: DataFrame, a: str, b: str, scratch: Scratch, settle: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``settle`` of the pairs (u, v, the smaller first), whose vertices are numbered in their order where they are no numbers."""
    kinds = {pairs.schema[c].dataType.typeName() for c in (a, b)}
    known = pairs.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a is not null and b is not null and a <> b")
    low, high = F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")
    if kinds == {"long"}:
        return settle(known.select(low, high).distinct())
    known = scratch.put(known.select(low, high).distinct(), "pairs")
    # a sorted table whose parts follow each other gets ascending numbers
    names = known.select(F.explode(F.array("u", "v")).alias("name")).distinct().orderBy("name")
    names = scratch.put(names.select("name", F.monotonically_increasing_id().alias("id")), "names")
    edges = attach(known, names.select(F.col("name").alias("u"), F.col("id").alias("x")), "u")
    edges = scratch.put(edges.select("x", "v"), "half")
    edges = attach(edges, names.select(F.col("name").alias("v"), F.col("id").alias("y")), "v")
    found = scratch.put(settle(edges.select(F.col("x").alias("u"), F.col("y").alias("v"))), "found")
    for tag in ("pairs", "half"):
        scratch.drop(tag)
    vertices = names.select(F.col("id").alias("vertex"), F.col("name").alias("vertex_name"))
    seeds = names.select(F.col("id").alias("component"), F.col("name").alias("component_name"))
    return attach(found.join(vertices, "vertex"), seeds, "component").select(F.col("vertex_name").alias("vertex"), F.col("component_name").alias("component"))


def seed_tree_components(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(vertex, component): every vertex of a pair with the smallest vertex it is linked to, directly or through others."""
    scratch = Scratch(pairs.sparkSession, "seed-tree")
    return _numbered(pairs, a, b, scratch, lambda edges: _seed_tree(edges, scratch))


def _seed_tree(edges: DataFrame, scratch: Scratch) -> DataFrame:
    every = F.lit(True)
    graph, counts = _counted(scratch, _both_ways(edges), "graph-0", total=every)
    forest: list[tuple[DataFrame, int]] = []
    for step in range(MAX_ROUNDS):
        if counts["total"] == 0:
            break
        # Minimum selection: every neighbour of u, and u, is pointed at the minimum of u's neighbourhood.
        least = graph.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        pointed = attach(graph, least, "u", total=counts["total"]).select(F.col("v").alias("u"), F.col("m").alias("v"))
        pointed, sizes = _counted(scratch, pointed.union(least.select("u", F.col("m").alias("v"))).distinct(), f"pointed-{step}", total=every)
        # Pruning: a vertex nobody is pointed at by itself leaves the graph as a child of its minimum.
        seen = pointed.groupBy("u").agg(
            F.min("v").alias("m"), F.count(F.lit(1)).alias("n"), F.max(F.col("u") == F.col("v")).alias("stays")
        )
        seen, leaving = _counted(scratch, seen, f"seen-{step}", total=~F.col("stays"))
        forest.append((seen.filter(~F.col("stays")).select(F.col("u").alias("vertex"), F.col("m").alias("parent")), leaving["total"]))
        wide = seen.filter("n > 1").select("u", "m")
        linked = attach(pointed, wide, "u", total=sizes["total"]).filter(F.col("v") != F.col("m")).select(F.least("m", "v").alias("u"), F.greatest("m", "v").alias("v"))
        graph, counts = _counted(scratch, _both_ways(linked.distinct()), f"graph-{step + 1}", total=every)
        for name in ("graph", "pointed"):
            scratch.drop(f"{name}-{step}")
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    # Propagation: a parent of round t leaves the graph later than t or never (then it is a seed).
    labelled: list[DataFrame] = []
    for step in reversed(range(len(forest))):
        tree, size = forest[step]
        found = tree.select("vertex", F.col("parent").alias("component"))
        if labelled:
            seeds = reduce(DataFrame.unionByName, labelled).select(F.col("vertex").alias("parent"), "component")
            found = attach(tree, seeds, "parent", "left", size).select("vertex", F.coalesce("component", "parent").alias("component"))
        labelled.append(scratch.put(found, f"labelled-{step}"))
        scratch.drop(f"seen-{step}")
    if not labelled:
        return graph.select(F.col("u").alias("vertex"), F.col("v").alias("component"))
    whole = reduce(DataFrame.unionByName, labelled)
    return whole.unionByName(whole.select(F.col("component").alias("vertex"), "component").distinct())


def star_components(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(vertex, component) as above, by alternating large-star and small-star."""
    scratch = Scratch(pairs.sparkSession, "stars")
    return _numbered(pairs, a, b, scratch, lambda edges: _stars(edges, scratch))


def _stars(edges: DataFrame, scratch: Scratch) -> DataFrame:
    every = F.lit(True)
    # edges run from the larger vertex u to the smaller vertex v
    edges, counts = _counted(scratch, edges.select(F.col("v").alias("u"), F.col("u").alias("v")), "edges-0", total=every, changed=every)
    for step in range(MAX_ROUNDS):
        if counts["changed"] == 0:
            break
        # large-star: larger neighbours of u go to the minimum of u's whole neighbourhood
        around = _both_ways(edges)
        least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = attach(around, least, "u", total=2 * counts["total"]).filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large, sizes = _counted(scratch, large.distinct(), f"large-{step}", total=every)
        # small-star: smaller neighbours of u, and u, go to the minimum of the smaller neighbours
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = attach(large, least, "u", total=sizes["total"]).filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = small.unionByName(least.select("u", F.col("m").alias("v"))).withColumn("new", F.lit(1))
        # one grouping makes the edges distinct and tells which were not there before, or are no longer
        both = new.unionByName(edges.withColumn("new", F.lit(0))).groupBy("u", "v").agg(F.max("new").alias("now"), F.min("new").alias("before"))
        fresh = F.col("now") == 1
        edges, counts = _counted(scratch, both, f"edges-{step + 1}", fresh, total=fresh, changed=F.col("now") == F.col("before"))
        edges = edges.select("u", "v")
        for name in ("edges", "large"):
            scratch.drop(f"{name}-{step}")
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return edges.select(F.col("u").alias("vertex"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("vertex"), F.col("v").alias("component")).distinct()
    )
