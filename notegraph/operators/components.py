"""Connected components by alternating large and small stars, and joins that no key dominates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notegraph.session import Scratch, materialize

#: A key with more than one in so many of a table's rows is heavy, so there are fewer heavy keys than that.
SHARE, LEAST = 500, 100_000


def even_left_join(left: DataFrame, right: DataFrame, key: str, rows: int, counts: DataFrame | None = None) -> DataFrame:
    """``left``, of so many rows at most, joined with ``right``, which has one row per key at most; keys without one get nulls.

    Heavy keys of ``left``, fewer than `SHARE`, get their rows by broadcast, so their rows stay where they are; only the
    others are shuffled. ``counts (key, n)`` are ``left``'s rows by key, where they are known already.
    """
    if rows <= LEAST:
        return left.join(right, key, "left")
    if counts is None:
        counts = left.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    most, n = counts.agg(F.max("n"), F.sum("n")).first()
    least = max((n or 0) // SHARE, LEAST)
    if (most or 0) <= least:
        return left.join(right, key, "left")
    heavy = [r[0] for r in counts.where(F.col("n") > least).select(key).collect()]
    some = F.col(key).isin(heavy)
    rest = F.coalesce(~some, F.lit(True))
    return left.where(rest).join(right, key, "left").unionByName(left.where(some).join(F.broadcast(right.where(some)), key, "left"))


def components(edges: DataFrame) -> DataFrame:
    """``edges (src, dst)`` to ``(node, component)``, the smallest node of each.

    An edge points from its larger node to its smaller one. A large star hangs a node's larger neighbours on its smallest
    one, a small star does so with the smaller ones; in turns they halve paths and leave, in the end, one star a
    component. Rounds are few (logarithmic on chains). Each is written to the shared folder, so lost executors cost one
    round at most. A hub's edges are not gathered: minima are combined before the shuffle, and go to a hub's many edges
    by `even_left_join`. Edges of a node with itself make it a component of its own.

    A small star comes first. Nodes without larger neighbours are leaves behind it, so they wait for their neighbour's
    component while the rounds go on without them; of a two-sided graph, whose one side is above the other, that is a side.
    """
    scratch = Scratch(edges.sparkSession, "components")
    given = scratch.write(edges.select(F.greatest("src", "dst").alias("hi"), F.least("src", "dst").alias("lo")), "given")
    now, n = given.where("hi <> lo"), given.count()
    inner = now.select(F.col("lo").alias("hi")).distinct().withColumn("inner", F.lit(True))
    first = scratch.write(now.groupBy("hi").agg(F.min("lo").alias("m"), F.count("*").alias("n")).join(inner, "hi", "left"), "first")
    leaves = first.where("inner is null").select("hi", "m")
    now = scratch.write(_small_star(now, first, n, first.where("inner")), "edges")
    n, stars = now.count(), None
    while n:
        # large star: an edge's lower end moves to that node's own smallest neighbour
        below = now.groupBy(F.col("hi").alias("lo")).agg(F.min("lo").alias("far"))
        moved = even_left_join(now, below, "lo", n).groupBy("hi", F.coalesce("far", "lo").alias("lo")).agg(F.max(F.col("far").isNotNull()).alias("moved"))
        moved = scratch.write(moved, "moved")
        below = scratch.write(moved.groupBy("hi").agg(F.min("lo").alias("m"), F.count("*").alias("n"), F.bool_or("moved").alias("moved")), "below")
        n, most, open_ = below.agg(F.sum("n"), F.max("n"), F.bool_or("moved")).first()
        if most == 1 and not open_:
            stars = moved.select(F.col("hi").alias("m"), F.col("lo").alias("component"))
            break
        now = scratch.write(_small_star(moved.select("hi", "lo"), below, n, below), "edges")
    if stars is not None:
        leaves = even_left_join(leaves, stars, "m", first.count()).select("hi", "m", F.coalesce("component", "m").alias("component"))
    else:
        leaves = leaves.withColumn("component", F.col("m"))
    every = leaves.select(F.col("hi").alias("node"), "component").union(leaves.select("m", "component")).union(given.where("hi = lo"))
    if stars is not None:
        every = every.union(stars).union(stars.select("component", "component"))
    out = materialize(every.groupBy("node").agg(F.min("component").alias("component")), "components")
    scratch.close()
    return out


def _small_star(now: DataFrame, below: DataFrame, n: int, kept: DataFrame) -> DataFrame:
    """Of a node's lower neighbours all but the smallest hang on that one, and so do the nodes ``kept``.

    ``below (hi, m, n)``: each node's smallest lower neighbour and how many it has.
    """
    hung = even_left_join(now, below.select("hi", "m"), "hi", n, below.select("hi", "n")).where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return hung.unionByName(kept.select("hi", F.col("m").alias("lo"))).distinct()
