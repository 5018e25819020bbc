"""Connected components of an edge table, by hooking to smaller neighbours, jumping to roots and contracting."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import small_side, staged


def rooted(hooks: DataFrame, label: str) -> tuple[DataFrame, int]:
    """(hooks, jumps): the acyclic pointers (node, to) followed to their ends, each jump doubling the links that are followed."""
    jumps = 0
    while True:
        side = small_side(hooks).select(F.col("node").alias("to"), F.col("to").alias("next"))
        after = staged(hooks.join(side, "to", "left").select("node", F.coalesce("next", "to").alias("to"), F.isnotnull("next").alias("moved")), f"{label}-hooks")
        hooks, jumps = after.select("node", "to"), jumps + 1
        if after.filter("moved").isEmpty():
            return hooks, jumps


def connected_components(edges: DataFrame, label: str = "cc", report: Callable[[int, int], None] | None = None) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of edges (a long, b long).

    Each round, every node with a neighbour of a lower rank hooks to the lowest one; hooks are followed to their roots (log of the longest
    chain of hooks in joins, whatever the chain), and the edges between roots are renamed and made distinct, until none is left. Ranks are the
    ids themselves, so that a chain of ascending ids or a star is done in one or two rounds; from the third round on every other round ranks
    by a hash of the id and the round: a node that still has a neighbour is then a root with a chance of a half at most, so that
    no graph takes more than about 2 * log2(nodes) rounds. Only minima are aggregated, so a node with very many neighbours costs one row for
    each task. A node hooks once at most, so the rounds' hooks together hold each node once; they are put together from the last round back.
    Hooks are broadcast while a count shows them to be few. Tables are written to the shared folder. report(rounds, jumps), if given, is told
    how many there were.
    """
    distinct = lambda df, a, b: df.filter(F.col(a) != F.col(b)).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()
    current = staged(distinct(edges, "a", "b"), f"{label}-edges")
    start, done, jumps = current, [], 0
    while not current.isEmpty():
        n = len(done)
        rank = (lambda c, n=n: F.xxhash64(F.lit(n), c)) if n > 1 and n % 2 == 0 else (lambda c: F.col(c))
        ends = lambda c, r=rank: F.struct(r(c).alias("rank"), F.col(c).alias("id"))
        lower: Column = F.least(ends("a"), ends("b"))
        upper: Column = F.greatest(ends("a"), ends("b"))
        hooks = current.select(upper["id"].alias("node"), lower.alias("low")).groupBy("node").agg(F.min("low").alias("low")).select("node", F.col("low.id").alias("to"))
        hooks, more = rooted(staged(hooks, f"{label}-hooks"), label)
        done.append(hooks)
        jumps += more
        side = small_side(hooks)
        to = lambda c: side.select(F.col("node").alias(c), F.col("to").alias(f"{c}_to"))
        renamed = current.join(to("a"), "a", "left").join(to("b"), "b", "left").select(F.coalesce("a_to", "a").alias("a"), F.coalesce("b_to", "b").alias("b"))
        current = staged(distinct(renamed, "a", "b"), f"{label}-edges")
    if report:
        report(len(done), jumps)
    if not done:
        return start.select(F.col("a").alias("node"), F.col("b").alias("component"))
    root = done.pop()
    while done:
        earlier = done.pop()
        side = small_side(root).select(F.col("node").alias("to"), F.col("to").alias("next"))
        root = staged(earlier.join(side, "to", "left").select("node", F.coalesce("next", "to").alias("to")).union(root), f"{label}-roots")
    # A root need not be the smallest node of its component.
    least = root.groupBy("to").agg(F.least(F.min("node"), F.col("to")).alias("component"))
    named = root.join(small_side(staged(least, f"{label}-least")), "to").select("node", "component")
    return staged(named.union(least.select(F.col("to").alias("node"), "component")), f"{label}-nodes")
