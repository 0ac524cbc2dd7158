"""Parents, children and chains."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from snapbook.operators.asof import first_per
from snapbook.session import cut


def expand_children(roots: DataFrame, nodes: DataFrame, depth: int = 2, node: str = "operation_id",
                    parent: str = "parent_id") -> DataFrame:
    """Roots at level 0 and their descendants down to ``depth``, with the level as a column.

    Every level is written out before the next one is looked for. Its size is then known, so the few rows of a
    day's roots are broadcast and the node table is only scanned; a large level joins by shuffle.
    """
    level = cut(roots.withColumn("level", F.lit(0)))
    out = level
    for step in range(1, depth + 1):
        above = level.select(F.col(node).alias(parent))
        level = nodes.join(above, parent).select(*roots.columns).withColumn("level", F.lit(step))
        if step < depth:
            level = cut(level)
        out = out.unionByName(level)
    return out


def expand_parents(links: DataFrame, edges: DataFrame, step: int = 10, rounds: int = 2) -> DataFrame:
    """Copy every (register type, account type) link to the parent register types.

    Each round adds ``step`` to the priority. From the second round on only links made by an earlier
    round (priority >= ``step``) are lifted. The same pair may stay with several priorities.
    """
    out = links.distinct()
    for turn in range(rounds):
        base = out if turn == 0 else out.filter(F.col("priority") >= step * turn)
        lifted = base.join(edges, base.register_type_id == edges.child_id).select(
            F.col("parent_id").alias("register_type_id"),
            "account_type_id",
            (F.col("priority") + step).alias("priority"),
        )
        out = out.unionByName(lifted.distinct())
    return out


def resolve_chains(links: DataFrame, node: str, prev: str) -> tuple[DataFrame, DataFrame]:
    """Root and depth of every node of a set of chains given by a previous-node column, and the nodes that have no root.

    Pointer doubling: every round joins each node with its current ancestor, so a chain of length n
    takes log2(n) rounds. A round after which as many nodes are open as before leaves only those whose way ends in a cycle. They come in
    the second frame: the node, ``base_id`` (smallest node of its cycle), ``cycle_length``, and ``on_cycle`` (false for a node that leads into it).

    Both sides of these joins grow with the links, so they are merged: a broadcast in every round would pass the whole set through the driver each time.
    """
    known = links.select(F.col(node).alias("_up"), F.lit(True).alias("_known")).distinct()
    # A previous node that is not in the set itself is a root.
    state = links.select(
        F.col(node),
        F.coalesce(F.col(prev), F.col(node)).alias("root"),
        F.when(F.col(prev).isNull(), F.lit(0)).otherwise(F.lit(1)).cast("long").alias("level"),
    ).distinct()
    state = state.join(known.hint("merge"), state.root == known._up, "left").select(
        node, "root", "level", (F.col("_known").isNotNull() & (F.col("level") > 0)).alias("open")
    )
    before, steps = -1, 1
    while True:
        state = cut(state)
        left = state.filter("open").count()
        if left == 0 or left == before and steps >= left:
            break
        before, steps = left, 2 * steps
        up = state.select(
            F.col(node).alias("_up"),
            F.col("root").alias("_root"),
            F.col("level").alias("_level"),
            F.col("open").alias("_open"),
        )
        state = state.join(up.hint("merge"), state.root == up._up, "left").select(
            node,
            F.when(F.col("open"), F.col("_root")).otherwise(F.col("root")).alias("root"),
            F.when(F.col("open"), F.col("level") + F.col("_level")).otherwise(F.col("level")).alias("level"),
            (F.col("open") & F.col("_open")).alias("open"),
        )
    return state.filter(~F.col("open")).drop("open"), _cycles(links, state.filter("open"), left, node, prev)


def _cycles(links: DataFrame, stuck: DataFrame, count: int, node: str, prev: str) -> DataFrame:
    """Nodes that ``count`` or more steps up have not led to a root. Where such a walk ends is on a cycle, and every cycle node is such an end."""
    ring = stuck.select(F.col("root").alias(node)).distinct()
    walk = cut(links.join(ring.hint("merge"), node, "left_semi").select(node, F.col(prev).alias("_at"), F.least(node, prev).alias("base_id")).distinct())
    steps = 1
    while steps < count:
        # The smallest node on the way, over twice as many steps each round.
        ahead = walk.select(F.col(node).alias("_up"), F.col("_at").alias("_next"), F.col("base_id").alias("_low"))
        walk = cut(walk.join(ahead.hint("merge"), walk._at == ahead._up).select(node, F.col("_next").alias("_at"), F.least("base_id", "_low").alias("base_id")))
        steps *= 2
    sized = walk.join(walk.groupBy("base_id").agg(F.count(F.lit(1)).alias("cycle_length")).hint("merge"), "base_id")
    ends = sized.select(F.col(node).alias("_end"), "base_id", "cycle_length")
    on = sized.select(node, F.lit(True).alias("on_cycle"))
    found = stuck.join(ends.hint("merge"), stuck.root == ends._end).join(on.hint("merge"), node, "left")
    return cut(found.select(node, "base_id", "cycle_length", F.coalesce("on_cycle", F.lit(False)).alias("on_cycle")))


def chain_roots(links: DataFrame, node: str, prev: str) -> DataFrame:
    """As ``resolve_chains`` where a cycle is an error."""
    roots, cycles = resolve_chains(links, node, prev)
    if not cycles.isEmpty():
        raise ValueError("the chains contain a cycle")
    return roots


def chain_latest(series: DataFrame, asof: date) -> DataFrame:
    """For every chain member, the highest member of its chain that has been switched to by the date.

    ``series`` has ``pledge_id, switch_date, level, base_id``; a missing switch date counts as long ago.
    """
    day = F.lit(asof).cast("date")
    reached = series.filter(F.col("switch_date").isNull() | (F.col("switch_date") <= day))
    top = first_per(
        reached, "base_id", [F.col("level").desc_nulls_last(), F.col("pledge_id").desc_nulls_last()]
    ).select("base_id", F.col("pledge_id").alias("current_id"))
    return series.select("pledge_id", "base_id").join(top, "base_id").select("pledge_id", "current_id")
