"""Dependency closure over an edge table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetloom.session import checkpointed


def closure(edges: DataFrame, seeds: DataFrame, source: str, target: str, max_rounds: int | None = None) -> DataFrame:
    """Nodes reached from the seeds along ``source -> target``, with the fewest steps (seeds are 0).

    Breadth-first: each round joins the newest nodes with the edges, drops those already seen and is
    checkpointed, so cycles end and the plan stays one round deep.
    """
    frontier = checkpointed(seeds.select(F.col(seeds.columns[0]).alias("node")).distinct())
    seen = frontier.withColumn("steps", F.lit(0))
    rounds = 0
    while max_rounds is None or rounds < max_rounds:
        rounds += 1
        reached = (
            frontier.join(edges, frontier.node == edges[source])
            .select(edges[target].alias("node"))
            .distinct()
            .join(seen.select("node"), "node", "left_anti")
        )
        frontier = checkpointed(reached)
        if frontier.isEmpty():
            break
        seen = seen.unionByName(frontier.withColumn("steps", F.lit(rounds)))
        if rounds % 20 == 0:
            seen = checkpointed(seen)
    return seen


def select_targets(nodes: DataFrame, names: Sequence[str] = (), tags: Sequence[str] = ()) -> DataFrame:
    """Nodes chosen by name or by tag; everything when neither is given."""
    if not names and not tags:
        return nodes.select("node")
    hit = F.lit(False)
    if names:
        hit = hit | F.col("node").isin(*names)
    if tags:
        hit = hit | F.arrays_overlap("tags", F.array(*map(F.lit, tags)))
    return nodes.where(hit).select("node")


def with_dependencies(edges: DataFrame, selected: DataFrame, dependencies: bool = True,
                      dependents: bool = False) -> DataFrame:
    """Selected nodes plus everything they depend on and/or everything that depends on them.

    ``edges(node, depends_on)``; the result says in which direction a node was reached.
    """
    out = selected.select(F.col(selected.columns[0]).alias("node")).distinct().select(
        "node", F.lit("selected").alias("reached"), F.lit(0).alias("steps"))
    if dependencies:
        up = closure(edges, selected, "node", "depends_on").where("steps > 0")
        out = out.unionByName(up.select("node", F.lit("dependency").alias("reached"), "steps"))
    if dependents:
        down = closure(edges, selected, "depends_on", "node").where("steps > 0")
        out = out.unionByName(down.select("node", F.lit("dependent").alias("reached"), "steps"))
    return out


def pass_through_hidden(edges: DataFrame, hidden: DataFrame) -> DataFrame:
    """Edges with hidden nodes cut out: a dependency on one becomes dependencies on its own."""
    shown = edges.select("node", "depends_on").distinct()
    hide = hidden.select(F.col(hidden.columns[0]).alias("depends_on")).distinct()
    done = shown.join(hide, "depends_on", "left_anti")
    pending = checkpointed(shown.join(hide, "depends_on", "left_semi").select("node", "depends_on"))
    seen = pending
    while not pending.isEmpty():
        step = pending.alias("p").join(shown.alias("e"), F.col("p.depends_on") == F.col("e.node")).select(
            F.col("p.node").alias("node"), F.col("e.depends_on").alias("depends_on")).distinct()
        step = checkpointed(step)
        done = done.unionByName(step.join(hide, "depends_on", "left_anti").select("node", "depends_on"))
        pending = checkpointed(
            step.join(hide, "depends_on", "left_semi").select("node", "depends_on")
            .join(seen, ["node", "depends_on"], "left_anti")
        )
        seen = seen.unionByName(pending)
    own = hidden.select(F.col(hidden.columns[0]).alias("node")).distinct()
    return done.distinct().join(own, "node", "left_anti").select("node", "depends_on")
