"""Connected components by contraction, all state in tables.

Each round hooks every node to its smallest neighbour, follows the hooks to their ends by
pointer jumping, and replaces the edges by edges between the ends. At least half of the
nodes that still have an edge are contracted in a round, so the rounds are logarithmic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import Scratch, write_table


def _ends(hooks: DataFrame, write_table) -> DataFrame:
    """(node, root) from (node, root) where root may itself be hooked on."""
    while True:
        up = hooks.select(F.col("node").alias("root"), F.col("root").alias("next"))
        step = (hooks.join(up, "root", "left")
                .select("node", F.coalesce("next", "root").alias("root"),
                        (F.coalesce("next", "root") != F.col("root")).alias("moved")))
        step = write_table(step, "hooks")
        moved = not step.where("moved").isEmpty()
        hooks = step.select("node", "root")
        if not moved:
            return hooks


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b); root is the smallest node
    reachable. Repeated edges and loops do no harm; no edges give an empty table."""
    scratch = Scratch(edges.sparkSession, "components")
    keep, write = write_table, scratch.write
    left = write(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                 .where("a != b").distinct(), "edges")
    roots = None
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = (both.groupBy("a").agg(F.min("b").alias("m"))
                 .select(F.col("a").alias("node"), F.least("a", "m").alias("root")))
        ends = _ends(write(hooks, "hooks"), write)
        if roots is None:
            roots = ends
        else:
            up = ends.select(F.col("node").alias("root"), F.col("root").alias("next"))
            roots = write(roots.join(up, "root", "left")
                          .select("node", F.coalesce("next", "root").alias("root")), "roots")
        to_a = ends.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        to_b = ends.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        left = write(
            left.join(to_a, "a").join(to_b, "b").where("ra != rb")
            .select(F.greatest("ra", "rb").alias("a"), F.least("ra", "rb").alias("b")).distinct(),
            "edges")
    if roots is None:
        roots = left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = keep(roots, "roots")
    scratch.remove()
    return roots
