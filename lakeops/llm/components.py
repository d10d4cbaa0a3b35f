"""Connected components of a graph whose links are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakeops.llm.common import stage_table


def connected_components(edges: DataFrame) -> DataFrame:
    """``(id, label)`` for every id in ``edges(a, b)``; ``label`` is the
    smallest id reachable.

    Each round takes the smallest label among a node's neighbours and then
    follows the label's own label (pointer jumping), so a chain shortens by
    a factor each round.  Both joins are plain equi-joins on written tables,
    which adaptive execution can split where one label holds many nodes;
    the driver sees one count per round.
    """
    both = stage_table(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "cc-edges")
    state = stage_table(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m"))
                        .select("id", F.least("id", "m").alias("label")), "cc-state")
    while True:
        near = both.join(state.select(F.col("id").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("m"))
        hooked = stage_table(state.join(near, state.id == near.a).select("id", F.least("label", "m").alias("label"), F.col("label").alias("old")), "cc-hook")
        up = hooked.select(F.col("id").alias("label"), F.col("label").alias("root"))
        jumped = stage_table(hooked.join(up, "label").select("id", F.col("root").alias("label"), "old"), "cc-jump")
        if jumped.filter("label <> old").isEmpty():
            return state
        state = jumped.select("id", "label")
