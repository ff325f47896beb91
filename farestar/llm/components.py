"""Connected components of a link table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from farestar.llm.common import written


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, label) of every node: nodes joined by a path of (a, b) links share their label.

    In each pass every label hooks to the least label it is linked with, labels and links are
    rewritten, and links within one label vanish; random labels need about log(n) passes.  All
    groupings are minima, summed before the shuffle; tables are written between passes, so a
    label with a third of the nodes meets its one new label by a join that can be split.
    """
    labels = nodes.select("node", F.col("node").alias("label"))
    edges = written(links.select("a", "b").where("a <> b").distinct(), "links")
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = written(
            both.groupBy("a").agg(F.min("b").alias("to")).where("to < a"), "component_hooks"
        )
        labels = written(
            labels.join(hooks, labels["label"] == hooks["a"], "left")
            .select("node", F.coalesce("to", "label").alias("label")),
            "component_labels",
        )
        for end in ("a", "b"):
            step = hooks.select(F.col("a").alias("from"), "to")
            edges = edges.join(step, edges[end] == step["from"], "left").select(
                *[F.coalesce("to", end).alias(end) if c == end else c for c in ("a", "b")]
            )
        edges = written(edges.where("a <> b").distinct(), "links")
    return labels
