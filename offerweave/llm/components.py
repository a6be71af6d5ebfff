"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerweave.llm.shared import Scratch


def components(edges: DataFrame, scratch: Scratch, known: DataFrame | None = None) -> DataFrame:
    """(node, root) for every node of edges (a, b), root being the smallest node that can be reached.

    ``known`` is what this gave for other edges; the result is that of both together, and rounds are run only over those
    of the new edges that join components.

    Every round each node takes the smallest label among its own and its neighbours', then the label of that
    label, so that long chains shorten by half. Labels are written to the shared folder after each round: a
    lost executor costs one round. They and the result are ``scratch``'s. The rounds end when no label changes. Null ends are ignored.
    """
    if known is not None:
        for end in "ab":
            roots = known.select(F.col("node").alias(end), F.col("root").alias("at"))
            edges = edges.join(roots, end, "left").withColumn(end, F.coalesce("at", end)).select("a", "b")
    both = scratch.stored(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e"))
        .select("e.a", "e.b")
        .distinct(),
        "links",
    )
    if known is not None:
        if not both.limit(1).count():
            return known
        further = _rounds(both, scratch)
        now = known.join(further.select(F.col("node").alias("root"), F.col("root").alias("next")), "root", "left").select("node", F.coalesce("next", "root").alias("root"))
        return scratch.stored(now.unionByName(further.join(known, "node", "left_anti")), "labels")
    return _rounds(both, scratch)


def _rounds(both: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) from edges (a, b) that are there in both directions."""
    labels = scratch.stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), F.col("root").alias("other")), "b").groupBy("a").agg(F.min("other").alias("near"))
        moved = labels.join(near, labels["node"] == near["a"]).select("node", "root", F.least("root", "near").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("root").alias("beyond"))
        labels = scratch.stored(
            moved.join(jump, "next").select("node", F.least("next", "beyond").alias("root"), (F.least("next", "beyond") != F.col("root")).alias("changed")),
            "labels",
        )
        if not labels.where("changed").limit(1).count():
            return labels.select("node", "root")
        labels = labels.select("node", "root")
