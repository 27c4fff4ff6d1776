"""Connected components of a large graph by shuffled joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root): for each node of the (a, b) edges the smallest one of its component.

    Each round looks at the root's root of every neighbour. The smallest is
    proposed to the node and to the node's root, so that whole trees are hooked
    at once and not only the node that saw it, and roots are replaced by their
    roots. Long chains thus take few rounds, whatever the order of ids. Rounds
    are written to the shared folder, so a lost executor costs one at most.
    """
    arcs = written(
        edges.select(F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))))
        .toDF("node", "near")
        .where("node <> near")
        .distinct(),
        "arcs",
    )
    roots = written(arcs.groupBy("node").agg(F.least("node", F.min("near")).alias("root")), "roots")
    while True:
        above = roots.select(F.col("node").alias("up"), F.col("root").alias("top"))
        tops = roots.join(above, F.col("root") == F.col("up")).select("node", "root", "top")
        near = tops.select(F.col("node").alias("near_node"), F.col("top").alias("near_top"))
        seen = (
            arcs.join(near, F.col("near") == F.col("near_node"))
            .groupBy(F.col("node").alias("seen_by"))
            .agg(F.min("near_top").alias("seen"))
        )
        least = F.least("top", "seen")
        proposed = tops.join(seen, F.col("node") == F.col("seen_by")).select(
            F.inline(
                F.array(
                    F.struct("node", least.alias("least"), F.col("root").alias("old")),
                    F.struct(F.col("root").alias("node"), least.alias("least"), F.lit(None).cast("bigint").alias("old")),
                )
            )
        )
        moved = written(proposed.groupBy("node").agg(F.min("least").alias("root"), F.max("old").alias("old")), "roots")
        roots = moved.select("node", "root")
        if moved.where("root <> old").isEmpty():
            return roots
