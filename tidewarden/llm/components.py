"""Connected components of a link table, by hooking and contraction.

Every round hooks each node to its smallest neighbour, follows the pointers twice, and
replaces the ends of each link by where they point; links inside a group vanish. The
link table shrinks by a factor each round, and a star, however large, goes in one. No
node's neighbours are gathered: the minimum is a partial aggregate, and links of a hub
meet it in plain joins that the adaptive skew join can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import Steps


def _pointed(links: DataFrame, parents: DataFrame) -> DataFrame:
    """Links between the nodes that the ends point to."""
    left = parents.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
    right = parents.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
    ends = links.join(left, "a").join(right, "b")
    return (
        ends.where("pa <> pb")
        .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
        .distinct()
    )


def components(links: DataFrame, step: Steps) -> DataFrame:
    """``(node, root)`` for every node of ``links`` ``(a, b)``; root is the smallest node
    that can be reached. Each round is a table, so a lost executor costs one round."""
    links = step(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "links-0")
    labels, round_ = None, 0
    while not links.isEmpty():
        both = links.select(F.col("a").alias("node"), F.col("b").alias("other")).unionAll(
            links.select(F.col("b").alias("node"), F.col("a").alias("other"))
        )
        hooks = both.groupBy("node").agg(F.min("other").alias("other")).select(
            "node", F.least("node", "other").alias("parent")
        )
        parents = step(hooks, f"hooks-{round_}")
        for _ in range(2):
            up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
            parents = parents.join(up, "parent").select("node", F.col("above").alias("parent"))
        parents = step(parents, f"parents-{round_}")
        if labels is None:
            labels = parents.withColumnRenamed("parent", "root")
        else:
            up = parents.select(F.col("node").alias("root"), F.col("parent").alias("above"))
            labels = labels.join(up, "root", "left").select("node", F.coalesce("above", "root").alias("root"))
        round_ += 1
        links = step(_pointed(links, parents), f"links-{round_}")
    if labels is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels
