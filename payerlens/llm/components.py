"""Connected components of a link table by repeated contraction, all in joins and groupings.

In every round each node picks one of its neighbours or itself and all links are rewritten
to the picked nodes; links inside one node vanish. The first round picks the smallest id,
which finishes stars around it; later rounds pick by a hash that changes each round, so
long chains lose a constant share of their nodes too. Each round's tables are written to
the shared folder, so no lineage grows and a lost executor repeats one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payerlens.llm.tables import stored


def connected_components(links: DataFrame) -> DataFrame:
    """(id, component) of every node in ``links(a, b)``; component is the smallest id reached."""
    left = stored(_clean(links.select("a", "b")), "links")
    labels, number = None, 0
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        if number:
            order = F.struct(F.xxhash64("b", F.lit(number)).alias("h"), F.col("b").alias("b"))
            own = F.struct(F.xxhash64("a", F.lit(number)).alias("h"), F.col("a").alias("b"))
            picked = both.groupBy("a").agg(F.min(order).alias("nearest"))
            picked = picked.select("a", F.least("nearest", own)["b"].alias("p"))
        else:
            picked = both.groupBy("a").agg(F.min("b").alias("p"))
            picked = picked.select("a", F.least("a", "p").alias("p"))
        picked = stored(picked, "picked")
        if labels is None:
            labels = picked.select(F.col("a").alias("id"), F.col("p").alias("label"))
        else:
            step = picked.select(F.col("a").alias("label"), "p")
            labels = stored(
                labels.join(step, "label", "left").select(
                    "id", F.coalesce("p", "label").alias("label")
                ),
                "labels",
            )
        ends = left.join(picked, "a").select("b", F.col("p").alias("a2"))
        other = picked.select(F.col("a").alias("b"), F.col("p").alias("b2"))
        left = stored(
            _clean(ends.join(other, "b").select(F.col("a2").alias("a"), F.col("b2").alias("b"))),
            "links",
        )
        number += 1
    if labels is None:
        return left.select(F.col("a").alias("id"), F.col("b").alias("component"))
    least = labels.groupBy("label").agg(F.min("id").alias("component"))
    return stored(labels.join(least, "label").select("id", "component"), "components")


def _clean(links: DataFrame) -> DataFrame:
    return links.where("a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).distinct()
