"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.llm.store import keep


def components(links: DataFrame) -> DataFrame:
    """``id, component`` (smallest id reachable) for every id in ``links(a, b)``.

    Rounds of hooking and contraction: every root takes its smallest neighbouring root as parent, parents
    are followed to their roots (each hop halves the depth), and links inside one root go. Every
    round at least halves the roots that still have links, so rounds are logarithmic in the largest component.
    Each round's tables are written, so that no plan holds earlier rounds.
    """
    links = keep(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    labels = keep(links.select(F.col("a").alias("id")).union(links.select("b")).distinct()
                  .select("id", F.col("id").alias("component")), "labels")
    while not links.isEmpty():
        both = links.union(links.select("b", "a"))
        parent = keep(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("p"))
                      .select("node", F.least("node", "p").alias("p")), "parents")
        while True:
            up = parent.select(F.col("node").alias("p"), F.col("p").alias("pp"))
            jumped = keep(parent.join(up, "p").select("node", F.col("pp").alias("p"), (F.col("pp") != F.col("p")).alias("moved")),
                          "parents")
            parent = jumped.select("node", "p")
            if jumped.filter("moved").isEmpty():
                break
        labels = keep(labels.join(parent, labels["component"] == parent["node"], "left")
                      .select("id", F.coalesce("p", "component").alias("component")), "labels")
        pa, pb = parent.select(F.col("node").alias("a"), F.col("p").alias("ra")), parent.select(F.col("node").alias("b"), F.col("p").alias("rb"))
        links = keep(links.join(pa, "a").join(pb, "b").filter("ra <> rb")
                     .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "links")
    return labels
