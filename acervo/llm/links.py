"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acervo.llm.common import staged


def components(links: DataFrame) -> DataFrame:
    """The smallest member (root) of each node's component; links are (a, b), the result (node, root).

    Each round sends every node to the smallest node it is linked to (or itself) and rewrites the links by it, so every
    node but local minima is merged away; rounds follow the logarithm of a component's size. Only tables of links and
    nodes are held; a node with very many links is pre-aggregated, and joins on it are split by size.
    """
    live = staged(links.where("a <> b").select("a", "b").distinct(), "links")
    found = None
    while live.limit(1).count():
        both = live.union(live.select("b", "a"))
        step = staged(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                      .select("node", F.least("node", "m").alias("root")), "roots")
        if found is None:
            found = step
        else:
            nexts = step.select(F.col("node").alias("_n"), F.col("root").alias("_r"))
            found = staged(found.join(nexts, F.col("root") == F.col("_n"), "left")
                           .select("node", F.coalesce("_r", "root").alias("root")), "components")
        left = step.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        right = step.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        live = staged(live.join(left, "a").join(right, "b").where("ra <> rb")
                      .select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), "links")
    return found if found is not None else live.select(F.col("a").alias("node"), F.col("b").alias("root"))
