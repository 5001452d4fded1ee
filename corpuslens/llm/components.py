"""Connected components of links, as joins."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.llm.stored import stored


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links`` (a, b): the least node it is linked with,
    over any number of links.

    Each pass takes the least root among the neighbours and then the root's root, so paths
    halve; passes end when no root changes. Every pass is written, and only the number of
    changes comes to the driver. No links, no rows.
    """
    both = stored(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    )
    roots = stored(
        both.groupBy(F.col("a").alias("node"))
        .agg(F.min("b").alias("least"))
        .select("node", F.least("node", "least").alias("root"), F.lit(True).alias("changed"))
    )
    while not roots.filter("changed").isEmpty():
        near = (
            both.join(roots.select(F.col("node").alias("b"), "root"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("root").alias("near"))
        )
        closer = roots.join(near, "node").select(
            "node", F.col("root").alias("was"), F.least("root", "near").alias("via")
        )
        jump = closer.select(F.col("node").alias("via"), F.col("via").alias("root"))
        roots = stored(
            closer.join(jump, "via").select("node", "root", (F.col("root") != F.col("was")).alias("changed"))
        )
    return roots.select("node", "root")
