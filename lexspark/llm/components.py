"""Connected components of a table of edges, by alternating star contraction."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexspark.llm.storage import cut


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): each node of an edge with the smallest node of its component; nodes that are their own root are left out.

    Large-star and small-star steps alternate until every edge points to a root. Nulls and loops are no edges; no edge gives
    no row. Minima are aggregated
    before the shuffle and joined back, so a star of any size is no single row, and Spark splits it if it is skewed.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(f"`{a}` is not null and `{b}` is not null and `{a}` <> `{b}`").distinct()
    e = cut(e)
    while True:
        both = e.union(e.select(F.col("v"), F.col("u")))
        large = both.join(both.groupBy("u").agg(F.min("v").alias("low")), "u").withColumn("m", F.least("u", "low")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # every node's smaller neighbours and the node itself go to the smallest of them
        small = large.join(large.groupBy("u").agg(F.min("v").alias("m")), "u")
        new = small.select(F.col("u"), F.col("m").alias("v")).union(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()
        new = cut(new)
        # done when each node has one neighbour below it, which has none itself
        state = new.groupBy("u").agg(F.count("*").alias("n")).agg(F.max("n").alias("n")).first()["n"]
        if not state or (state == 1 and new.join(new.select(F.col("u").alias("v")).distinct(), "v", "left_semi").isEmpty()):
            return new.select(F.col("u").alias("node"), F.col("v").alias("root"))
        e = new
