"""Connected components by joins, for links between keys of any kind."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.shared import stored

# Links that one task is given at least, so that a small graph is not dealt over every partition of a shuffle.
LINKS_PER_TASK = 4096


def nearest_of(edges: DataFrame) -> DataFrame:
    """(node, m, loose) of the ends of `edges` (low, high): the smallest of a node and its neighbours, and whether
    it has two neighbours below it, or one below and one above. Where no node is loose, stars are left."""
    ends = F.array(F.struct(F.col("high").alias("node"), F.col("low").alias("below"), F.lit(None).alias("above")),
                   F.struct(F.col("low").alias("node"), F.lit(None).alias("below"), F.col("high").alias("above")))
    nodes = edges.select(F.inline(ends)).groupBy("node").agg(
        F.min("below").alias("least"), F.max("below").alias("next"), F.max("above").alias("above"))
    loose = F.col("least").isNotNull() & (F.col("above").isNotNull() | (F.col("least") != F.col("next")))
    return nodes.select("node", F.coalesce("least", "node").alias("m"), loose.alias("loose"))


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (a, b); `root` is the smallest node reachable.

    Alternating stars: each node hands its larger neighbours to its smallest one, then its
    smaller ones. Rounds are about the logarithm of the longest path. Minima are summed up
    map-side and written before they are joined, so Spark can split a join on a node that has a
    third of the links. All tables are in the shared folder; the driver gets one count a round.
    `links` are read several times, so they had better be a table that was written.
    """
    edges = links.where("a != b").select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high"))
    tasks = links.count() // LINKS_PER_TASK + 1
    while True:
        nearest = stored(nearest_of(edges).coalesce(tasks), "nearest")
        if nearest.where("loose").count() == 0:
            return nearest.select("node", F.col("m").alias("root"))
        large = edges.join(nearest, F.col("low") == F.col("node")).select("high", F.col("m").alias("low"))
        large = stored(large.coalesce(tasks).distinct().coalesce(tasks), "edges")
        nearest = stored(large.groupBy("high").agg(F.min("low").alias("m")).coalesce(tasks), "nearest")
        small = large.join(nearest, "high").where("low != m").select(F.col("m").alias("low"), F.col("low").alias("high"))
        small = small.unionByName(nearest.select(F.col("m").alias("low"), "high"))
        edges = stored(small.coalesce(tasks).distinct().coalesce(tasks), "edges")
