"""Connected components by alternating large-star and small-star steps."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.workspace import settle


def components(links: DataFrame) -> DataFrame:
    """node and root (the smallest node it is connected to) of all nodes in ``links`` (a, b).

    Every step is a minimum per node with map-side partials and a join back, so a node with very
    many links is never gathered; adaptive execution splits the join by skew. The links of each
    round are written, which cuts the lineage; rounds grow with the logarithm of the longest chain.
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    links, mark = settled(links)
    while True:
        links, after = settled(small_star(large_star(links)))
        if after == mark:
            break
        mark = after
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)


def settled(links: DataFrame) -> tuple[DataFrame, tuple[int, int]]:
    """Written links (a > b), and a mark by which a round that changes nothing is known."""
    links = settle(links, "links")
    row = links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
    return links, (row[0], row[1])


def large_star(links: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of its neighbours and itself."""
    both = links.select("a", "b").union(links.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("of"), F.least("a", "least").alias("least"))
    joined = both.join(least, F.col("a") == F.col("of")).filter("b > a")
    return joined.select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def small_star(links: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("least")).withColumnRenamed("a", "of")
    joined = links.join(least, F.col("a") == F.col("of"))
    below = joined.filter("b > least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return below.union(least.select(F.col("of").alias("a"), F.col("least").alias("b"))).distinct()
