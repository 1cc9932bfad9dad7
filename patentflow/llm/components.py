"""Connected components of an edge table, by alternating star operations."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patentflow.storage import stage


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) of every id on an edge; the component is its smallest id.

    `edges` has two columns of one orderable type; their direction, repetitions, loops and rows with a NULL
    end do not matter. Each round links every node to the smallest node it sees (large star, then small
    star), so a hub's rows are aggregated before they are shuffled, and the rounds grow with the
    logarithm of the largest component. Every round is a written table. No edges give no rows.
    """
    a, b = (F.col(name) for name in edges.columns)
    links = edges.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    links, before = stage(links), None
    while (now := _state(links)) != before and now[0]:
        before = now
        links = stage(_small_star(_large_star(links)))
    children = links.select(F.col("u").alias("id"), F.col("v").alias("component"))
    roots = links.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return children.unionByName(roots)


def _state(links: DataFrame) -> tuple:
    """A number of links and a checksum of them, which stay as they are once all are stars."""
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def _large_star(links: DataFrame) -> DataFrame:
    """Connect the larger neighbours of each node to the smallest of the node and its neighbours."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least"))
    joined = both.join(least, "u").where(F.col("v") > F.col("u"))
    return joined.select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Connect each node and its smaller neighbours to the smallest of them."""
    least = links.groupBy("u").agg(F.min("v").alias("least"))
    neighbours = links.join(least, "u").where(F.col("v") != F.col("least"))
    moved = neighbours.select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.unionByName(least.select("u", F.col("least").alias("v"))).distinct()
