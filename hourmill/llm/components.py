"""Connected components of a link table by alternating large and small stars.

Every round is two joins on a node against its smallest neighbour, written to
the shared folder, until all links form stars; no adjacency list is ever gathered into a row, so a hub
with very many links is a skewed join that Spark can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourmill.llm.common import write_scratch


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(e: DataFrame) -> DataFrame:
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    hop = e.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hop.unionByName(least.select("u", F.col("m").alias("v")))


def _settled(e: DataFrame) -> bool:
    """Whether all links form stars: a node has one smaller neighbour or is one, not both. No links are settled."""
    ends = e.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("in")).unionByName(
        e.select(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("in"))
    )
    most = ends.groupBy("node").agg((F.sum("out") + F.max("in")).alias("n")).agg(F.max("n")).first()[0]
    return most is None or most == 1


def connected_components(links: DataFrame) -> DataFrame:
    """(u, v) links of integer nodes to (node, component_id); nodes without a link are absent.

    component_id is the smallest node reachable. Self-links, repeated links
    and links with a null end are ignored. No links give an empty table.
    """
    e = write_scratch(
        links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"), (F.col("u").isNull() | F.col("v").isNull()).alias("_n"))
        .filter("not _n and u <> v")
        .select("u", "v")
        .distinct(),
        "links",
    )
    while not _settled(e):
        e = write_scratch(_small_star(_large_star(e)).distinct(), "stars")
    roots = e.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component_id"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component_id")).unionByName(roots)
