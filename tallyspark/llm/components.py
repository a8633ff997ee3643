"""Connected components of an edge table by alternating star steps.

Large-star links every larger neighbour of a node to its smallest neighbour;
small-star does so for the smaller ones.  Alternating them turns each
component into a star around its smallest node in a logarithmic number of
rounds.  Each round is a grouped minimum (combined on the map side) and a
join whose edge side Spark can split where a node has many edges.  Rounds are
written to the shared folder; only the number of unsettled nodes reaches the
driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm.shared import stored
from tallyspark.session import released_shuffles

MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.*")
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    out = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return out.where("a != b")


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges come as (larger a, smaller b)."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(least, "a")
    # a node and its smaller neighbours all go to the smallest
    ends = joined.select("m", F.explode(F.array("a", "b")).alias("a"))
    return ends.select("a", F.col("m").alias("b")).where("a != b").distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every edge leads straight to a root and none leads to two."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("x"), F.lit(1).alias("out")),
                                          F.struct(F.col("b").alias("x"), F.lit(0).alias("out")))).alias("e")).select("e.*")
    nodes = ends.groupBy("x").agg(F.sum("out").alias("out"), F.min("out").alias("least"))
    moving = nodes.agg(F.count_if((F.col("out") > 1) | ((F.col("out") == 1) & (F.col("least") == 0)))).first()[0]
    return not moving


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns ``a``, ``b``,
    one orderable type; self-loops and repeats are allowed, nulls are not).
    ``component`` is the smallest node reachable."""
    edges = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = stored(spark, edges, "links")
    for _ in range(MAX_ROUNDS):
        with released_shuffles(spark):
            settled = _settled(edges)
        if settled:
            break
        edges = stored(spark, _small_star(_large_star(edges)), "stars")
    else:
        raise RuntimeError("components did not settle")
    members = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return members.unionByName(roots)
