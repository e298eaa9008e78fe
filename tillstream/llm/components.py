"""Connected components of an undirected graph given as an edge table.

Alternating large-star / small-star rounds (Kiveris et al., "Connected
Components in MapReduce and Beyond", 2014). Minima are partial aggregates; the
join that hands a node's minimum to its edges is salted, so a hub with a large
share of the edges is spread over many tasks. Every round is written to the
shared checkpoint folder; only two numbers per round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import staged

SALTS = 16


def _hooked(pairs: DataFrame) -> DataFrame:
    """(u, v) -> (v, m) with m the least node among u and the v of u."""
    least = (pairs.groupBy("u").agg(F.min("v").alias("m"))
             .select("u", F.least("u", "m").alias("m"))
             .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
    return salted.join(least, ["u", "salt"])


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    return (_hooked(both).filter("v > u and v != m")
            .select(F.col("v").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    hooked = _hooked(down)
    return (hooked.select(F.col("v").alias("a"), F.col("m").alias("b"))
            .union(hooked.select(F.col("u").alias("a"), F.col("m").alias("b")))
            .filter("a != b").distinct())


def components(edges: DataFrame) -> DataFrame:
    """(a, b) edges of long nodes -> (node, root), root the least node of the component.

    Nodes without an edge to another node are not returned. Repeated edges,
    loops and both directions of an edge are fine; null ends are ignored; an
    empty table gives an empty table.
    """
    now = staged(edges.filter("a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        mark = now.agg(F.count("*").alias("n"),
                       F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if before == mark or mark["n"] == 0:
            break
        before = mark
        now = staged(_small_star(_large_star(now)), "edges")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
