"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from allelic.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to the least node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # a table of its own, so that adaptive execution can split a large node's part of the join
    least = stored(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("at"), F.least("u", "m").alias("m")), "least")
    return (both.where("v > u").join(least, F.col("u") == F.col("at"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("at"), "m")
    to_least = edges.join(least, F.col("u") == F.col("at")).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return to_least.unionByName(least.select(F.col("at").alias("u"), F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b) but the roots
    themselves; root is the component's least node.

    Every round is written to the shared folder; the number of rounds grows
    with the logarithm of the longest path.  A node with very many edges is
    reduced to a partial minimum in each task, and its part of the join may be
    split by adaptive execution.
    """
    star = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    while True:
        mark = star.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if mark == before or mark[0] == 0:
            return star.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = mark
        star = stored(_small_star(_large_star(star)), "stars")
