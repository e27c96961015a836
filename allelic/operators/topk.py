"""Top-k, ordering and unions.

Global top-k is ``orderBy().limit()``, which Spark plans as
TakeOrderedAndProject: every partition keeps its own k best rows and only
those reach the final merge, so nothing larger than k x partitions moves.

Per-group top-k is a ranked window with a limit, which Spark plans with a
partial group limit before the shuffle: every task sends k rows of a group at
most, so a group with a large share of the rows stays small.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from allelic.operators.ranks import numbered_rows


def _order_exprs(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def top_k(df: DataFrame, order: Sequence[Column | str], k: int, *,
          by: Sequence[str] | None = None, rank_col: str | None = None) -> DataFrame:
    """The first ``k`` rows in ``order`` (per ``by`` group when given).

    ``order`` must be a total order for the result to be deterministic;
    ``rank_col`` adds the 1-based rank.
    """
    order = _order_exprs(order)
    if not by:
        top = df.orderBy(*order).limit(k)
        if rank_col:
            # at most k rows: a single-partition window is free here
            top = top.withColumn(rank_col, F.row_number().over(Window.orderBy(*order)).cast("long"))
        return top
    by = list(by)
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("long")
    out = df.withColumn("_rank", rank).filter(F.col("_rank") <= k)
    if rank_col:
        return out.withColumnRenamed("_rank", rank_col)
    return out.drop("_rank")


def top_genes(gene_counts: DataFrame, k: int = 5) -> DataFrame:
    """The k most frequent genes (ties by gene name)."""
    return top_k(gene_counts, [F.desc("count"), F.asc("gene")], k, rank_col="rank")


def top_variants(variant_counts: DataFrame, k: int = 5) -> DataFrame:
    """The k most frequent variant types."""
    return top_k(variant_counts, [F.desc("count"), F.asc("variant_type")], k, rank_col="rank")


def members_of(df: DataFrame, members: Sequence[str] = ("father", "mother", "child")) -> DataFrame:
    """U1/U2 over one table: the members' rows, in one scan."""
    return df.filter(F.col("member_type").isin(*members))


def union_members(*dfs: DataFrame) -> DataFrame:
    """Concatenate same-schema member streams or metric tables that
    are separate inputs (use ``members_of`` for one table)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def global_hotspots(per_member: DataFrame, k: int = 10) -> DataFrame:
    """T4: merge members' hotspot lists, regroup by locus, take the top k
    by summed frequency."""
    merged = per_member.groupBy("chromosome", "position").agg(
        F.sum("frequency").cast("long").alias("frequency"))
    return top_k(merged, [F.desc("frequency"), F.asc_nulls_last("chromosome"), F.asc("position")],
                 k, rank_col="rank")


def chromosome_order(df: DataFrame, col: str = "chromosome") -> DataFrame:
    """T5: distinct chromosome labels with their lexical rank (as the
    dashboard sorts them) and a natural rank (1..22, X, Y, MT, others)."""
    labels = df.select(F.col(col).alias("chromosome")).filter(F.col("chromosome").isNotNull()).distinct()
    n = F.regexp_replace(F.upper("chromosome"), "^CHR", "")
    natural_key = (F.when(n.rlike("^[0-9]{1,3}$"), n.try_cast("int"))
                   .when(n == "X", 1001).when(n == "Y", 1002).when(n == "MT", 1003)
                   .otherwise(2000))
    # labels are free text: both ranks come from range sorts
    lexical = numbered_rows(labels, [], ["chromosome"]).select("chromosome", (F.col("_i") + 1).cast("int").alias("lexical_rank"))
    natural = numbered_rows(lexical.withColumn("_natural", natural_key), [], ["_natural", "chromosome"])
    return natural.select("chromosome", "lexical_rank", (F.col("_i") + 1).cast("int").alias("natural_rank"))
