"""Exact dedup by content sort, in DataFrame operations only.

Sampled splitters deal the documents into ranges of normalised text, each
range is sorted (Spark's sort spills to disk), so that equal texts are
neighbours, and the window compares whole neighbouring texts and keeps the
smallest identifier of each run.

The range key is the text's first characters, then its digest, then a salt:
the sampled splitters stay short whatever the texts' length, texts that only
share a beginning still fall apart, and equal texts fall together.  The salt
is 0 but for hot texts, those with more than 1/``HOT_TEXTS`` of all rows.  A
hot text's copies are dealt by row number, whatever their ids, into runs of
about that many rows, and a second comparison, over one head per run, joins
the runs; a run that holds the smallest identifier keeps its first row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from allelic.llm.common import SPACE, stored, text_or_empty

#: There are fewer hot texts than this, since each has over 1/HOT_TEXTS of the rows.
HOT_TEXTS = 1024
#: Characters of the text in the range key.
LEAD = 32


def normalised(text: str) -> Column:
    """Every run of ASCII white space as one space; null as the empty text."""
    return F.regexp_replace(text_or_empty(text), f"[{SPACE}]+", " ")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id, keep_id, group_size, kept, text_sha256.

    Null texts count as empty, and empty texts are equal to each other.  Null
    ids come after all others: keep_id is null only if every id of the group
    is.  Exactly one row of each group is kept; among rows that repeat the
    smallest id, any one of them.  Other columns of ``docs`` are not read.
    """
    rows = docs.select(F.col(id_col).alias("id"), normalised(text_col).alias("norm"),
                       F.monotonically_increasing_id().alias("row"))
    rows = rows.withColumn("sha", F.sha2(F.col("norm"), 256))
    total = docs.count()
    hot = (rows.groupBy("sha").agg(F.count(F.lit(1)).alias("copies"))
           .where(F.col("copies") * HOT_TEXTS > F.lit(total))
           .select(F.col("sha").alias("hot_sha"),
                   F.ceil(F.col("copies") * HOT_TEXTS / F.lit(max(total, 1))).alias("runs")))
    salted = (rows.join(F.broadcast(hot), F.col("sha") == F.col("hot_sha"), "left")
              .select("id", "norm", "sha", F.col("runs").isNotNull().alias("hot"),
                      F.coalesce(F.pmod(F.xxhash64("row"), F.col("runs")), F.lit(0)).alias("salt"),
                      F.substring("norm", 1, LEAD).alias("lead")))
    dealt = salted.repartitionByRange("lead", "sha", "salt")
    run = Window.partitionBy("lead", "sha", "salt", "norm").orderBy(F.col("id").asc_nulls_last())
    whole = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = F.row_number().over(run) == 1
    runs = stored(dealt.select(
        "id", "sha", "hot", "salt", first.alias("first"),
        F.min("id").over(whole).alias("run_min"),
        F.count(F.lit(1)).over(whole).alias("run_size"),
        F.when(F.col("hot") & first, F.col("norm")).alias("head")), "runs")
    merged = (runs.where("hot AND first").groupBy("sha", "head")
              .agg(F.min("run_min").alias("all_min"), F.sum("run_size").alias("all_size"),
                   F.coalesce(F.min_by("salt", "run_min"), F.min("salt")).alias("all_salt"))
              .select(F.col("sha").alias("all_sha"), "all_min", "all_size", "all_salt"))
    joined = runs.join(F.broadcast(merged), F.col("hot") & (F.col("sha") == F.col("all_sha")), "left")
    is_hot = F.col("all_size").isNotNull()
    return joined.select(
        F.col("id").alias(id_col),
        F.when(is_hot, F.col("all_min")).otherwise(F.col("run_min")).alias("keep_id"),
        F.coalesce("all_size", "run_size").alias("group_size"),
        (F.col("first") & (~is_hot | (F.col("salt") == F.col("all_salt")))).alias("kept"),
        F.col("sha").alias("text_sha256"))


ORACLE = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t
  FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST) = 1 AS kept,
       sha256(t) AS text_sha256
FROM n
"""
