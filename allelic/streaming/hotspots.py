"""Live hotspots, kept from refresh to refresh.

What is new since the last refresh becomes runs of position sums in hash
buckets (see ``runs``).  Beside its sums a run holds, for each of the many
hash cells of its bucket, the largest sum in it.  A position's total is at
most the sum of its cell's peaks over the runs, so only positions that are
new in this refresh and whose bound reaches their member's k-th frequency can
enter its list; their exact totals come from the buckets they lie in, by a
semi join.  All others keep their place: counts never fall, and a position
without new rows cannot overtake one that is listed.

A refresh reads the new sums, the peaks (a bounded number of cells per run)
and the candidates' buckets, not all positions.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from allelic.operators.topk import top_k
from allelic.streaming.runs import (
    Held, Table, all_runs, delete, forget, latest_version, numbered, previous, read_runs, take_in, write_manifest,
)

MEMBER = "member_type"
KEYS = [MEMBER, "chromosome", "position"]
#: Hash buckets of a new table, cells of a bucket, runs a bucket may have before all are merged.
BUCKETS, CELLS, MOST_RUNS = 64, 256, 16


def _best(counts: DataFrame, k: int) -> DataFrame:
    order = [F.desc("frequency"), F.asc_nulls_last("chromosome"), F.asc("position")]
    return top_k(counts.select(*KEYS, "frequency"), order, k, by=[MEMBER], rank_col="rank")


def hotspot_table(path: str) -> Table:
    return Table(os.path.join(path, "runs"), os.path.join(path, "manifest"), "_run", "_bucket")


def refreshed_after(spark: SparkSession, path: str, batch_id: int) -> int | None:
    """The batch of the last refresh before ``batch_id``."""
    return latest_version(spark, hotspot_table(path).manifests, before=batch_id)


def _same(a: DataFrame, b: DataFrame):
    """Equality of the keys, NULLs equal."""
    return [a[c].eqNullSafe(b[c]) for c in KEYS]


def _lists(path: str, version: int) -> str:
    return os.path.join(path, "lists", f"version={version}")


def _write_runs(spark: SparkSession, table: Table, new: DataFrame, held: Held, batch_id: int) -> Held:
    """Writes the new sums as a run of each bucket they touch, with the newest
    small runs merged in; returns the runs that are held then."""
    touched = {r[0]: r["count"] for r in new.groupBy(table.part).count().collect()}  # at most BUCKETS rows
    taken, left = take_in(held, touched, unless_over=0, most=MOST_RUNS)
    if not touched:
        return left
    sums = new
    if taken:
        old = read_runs(spark, table, taken).filter("_what = 'sums'").drop("_what")
        old = old.withColumn(table.part, F.col(table.part).cast("string"))
        sums = old.unionByName(new).groupBy(table.part, "_cell", *KEYS).agg(F.sum("frequency").alias("frequency"))
    own = os.path.join(table.base, f"{table.run}={batch_id}")
    (sums.withColumn("_what", F.lit("sums")).repartition(len(touched), table.part)
     .write.mode("overwrite").partitionBy(table.part, "_what").parquet(own))
    written = spark.read.parquet(own).filter("_what = 'sums'").withColumn(table.part, F.col(table.part).cast("string"))
    sizes = written.groupBy(table.part).count().collect()
    empty = [F.lit(None).cast(new.schema[c].dataType).alias(c) for c in KEYS]
    (written.groupBy(table.part, "_cell").agg(F.max("frequency").alias("frequency"))
     .select(table.part, "_cell", *empty, "frequency", F.lit("peaks").alias("_what"))
     .repartition(len(touched), table.part).write.mode("append").partitionBy(table.part, "_what").parquet(own))
    for r in sizes:
        left[r[0]].append((batch_id, r["count"]))
    return left


def refresh_hotspots(spark: SparkSession, new: DataFrame, batch_id: int, path: str, k: int = 10, *, again: bool = False, keep: int = 2) -> None:
    """Brings each member's ``k`` most frequent positions up to date.

    ``new`` has (member_type, chromosome, position, frequency): sums of what
    came since the last refresh before ``batch_id``, of everything if there was
    none or with ``again``.  A NULL member or chromosome is a value of its own;
    ties go by chromosome, NULL last, then position.  A replayed refresh
    rewrites the same files from the ones before it.
    """
    table = hotspot_table(path)
    settings, held = previous(spark, table, batch_id)
    first = settings is None or again
    settings = {"buckets": BUCKETS, "cells": CELLS, "k": k} if first else settings
    held = {} if first else held
    cell = F.pmod(F.xxhash64(*KEYS), F.lit(settings["buckets"] * settings["cells"]))
    new = (new.groupBy(*KEYS).agg(F.sum("frequency").cast("long").alias("frequency"))
           .withColumn("_cell", cell).withColumn(table.part, (F.col("_cell") % settings["buckets"]).cast("string")))
    new = new.persist()
    try:
        if first:
            _best(new, settings["k"]).write.mode("overwrite").parquet(_lists(path, batch_id))
        else:
            before = _lists(path, refreshed_after(spark, path, batch_id))
            _write_lists(spark, table, held, new, settings["k"], before, _lists(path, batch_id))
        left = _write_runs(spark, table, new, held, batch_id)
        write_manifest(spark, table, batch_id, settings, left)
    finally:
        new.unpersist()
    forget(spark, table, batch_id, keep)
    for v in numbered(spark, os.path.join(path, "lists"), "version=")[:-keep]:
        if v < batch_id:
            delete(spark, _lists(path, v))


def _write_lists(spark: SparkSession, table: Table, held: Held, new: DataFrame, k: int, before: str, to: str) -> None:
    """The lists after ``new``: exact totals of the candidates, and the listed rows that are none."""
    listed = spark.read.parquet(before).drop("rank")
    found = candidates(spark, table, held, new, k, listed).persist()
    try:
        within = {r[0] for r in found.select(table.part).distinct().collect()}  # at most BUCKETS rows
        totals = found.select(*KEYS, "frequency")
        runs = [(run, part) for run, part in all_runs(held) if part in within]
        if runs:
            old = read_runs(spark, table, runs).filter("_what = 'sums'").select(*KEYS, "frequency")
            totals = totals.unionByName(old.join(found, _same(old, found), "left_semi"))
        totals = totals.groupBy(*KEYS).agg(F.sum("frequency").alias("frequency"))
        rest = listed.join(found, _same(listed, found), "left_anti")
        _best(totals.unionByName(rest.select(*KEYS, "frequency")), k).write.mode("overwrite").parquet(to)
    finally:
        found.unpersist()


def candidates(spark: SparkSession, table: Table, held: Held, new: DataFrame, k: int, listed: DataFrame) -> DataFrame:
    """The rows of ``new`` whose position can be in its member's list."""
    least = listed.groupBy(F.col(MEMBER).alias("_m")).agg(
        F.when(F.count(F.lit(1)) >= k, F.min("frequency")).otherwise(0).alias("_least"))
    able = new.join(least, F.col(MEMBER).eqNullSafe(F.col("_m")), "left")
    bound = F.col("frequency")
    if held:
        peaks = (read_runs(spark, table, all_runs(held)).filter("_what = 'peaks'")
                 .groupBy(F.col("_cell").alias("_c")).agg(F.sum("frequency").alias("_peak")))
        able = able.join(peaks, F.col("_cell") == F.col("_c"), "left")
        bound = bound + F.coalesce("_peak", F.lit(0))
    return able.filter(bound >= F.coalesce("_least", F.lit(0))).select(*new.columns)


def read_hotspots(spark: SparkSession, path: str) -> DataFrame:
    """The newest lists: member_type, chromosome, position, frequency, rank."""
    v = latest_version(spark, hotspot_table(path).manifests)
    if v is None:
        raise FileNotFoundError(f"no hotspots under {path}")
    return spark.read.parquet(_lists(path, v)).withColumn("batch_id", F.lit(v).cast("long"))
