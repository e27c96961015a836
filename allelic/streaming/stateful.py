"""Event-time stateful streaming operators.

The reference had no event time (it windowed on ``processed_at``, one
constant per micro-batch).  Here windows run on the message's own event
time with a watermark, so state is bounded and late data has a policy:
rows later than the watermark are dropped by Spark, everything else is
folded into its window.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from allelic.operators.metrics import window_counts
from allelic.operators.timeseries import latest_by_key
from allelic.streaming.runs import (
    Table, all_runs, forget, latest_version, previous, read_manifest, read_runs, take_in, write_manifest,
)

DEFAULT_WATERMARK = "10 minutes"


def stream_window_counts(snps: DataFrame, width: str, *, watermark: str = DEFAULT_WATERMARK,
                         slide: str | None = None) -> DataFrame:
    """Tumbling (or sliding) event-time window counts per member,
    state bounded by the watermark.  Same columns as ``window_counts``."""
    return window_counts(snps, width, slide=slide, watermark=watermark)


def stream_running_totals(snps: DataFrame) -> DataFrame:
    """Valid records per member kept forever (state = one row per
    member; run in complete or update mode)."""
    return snps.groupBy("member_type").agg(F.count_if(F.col("has_snp")).alias("total_records"))


def stream_mutation_rate(snps: DataFrame, seconds: int = 60, slide: int = 10, *,
                         watermark: str = DEFAULT_WATERMARK) -> DataFrame:
    """Live trailing rate: sliding ``seconds`` windows every ``slide``
    seconds; ``mutation_rate`` = valid SNPs in the window / seconds."""
    w = F.window("ts", f"{seconds} seconds", f"{slide} seconds")
    return (snps.filter(F.col("has_snp")).withWatermark("ts", watermark)
            .groupBy(w.alias("window")).agg(F.count(F.lit(1)).alias("n_window"))
            .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                    "n_window", (F.col("n_window") / float(seconds)).alias("mutation_rate")))


def stream_family_completion(snps: DataFrame, *, watermark: str = DEFAULT_WATERMARK) -> DataFrame:
    """Each finished family once (duplicate tokens within the
    watermark are dropped); count the sink's rows for the total."""
    tokens = snps.filter(F.col("kind") == "token") if "kind" in snps.columns else \
        snps.filter(~F.col("has_snp"))
    return (tokens.select("family_id", "ts").withWatermark("ts", watermark)
            .dropDuplicatesWithinWatermark(["family_id"]))


#: Hash buckets of a new snapshot; runs a bucket may have before all are merged.
BUCKETS, MOST_RUNS = 64, 16


def _snapshot(path: str) -> Table:
    return Table(os.path.join(path, "runs"), os.path.join(path, "manifest"), "_run", "_bucket")


def upsert_snapshot(spark: SparkSession, batch: DataFrame, batch_id: int, path: str,
                    keys: list[str], ts: str, keep: int = 2, buckets: int = BUCKETS) -> None:
    """Merge a micro-batch into a last-write-wins snapshot.

    Keys lie in hash buckets, and a bucket is a list of runs (see ``runs``):
    the batch becomes a run of each bucket it touches, with the newest small
    runs merged in; readers merge the rest.  What a batch writes follows the
    batch, not the snapshot.  Equal times are decided by the rows' other
    columns.  A replayed batch gives the same snapshot; the ``keep`` newest
    versions stay.
    """
    table = _snapshot(path)
    settings, held = previous(spark, table, batch_id)
    settings = settings or {"keys": keys, "ts": ts, "buckets": buckets, "schema": batch.schema.json()}
    placed = batch.withColumn(table.part, F.pmod(F.xxhash64(*keys), F.lit(settings["buckets"])).cast("string"))
    touched = {r[0]: r["count"] for r in placed.groupBy(table.part).count().collect()}  # at most ``buckets`` rows
    taken, left = take_in(held, touched, unless_over=0, most=MOST_RUNS)
    if touched:
        merged = placed
        if taken:
            old = read_runs(spark, table, taken)
            merged = old.withColumn(table.part, F.col(table.part).cast("string")).unionByName(placed, allowMissingColumns=True)
        own = os.path.join(table.base, f"{table.run}={batch_id}")
        (latest_by_key(merged, [table.part, *keys], ts).repartition(len(touched), table.part)
         .write.mode("overwrite").partitionBy(table.part).parquet(own))
        for r in spark.read.parquet(own).groupBy(F.col(table.part).cast("string")).count().collect():
            left[r[0]].append((batch_id, r["count"]))
    write_manifest(spark, table, batch_id, settings, left)
    forget(spark, table, batch_id, keep)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The newest snapshot: one row per key, the latest of its bucket's runs."""
    table = _snapshot(path)
    v = latest_version(spark, table.manifests)
    if v is None:
        raise FileNotFoundError(f"no snapshot under {path}")
    settings, held = read_manifest(spark, table, v)
    if not held:
        return spark.createDataFrame([], StructType.fromJson(json.loads(settings["schema"])))
    return latest_by_key(read_runs(spark, table, all_runs(held)).drop(table.part), settings["keys"], settings["ts"])
