"""Streaming metric runner.

One ``foreachBatch`` query per message stream.  Per micro-batch it

1. persists the parsed batch;
2. archives the rows (Parquet by event date, sorted by event time, small
   runs merged; ``read_archive`` reads it by its manifest);
3. computes every metric as *additive partial counts* of this batch in one
   grouping-sets aggregation (one scan, one shuffle) and writes them to
   ``{out}/partials/batch_id={n}/metric=...``, replacing that batch folder.
   A batch replayed after a failure rewrites the same folder, so results
   stay exact under the sink's at-least-once delivery;
4. every ``every``-th batch refreshes the derived snapshots: the hotspots
   from what is new since the last refresh (see ``hotspots``), the population
   from a row per member and batch.  Unlike the reference, skipped batches are
   not lost: their partials are already stored.

``metric_snapshot`` reads one metric's partials (partition-pruned) and
merges all batches with one hash aggregation.  Every ``compact_every``
batches the partials are merged into ``base/version=N``; readers open the
latest base and the folders of later batches only.  Folders that an earlier
base holds are deleted then, as are old snapshots and merged batch logs, so
neither files nor read cost grow with the age of the stream.  One ``out``
folder belongs to one checkpoint.
"""

from __future__ import annotations

import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from allelic.functions.genotype import bucket, is_het, pct
from allelic.operators.genes import annotate_gene
from allelic.operators.metrics import _het_summary, orientation, with_group_total
from allelic.sources import codec as C
from allelic.streaming.hotspots import read_hotspots, refresh_hotspots, refreshed_after
from allelic.streaming.runs import (
    Table, all_runs, delete, forget, has_parts, latest_version, numbered, previous, read_manifest, read_runs, take_in, write_manifest,
)

MEMBER = "member_type"


TOKEN_FIELDS = ["total_members", "num_children", "generation_start_time", "generation_end_time",
                "generation_duration_secs", "snps_per_member"]


def messages_to_snps(raw: DataFrame) -> DataFrame:
    """Raw ``value`` messages -> the flattened SNP view (event time as a
    UTC TIMESTAMP so it can carry a watermark), plus ``kind``, the
    micro-batch's ``processed_at`` (S4) and the completion token's fields
    (NULL on SNP messages).  A key that is no number gives a NULL id."""
    parsed = C.stamp_ingest_time(C.message_kind(C.parse_snp_json(raw)))
    # a message whose time cannot be read is corrupt; it must not end the stream
    parsed = parsed.withColumn("ts", F.try_to_timestamp("timestamp"))
    parsed = parsed.withColumn("kind", F.when(F.col("ts").isNull(), "corrupt").otherwise(F.col("kind")))
    flat = C.flatten_snp(parsed)
    key = F.col("key") if "key" in raw.columns else F.lit(None)
    return flat.select(
        key.try_cast("long").alias("snp_id"),
        "ts",
        "family_id", MEMBER, "person_id", "gender",
        (F.col("kind") == "snp").alias("has_snp"),
        "chromosome", "position", "genotype",
        F.lit(None).cast("string").alias("gt_num"),
        "kind", "_corrupt_record", "processed_at", *TOKEN_FIELDS)


# --- additive per-batch partials: one grouping-sets aggregation ----------------
# metric -> its grouping columns (a column absent from a set is NULL there)
_SETS = {
    "batch_metrics": [MEMBER],
    "chromosome_counts": [MEMBER, "chromosome_b", "genotype_b"],
    "position_counts": [MEMBER, "chromosome", "position"],
    "het_counts": [MEMBER, "person_id"],
    "gene_counts": [MEMBER, "gene"],
    "orientation_counts": [MEMBER, "orientation"],
    "family_tokens": ["family_id"],
    "minute_counts": [MEMBER, "minute"],
}
_KEYS = [MEMBER, "chromosome_b", "genotype_b", "chromosome", "position", "person_id", "gene",
         "orientation", "family_id", "minute"]


def _partials(snps: DataFrame) -> DataFrame:
    """All additive metric partials of one batch in a single pass: one scan
    of the batch, one partial aggregate, one shuffle.  ``metric`` names the
    grouping set each row belongs to."""
    valid = F.col("has_snp")
    rows = annotate_gene(snps, out="gene").select(
        MEMBER, "chromosome", "position", "person_id", "gene", "family_id", "ts", "kind", valid.alias("v"),
        bucket("chromosome", "Unknown").alias("chromosome_b"), bucket("genotype", "0/0").alias("genotype_b"),
        orientation("letters").alias("orientation"), is_het("genotype").alias("_h"),
        F.window("ts", "1 minute").start.alias("minute"))
    gid = F.grouping_id(*_KEYS)
    full = (1 << len(_KEYS)) - 1
    names = F.lit(None).cast("string")
    for name, cols in _SETS.items():
        mask = full
        for c in cols:
            mask &= ~(1 << (len(_KEYS) - 1 - _KEYS.index(c)))
        names = F.when(gid == mask, F.lit(name)).otherwise(names)
    agg = rows.groupingSets([tuple(c) for c in _SETS.values()], *_KEYS).agg(
        F.count_if(F.col("v")).alias("valid"),
        F.count(F.lit(1)).alias("messages"),
        F.count_if(F.col("kind") == "token").alias("tokens"),
        F.max("ts").alias("last_ts"),
        F.sum(F.when(F.col("v"), F.col("_h"))).cast("long").alias("heterozygous"),
        F.count(F.when(F.col("v"), F.col("_h"))).alias("het_n"),
        F.min(F.when(F.col("kind") == "token", F.col("ts"))).alias("first_token_ts"),
        names.alias("metric"))
    m = F.col("metric")
    keep = (m.isin("batch_metrics", "minute_counts")
            | (m.isin("chromosome_counts", "gene_counts") & (F.col("valid") > 0))
            | ((m == "position_counts") & (F.col("valid") > 0) & F.col("position").isNotNull())
            | ((m == "het_counts") & (F.col("het_n") > 0))
            | ((m == "orientation_counts") & (F.col("valid") > 0) & F.col("orientation").isNotNull())
            | ((m == "family_tokens") & (F.col("tokens") > 0)))
    return agg.filter(keep)


def write_partials(snps: DataFrame, batch_id: int, out: str) -> None:
    """All partials of a batch (the SNP view with ``kind``, without corrupt
    rows), in a folder of its own that a replay rewrites."""
    (_partials(snps).write.mode("overwrite").partitionBy("metric")
     .parquet(os.path.join(out, "partials", f"batch_id={batch_id}")))


# metric -> (key columns as stored -> output name, value columns -> merge)
_SUMS = {
    "batch_metrics": ({MEMBER: MEMBER}, {"valid": ("sum", "total_records"), "messages": ("sum", "messages"),
                                         "tokens": ("sum", "tokens"), "last_ts": ("max", "last_ts")}),
    "chromosome_counts": ({MEMBER: MEMBER, "chromosome_b": "chromosome", "genotype_b": "genotype"},
                          {"valid": ("sum", "count")}),
    "position_counts": ({MEMBER: MEMBER, "chromosome": "chromosome", "position": "position"},
                        {"valid": ("sum", "frequency")}),
    "het_counts": ({MEMBER: MEMBER, "person_id": "person_id"},
                   {"heterozygous": ("sum", "heterozygous"), "het_n": ("sum", "total_snps")}),
    "gene_counts": ({MEMBER: MEMBER, "gene": "gene"}, {"valid": ("sum", "count")}),
    "orientation_counts": ({MEMBER: MEMBER, "orientation": "orientation"}, {"valid": ("sum", "count")}),
    "family_tokens": ({"family_id": "family_id"}, {"first_token_ts": ("min", "first_token_ts")}),
    "minute_counts": ({MEMBER: MEMBER, "minute": "minute"},
                      {"messages": ("sum", "total_records"), "valid": ("sum", "valid_records")}),
}


_VALUE_MERGE = {"valid": "sum", "messages": "sum", "tokens": "sum", "last_ts": "max",
                "heterozygous": "sum", "het_n": "sum", "first_token_ts": "min"}


def _merge(col: str, how: str):
    e = {"sum": F.sum, "max": F.max, "min": F.min}[how](col)
    return (e.cast("long") if how == "sum" else e).alias(col)


#: Types of a folder of partials in which no batch has a row.
_EMPTY = """member_type string, chromosome_b string, genotype_b string, chromosome string, position int, person_id string,
    gene string, orientation string, family_id string, minute timestamp, valid long, messages long, tokens long,
    last_ts timestamp, heterozygous long, het_n long, first_token_ts timestamp, metric string, batch_id int"""


def _partial_rows(spark: SparkSession, out: str, upto: int | None = None, after: int | None = None) -> DataFrame:
    """Partials of every batch (up to ``upto``): the latest compacted base
    (below ``upto``) plus the per-batch partials written after it; older
    batch folders are pruned by ``batch_id``.  With ``after``, only the
    folders of later batches.  Batches without SNPs and tokens give no rows."""
    base_dir, folder = os.path.join(out, "base"), os.path.join(out, "partials")
    v = after if after is not None else latest_version(spark, base_dir, before=upto)
    written = [b for b in numbered(spark, folder, "batch_id=") if (v is None or b > v) and (upto is None or b <= upto)]
    if v is None and not written:
        raise FileNotFoundError(f"no partials under {out}")
    later = [p for p in (os.path.join(folder, f"batch_id={b}") for b in written) if has_parts(spark, p)]
    rows = spark.read.option("basePath", folder).parquet(*later) if later else None
    held = os.path.join(base_dir, f"version={v}")
    if after is None and v is not None and has_parts(spark, held):
        base = spark.read.parquet(held).withColumn("batch_id", F.lit(v))
        rows = base if rows is None else rows.unionByName(base, allowMissingColumns=True)
    return spark.createDataFrame([], _EMPTY) if rows is None else rows


def compact(spark: SparkSession, out: str, batch_id: int) -> None:
    """Merge all partials up to ``batch_id`` into ``base/version=batch_id``
    (one aggregation over every metric), starting from the newest base
    strictly below it.  Re-running it for the same batch rewrites the same
    version from the same inputs, so compaction is replay-safe too."""
    bases, folder, logs = os.path.join(out, "base"), os.path.join(out, "partials"), os.path.join(out, "batch_log")
    if any(v > batch_id for v in numbered(spark, bases, "version=")):
        return  # a later base holds this one
    rows = _partial_rows(spark, out, upto=batch_id)
    merged = rows.groupBy("metric", *_KEYS).agg(*[_merge(c, h) for c, h in _VALUE_MERGE.items()])
    (merged.write.mode("overwrite").partitionBy("metric")
     .parquet(os.path.join(bases, f"version={batch_id}")))
    # what the base before this one holds is needed by no replay
    older = [v for v in numbered(spark, bases, "version=") if v < batch_id]
    for v in older[:-1]:
        delete(spark, os.path.join(bases, f"version={v}"))
    held = older[-1] if older else -1
    for b in numbered(spark, folder, "batch_id="):
        if b <= held:
            delete(spark, os.path.join(folder, f"batch_id={b}"))
    log = [b for b in numbered(spark, logs, "batch_id=") if b <= held]
    if len(log) > 1:  # the newest of them takes the rows of the others
        rows = batch_log(spark, out).filter(F.col("batch_id") <= held)
        rows.coalesce(1).write.mode("overwrite").parquet(os.path.join(out, "batch_log_base", f"version={held}"))
        for b in log:
            delete(spark, os.path.join(logs, f"batch_id={b}"))
        for v in numbered(spark, os.path.join(out, "batch_log_base"), "version=")[:-1]:
            delete(spark, os.path.join(out, "batch_log_base", f"version={v}"))


def batch_log(spark: SparkSession, out: str) -> DataFrame:
    """One row per batch: batch_id, processing_ms, corrupt, finished_at."""
    folder, base = os.path.join(out, "batch_log"), os.path.join(out, "batch_log_base")
    v = latest_version(spark, base)
    later = [b for b in numbered(spark, folder, "batch_id=") if v is None or b > v]
    paths = [os.path.join(folder, f"batch_id={b}") for b in later]
    if v is not None:
        paths.append(os.path.join(base, f"version={v}"))
    return spark.read.schema("batch_id long, processing_ms double, corrupt long, finished_at timestamp").parquet(*paths)


def window_snapshot(spark: SparkSession, out: str, minutes: int = 1) -> DataFrame:
    """Current counts per member and event-time window of whole minutes, and
    the window's rate of valid records per second (A2, W1 over windows)."""
    m = metric_snapshot(spark, out, "minute_counts").filter(F.col("minute").isNotNull())
    w = F.window("minute", f"{minutes} minutes")
    return (m.groupBy(MEMBER, w.start.alias("window_start"))
            .agg(F.sum("total_records").cast("long").alias("total_records"),
                 F.sum("valid_records").cast("long").alias("valid_records"))
            .withColumn("rate", F.round(F.col("valid_records") / (minutes * 60.0), 4)))


def genotype_snapshot(spark: SparkSession, out: str) -> DataFrame:
    """Current genotype counts, totals and percent per member (A5)."""
    counts = (metric_snapshot(spark, out, "chromosome_counts").groupBy(MEMBER, "genotype")
              .agg(F.sum("count").cast("long").alias("count")))
    return with_group_total(counts, [MEMBER], "total").withColumn("pct", pct("count", "total", share_first=True))


def metric_snapshot(spark: SparkSession, out: str, metric: str) -> DataFrame:
    """Merged current value of a metric over every stored batch (the
    ``metric`` partition filter prunes the other metrics' files)."""
    keys, vals = _SUMS[metric]
    parts = _partial_rows(spark, out).filter(F.col("metric") == metric)
    exprs = []
    for c, (how, name) in vals.items():
        e = {"sum": F.sum, "max": F.max, "min": F.min}[how](c)
        exprs.append((e.cast("long") if how == "sum" else e).alias(name))
    return parts.groupBy(*[F.col(k).alias(v) for k, v in keys.items()]).agg(*exprs)


def refresh_positions(spark: SparkSession, out: str, batch_id: int) -> None:
    """Each member's hotspots after a batch, from the partials written
    since the last refresh.  Partials that are in a base only cannot be told
    from those before them; then the table is begun anew from all."""
    path = os.path.join(out, "hotspots")
    last = refreshed_after(spark, path, batch_id)
    since = range(0 if last is None else last + 1, batch_id + 1)
    again = last is not None and not set(since) <= set(numbered(spark, os.path.join(out, "partials"), "batch_id="))
    rows = _partial_rows(spark, out, upto=batch_id, after=None if again else last)
    new = rows.filter(F.col("metric") == "position_counts").select(MEMBER, "chromosome", "position", F.col("valid").alias("frequency"))
    refresh_hotspots(spark, new, batch_id, path, again=again)


def population_snapshot(spark: SparkSession, out: str) -> DataFrame:
    """A7 over every stored batch, from a row per member and batch."""
    rows = _partial_rows(spark, out).filter(F.col("metric") == "batch_metrics")
    pop = (rows.groupBy(MEMBER).agg(F.sum("heterozygous").cast("long").alias("heterozygous"),
                                    F.sum("het_n").cast("long").alias("total_snps"))
           .filter(F.col("total_snps") > 0)
           .withColumn("homozygous", F.col("total_snps") - F.col("heterozygous")))
    # the batch operator's own summary: identical numbers on both paths
    return _het_summary(pop, [MEMBER])


def derived_snapshot(spark: SparkSession, out: str, name: str) -> DataFrame:
    """The newest refresh of a derived metric (``hotspots``,
    ``population``) that the sink wrote, with the batch it was made after."""
    if name == "hotspots":
        return read_hotspots(spark, os.path.join(out, "hotspots"))
    folder = os.path.join(out, "snapshots", name)
    v = latest_version(spark, folder)
    if v is None:
        raise FileNotFoundError(f"no refresh of {name} under {out}")
    return spark.read.parquet(os.path.join(folder, f"version={v}")).withColumn("batch_id", F.lit(v).cast("long"))


#: Runs of an event date that are left alone, and that are merged whatever their sizes.
FEW_RUNS, MOST_RUNS = 8, 24


def _archive(path: str) -> Table:
    # readers that list the folder skip names that begin with an underscore
    return Table(path, os.path.join(path, "_manifest"), "batch_id", "event_date")


def archive_batch(spark: SparkSession, batch: DataFrame, batch_id: int, path: str, keep: int = 2) -> int:
    """Appends the rows to the archive, corrupt ones too; returns how many
    are corrupt.

    Rows lie by event date, sorted by event time inside each file, so hour and
    time filters prune row groups by Parquet statistics.  Each date is a list
    of runs (see ``runs``): with over ``FEW_RUNS``, the batch takes in the small
    ones, sorted anew into files of the size adaptive execution aims at, so the
    number of files does not grow with the age of the stream.  A replay
    rewrites the same files; ``read_archive`` reads what the newest manifest
    names.
    """
    table = _archive(path)
    rows = batch.withColumn("event_date", F.to_date("ts")).withColumn("event_hour", F.hour("ts"))
    found = rows.groupBy("event_date").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("kind") == "corrupt").alias("corrupt")).collect()
    touched = {None if r["event_date"] is None else r["event_date"].isoformat(): r["n"] for r in found}  # dates of one batch
    settings, held = previous(spark, table, batch_id)
    taken, left = take_in(held, touched, unless_over=FEW_RUNS, most=MOST_RUNS)
    if touched:
        merged = rows
        if taken:
            old = read_runs(spark, table, taken)
            merged = old.withColumn("event_date", F.col("event_date").cast("date")).unionByName(rows, allowMissingColumns=True)
            merged = merged.repartitionByRange("event_date", "ts")
        (merged.sortWithinPartitions("event_date", "ts").write.mode("overwrite").partitionBy("event_date")
         .parquet(os.path.join(path, f"{table.run}={batch_id}")))
        size = {part: n + sum(dict(held[part])[run] for run, p in taken if p == part) for part, n in touched.items()}
        for part, n in size.items():
            left[part].append((batch_id, n))
    write_manifest(spark, table, batch_id, settings or {}, left)
    forget(spark, table, batch_id, keep)
    return sum(r["corrupt"] for r in found)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The archived rows with event_date and event_hour, by the newest
    manifest; filters on event_date prune folders."""
    table = _archive(path)
    v = latest_version(spark, table.manifests)
    held = read_manifest(spark, table, v)[1] if v is not None else {}
    if not held:
        raise FileNotFoundError(f"no archive under {path}")
    return read_runs(spark, table, all_runs(held))


def _write_batch(spark: SparkSession, batch: DataFrame, batch_id: int, out: str,
                 archive: str | None, every: int, compact_every: int = 0) -> None:
    started = time.time()
    batch.persist()
    try:
        if archive:
            corrupt = archive_batch(spark, batch, batch_id, archive)
        else:
            corrupt = batch.filter(F.col("kind") == "corrupt").count()
        snps = batch.filter(F.col("kind") != "corrupt")
        write_partials(snps, batch_id, out)
        if compact_every and batch_id > 0 and batch_id % compact_every == 0:
            compact(spark, out, batch_id)
        if every and batch_id % every == 0:
            # versioned by batch id: a replay rewrites the same version
            refresh_positions(spark, out, batch_id)
            folder = os.path.join(out, "snapshots", "population")
            population_snapshot(spark, out).write.mode("overwrite").parquet(os.path.join(folder, f"version={batch_id}"))
            for v in numbered(spark, folder, "version=")[:-2]:
                if v < batch_id:
                    delete(spark, os.path.join(folder, f"version={v}"))
        # One row per batch with its processing time (the metric work
        # above, as the reference measured it), replay-safe like the partials
        ms = (time.time() - started) * 1000.0
        (spark.range(1).select(F.lit(batch_id).cast("long").alias("batch_id"),
                               F.lit(round(ms, 3)).alias("processing_ms"),
                               F.lit(corrupt).cast("long").alias("corrupt"),
                               F.current_timestamp().alias("finished_at"))
         .write.mode("overwrite").parquet(os.path.join(out, "batch_log", f"batch_id={batch_id}")))
    finally:
        batch.unpersist()


def run_metrics(spark: SparkSession, source: str, out: str, checkpoint: str, *,
                fmt: str = "kafka", topics: str | None = None, every: int = 5, compact_every: int = 100,
                archive: str | None = None, max_per_trigger: int | None = None,
                available_now: bool = False, trigger_seconds: int = 1) -> StreamingQuery:
    """Start the per-batch metric query (1 s trigger, or
    ``availableNow`` to drain what exists and stop)."""
    raw = C.read_snp_stream(spark, source, fmt, topics=topics, max_per_trigger=max_per_trigger)
    snps = messages_to_snps(raw)
    w = (snps.writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(lambda b, i: _write_batch(spark, b, i, out, archive, every, compact_every)))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=f"{trigger_seconds} seconds")
    return w.start()


# --- S5 / S6 --------------------------------------------------------------------
def archive(df: DataFrame, path: str, checkpoint: str, *, partition_by=(),
            available_now: bool = False, trigger_seconds: int = 1) -> StreamingQuery:
    """Append the parsed rows to Parquet (exactly once through the file
    sink's commit log).  ``partition_by=("event_date", "event_hour")``
    lays the archive out by event time so later reads prune partitions."""
    src = df
    if "event_date" in partition_by:
        src = src.withColumn("event_date", F.to_date("ts"))
    if "event_hour" in partition_by:
        src = src.withColumn("event_hour", F.hour("ts"))
    w = (src.writeStream.format("parquet").outputMode("append")
         .option("path", path).option("checkpointLocation", checkpoint))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=f"{trigger_seconds} seconds")
    return w.start()
