"""Batch-stream parity, replay safety, restart recovery."""
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from allelic.operators import metrics as M
from allelic.plans.catalog import load_snps
from allelic.sources import codec as C
from allelic.sources.fixture import nest_snp
from allelic.streaming import runner as R
from allelic.streaming import stateful as ST

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def msg_dir(spark):
    """The sf0.001 SNP view written as JSON message files (one per line)."""
    d = tempfile.mkdtemp(prefix="allelic-msgs-")
    msgs = C.encode_snp_json(C.to_message(nest_snp(load_snps(spark, SF))), key_col="snp_id")
    # text files hold only the JSON value; put the id inside as well
    src = msgs.select(F.col("value"))
    src.repartition(4).write.text(os.path.join(d, "all"))
    return os.path.join(d, "all")


def _batch_snps(spark):
    s = load_snps(spark, SF)
    return s


def test_foreach_batch_parity_with_batch(spark, msg_dir):
    root = tempfile.mkdtemp(prefix="allelic-run-")
    out, ck = os.path.join(root, "out"), os.path.join(root, "ck")
    q = R.run_metrics(spark, msg_dir, out, ck, fmt="text", available_now=True, max_per_trigger=1,
                      archive=os.path.join(root, "archive"), every=2)
    q.awaitTermination()
    assert q.lastProgress is not None
    batch = _batch_snps(spark)
    # chromosome distribution: stream partials merged == batch operator
    s = R.metric_snapshot(spark, out, "chromosome_counts").select("member_type", "chromosome", "genotype", "count")
    b = M.chromosome_distribution(batch).select("member_type", "chromosome", "genotype", "count")
    assert s.exceptAll(b).count() == 0 and b.exceptAll(s).count() == 0
    # several micro-batches really ran
    assert spark.read.parquet(os.path.join(out, "partials")).select("batch_id").distinct().count() >= 4
    # population heterozygosity from the snapshot == batch operator
    pop = R.derived_snapshot(spark, out, "population")
    latest = pop.select("batch_id").distinct().collect()
    assert len(latest) == 1 and pop.count() == 3
    latest = latest[0][0]
    hot = R.derived_snapshot(spark, out, "hotspots")
    assert hot.groupBy("member_type").agg(F.max("rank").alias("r")).filter("r <> 10").count() == 0
    with pytest.raises(FileNotFoundError):
        R.derived_snapshot(spark, out, "no such metric")
    # the newest snapshot covers every batch up to its version; recompute the
    # same snapshot now over all batches and compare it with the batch operator
    assert latest % 2 == 0
    now = R.population_snapshot(spark, out)
    cols = ["member_type", "heterozygous", "homozygous", "heterozygous_pct", "homozygous_pct",
            "diversity", "total_snps"]
    ref = M.population_heterozygosity(batch).select(*cols)
    assert now.select(*cols).exceptAll(ref).count() == 0 and ref.exceptAll(now.select(*cols)).count() == 0
    log = R.batch_log(spark, out)
    assert log.count() == spark.read.parquet(os.path.join(out, "partials")).select("batch_id").distinct().count()
    assert log.filter("processing_ms > 0").count() == log.count()
    # archive holds every message once
    assert R.read_archive(spark, os.path.join(root, "archive")).count() == 1000


def test_replayed_batch_changes_nothing(spark, msg_dir):
    root = tempfile.mkdtemp(prefix="allelic-replay-")
    out = os.path.join(root, "out")
    raw = spark.read.text(msg_dir).select(F.lit(None).cast("string").alias("key"), "value")
    batch = R.messages_to_snps(raw)
    R._write_batch(spark, batch, 0, out, None, every=1)
    first = sorted(R.metric_snapshot(spark, out, "gene_counts").collect())
    R._write_batch(spark, batch, 0, out, None, every=1)  # at-least-once redelivery
    assert sorted(R.metric_snapshot(spark, out, "gene_counts").collect()) == first


def test_restart_from_checkpoint(spark, msg_dir):
    root = tempfile.mkdtemp(prefix="allelic-restart-")
    src, out, ck = os.path.join(root, "src"), os.path.join(root, "out"), os.path.join(root, "ck")
    os.makedirs(src)
    files = sorted(f for f in os.listdir(msg_dir) if f.startswith("part-"))
    import shutil
    for f in files[:2]:
        shutil.copy(os.path.join(msg_dir, f), src)
    R.run_metrics(spark, src, out, ck, fmt="text", available_now=True).awaitTermination()
    n1 = R.metric_snapshot(spark, out, "batch_metrics").agg(F.sum("messages")).first()[0]
    for f in files[2:]:
        shutil.copy(os.path.join(msg_dir, f), src)
    # a new query on the same checkpoint only reads the new files
    R.run_metrics(spark, src, out, ck, fmt="text", available_now=True).awaitTermination()
    n2 = R.metric_snapshot(spark, out, "batch_metrics").agg(F.sum("messages")).first()[0]
    assert n1 < n2 == 1000


def test_stream_window_counts_parity(spark):
    snps = load_snps(spark, SF).withColumn("ts", F.col("ts").cast("timestamp"))
    root = tempfile.mkdtemp(prefix="allelic-win-")
    src = os.path.join(root, "src")
    snps.repartition(3).write.parquet(src)
    stream = spark.readStream.schema(snps.schema).option("maxFilesPerTrigger", 1).parquet(src)
    agg = ST.stream_window_counts(stream, "1 hour")
    q = (agg.writeStream.outputMode("complete").format("memory").queryName("wc_parity")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.table("wc_parity").select("window_start", "member_type", "total_records", "valid_records")
    ref = M.window_counts(snps, "1 hour").select("window_start", "member_type", "total_records", "valid_records")
    assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0


def test_family_completion_once_each(spark):
    import datetime as dt
    t = dt.datetime(2024, 1, 1)
    rows = [("F1", t, False), ("F1", t + dt.timedelta(seconds=5), False), ("F2", t, False), ("F3", t, True)]
    root = tempfile.mkdtemp(prefix="allelic-fam-")
    spark.createDataFrame(rows, "family_id string, ts timestamp, has_snp boolean").write.parquet(root + "/src")
    stream = spark.readStream.schema("family_id string, ts timestamp, has_snp boolean").parquet(root + "/src")
    q = (ST.stream_family_completion(stream).writeStream.format("memory").queryName("fam_done")
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    assert sorted(r.family_id for r in spark.table("fam_done").collect()) == ["F1", "F2"]


def test_upsert_snapshot_last_write_wins(spark):
    import datetime as dt
    root = tempfile.mkdtemp(prefix="allelic-snap-") + "/snap"
    t = dt.datetime(2024, 1, 1)
    b0 = spark.createDataFrame([("p1", t, 1), ("p2", t, 2)], "k string, ts timestamp, v int")
    b1 = spark.createDataFrame([("p1", t + dt.timedelta(seconds=1), 10)], "k string, ts timestamp, v int")
    ST.upsert_snapshot(spark, b0, 0, root, ["k"], "ts")
    ST.upsert_snapshot(spark, b1, 1, root, ["k"], "ts")
    ST.upsert_snapshot(spark, b1, 1, root, ["k"], "ts")  # replay
    got = sorted((r.k, r.v) for r in ST.read_snapshot(spark, root).collect())
    assert got == [("p1", 10), ("p2", 2)]


def test_running_totals_and_rate_stream(spark):
    snps = load_snps(spark, SF).withColumn("ts", F.col("ts").cast("timestamp"))
    root = tempfile.mkdtemp(prefix="allelic-rt-")
    snps.write.parquet(root + "/src")
    stream = spark.readStream.schema(snps.schema).parquet(root + "/src")
    q = (ST.stream_running_totals(stream).writeStream.outputMode("complete").format("memory")
         .queryName("rt").trigger(availableNow=True).start())
    q.awaitTermination()
    got = {r.member_type: r.total_records for r in spark.table("rt").collect()}
    ref = {r.member_type: r.total_records for r in M.running_totals(snps).collect() if r.member_type != "all"}
    assert got == ref
    q = (ST.stream_mutation_rate(stream, 3600, 600).writeStream.outputMode("complete").format("memory")
         .queryName("rate").trigger(availableNow=True).start())
    q.awaitTermination()
    total = spark.table("rate").agg(F.sum("n_window")).first()[0]
    assert total == 6 * snps.filter("has_snp").count()  # every event sits in 3600/600 windows


def test_compaction_keeps_totals(spark, msg_dir):
    root = tempfile.mkdtemp(prefix="allelic-compact-")
    out, ck = os.path.join(root, "out"), os.path.join(root, "ck")
    R.run_metrics(spark, msg_dir, out, ck, fmt="text", available_now=True, max_per_trigger=1,
                  every=0, compact_every=2).awaitTermination()
    assert os.path.isdir(os.path.join(out, "base"))
    batch = load_snps(spark, SF)
    got = R.metric_snapshot(spark, out, "gene_counts").groupBy("gene").agg(F.sum("count").alias("count"))
    ref = M.gene_frequency(batch)
    assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0
    R.compact(spark, out, 2)  # replayed compaction of an old version changes nothing
    got2 = R.metric_snapshot(spark, out, "gene_counts").groupBy("gene").agg(F.sum("count").alias("count"))
    assert got2.exceptAll(ref).count() == 0


def test_archive_partitioned_by_event_time(spark, msg_dir):
    root = tempfile.mkdtemp(prefix="allelic-arch-")
    raw = C.read_snp_stream(spark, msg_dir, "text", max_per_trigger=2)
    q = R.archive(R.messages_to_snps(raw), os.path.join(root, "a"), os.path.join(root, "ck"),
                  partition_by=("event_date", "event_hour"), available_now=True)
    q.awaitTermination()
    back = spark.read.parquet(os.path.join(root, "a"))
    assert back.count() == 1000
    day = back.filter(F.col("event_date") == "2024-01-02")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    ref = load_snps(spark, SF).filter(F.to_date("ts") == "2024-01-02").count()
    assert day.count() == ref


def test_window_counts_append_mode_drops_late_rows(spark):
    import datetime as dt
    import shutil
    root = tempfile.mkdtemp(prefix="allelic-late-")
    src = os.path.join(root, "src")
    os.makedirs(src)
    ddl = "member_type string, ts timestamp, has_snp boolean"
    t = dt.datetime(2024, 1, 1, 0, 0, 0)
    batches = [
        [("child", t + dt.timedelta(minutes=1), True), ("child", t + dt.timedelta(minutes=2), True)],
        # advances the watermark to 02:00 - 10 min
        [("child", t + dt.timedelta(hours=2), True)],
        # late for the closed 00:00 window: dropped
        [("child", t + dt.timedelta(minutes=3), True), ("child", t + dt.timedelta(hours=2, minutes=5), True)],
    ]
    stream = spark.readStream.schema(ddl).option("maxFilesPerTrigger", 1).parquet(src)
    q = (ST.stream_window_counts(stream, "1 hour").writeStream.outputMode("append").format("memory")
         .queryName("late_rows").option("checkpointLocation", os.path.join(root, "ck"))
         .trigger(processingTime="0 seconds").start())
    try:
        for i, rows in enumerate(batches):
            d = os.path.join(root, f"b{i}")
            spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(d)
            f = [x for x in os.listdir(d) if x.endswith(".parquet")][0]
            shutil.copy(os.path.join(d, f), os.path.join(src, f"part-{i}.parquet"))
            q.processAllAvailable()
    finally:
        q.stop()
    got = {(r.window_start.hour, r.total_records) for r in spark.table("late_rows").collect()}
    # the 00:00 window was emitted once with its two on-time rows; the late
    # 00:03 row did not reopen it; the 02:00 window is still open
    assert got == {(0, 2)}


def test_stream_partials_match_batch_operators(spark, msg_dir):
    root = tempfile.mkdtemp(prefix="allelic-par2-")
    out, ck = os.path.join(root, "out"), os.path.join(root, "ck")
    R.run_metrics(spark, msg_dir, out, ck, fmt="text", available_now=True, max_per_trigger=1,
                  every=0, compact_every=3).awaitTermination()
    batch = load_snps(spark, SF)

    def same(a, b):
        return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0

    hot_cols = ["member_type", "chromosome", "position", "frequency", "rank"]
    R.refresh_positions(spark, out, max(b.batch_id for b in R.batch_log(spark, out).collect()))
    hot = R.derived_snapshot(spark, out, "hotspots").select(*hot_cols)
    assert same(hot, M.position_hotspots(batch, per_member=True).select(*hot_cols))
    orient = (R.metric_snapshot(spark, out, "orientation_counts")
              .groupBy("member_type").pivot("orientation", ["dominant", "recessive", "heterozygous"])
              .agg(F.sum("count")).na.fill(0))
    ref = M.genotype_class_trends(batch).select("member_type", "dominant", "recessive", "heterozygous")
    assert same(orient.select(ref.columns), ref)
    genes = R.metric_snapshot(spark, out, "gene_counts").groupBy("gene").agg(F.sum("count").alias("count"))
    assert same(genes, M.gene_frequency(batch))
    ind = (R.metric_snapshot(spark, out, "het_counts")
           .filter(F.col("person_id").isNotNull() & (F.col("person_id") != ""))
           .select("member_type", "person_id", "heterozygous", "total_snps"))
    assert same(ind, M.individual_heterozygosity(batch).select(ind.columns))


def test_read_snp_stream_parquet_with_file_cap(spark):
    snps = load_snps(spark, SF).withColumn("ts", F.col("ts").cast("timestamp"))
    root = tempfile.mkdtemp(prefix="allelic-pq-")
    snps.repartition(4).write.parquet(os.path.join(root, "src"))
    stream = C.read_snp_stream(spark, os.path.join(root, "src"), "parquet", max_per_trigger=1,
                               schema=snps.schema)
    q = (stream.writeStream.format("memory").queryName("pq_rows").trigger(availableNow=True)
         .option("checkpointLocation", os.path.join(root, "ck")).start())
    q.awaitTermination()
    assert spark.table("pq_rows").count() == 1000
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 4  # one file per batch


def _message(**fields):
    import json
    base = {"family_id": "f1", "member_type": "child", "person_id": "c1", "gender": "F",
            "snp_data": {"chromosome": "1", "position": 100, "genotype": "AG"},
            "timestamp": "2024-01-01T00:00:01.000000"}
    return json.dumps(base | fields)


def _keyless():
    def at(member, person, gt, second):
        return _message(member_type=member, person_id=person, timestamp=f"2024-01-01T00:00:{second:02d}.000000",
                        snp_data={"chromosome": "1", "position": 100, "genotype": gt})
    return [at("father", "p1", "AA", 1), at("mother", "m1", "GG", 2), at("child", "c1", "AG", 3), at("child", "c2", "AG", 4),
            at("child", "c2", "TT", 9),  # a later call of the same locus
            _message(timestamp="yesterday"), _message(timestamp=None), "no json", "",
            _message(message_type="FAMILY_COMPLETE", snp_data=None, member_type="family", person_id=None, total_members=4, num_children=2,
                     snps_per_member={"father": 1, "mother": 1, "children": [1, 2]})]


def test_messages_without_ids(spark):
    """Trios, similarity, samples and tokens of messages as the producer sends them."""
    from allelic.operators import family as FAM
    from allelic.operators import metrics as M
    from allelic.operators import timeseries as TS
    raw = spark.createDataFrame([("text key", v) for v in _keyless()], "key string, value string")
    rows = R.messages_to_snps(raw)
    kinds = {r["kind"]: r["n"] for r in rows.groupBy("kind").agg(F.count("*").alias("n")).collect()}
    assert kinds == {"snp": 5, "token": 1, "corrupt": 4}
    good = rows.filter("kind <> 'corrupt'")
    calls = FAM.genotype_calls(good)
    assert sorted((r.child_id, r.child_gt, r.father_gt, r.mother_gt) for r in FAM.trio_join(calls).collect()) == [
        ("c1", "AG", "AA", "GG"), ("c2", "AG", "AA", "GG")]
    pairs = {(r.relation, r.person_a, r.person_b): r.similarity for r in FAM.genetic_similarity(calls).collect()}
    assert pairs[("siblings", "c1", "c2")] == 1.0 and pairs[("father-mother", "p1", "m1")] == 0.0 and len(pairs) == 6
    sample = {r.member_type: r.sample_genotype for r in M.batch_metrics(good, with_sample=True).collect()}
    assert sample["father"] == "AA" and sample["child"] == "AG"
    first = TS.first_per_batch(good.filter("has_snp"), "family_id").first()
    assert first.person_id == "p1"
    check = FAM.check_tokens(good.filter("kind = 'token'"), good).first()
    assert check.agrees and check.total_snps == 5


def test_bad_messages_do_not_end_the_stream(spark):
    root = tempfile.mkdtemp(prefix="allelic-bad-")
    src, out = os.path.join(root, "in"), os.path.join(root, "out")
    spark.createDataFrame([(v,) for v in _keyless()], "value string").coalesce(1).write.text(src)
    R.run_metrics(spark, src, out, os.path.join(root, "ckpt"), fmt="text", available_now=True, every=1).awaitTermination()
    log = R.batch_log(spark, out).agg(F.sum("corrupt")).first()[0]
    assert log >= 3  # an empty line may be dropped by the text reader
    counts = {r.member_type: r.total_records for r in R.metric_snapshot(spark, out, "batch_metrics").collect()}
    assert counts["child"] == 3 and counts["father"] == 1
    windows = {r.member_type: r.valid_records for r in R.window_snapshot(spark, out, 5).collect()}
    assert windows["child"] == 3
    assert {(r.member_type, r.genotype): r["count"] for r in R.genotype_snapshot(spark, out).collect()}[("child", "AG")] == 2


def test_files_of_a_long_stream_stay_few(spark):
    """60 batches through the sink; a replay of the last one changes nothing."""
    from allelic.streaming.runs import numbered
    out = os.path.join(tempfile.mkdtemp(prefix="allelic-long-"), "out")
    raw = spark.createDataFrame([(None, v) for v in _keyless()[:5]], "key string, value string")
    batch = R.messages_to_snps(raw).cache()
    for i in range(60):
        R._write_batch(spark, batch, i, out, None, 30, 10)
    R._write_batch(spark, batch, 59, out, None, 30, 10)
    assert len(numbered(spark, os.path.join(out, "partials"), "batch_id=")) <= 20
    assert len(numbered(spark, os.path.join(out, "base"), "version=")) <= 2
    assert len(numbered(spark, os.path.join(out, "batch_log"), "batch_id=")) <= 20
    assert R.batch_log(spark, out).select("batch_id").distinct().count() == 60 == R.batch_log(spark, out).count()
    got = {r.member_type: r.total_records for r in R.metric_snapshot(spark, out, "batch_metrics").collect()}
    assert got == {"father": 60, "mother": 60, "child": 180}


def test_two_fathers_give_two_rows(spark):
    from allelic.operators import family as FAM
    rows = [("f", "p1", "father", "1:5", "TT"), ("f", "p2", "father", "1:5", "AA"), ("f", "m", "mother", "1:5", "AG"),
            ("f", "c", "child", "1:5", "AG"), (None, "x", "father", "1:5", "AA"), (None, "y", "child", "1:5", "AA"), (None, "z", "mother", "1:5", "AA")]
    calls = spark.createDataFrame(rows, "family_id string, person_id string, member_type string, locus string, genotype string")
    assert sorted((r.father_id, r.father_gt) for r in FAM.trio_join(calls).collect()) == [("p1", "TT"), ("p2", "AA")]


def test_cells_hold_a_hot_window(spark):
    """Trailing counts over a window that holds nearly all rows."""
    from allelic.operators import timeseries as TS
    times = [i * 7 for i in range(2000)] + [5, 5, 40_000]
    rows = spark.createDataFrame([(t, True) for t in times], "t long, has_snp boolean").select(
        F.timestamp_seconds("t").alias("ts"), "has_snp")
    got = {int(r.ts.timestamp()): (r.n_21600s, r.n_30s) for r in TS.rate_series(rows, (21600, 30)).collect()}
    for t in {0, 5, 7, 700, 13_993, 40_000}:
        assert got[t] == (sum(t - 21600 < x <= t for x in times), sum(t - 30 < x <= t for x in times))


def test_sequence_numbers_every_row(spark):
    from allelic.operators import timeseries as TS
    rows = [("g", None, 1), ("g", None, 2), ("g", 5, 1), ("g", 5, 2), ("g", 5, 0), ("g", 7, 9), (None, 1, 1)]
    df = spark.createDataFrame(rows, "g string, t int, u int")
    got = sorted((r.g or "", r.seq, r.t, r.u) for r in TS.sequence(df, ["g"], ["t", "u"]).collect())
    assert got == [("", 0, 1, 1), ("g", 0, None, 1), ("g", 1, None, 2), ("g", 2, 5, 0), ("g", 3, 5, 1), ("g", 4, 5, 2), ("g", 5, 7, 9)]
    assert TS.downsample(df, 3, ["t", "u"], by=["g"]).filter("g = 'g'").count() == 3
