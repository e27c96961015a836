"""Live hotspots: equal to the batch operator after every refresh, replay-safe, candidates only."""
import os
import random
import tempfile

from pyspark.sql import functions as F

from allelic.operators import metrics as M
from allelic.streaming import hotspots as H
from allelic.streaming import runner as R
from allelic.streaming.runs import numbered, previous

DDL = "member_type string, chromosome string, position int, frequency long"


def _brute(rows, k):
    sums = {}
    for m, c, p, n in rows:
        sums[m, c, p] = sums.get((m, c, p), 0) + n
    out = set()
    for m in {x[0] for x in sums}:
        own = sorted(((-n, x[1] is None, x[1] or "", x[2], x[1]) for x, n in sums.items() if x[0] == m))
        out |= {(m, c, p, -n, i + 1) for i, (n, _, _, p, c) in enumerate(own[:k])}
    return out


def _lists(spark, path):
    return {tuple(r) for r in H.read_hotspots(spark, path).drop("batch_id").collect()}


def _rows(rng, n, spread):
    return [(rng.choice(["father", "child", None]), rng.choice(["1", "2", None]), rng.randrange(spread), 1 + (rng.random() < 0.1)) for _ in range(n)]


def test_each_refresh_equals_brute_force(spark):
    """Ties, NULL members and chromosomes, positions that overtake listed ones, an empty refresh, a replay."""
    rng, path, all_rows = random.Random(5), os.path.join(tempfile.mkdtemp(prefix="allelic-hot-"), "h"), []
    batches = [_rows(rng, 300, 60), _rows(rng, 200, 200), [], _rows(rng, 40, 8) * 3, [("mother", "X", 7, 2)], _rows(rng, 300, 60)]
    for i, rows in enumerate(batches):
        for _ in range(2 if i in (1, 3) else 1):  # a replay rewrites the same refresh
            H.refresh_hotspots(spark, spark.createDataFrame(rows, DDL), i * 5, path, k=4)
        all_rows += rows
        assert _lists(spark, path) == _brute(all_rows, 4), i
    assert len(numbered(spark, os.path.join(path, "lists"), "version=")) == 2


def test_begins_with_nothing_and_anew(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="allelic-hot-"), "h")
    H.refresh_hotspots(spark, spark.createDataFrame([], DDL), 0, path, k=3)
    assert _lists(spark, path) == set()
    rows = [("father", "1", p, 1 + p % 3) for p in range(20)]
    H.refresh_hotspots(spark, spark.createDataFrame(rows, DDL), 1, path, k=3)
    assert _lists(spark, path) == _brute(rows, 3)
    H.refresh_hotspots(spark, spark.createDataFrame(rows, DDL), 2, path, k=3, again=True)
    assert _lists(spark, path) == _brute(rows, 3)


def test_positions_below_the_bound_are_no_candidates(spark):
    """Many cold positions and few hot ones: a batch of cold ones reads no bucket."""
    path = os.path.join(tempfile.mkdtemp(prefix="allelic-hot-"), "h")
    hot = [("father", "1", p, 1000 + p) for p in range(5)]
    cold = [("father", "2", p, 1) for p in range(2000)]
    H.refresh_hotspots(spark, spark.createDataFrame(hot + cold, DDL), 0, path, k=5)
    table = H.hotspot_table(path)
    _, held = previous(spark, table, 1)
    listed = H.read_hotspots(spark, path).drop("rank", "batch_id")
    hot_cells = F.pmod(F.xxhash64(*H.KEYS), F.lit(H.BUCKETS * H.CELLS))
    new = spark.createDataFrame(cold + [("father", "1", 3, 1)], DDL).withColumn("_cell", hot_cells).withColumn(
        table.part, (F.col("_cell") % H.BUCKETS).cast("string"))
    found = H.candidates(spark, table, held, new, 5, listed)
    in_hot_cells = new.join(new.sparkSession.createDataFrame(hot, DDL).select(hot_cells.alias("_h")), F.col("_cell") == F.col("_h"), "left_semi").count()
    assert found.filter("position = 3 AND chromosome = '1'").count() == 1
    assert found.count() == in_hot_cells < 10


def test_files_stay_few(spark, monkeypatch):
    """Ten refreshes: a bucket has few runs, and old runs, manifests and lists are deleted."""
    path = os.path.join(tempfile.mkdtemp(prefix="allelic-hot-"), "h")
    monkeypatch.setattr(H, "MOST_RUNS", 3)
    rng, rows = random.Random(2), []
    for i in range(10):
        new = [("father", "1", rng.randrange(12), 1) for _ in range(6)]
        rows += new
        H.refresh_hotspots(spark, spark.createDataFrame(new, DDL).coalesce(1), i, path, k=3)
    _, held = previous(spark, H.hotspot_table(path), 10)
    assert max(len(runs) for runs in held.values()) <= H.MOST_RUNS
    assert len(numbered(spark, os.path.join(path, "manifest"), "version=")) == 2
    assert _lists(spark, path) == _brute(rows, 3)


def test_sink_refreshes_across_compaction_and_empty_batches(spark, snps01):
    """The sink's own path, with a batch of corrupt rows first, a gap that only a base holds, and the whole table in the end."""
    out = os.path.join(tempfile.mkdtemp(prefix="allelic-hot-"), "out")
    snps = snps01.withColumn("kind", F.when(F.col("has_snp"), "snp").otherwise("token"))
    parts = [snps.filter("false")] + [snps.filter(F.pmod(F.xxhash64("snp_id"), F.lit(4)) == i) for i in range(4)]
    for i, part in enumerate(parts):
        R.write_partials(part, i, out)
        if i in (2, 3):
            R.compact(spark, out, i)  # the second one deletes the folders of batches 0 to 2
        if i in (0, 4):
            R.refresh_positions(spark, out, i)
    got = R.derived_snapshot(spark, out, "hotspots").drop("batch_id")
    want = M.position_hotspots(snps01, per_member=True).select(*got.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    pop, ref = R.population_snapshot(spark, out), M.population_heterozygosity(snps01)
    assert pop.exceptAll(ref.select(pop.columns)).count() == 0 and pop.count() == ref.count()
