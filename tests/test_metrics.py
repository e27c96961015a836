"""Aggregates, time series and top-k: golden values, invariants, brute force."""
import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from allelic.operators import metrics as M
from allelic.operators import timeseries as TS
from allelic.operators.topk import top_k

SNP_DDL = ("snp_id long, ts timestamp_ntz, family_id string, member_type string, person_id string, "
           "gender string, has_snp boolean, chromosome string, position int, genotype string, gt_num string")


def _snps(spark, rows):
    base = dt.datetime(2024, 1, 1)
    full = []
    for i, r in enumerate(rows):
        d = dict(snp_id=i, ts=base, family_id="F1", member_type="child", person_id="F1_C1",
                 gender="Male", has_snp=True, chromosome="1", position=100, genotype="AA", gt_num="0/0")
        d.update(r)
        full.append(tuple(d[k] for k in ["snp_id", "ts", "family_id", "member_type", "person_id", "gender",
                                         "has_snp", "chromosome", "position", "genotype", "gt_num"]))
    return spark.createDataFrame(full, SNP_DDL)


def test_heterozygosity_edge(spark):
    df = _snps(spark, [{"genotype": g} for g in ["AG", "CT", "AC", "GG", "A", None, ""]])
    r = M.population_heterozygosity(df).collect()[0]
    assert (r.heterozygous_pct, r.homozygous_pct, r.diversity, r.total_snps) == (75.0, 25.0, 0.375, 4)
    i = M.individual_heterozygosity(df).collect()[0]
    assert (i.heterozygous, i.homozygous, i.total_snps) == (3, 1, 4)


def test_population_golden_sf001(snps01):
    got = {r.member_type: (r.heterozygous, r.total_snps) for r in M.population_heterozygosity(snps01).collect()}
    assert got == {"child": (2388, 4891), "father": (824, 1645), "mother": (809, 1574)}


def test_hotspots_golden_sf001(snps01):
    top = [(r.chromosome, r.position, r.frequency) for r in M.position_hotspots(snps01).orderBy("rank").collect()]
    assert top[:3] == [("9", 2200000, 8), ("12", 34500000, 7), ("12", 218500000, 7)]


def test_invariants_sf001(snps01):
    valid = snps01.filter("has_snp").count()
    assert valid == 9896
    cd = M.chromosome_distribution(snps01)
    assert cd.agg(F.sum("count")).first()[0] == valid
    tot = cd.select("member_type", "chromosome", "chromosome_total").distinct().agg(F.sum("chromosome_total"))
    assert tot.first()[0] == valid
    gt = M.genotype_trends(snps01)
    for r in gt.groupBy("member_type").agg(F.sum("pct").alias("s")).collect():
        assert abs(r.s - 100.0) < 0.1
    ind = M.individual_heterozygosity(snps01)
    assert ind.filter(F.col("heterozygous") + F.col("homozygous") != F.col("total_snps")).count() == 0
    rt = {r.member_type: r.total_records for r in M.running_totals(snps01).collect()}
    assert rt["all"] == valid == rt["child"] + rt["father"] + rt["mother"]
    assert (rt["child"], rt["father"], rt["mother"]) == (5949, 2004, 1943)


def test_orientation_always_three_keys(spark):
    df = _snps(spark, [{"genotype": "A"}, {"genotype": None}])
    rows = {r.orientation: r["count"] for r in M.orientation_distribution(df).collect()}
    assert rows == {"dominant": 0, "recessive": 0, "heterozygous": 0}
    assert M.orientation_percentages(df).count() == 0
    assert M.gene_diversity(df, style="letters").first().gene_diversity == 0.0


def test_gt_num_golden_sf001(snps01):
    got = {r.gt_num: r["count"] for r in snps01.filter("has_snp").groupBy("gt_num").count().collect()}
    assert got == {"0/0": 3465, "0/1": 2909, "1/1": 1736, "1/2": 605, "AG": 590, "Unknown": 591}


def test_rate_anomaly_edges(spark):
    t0 = dt.datetime(2024, 1, 1, 0, 0, 0)
    # six events inside the last 10 s and no older ones: n10 = n60 = 6
    six = _snps(spark, [{"ts": t0 + dt.timedelta(seconds=55 + i)} for i in range(6)])
    last = TS.rate_anomaly(six, 10, 60, 2.5).orderBy(F.desc("ts")).first()
    assert (last.n_short, last.n_long, last.is_anomaly, last.severity) == (6, 6, True, "medium")
    # a token only: no valid events, so expected = 0 -> normal
    none = _snps(spark, [{"has_snp": False}])
    assert TS.rate_anomaly(none, 10, 60).count() == 0


def _brute_counts(ts_list, width_s):
    out = {}
    for t in ts_list:
        out[t] = sum(1 for u in ts_list if (t - u).total_seconds() < width_s and u <= t)
    return out


def test_rate_series_matches_brute_force(spark):
    rnd = random.Random(3)
    t0 = dt.datetime(2024, 1, 1)
    stamps = sorted({t0 + dt.timedelta(microseconds=rnd.randint(0, 400 * 10**6)) for _ in range(400)})
    # duplicates at one instant and events exactly w apart
    stamps += [stamps[10], stamps[20] + dt.timedelta(seconds=60), stamps[20] + dt.timedelta(seconds=30)]
    rows = [{"ts": t, "member_type": rnd.choice(["father", "child"])} for t in stamps]
    df = _snps(spark, rows)
    got = {(r.member_type, r.ts): (r.n_60s, r.n_30s) for r in
           TS.rate_series(df, (60, 30), by=["member_type"]).collect()}
    for m in ["father", "child"]:
        ts_m = [r["ts"] for r in rows if r["member_type"] == m]
        b60, b30 = _brute_counts(ts_m, 60), _brute_counts(ts_m, 30)
        for t in set(ts_m):
            assert got[(m, t)] == (b60[t], b30[t])


def test_top_k_per_group_equals_single_stage(spark):
    rnd = random.Random(5)
    rows = [(rnd.choice("abc"), rnd.randint(0, 50), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, v int, i int")
    order = [F.desc("v"), F.asc("i")]
    got = sorted(tuple(r) for r in top_k(df, order, 7, by=["g"], rank_col="rank").collect())
    ref = (df.withColumn("rank", F.row_number().over(Window.partitionBy("g").orderBy(*order)).cast("long"))
           .filter("rank <= 7"))
    assert got == sorted(tuple(r) for r in ref.collect())


def test_window_counts_mean_time(spark):
    t0 = dt.datetime(2024, 1, 1, 0, 0, 10)
    df = _snps(spark, [{"ts": t0}, {"ts": t0 + dt.timedelta(seconds=20)}, {"ts": t0, "has_snp": False}])
    r = M.window_counts(df, "1 minute").first()
    assert (r.total_records, r.valid_records) == (3, 2)
    assert r.avg_epoch_us == int((t0 - dt.datetime(1970, 1, 1)).total_seconds() * 1e6) + 6_666_666


def test_downsample(spark):
    df = spark.createDataFrame([(i,) for i in range(25)], "i int")
    got = [r.i for r in TS.downsample(df, 10, "i").orderBy("i").collect()]
    # step = ceil(25/10) = 3 -> 0,3,...,24 (9 rows) -> last 10 = all of them
    assert got == list(range(0, 25, 3))
    got = [r.i for r in TS.downsample(df, 5, "i").orderBy("i").collect()]
    assert got == [0, 5, 10, 15, 20]  # step 5 -> five rows, all within the last 5


def test_sequence_matches_row_number(spark):
    rnd = random.Random(4)
    rows = [(rnd.choice("ab"), i * 7 + rnd.randint(0, 3), i) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, t long, i int")
    got = {(r.g, r.t): r.seq for r in TS.sequence(df, ["g"], "t").collect()}
    for g in "ab":
        ts = sorted(t for gg, t, _ in rows if gg == g)
        assert [got[(g, t)] for t in ts] == list(range(len(ts)))
    big = spark.createDataFrame([(i,) for i in range(1000)], "i int")
    got = [r.i for r in TS.downsample(big, 30, "i").orderBy("i").collect()]
    ref = [i for i in range(1000) if i % 34 == 0][-30:]
    assert got == ref


def test_gene_diversity_approximate_close(snps01):
    exact = M.gene_diversity(snps01).first()
    approx = M.gene_diversity(snps01, approximate=True).first()
    assert exact.distinct_genes == 45
    assert abs(approx.distinct_genes - exact.distinct_genes) <= 3


def test_flagship_plan_prunes_and_shuffles_once(snps01):
    plan = M.population_heterozygosity(snps01)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,value:double>" in plan
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_sum" in plan and "partial_count" in plan


def test_top_k_with_map_column(spark):
    df = spark.createDataFrame([("a", i, {"k": i}) for i in range(20)], "g string, v int, m map<string,int>")
    got = [r.v for r in top_k(df, [F.desc("v")], 3, by=["g"]).orderBy(F.desc("v")).collect()]
    assert got == [19, 18, 17]


def test_rate_series_rejects_fractional_widths(spark):
    import pytest
    df = _snps(spark, [{}])
    with pytest.raises(ValueError):
        TS.rate_series(df, (0.5,))
