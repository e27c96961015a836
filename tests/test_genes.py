"""Gene annotation: edge rows, brute force, plan shape."""
import random

import pytest
from pyspark.sql import functions as F

from allelic.operators.genes import annotate_gene, genetic_record
from allelic.schemas import GENES, INT_TYPED_GENES


def _ann(spark, rows, **kw):
    df = spark.createDataFrame([(i, c, p) for i, (c, p) in enumerate(rows)],
                               "i int, chromosome string, position int")
    return [r.gene for r in annotate_gene(df, **kw).orderBy("i").collect()]


def test_interval_ends(spark):
    assert _ann(spark, [("X", 153000000), ("X", 153500000), ("X", 153500001)]) == ["FMR1", "FMR1", "ChrX"]


def test_first_gene_wins_on_overlap(spark):
    assert _ann(spark, [("MT", 8527), ("MT", 8573), ("MT", 9207), ("chrMT", 8572)]) == \
        ["MT-ATP8", "MT-ATP6", "MT-ATP6", "MT-ATP8"]


def test_null_inputs(spark):
    assert _ann(spark, [(None, 5), ("1", None), ("", 5)]) == ["Unknown", "Unknown", "Chr"]


def test_strict_types_reproduces_int_typed_genes(spark):
    assert _ann(spark, [("17", 43100000)]) == ["BRCA1"]
    assert _ann(spark, [("17", 43100000)], strict_types=True) == ["Chr17"]


def _brute(c, p, genes, strict=False):
    if c is None or p is None:
        return "Unknown"
    n = c.upper().replace("CHR", "")
    for g, gc, s, e in genes:
        if strict and g in INT_TYPED_GENES:
            continue
        if n == gc and s <= p <= e:
            return g
    return f"Chr{n}"


@pytest.mark.parametrize("strict", [False, True])
def test_brute_force_random(spark, strict):
    rnd = random.Random(7)
    rows = []
    for _ in range(3000):
        g = rnd.choice(GENES)
        c = rnd.choice([g[1], "chr" + g[1], g[1].lower(), "1", None])
        p = rnd.choice([g[2], g[3], g[2] - 1, g[3] + 1, rnd.randint(g[2], g[3]), rnd.randint(1, 250_000_000), None])
        rows.append((c, p))
    assert _ann(spark, rows, strict_types=strict) == [_brute(c, p, GENES, strict) for c, p in rows]


def test_custom_table_and_shuffle_path(spark):
    genes = [("A", "1", 100, 200), ("B", "1", 150, 300), ("C", "2", 5_000_000, 7_500_000)]
    rows = [("1", 99), ("1", 100), ("1", 160), ("1", 201), ("1", 300), ("2", 6_999_999), ("2", 7_500_001)]
    expect = [_brute(c, p, genes) for c, p in rows]
    assert _ann(spark, rows, genes=genes, bin_size=1000) == expect
    gdf = spark.createDataFrame([(i, *g) for i, g in enumerate(genes)],
                                "priority int, gene string, chromosome string, start int, end int")
    assert _ann(spark, rows, genes=gdf, bin_size=1000) == expect


def test_plan_broadcasts_and_never_shuffles_snps(spark, snps01):
    plan = annotate_gene(snps01.select("snp_id", "chromosome", "position"))._jdf \
        .queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftOuter" in plan
    # the only exchanges belong to the small gene side (segments)
    probe = plan.split("BroadcastExchange")[0]
    assert "Exchange hashpartitioning" not in probe


def test_genetic_record(spark):
    df = spark.createDataFrame([("MT", 700, None), (None, None, ""), ("5", 10, "AG")],
                               "chromosome string, position int, genotype string")
    r = genetic_record(df).select("gene", "record_genotype", "record_chromosome", "record_position",
                                  "quality", "variant_type").collect()
    assert [tuple(x) for x in r] == [("MT-RNR1", "0/0", "MT", 700, 99, "SNP"),
                                     ("Unknown", "0/0", None, 0, 99, "SNP"),
                                     ("Chr5", "AG", "5", 10, 99, "SNP")]


def test_golden_gene_counts_sf001(spark, snps01):
    from allelic.operators.metrics import gene_frequency
    got = {r.gene: r["count"] for r in gene_frequency(snps01).collect()}
    assert len(got) == 45 and got["Unknown"] == 56
    named = {g for g, *_ in GENES}
    assert sum(v for k, v in got.items() if k in named) == 325
    expect = {"MT-RNR2": 90, "MT-RNR1": 51, "MT-ND1": 38, "MT-ND2": 36, "MT-CO1": 28, "MT-CO2": 15,
              "MT-ND5": 12, "MT-ND4": 11, "MT-ATP6": 8, "DAZ": 7, "MT-CO3": 5, "MT-CYB": 5, "AR": 4,
              "MT-ND3": 4, "BRCA1": 3, "MT-ND6": 3, "EGFR": 2, "ZFY": 2, "MT-ATP8": 1}
    assert {k: v for k, v in got.items() if k in named} == expect


def test_local_segments_equal_distributed_segments(spark):
    from allelic.operators.genes import disjoint_segments, gene_table, local_segments
    from allelic.schemas import gene_rows
    for strict in (False, True):
        dist = sorted(tuple(r) for r in disjoint_segments(gene_table(spark, strict))
                      .select("chromosome", "lo", "hi", "gene").collect())
        assert dist == sorted(local_segments(gene_rows(strict)))


def test_apply_record_defaults(spark):
    from allelic.operators.genes import apply_record_defaults
    df = spark.createDataFrame([(None, None, None, None, None, None), ("SNP", "BRCA1", "AG", "17", 5, 99)],
                               "variant_type string, gene string, genotype string, chromosome string, "
                               "position int, quality int")
    rows = [tuple(r) for r in apply_record_defaults(df).collect()]
    assert rows == [("SNP", "Unknown", "Unknown", "0", 0, 0), ("SNP", "BRCA1", "AG", "17", 5, 99)]


def test_many_overlapping_intervals(spark):
    """20,000 intervals on one chromosome, by brute force at some points, and
    no join on the chromosome alone."""
    import random

    from pyspark.sql import functions as F

    from allelic.operators.genes import disjoint_segments
    rng = random.Random(4)
    rows = []
    for i in range(20_000):
        start = rng.randint(0, 5_000_000)
        rows.append((rng.randint(0, 10 ** 6) * 20_000 + i, f"g{i}", "7", start, start + rng.choice([3, 500, 100_000, 4_000_000])))
    genes = spark.createDataFrame(rows, "priority long, gene string, chromosome string, start long, end long").repartition(8)
    points = sorted(rng.sample(range(-10, 9_100_000), 60))
    segments = disjoint_segments(genes)
    wanted = spark.createDataFrame([(p,) for p in points], "p long")
    got = {r["p"]: r["gene"] for r in segments.join(F.broadcast(wanted), (F.col("lo") <= F.col("p")) & (F.col("p") <= F.col("hi"))).collect()}
    for p in points:
        cover = [(pri, g) for pri, g, _, s, e in rows if s <= p <= e]
        assert got.get(p) == (min(cover)[1] if cover else None)
    plan = disjoint_segments(genes)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_a_chromosome_is_no_single_task(spark, monkeypatch):
    """200,000 intervals on one chromosome: the boundaries lie in many ranges,
    and the segments equal a sweep with a heap."""
    import heapq
    import random

    from allelic.operators import genes as G
    rng = random.Random(8)
    rows = []
    for i in range(200_000):
        start = rng.randint(0, 50_000_000)
        rows.append((rng.randint(0, 10 ** 6) * 200_000 + i, f"g{i}", "7", start, start + rng.choice([3, 500, 2_000])))
    genes = spark.createDataFrame(rows, "priority long, gene string, chromosome string, start long, end long").repartition(8)
    kept, real = [], G.numbered_rows

    def numbered(*a):
        kept.append(real(*a))
        return kept[-1]
    monkeypatch.setattr(G, "numbered_rows", numbered)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        segments = G.disjoint_segments(genes)
        got = {r["lo"]: (r["hi"], r["gene"]) for r in segments.collect()}
        plan = segments._jdf.queryExecution().executedPlan().toString()
        assert "row_number" not in plan and "lead(" not in plan
        assert len(kept) == 1 and kept[0].count() == len({b for r in rows for b in (r[3], r[4] + 1)})
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    bounds = sorted({b for r in rows for b in (r[3], r[4] + 1)})
    waiting, opened, at, expected = sorted((r[3], r[0], r[1], r[4]) for r in rows), [], 0, {}
    for lo, following in zip(bounds, bounds[1:]):
        while at < len(waiting) and waiting[at][0] <= lo:
            heapq.heappush(opened, waiting[at][1:])
            at += 1
        while opened and opened[0][2] < lo:
            heapq.heappop(opened)
        if opened:
            expected[lo] = (following - 1, opened[0][1])
    assert got == expected
