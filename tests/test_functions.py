"""Handwritten edge rows for the Column expressions (FIXTURES section 5)."""
from pyspark.sql import functions as F

from allelic.functions import genotype as G


def _apply(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_classify_genotype(spark):
    got = _apply(spark, ["AA", "aa", "Aa", "AG", "--", "A", "", None, "11"], G.classify_genotype)
    assert got == ["dominant", "recessive", "heterozygous", "heterozygous", "recessive",
                   "invalid", "invalid", "invalid", "recessive"]


def test_genotype_orientation(spark):
    got = _apply(spark, ["0/0", "1/1", "0/1", "1/2", "2/2", "AG", "Unknown", "0/1/1", None],
                 G.genotype_orientation)
    assert got == ["recessive", "dominant", "heterozygous", "heterozygous", "heterozygous",
                   None, None, None, None]


def test_normalize_chromosome(spark):
    assert _apply(spark, ["chr17", "CHRX", "mt", None, "chrCHR1"], G.normalize_chromosome) == \
        ["17", "X", "MT", None, "1"]


def test_zygosity_and_het(spark):
    vals = ["AA", "AG", "--", "Aa", "A", "", None, "AAA"]
    assert _apply(spark, vals, G.zygosity) == \
        ["homozygous", "heterozygous", "homozygous", "heterozygous", None, None, None, None]
    assert _apply(spark, vals, G.is_het) == [0, 1, 0, 1, None, None, None, None]


def test_bucket_and_default(spark):
    assert _apply(spark, [None, "", "AG"], G.default_genotype) == ["0/0", "0/0", "AG"]
    assert _apply(spark, [None, "", "7"], lambda c: G.bucket(c, "Unknown")) == ["Unknown", "Unknown", "7"]


def test_levels(spark):
    assert _apply(spark, [6.0, 5.0, 2.5, 2.0, 0.0], G.rate_level, "double") == \
        ["high", "medium", "medium", "low", "low"]
    assert _apply(spark, [5.01, 5.0, -5.0, -5.01], G.trend_direction, "double") == \
        ["up", "stable", "stable", "down"]


def test_labels_and_keys(spark):
    df = spark.createDataFrame([("FAM_1", "child", 2, "9", 12), ("FAM_1", "father", None, "X", 5)],
                               "f string, m string, n int, c string, p int")
    r = df.select(G.person_key("f", "m", "n").alias("k"), G.hotspot_label("c", "p").alias("l")).collect()
    assert [(x.k, x.l) for x in r] == [("FAM_1_C2", "Chr9:12"), ("FAM_1_F", "ChrX:5")]
    back = df.select(G.person_key("f", "m", "n").alias("k")).select(
        G.person_role("k").alias("r"), G.child_number("k").alias("n"), G.family_of("k").alias("f")).collect()
    assert [(x.r, x.n, x.f) for x in back] == [("child", 2, "FAM_1"), ("father", None, "FAM_1")]


def test_is_rsid(spark):
    assert _apply(spark, ["rs123", "i700", None], G.is_rsid) == [True, False, None]


def test_pct_zero_denominator(spark):
    df = spark.createDataFrame([(1, 0), (1, 3)], "a int, b int")
    assert [r[0] for r in df.select(G.pct("a", "b")).collect()] == [None, 33.33]
