"""FIXTURES section 4 golden values at sf 0.01 (and row counts at 0.001 / 0.1)."""
from pyspark.sql import functions as F

from allelic.operators import family as FAM
from allelic.operators import profile as P
from allelic.plans.catalog import load_snps


def test_fixture_counts(snps01):
    r = snps01.agg(F.count(F.lit(1)).alias("rows"), F.count_if("has_snp").alias("snp"),
                   F.count_if(~F.col("has_snp")).alias("tok"),
                   F.count_distinct("family_id").alias("fam"), F.count_distinct("person_id").alias("persons"),
                   F.count_if(F.col("person_id").isNull()).alias("null_person"),
                   F.count_if(F.col("has_snp") & F.col("chromosome").isNull()).alias("null_chrom"),
                   F.count_if(F.col("has_snp") & F.col("position").isNull()).alias("null_pos")).first()
    assert tuple(r) == (10000, 9896, 104, 30, 150, 48, 31, 25)
    by_member = {x.member_type: (x.rows, x.snp) for x in snps01.groupBy("member_type").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("has_snp").alias("snp")).collect()}
    assert by_member == {"child": (6016, 5949), "father": (2024, 2004), "mother": (1960, 1943)}


def test_raw_chromosome_labels(snps01):
    got = {r.chromosome: r["count"] for r in snps01.filter("has_snp").groupBy("chromosome").count().collect()}
    assert (got["1"], got["chr1"], got["X"], got["Y"], got["MT"]) == (370, 21, 393, 417, 405)


def test_other_scale_factors(spark):
    for sf, snp, fam, persons in (("0.001", 989, 3, 15), ("0.1", 98969, 300, 1500)):
        s = load_snps(spark, f"/root/testdata/sf{sf}")
        r = s.agg(F.count_if("has_snp"), F.count_distinct("family_id"), F.count_distinct("person_id")).first()
        assert tuple(r) == (snp, fam, persons)


def test_trios_and_mendel(snps01):
    calls = FAM.genotype_calls(snps01, (F.col("snp_id") % 23).alias("locus"))
    m = FAM.mendelian_consistency(calls).agg(F.sum("trios"), F.sum("consistent")).first()
    assert tuple(m) == (1219, 287)


def test_ecdf_monotone(snps01):
    e = P.position_ecdf(snps01)
    from pyspark.sql import Window
    w = Window.partitionBy("chromosome").orderBy("position")
    bad = e.withColumn("prev", F.lag("ecdf").over(w)).filter(F.col("prev") >= F.col("ecdf")).count()
    assert bad == 0
    # knots span [0, 1): the first is 0 and the last below 1
    r = e.groupBy("chromosome").agg(F.min("ecdf").alias("lo"), F.max("ecdf").alias("hi"))
    assert r.filter((F.col("lo") != 0) | (F.col("hi") >= 1)).count() == 0
